"""Delimited files whose headers differ and need not come first, and records in running text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.rules import first_pattern, place_suffix
from ..functions.text import clean_spaces, strip_accents, text, title_case

SEPARATORS = (",", ";", "\t", "|")


def fields(line: Column, sep: Column) -> Column:
    """The cells of a line: quoted ones may hold the separator and doubled quotes."""
    outside = F.concat(F.lit("["), sep, F.lit(r'](?=(?:[^"]*"[^"]*")*[^"]*$)'))
    quoted = lambda c: F.trim(c).rlike('^".*"$')
    bare = lambda c: F.replace(F.regexp_replace(F.trim(c), '^"|"$', ""), F.lit('""'), F.lit('"'))
    return F.transform(F.split(line, outside), lambda c: F.when(quoted(c), bare(c)).otherwise(F.trim(c)))


def read_tabular(spark: SparkSession, path: str, word: str, roles: dict[str, list[tuple[str, ...]]], required: tuple[str, ...], within: int = 15) -> DataFrame:
    """(file, roles...) of the rows of all files below a folder, all text, empty where a file has no such column.

    A file's header is the first of its first ``within`` lines that holds ``word``, and its separator the one that the header has
    most of.  A role's column is the first whose title holds every part of the role's first alternative that any title
    holds; accents and letter case aside.  Files without a header, or without a column for a required role, give no rows;
    neither do blank lines.  Cells do not run over lines.  Files are split as Spark likes: a header is found by file and
    position in one aggregation, and joined to the file's lines with the places of its columns."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.regexp_replace("value", "^﻿|\r$", "").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    start = lines.where("block = 0")  # ids of a split go up by one a line
    holds = F.lower("line").contains(word.lower())
    heads = start.groupBy("file").agg(F.min("at").alias("first"), F.min(F.when(holds, F.struct("at", "line"))).alias("head")).where(F.col("head.at") - F.col("first") < within)
    counted = F.array(*[F.struct((F.length("head.line") - F.length(F.replace("head.line", F.lit(s), F.lit("")))).alias("n"), F.lit(-k).alias("k"), F.lit(s).alias("s")) for k, s in enumerate(SEPARATORS)])
    heads = heads.select("file", F.col("head.at").alias("head"), "head.line", F.array_max(counted)["s"].alias("sep"))
    heads = heads.withColumn("titles", F.transform(fields(F.col("line"), F.col("sep")), lambda t: F.lower(strip_accents(t))))

    def first(parts: tuple[str, ...]) -> Column:
        found = F.transform("titles", lambda t: F.forall(F.array(*map(F.lit, parts)), lambda p: t.contains(p)))
        return F.nullif(F.array_position(found, True), F.lit(0))

    def place(alternatives: list[tuple[str, ...]]) -> Column:
        return F.coalesce(*map(first, alternatives))

    heads = heads.select("file", "head", "sep", F.create_map(*[x for r, a in roles.items() for x in (F.lit(r), place(a).cast("int"))]).alias("places"))
    heads = heads.where(F.forall(F.array(*map(F.lit, required)), lambda r: F.element_at("places", r).isNotNull()))
    rows = lines.where(F.trim("line") != "").join(heads, "file").where((F.col("block") > 0) | (F.col("at") > F.col("head")))
    cells = rows.select("file", "places", fields(F.col("line"), F.col("sep")).alias("cells"))
    value = lambda r: F.when(F.element_at("places", r) > 0, F.try_element_at("cells", F.element_at("places", r)))
    return cells.select("file", *[F.coalesce(value(r), F.lit("")).alias(r) for r in roles])


def closed_by(body: Column, anchor: str) -> Column:
    """array<struct(part, anchor)>: the text cut after each match of a pattern; what follows the last match is left out."""
    ends = F.regexp_extract_all(body, F.lit(f"({anchor})"), F.lit(1))
    return F.zip_with(F.slice(F.split(body, anchor), F.lit(1), F.size(ends)), ends, lambda p, a: F.struct(p.alias("part"), a.alias("anchor")))


#: What stands in an institution's published directory: fixed patterns of its layout.
HEADING = r"(?s)No\. Apellidos y Nombres.*?Correo Electr[oó]nico institucional"
NOTICE = r"Art\. 7 de la Ley.*?\n|Literal b1\).*?\n|logotipo institucional imagen jpg"
ADDRESS, PERSON, PHONE = r"[\w.+-]+@[\w.-]+\.\w+", r"(?iu)^\d+ (.+?) (M[EÉ]DICO/A .+)$", r" (\(593\)\s*0?\d[\d ]{6,10}\d|0\d{8})\b"


def directory_record(name: Column, post: Column, place: Column, phone: Column, email: Column, posts: list[tuple[str, str]], cities: list[str]) -> Column:
    """struct(name, category, city, phone, email) of a directory's entry, or null if its post or city is not one of those known."""
    category, city = first_pattern(post, posts), place_suffix(place, cities)
    mail = F.trim(email)
    whole = F.when(F.lower(mail).endswith(".gob"), F.concat(mail, F.lit(".ec"))).otherwise(mail)  # cut off by the end of a line
    short = F.regexp_replace(F.trim(phone), r"^\(?593\)?\s*", "")
    return F.when(category.isNotNull() & city.isNotNull(), F.struct(title_case(F.trim(name)).alias("name"), category.alias("category"), city.alias("city"), short.alias("phone"), whole.alias("email")))


def directory_text(df: DataFrame, keep: list[str], body: str, posts: list[tuple[str, str]], cities: list[str]) -> DataFrame:
    """The entries of directories that come as running text: each ends with its address, and within it stand a number, a name, a post
    that ends with a city, and a phone.  Entries without a phone, or of another post or city, go; a text without an
    address has none.  Texts are whole; entries do not run from one text to the next."""
    clean = F.regexp_replace(F.regexp_replace(text(body), HEADING, ""), NOTICE, "")
    parts = df.select(*keep, F.explode(closed_by(clean, ADDRESS)).alias("_rl_e"))
    entry = clean_spaces(F.col("_rl_e.part"))
    rest = F.regexp_extract(entry, PERSON, 2)
    split = parts.select(*keep, F.regexp_extract(entry, PERSON, 1).alias("_rl_n"), rest.alias("_rl_r"), F.regexp_extract(rest, PHONE, 1).alias("_rl_p"), F.element_at(F.split(rest, PHONE), 1).alias("_rl_b"), F.col("_rl_e.anchor").alias("_rl_a"))
    found = split.where("_rl_r <> '' and _rl_p <> ''").withColumn("_rl_d", directory_record(F.col("_rl_n"), F.col("_rl_r"), F.col("_rl_b"), F.col("_rl_p"), F.col("_rl_a"), posts, cities))
    return found.where("_rl_d is not null").select(*keep, "_rl_d.*")

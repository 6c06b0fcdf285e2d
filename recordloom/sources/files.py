"""Delimited and JSON sources, and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROLES = {
    "category": ("especialidad", "specialty"), "name": ("nombre", "name", "medico", "médico"), "email": ("email", "correo", "e-mail"),
    "phone": ("telefono", "teléfono", "phone"), "comment": ("comentario", "comment"), "assigned": ("asignado", "assigned"),
}

_CONTROLS = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_WINDOWS = ("".join(map(chr, _CONTROLS)), bytes(_CONTROLS).decode("cp1252"))


def read_delimited(spark: SparkSession, path: str, sep: str = ",", encodings: tuple[str, ...] = ("utf-8",), columns: list[str] | None = None) -> DataFrame:
    """All-string rows, nulls as empty strings; the first encoding that decodes without replacement characters is used.

    ``columns`` renames the leading columns by position, whatever the header says."""
    df = None
    for encoding in encodings:
        windows = encoding.lower() in ("cp1252", "windows-1252")  # read as Latin-1, then put right
        df = spark.read.option("sep", sep).option("header", True).option("encoding", "iso-8859-1" if windows else encoding).option("multiLine", True).option("escape", '"').csv(path)
        if windows:
            df = df.select(*[F.translate(f"`{c}`", *_WINDOWS).alias(c) for c in df.columns])
        if not df.columns or df.where(F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns]).contains("�")).limit(1).count() == 0:
            break
    if columns:
        df = df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, columns)])
    return df.na.fill("")


def bind_roles(df: DataFrame, required: tuple[str, ...] = ("category", "name"), roles: dict | None = None) -> DataFrame:
    """Columns by role: the first header, in header order, that is an alias; a missing required role is an error."""
    roles, found = roles or ROLES, {}
    for c in df.columns:
        for role, names in roles.items():
            if c.strip().lower() in names:
                found.setdefault(role, c)
    if missing := [r for r in required if r not in found]:
        raise ValueError(f"no column for {', '.join(missing)}")
    return df.select(*[F.col(f"`{found[r]}`").alias(r) if r in found else F.lit("").alias(r) for r in roles])


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines that hold no whole object are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def open_envelope(df: DataFrame, raw: str, schema: str) -> DataFrame:
    """The Data of {Type, Data}, which may itself be a JSON string; null if Type is not 0."""
    inner = F.get_json_object(raw, "$.Data")
    return df.withColumn("data", F.when(F.get_json_object(raw, "$.Type") == "0", F.from_json(inner, schema)))


def with_contact(df: DataFrame, phone: str, address: str, site: str) -> DataFrame:
    """Rows of an institution's one answer, each with the institution's own contacts."""
    return df.withColumns({"phone": F.lit(phone), "address": F.lit(address), "site": F.lit(site)})


def fresh_snapshots(df: DataFrame, url: str, fetched: str, now, days: int = 7) -> DataFrame:
    """The latest snapshot of each url, no older than ``days``."""
    keyed = df.withColumn("url_key", F.substring(F.sha2(F.col(url), 256), 1, 16))
    fresh = keyed.where(F.col(fetched) > now - F.expr(f"INTERVAL {days} DAYS"))
    return fresh.groupBy("url_key").agg(F.max_by(F.struct(*[c for c in df.columns]), fetched).alias("s")).select("url_key", "s.*")


#: Answers that mean no: status codes, and words near the beginning of a page. Fixed values.
REFUSALS, HEAD = (403, 429, 503), 5000
HINTS = ("captcha", "cf-chl", "are you a robot", "verifica que eres humano", "access denied", "blocked", "challenge-platform")


def refused(html: Column, status: Column) -> Column:
    """Whether a site has refused an answer, by its status or by what the page begins with."""
    head = F.lower(F.substring(F.coalesce(html, F.lit("")), 1, HEAD))
    return status.isin(*REFUSALS) | F.exists(F.array(*map(F.lit, HINTS)), lambda h: head.contains(h))


def settled(wanted: DataFrame, cache: DataFrame, answers: DataFrame, url: str, fetched: str, html: str, status: str, now, days: int = 7) -> DataFrame:
    """Each wanted url with its state and page: cached, if the cache has a snapshot no older than ``days``; else fetched, if an answer
    came that is no refusal, the last of several; else refused, if one came; else missing.  Only pages of the first two
    are given, and urls that are wanted twice come once."""
    fresh = cache.where(F.col(fetched) > now - F.expr(f"INTERVAL {days} DAYS")).groupBy(url).agg(F.max_by(html, fetched).alias("_rl_c"), F.count(F.lit(1)).alias("_rl_n"))
    good = F.when(~refused(F.col(html), F.col(status)), F.struct(F.col(fetched).alias("at"), F.col(html).alias("page")))
    came = answers.groupBy(url).agg(F.max(good).alias("_rl_g"), F.count(F.lit(1)).alias("_rl_m"))
    j = wanted.select(url).where(F.col(url).isNotNull()).distinct().join(fresh, url, "left").join(came, url, "left")
    state = F.when(F.col("_rl_n") > 0, "cached").when(F.col("_rl_g").isNotNull(), "fetched").when(F.col("_rl_m") > 0, "refused").otherwise("missing")
    return j.select(url, state.alias("state"), F.when(F.col("_rl_n") > 0, F.col("_rl_c")).otherwise(F.col("_rl_g.page")).alias(html))


def write_sheets(sheets: dict[str, DataFrame], folder: str, kind: str = "parquet") -> None:
    """One folder per sheet; each is written beside its place and then takes it.  The old one is put aside until the new one is
    there, and comes back if that fails."""
    for name, df in sheets.items():
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path
        mark = uuid.uuid4().hex
        target, fresh, aside = path(f"{folder}/{name}"), path(f"{folder}/.{name}-{mark}"), path(f"{folder}/.{name}-{mark}-before")
        df.write.format(kind).option("header", True).save(fresh.toString())
        store = target.getFileSystem(sc._jsc.hadoopConfiguration())
        there = store.exists(target)
        if there and not store.rename(target, aside):
            raise OSError(f"{target} could not be put aside")
        if not store.rename(fresh, target):
            if there:
                store.rename(aside, target)
            raise OSError(f"{fresh} could not take the place of {target}")
        store.delete(aside, True)


def append(df: DataFrame, path: str, kind: str = "json") -> None:
    """Add part files to a folder; of delimited ones each has a header, as whoever reads them needs only one file."""
    df.write.mode("append").option("header", True).format(kind).save(path)


def report(rows: DataFrame, path: str) -> None:
    """A report of metrics (metric, value) as one JSON object in one file; metrics are few, whatever they count."""
    whole = rows.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value"))))).alias("value"))
    whole.coalesce(1).write.mode("overwrite").text(path)

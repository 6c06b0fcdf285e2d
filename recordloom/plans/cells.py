"""Queries of names, cells and file formats, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import contacts, ratio, text
from ..operators import matching
from ..runtime import run_folder, ship, table
from ..sources import files
from .book import query as _query
from .names import _NAME, _ratio, _sorted

_WORD_SQL = "'w' || translate(CAST({k} AS VARCHAR), '0123456789', 'abcdefghij')"


def _word(k: Column) -> Column:
    return F.concat(F.lit("w"), F.translate(k.cast("string"), "0123456789", "abcdefghij"))


def _title(c: str) -> str:
    return f"array_to_string(list_transform(list_filter(string_split({c}, ' '), lambda w: w <> ''), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


_GIVEN_SQL = f"""WITH k AS (SELECT client_id AS id, client_id % 6 AS v, upper({_WORD_SQL.format(k='client_id')}) AS a, upper({_WORD_SQL.format(k='client_id * 7')}) AS b, coalesce(segment, '') AS segment FROM clients),
  n AS (SELECT *, CASE v WHEN 3 THEN 'DEL ' || a WHEN 5 THEN 'DE LOS SANTOS' ELSE a END AS f1, CASE v WHEN 0 THEN NULL WHEN 4 THEN NULL WHEN 2 THEN 'DE LA ' || b WHEN 5 THEN a ELSE b END AS f2,
    CASE v WHEN 2 THEN 'ANA MARIA' WHEN 3 THEN 'LUIS' WHEN 4 THEN '' ELSE 'ANA' END AS g FROM k),
  p AS (SELECT *, trim(f1 || ' ' || coalesce(f2, '')) AS f FROM n)"""


@_query(_GIVEN_SQL + f""" SELECT id, f1, f2, g, {_title('f')} || CASE WHEN g = '' THEN '' ELSE ', ' || {_title('g')} END AS display, array_to_string(list_transform(list_filter(list_concat([f1, coalesce(f2, '')], string_split(g, ' ')), lambda w: w <> ''), lambda w: w[1]), '.') || '.' AS initials,
    list_filter(string_split(lower(trim(f || ' ' || g)), ' '), lambda w: w <> '') AS tokens, 'CR|' || segment || '|' || lower(f1[1:3]) AS block, list_sort(list_distinct(list_filter(string_split(f || ' ' || g, ' '), lambda w: length(w) >= 4))) AS key FROM p""")
def given_first_names(spark, sf) -> DataFrame:
    """Names in the order given, family, family, with particles of one and two words, and what is made of them."""
    k, t = F.col("client_id"), table(spark, sf, "clients")
    a, b = _word(k), _word(k * 7)
    forms = [("Ana ", a), ("Ana  ", a, " ", b), ("Ana Maria ", a, " De La ", b), ("Luis del ", a, "\n", b), (" ", a), ("ana de los santos ", a)]
    whole = F.element_at(F.array(*[F.concat(*[F.lit(x) if isinstance(x, str) else x for x in f]) for f in forms]), (k % 6 + 1).cast("int"))
    n = F.col("n")
    return t.select(k.alias("id"), "segment", whole.alias("whole"), text.parse_given_first(whole).alias("n")).select(
        "id", n["family_name_1"].alias("f1"), n["family_name_2"].alias("f2"), n["given_name"].alias("g"), text.display_name(n).alias("display"), text.initials(n).alias("initials"), text.fuzzy_tokens(n).alias("tokens"),
        text.block_key(n, F.lit("CR"), F.col("segment")).alias("block"), text.name_key("whole").alias("key"))


_VARIANTS = {"pediatria": ["PEDIATRIA", "PEDIATRA"], "cardiologia": ["CARDIOLOGIA", "CARDIOLOGO"]}


@_query(f"""SELECT client_id, CASE client_id % 3 WHEN 0 THEN 'Dra' WHEN 1 THEN 'dr' ELSE '' END AS title, CASE client_id % 3 WHEN 0 THEN 'Ana Soto' ELSE coalesce(trim(name), '') END AS rest,
    {_NAME.format(c="coalesce(name, '')")} AS plain, list_filter(string_split({_NAME.format(c="coalesce(name, '')")}, ' '), lambda t: length(t) > 1 AND t NOT IN ('DR', 'DRA', 'DOCTOR', 'DOCTORA', 'MD', 'MG', 'ESP', 'MSC', 'LIC')) AS words,
    coalesce(regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+'), false) AS loose, CASE client_id % 4 WHEN 0 THEN '+57 310 ' || lpad(CAST(client_id AS VARCHAR), 7, '0') WHEN 1 THEN '+57 601 ' || lpad(CAST(client_id AS VARCHAR), 7, '0') WHEN 2 THEN '12 34' ELSE '' END AS phone,
    CASE client_id % 4 WHEN 0 THEN '310' || lpad(CAST(client_id AS VARCHAR), 7, '0') ELSE 'none' END AS first_phone, 'q%20%26' || client_id AS quoted,
    CASE client_id % 5 WHEN 0 THEN 'pediatria' WHEN 1 THEN 'cardiologia' WHEN 2 THEN 'pediatria' END AS code FROM clients""")
def cell_forms(spark, sf) -> DataFrame:
    """Titles, plain names, words, loose addresses, phones of a country that keeps what it cannot read, first values, quoted text, and
    categories by their nearest known name."""
    ship(spark)
    k = F.col("client_id")
    titled = F.when(k % 3 == 0, F.lit(" Dra.  Ana Soto")).when(k % 3 == 1, F.concat(F.lit("dr "), text.text("name"))).otherwise(text.text("name"))
    number = F.lpad(k.cast("string"), 7, "0")
    phone = F.when(k % 4 == 0, F.concat(F.lit("(310) "), number)).when(k % 4 == 1, F.concat(F.lit("+57 601-"), number)).when(k % 4 == 2, "12 34").otherwise("")
    first = F.when(k % 4 == 0, F.array(F.lit(None), F.lit(" "), F.concat(F.lit("310"), number), F.lit("x"))).otherwise(F.array(F.lit(None).cast("string"), F.lit("")))
    raw = F.when(k % 5 == 0, " pediatría").when(k % 5 == 1, "CARDIOLOGA").when(k % 5 == 2, "PEDIATRIAS").when(k % 5 == 3, "zzz")
    split = text.split_title(titled)
    return table(spark, sf, "clients").select("client_id", split["title"].alias("title"), split["rest"].alias("rest"), text.match_name("name").alias("plain"), text.registry_tokens("name").alias("words"), contacts.loose_email("email").alias("loose"),
                                             contacts.phone_or_raw(phone, "CO").alias("phone"), text.first_value(first, F.lit("none")).alias("first_phone"), text.quoted(F.concat(F.lit("q &"), k.cast("string"))).alias("quoted"), contacts.nearest_category(raw, _VARIANTS).alias("code"))


@_query("""WITH c AS (SELECT client_id, coalesce(name, '') AS name, coalesce(email, '') AS email FROM clients)
  SELECT 'delimited' AS kind, client_id, name, email FROM c UNION ALL SELECT 'lines', client_id, name, email FROM c WHERE client_id % 10 <> 0 UNION ALL SELECT 'array', client_id, name, email FROM c
  UNION ALL SELECT 'envelope', client_id, name, email FROM c WHERE client_id % 7 <> 0 UNION ALL SELECT 'log', client_id, name, email FROM c UNION ALL SELECT 'log', client_id, name, email FROM c""")
def file_formats(spark: SparkSession, sf) -> DataFrame:
    """Clients written in five formats and read again: a delimited file in a Windows code page, JSON lines of which some are cut off,
    JSON arrays, answers whose data is JSON in JSON or an error, and a log that is appended to twice."""
    folder = run_folder(spark, "formats")
    c = table(spark, sf, "clients").select("client_id", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("email", F.lit("")).alias("email"))
    c.select("client_id", F.col("name").alias("Médico"), F.col("email").alias("Correo")).write.option("sep", ";").option("header", True).option("encoding", "iso-8859-1").csv(f"{folder}/delimited")
    one = F.to_json(F.struct("client_id", "name", "email"))
    c.select(F.when(F.col("client_id") % 10 == 0, F.substr(one, F.lit(1), F.length(one) - 3)).otherwise(one)).write.text(f"{folder}/lines")
    rows = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("client_id", one.alias("j")))), lambda x: x["j"]), ",\n")
    arrays = c.groupBy(F.floor(F.col("client_id") / 100).alias("part")).agg(F.concat(F.lit("["), rows, F.lit("]")).alias("value"))
    arrays.write.partitionBy("part").text(f"{folder}/array")
    data = F.when(F.col("client_id") % 2 == 0, F.to_json(F.struct(one.alias("Data")))).otherwise(F.concat(F.lit('{"Data":'), one, F.lit("}")))
    answer = F.concat(F.lit('{"Type":'), (F.col("client_id") % 7 == 0).cast("int"), F.lit(","), F.substr(data, F.lit(2), F.length(data)))
    answers = c.select(answer.alias("raw"))
    for _ in range(2):
        files.append(c, f"{folder}/log")
    schema = "client_id long, name string, email string"
    delimited = files.bind_roles(files.read_delimited(spark, f"{folder}/delimited", ";", ("utf-8", "cp1252")), ("name", "email"), {"client_id": ("client_id",), "name": ("médico", "nombre"), "email": ("correo",)})
    found = {"delimited": delimited.withColumn("client_id", F.col("client_id").cast("long")), "lines": files.read_json_lines(spark, f"{folder}/lines", schema), "array": files.read_json_array(spark, f"{folder}/array", schema).drop("part"),
             "envelope": files.open_envelope(answers, "raw", f"struct<{schema.replace(' ', ':').replace(',:', ',')}>").where("data is not null").select("data.*"), "log": spark.read.schema(schema).json(f"{folder}/log")}
    out = None
    for kind, df in found.items():
        df = df.select(F.lit(kind).alias("kind"), "client_id", "name", "email")
        out = df if out is None else out.unionByName(df)
    return out


@_query(f"""WITH n AS (SELECT DISTINCT p_name AS n, list_distinct(list_filter(string_split(p_name, ' '), lambda w: w <> '')) AS t FROM part), q AS (SELECT x.n AS p_name, y.n AS q_name, {_sorted('x.n')} AS a, {_sorted('y.n')} AS b FROM n x JOIN n y ON x.n < y.n AND len(list_intersect(x.t, y.t)) > 0)
  SELECT p_name, q_name, {_ratio('a', 'b')} AS score FROM q""")
def fuzzy_pairs(spark, sf) -> DataFrame:
    ship(spark)
    names = table(spark, sf, "part").select("p_name").distinct().select("p_name", text.tokens("p_name").alias("t"))
    other = names.withColumnsRenamed({"p_name": "q_name", "t": "u"})
    pairs = matching.shared_tokens(names, other, "p_name", "q_name", "t", "u", 1).where("p_name < q_name")
    return pairs.select("p_name", "q_name", ratio.scorer("token_sort")("p_name", "q_name").alias("score"))

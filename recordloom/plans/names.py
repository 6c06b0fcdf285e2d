"""Queries that compare names by string ratios, each beside SQL that works the ratios out itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import contacts, ratio, scores, text
from ..operators import calibration, consolidating, matching
from ..runtime import ship, table
from .book import query as _query


def _lcs(a: str, b: str) -> str:
    """SQL for the length of the longest common subsequence of two columns of under 120 characters, by one bit a character."""
    bits = f"list_sum(list_transform(range(length({a})), lambda i: CASE WHEN {a}[i + 1] = c THEN 1::HUGEINT << i::INTEGER ELSE 0::HUGEINT END))"
    full = f"((1::HUGEINT << length({a})) - 1)"
    steps = f"list_reduce(list_concat([{full}], list_transform(string_split({b}, ''), lambda c: {bits})), lambda s, m: ((s + (s & m::HUGEINT)) | (s - (s & m::HUGEINT))) & {full})"
    return f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE length({a}) - bit_count({steps}) END)"


def _ratio(a: str, b: str) -> str:
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {_lcs(a, b)} / (length({a}) + length({b})) END)"


def _sorted(a: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({a}, ' '), lambda w: w <> '')), ' ')"


#: From a table p with sorted distinct word lists x and y: their token set ratio as the column s.
_TOKEN_SET = f"""SELECT * EXCLUDE (head, l, r, one, two), CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0::DOUBLE WHEN head <> '' AND (l = '' OR r = '') THEN 100.0::DOUBLE WHEN head = '' THEN {_ratio('l', 'r')}
  ELSE greatest({_ratio('one', 'two')}, 200.0::DOUBLE * length(head) / (length(head) + length(one)), 200.0::DOUBLE * length(head) / (length(head) + length(two))) END AS s
  FROM (SELECT *, head || ' ' || l AS one, head || ' ' || r AS two FROM (SELECT *, array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') AS head,
    array_to_string(list_filter(x, lambda w: NOT list_contains(y, w)), ' ') AS l, array_to_string(list_filter(y, lambda w: NOT list_contains(x, w)), ' ') AS r FROM p))"""
_PLAIN = "translate({c}, '" + text.ACCENTED + "', '" + text.PLAIN + "')"
_NAME = f"trim(regexp_replace(regexp_replace(upper({_PLAIN.format(c='{c}')}), '[^A-Z ]', ' ', 'g'), ' +', ' ', 'g'))"
_WORDS = "list_sort(list_distinct(list_filter(string_split({c}, ' '), lambda t: length(t) >= 3 AND NOT list_contains([" + ", ".join(f"'{p}'" for p in text.MATCH_PARTICLES) + "], t))))"


@_query(f"""WITH n AS (SELECT DISTINCT master_id, {_NAME.format(c='name')} AS n FROM clients WHERE name IS NOT NULL AND master_id IS NOT NULL),
  q AS (SELECT master_id, u.n AS a, v.n AS b FROM n u JOIN n v USING (master_id) WHERE u.n < v.n),
  p AS (SELECT *, {_sorted('a')} AS sa, {_sorted('b')} AS sb, list_sort(list_distinct(string_split(a, ' '))) AS x, list_sort(list_distinct(string_split(b, ' '))) AS y FROM q)
  SELECT master_id, a, b, round({_ratio('a', 'b')}, 6) AS plain, round({_ratio('sa', 'sb')}, 6) AS token_sort, round(s, 6) AS token_set FROM ({_TOKEN_SET})""")
def name_ratios(spark, sf) -> DataFrame:
    """The three ratios of the different names of one master record."""
    ship(spark)
    n = table(spark, sf, "clients").where("name is not null and master_id is not null").select("master_id", text.match_name("name").alias("a")).distinct()
    pairs = n.join(n.withColumnRenamed("a", "b"), "master_id").where("a < b")
    return pairs.select("master_id", "a", "b", *[F.round(ratio.scorer(f)("a", "b"), 6).alias(c) for f, c in (("ratio", "plain"), ("token_sort", "token_sort"), ("token_set", "token_set"))])


_SIDES = f"""c AS (SELECT client_id AS id, source, coalesce(email, '') AS email, {_NAME.format(c="coalesce(city, '')")} AS place, regexp_extract(name, '^(\\S*)\\s*(.*)$', 1) AS f, regexp_extract(name, '^(\\S*)\\s*(.*)$', 2) AS r, name, coalesce(city, '') AS city
    FROM clients WHERE name IS NOT NULL),
  d AS (SELECT id, place, {_NAME.format(c="CASE WHEN id % 4 = 0 THEN name || ' ' || city ELSE name END")} AS n FROM c WHERE source <> 'crm'),
  g AS (SELECT id, place, email, {_NAME.format(c="CASE id % 3 WHEN 0 THEN f || ' ' || city || ' ' || r WHEN 1 THEN replace(name, 'er', 'ar') ELSE name END")} AS n FROM c WHERE source = 'crm')"""


def _sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Clients of all sources but one, some named with their city; and of that one as a registry, with longer or misspelt names."""
    c = table(spark, sf, "clients").where("name is not null").select(F.col("client_id").alias("id"), "source", F.coalesce("email", F.lit("")).alias("email"), text.match_name("city").alias("place"), "name", F.coalesce("city", F.lit("")).alias("city"))
    first, rest = (F.regexp_extract("name", r"^(\S*)\s*(.*)$", k) for k in (1, 2))
    d = c.where("source <> 'crm'").withColumn("n", F.when(F.col("id") % 4 == 0, F.concat_ws(" ", "name", "city")).otherwise(F.col("name")))
    g = c.where("source = 'crm'").withColumn("n", F.when(F.col("id") % 3 == 0, F.concat_ws(" ", first, "city", rest)).when(F.col("id") % 3 == 1, F.replace("name", F.lit("er"), F.lit("ar"))).otherwise(F.col("name")))
    return d.select("id", "place", "n"), g.select(F.col("id").alias("rid"), F.col("place").alias("rplace"), "email", F.col("n").alias("rn"))


@_query(f"""WITH {_SIDES},
  dw AS (SELECT id, place, {_WORDS.format(c='n')} AS x FROM d), gw AS (SELECT id AS rid, place AS rplace, email, {_WORDS.format(c='n')} AS y FROM g WHERE email <> ''),
  p AS (SELECT *, len(list_intersect(x, y)) AS shared, place <> '' AND contains(rplace, place) AS same FROM dw, gw WHERE len(list_intersect(x, y)) >= 2),
  t AS (SELECT *, shared = len(x) OR (len(y) >= 3 AND shared = len(y)) AS held FROM ({_TOKEN_SET})),
  k AS (SELECT *, CASE WHEN len(x) < 2 OR len(y) < 2 THEN 0 WHEN shared = len(x) AND (shared >= 3 OR same) THEN 3 WHEN s >= 93 AND shared >= 3 AND same THEN 3
    WHEN s >= 93 AND (shared >= 3 OR same) THEN 2 WHEN s >= 90 THEN 1 ELSE 0 END AS rank FROM t),
  u AS (SELECT id, min(email) AS email, arg_min(s, rid) AS score, min(rid) AS rid, count(*) AS candidates FROM k WHERE held GROUP BY id HAVING count(DISTINCT email) = 1 AND max(len(x)) >= 2),
  m AS (SELECT * FROM k WHERE rank > 0 AND id NOT IN (SELECT id FROM u)),
  b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank DESC, s DESC, rid) AS o, max(rank) OVER (PARTITION BY id) AS top, count(*) OVER (PARTITION BY id) AS n FROM m),
  w AS (SELECT id, top, s AS best, rid, email, n FROM b WHERE o = 1),
  a AS (SELECT w.id, count(DISTINCT m.email) AS emails FROM w JOIN m ON m.id = w.id AND m.rank = w.top AND m.s >= w.best - 1 GROUP BY w.id)
  SELECT d.id, CASE WHEN u.id IS NOT NULL THEN 'alta' WHEN w.id IS NULL THEN 'sin_match' WHEN a.emails > 1 THEN 'ambiguo' WHEN w.top = 3 THEN 'alta' WHEN w.top = 2 THEN 'media' ELSE 'baja' END AS label,
    round(coalesce(u.score, w.best), 6) AS score, CASE WHEN u.id IS NOT NULL THEN u.email WHEN a.emails > 1 OR w.id IS NULL THEN '' ELSE w.email END AS email, coalesce(u.rid, w.rid) AS rid, coalesce(u.candidates, w.n, 0) AS candidates,
    CASE WHEN u.id IS NOT NULL THEN 'contencion_unica' END AS rule FROM d LEFT JOIN u ON u.id = d.id LEFT JOIN w ON w.id = d.id LEFT JOIN a ON a.id = d.id""")
def registry_labels(spark, sf) -> DataFrame:
    """Every client against the registry: unique containment first, then labels by token set ratio, best of them, and ambiguity."""
    ship(spark)
    d, g = _sides(spark, sf)
    d, g = d.withColumn("words", text.match_tokens("n")), g.withColumn("rwords", text.match_tokens("rn"))
    return matching.match_registry(d, g, "id", "words", "place", "rid", "rwords", "rplace", "email", ratio.scorer("token_set")).withColumn("score", F.round("score", 6))


def _strict_sql(a: str, b: str) -> str:
    """Agreement of two name parts, 0 if either is empty."""
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE {_ratio(a, b)} / 100 END"


_PARTS = """SELECT *, u[1] AS w1, CASE WHEN len(u) = 0 THEN '' WHEN len(u) <= 2 THEN u[-1] ELSE u[-2] END AS {p}1, CASE WHEN len(u) >= 3 THEN u[-1] ELSE '' END AS {p}2, CASE WHEN len(u) >= 2 THEN u[1] ELSE '' END AS {p}g
  FROM (SELECT *, list_filter(string_split({p}n, ' '), lambda t: t <> '') AS u FROM {t})"""


_QUERIES_SQL = f"""WITH {_SIDES}, da AS (SELECT id, n AS an FROM d), gb AS (SELECT id AS rid, n AS bn FROM g),
  i AS ({_PARTS.format(p='a', t='da')}), r AS ({_PARTS.format(p='b', t='gb')}),
  q AS (SELECT id, a1, a2, ag, 1 AS turn, [a1, ag] AS words FROM i WHERE a1 <> '' AND ag <> '' UNION ALL SELECT id, a1, a2, ag, 2, [a1, a2] FROM i WHERE a1 <> '' AND a2 <> ''
    UNION ALL SELECT id, a1, a2, ag, 3, u FROM i WHERE len(u) > 0),
  k AS (SELECT *, list_distinct(words) AS z FROM q),
  j AS (SELECT id, turn, rid, a1, a2, ag, b1, b2, bg FROM k JOIN r ON len(list_intersect(z, u)) = len(z)),
  e AS (SELECT *, {_strict_sql('a1', 'b1')} AS s1, CASE WHEN a2 = '' AND b2 = '' THEN 1.0::DOUBLE WHEN a2 = '' OR b2 = '' THEN 0.5::DOUBLE ELSE {_ratio('a2', 'b2')} / 100 END AS s2, {_strict_sql('ag', 'bg')} AS s3 FROM j),
  s AS (SELECT id, turn, rid, CASE WHEN least(s1, s2) < 0.6 THEN least(s1, s2) / 2 ELSE 0.35 * s1 + 0.35 * s2 + 0.3 * s3 END AS score FROM e),
  best AS (SELECT id, turn, rid, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn, score DESC, rid) AS o FROM s WHERE score >= 0.75) WHERE o = 1)"""


@_query(_QUERIES_SQL + " SELECT id, turn, rid, round(score, 6) AS score FROM best")
def registry_queries(spark, sf) -> DataFrame:
    """Three queries a client, in turn, each finding registry names that hold its words; the first whose best strict score is 0.75
    or more decides."""
    return _best_of_queries(spark, sf).select("id", "turn", "rid", F.round("score", 6).alias("score"))


def _best_of_queries(spark, sf) -> DataFrame:
    ship(spark)
    d, g = _sides(spark, sf)
    name = text.parse_given_first(text.match_name("n"))
    d = d.select("id", name.alias("name"), text.tokens(text.match_name("n")).alias("all"))
    first = F.substring_index("name.given_name", " ", 1)
    asked = [F.when((F.col("name.family_name_1") != "") & (first != ""), F.array("name.family_name_1", first)), F.when(text.has_value("name.family_name_1") & text.has_value("name.family_name_2"), F.array("name.family_name_1", "name.family_name_2")), F.when(F.size("all") > 0, F.col("all"))]
    turns = d.select("id", "name", F.posexplode(F.array(*asked)).alias("turn", "words")).where("words is not null").withColumn("turn", F.col("turn") + 1)
    g = g.select("rid", F.col("rn"), text.tokens(text.match_name("rn")).alias("rwords"))
    # equal questions and equal registry names are compared once
    asks = turns.select(F.array_sort(F.array_distinct("words")).alias("z"), "name").distinct().withColumn("ask", F.struct("z", "name"))
    names = g.groupBy("rwords", "rn").agg(F.min("rid").alias("rid"))
    held = matching.contained(asks, names, "ask", "rid", "z", "rwords", 1, 1 << 30).join(names.select("rid", text.parse_given_first(text.match_name("rn")).alias("other")), "rid")
    scored = held.select("ask", "rid", "other").withColumn("score", ratio.strict_name_score(F.col("ask.name"), F.col("other")))
    pairs = turns.withColumn("ask", F.struct(F.array_sort(F.array_distinct("words")).alias("z"), "name")).join(scored, "ask")
    return matching.first_query_match(pairs, "id", "turn", "score", "rid")


@_query(_QUERIES_SQL + """, own AS (SELECT d.id, d.n AS name, coalesce(c.segment, '') AS category FROM d JOIN clients c ON c.client_id = d.id),
  reg AS (SELECT g.id AS rid, g.n AS canonical, CASE WHEN g.id % 5 = 0 THEN [] ELSE [upper(coalesce(c.segment, '')), 'Care-' || g.id % 3] END AS categories FROM g JOIN clients c ON c.client_id = g.id)
  SELECT own.id, name, category, best.id IS NOT NULL AS matched, coalesce(canonical, '') AS canonical_name, coalesce(array_to_string(categories, ', '), '') AS canonical_categories,
    CASE WHEN best.id IS NULL OR category = '' OR len(categories) = 0 THEN '' ELSE CAST(lower(categories[1]) = category AND categories[1] <> '' AS VARCHAR) END AS category_agrees, round(coalesce(score, 0), 3) AS score,
    CASE WHEN best.id IS NULL THEN '' ELSE '/doctor/' || best.rid END AS profile_url, coalesce(CAST(best.rid AS VARCHAR), '') AS oid, CASE WHEN best.id IS NULL THEN 'no match of 0.75 or more' ELSE '' END AS notes
  FROM own LEFT JOIN best ON best.id = own.id LEFT JOIN reg ON reg.rid = best.rid""")
def verification_rows(spark, sf) -> DataFrame:
    """The report of all clients verified against the registry, in ten columns."""
    d, g = _sides(spark, sf)
    c = table(spark, sf, "clients").select("client_id", "segment")
    own = d.join(c, F.col("id") == F.col("client_id")).select("id", text.match_name("n").alias("name"), F.col("segment").alias("category"))
    listed = F.when(F.col("rid") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.upper(F.coalesce("segment", F.lit(""))), F.concat(F.lit("Care-"), F.col("rid") % 3)))
    reg = g.join(c, F.col("rid") == F.col("client_id")).select("rid", text.match_name("rn").alias("canonical"), listed.alias("categories"))
    best = _best_of_queries(spark, sf).select("id", "rid", "score").join(reg, "rid").select("id", "canonical", "categories", "score", F.concat(F.lit("/doctor/"), "rid").alias("path"), F.col("rid").alias("oid"))
    return consolidating.verification_report(own, best, "id")


@_query(f"""WITH c AS (SELECT client_id AS id, master_id, lower({_PLAIN.format(c='name')}) AS n, segment, city, nation_id, source, email, balance FROM clients WHERE name IS NOT NULL AND master_id IS NOT NULL),
  q AS (SELECT a.id AS a, b.id AS b, a.n AS an, b.n AS bn, a.segment = b.segment AS seg, a.city = b.city AS city, a.nation_id = b.nation_id AS nat, a.source = b.source AS src, a.email = b.email AS mail, a.id % 5 = b.id % 5 AS tel,
    CASE WHEN a.balance IS NOT NULL AND b.balance IS NOT NULL THEN (a.balance * b.balance + 1000000) / (sqrt(a.balance * a.balance + 1000000) * sqrt(b.balance * b.balance + 1000000) + 1e-9) END AS cos
    FROM c a JOIN c b ON a.master_id = b.master_id AND a.id // 1000 = b.id // 1000 AND a.id < b.id),
  p AS (SELECT *, {_sorted('an')} AS sa, {_sorted('bn')} AS sb, list_sort(list_distinct(list_filter(string_split(an, ' '), lambda w: w <> ''))) AS x, list_sort(list_distinct(list_filter(string_split(bn, ' '), lambda w: w <> ''))) AS y FROM q),
  f AS (SELECT *, {_ratio('sa', 'sb')} / 100 AS ts, s / 100 AS tt FROM ({_TOKEN_SET}))
  SELECT a, b, round(ts, 6) AS name_token_sort, round(tt, 6) AS name_token_set, round(1 / (1 + exp(-(-3.5 + 2.1 * ts + 1.1 * tt + coalesce(2.8 * cos, 0) + CASE WHEN seg THEN 1.5 ELSE 0 END + CASE WHEN city THEN 1.0 ELSE 0 END
    + CASE WHEN src THEN 1.2 ELSE 0 END + CASE WHEN nat THEN 1.4 ELSE 0 END + CASE WHEN tel THEN 4.0 ELSE 0 END + CASE WHEN mail THEN 5.0 ELSE 0 END))), 6) AS p FROM f""")
def pair_features(spark, sf) -> DataFrame:
    """All nine features of two records of one master record, and the probability that they are one person's.  Blocks are cut by
    thousands of ids, so a master that very many records have does not make all their pairs."""
    out, f = _features(spark, sf)
    p = scores.pair_probability({k: F.col(k) for k in f})
    return out.select("a", "b", F.round("name_token_sort", 6).alias("name_token_sort"), F.round("name_token_set", 6).alias("name_token_set"), F.round(p, 6).alias("p"))


def _features(spark, sf, masters: int = 1) -> tuple[DataFrame, list[str]]:
    """The features of the pairs of clients in one block, and whether they have one master.  A block is so many masters' clients of
    one thousand of ids."""
    ship(spark)
    c = table(spark, sf, "clients").where("name is not null and master_id is not null")
    block = F.struct(F.floor(F.col("master_id") / masters), F.floor(F.col("client_id") / 1000)).alias("block")
    sets = {"cities": F.array_compact(F.array("city")), "schools": F.array_compact(F.array("source")), "places": F.array_compact(F.array(F.col("nation_id").cast("string"))), "phones": F.array((F.col("client_id") % 5).cast("string")), "emails": F.array_compact(F.array("email"))}
    vector = F.when(F.col("balance").isNotNull(), F.array(F.col("balance"), F.lit(1000.0)))
    one = c.select(block, F.struct(F.col("master_id").alias("master"), F.col("client_id").alias("id"), F.col("name").alias("full_name"), F.col("segment").alias("category"), *[v.alias(k) for k, v in sets.items()], vector.alias("vector")).alias("a"))
    pairs = one.join(one.withColumnRenamed("a", "b"), "block").where("a.id < b.id")
    f = ratio.pair_features(F.col("a"), F.col("b"))
    same = (F.col("a.master") == F.col("b.master")).cast("int").alias("same")
    return pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), same, *[v.alias(k) for k, v in f.items()]), list(f)


@_query()
def calibrated_coefficients(spark, sf) -> DataFrame:
    """Coefficients from pairs of clients of twenty neighbouring masters, labelled by whether they have one; a regression has no SQL."""
    pairs, f = _features(spark, sf, 20)
    return spark.createDataFrame([*calibration.calibrate(pairs, f, "same").items()], "feature string, coefficient double")


_FREE, _HELD = contacts.FREEMAIL, contacts.KNOWN_DOMAINS
_DOMAINS = ", ".join(f"'{d}'" for d in sorted(_FREE + _HELD))


@_query(f"""WITH k AS (SELECT unnest([{_DOMAINS}]) AS d), v AS (SELECT c_custkey, c_custkey % 15 + 1 AS w, c_custkey % 7 AS pos, c_custkey % 5 AS how, [{_DOMAINS}][c_custkey % 15 + 1] AS d FROM customer),
  m AS (SELECT c_custkey, CASE how WHEN 0 THEN d WHEN 1 THEN substr(d, 1, pos) || 'x' || substr(d, pos + 1) WHEN 2 THEN substr(d, 1, pos) || substr(d, pos + 2) WHEN 3 THEN 'mail.' || d ELSE 'q' || pos || '.zz' END AS v FROM v),
  u AS (SELECT DISTINCT v FROM m), f AS (SELECT v, d, CASE WHEN length(v) <= length(d) THEN v ELSE d END AS a, CASE WHEN length(v) <= length(d) THEN d ELSE v END AS b FROM u, k),
  p AS (SELECT v, d, a, b, {_ratio('a', 'b')} AS whole, length(b) / length(a) AS much FROM f),
  z AS (SELECT v, d, a, substr(b, CAST(greatest(i, 0) + 1 AS BIGINT), CAST(i + length(a) - greatest(i, 0) AS BIGINT)) AS w FROM (SELECT *, unnest(range(1 - length(a), length(b))) AS i FROM p WHERE much >= 1.5)),
  t AS (SELECT v, d, max({_ratio('a', 'w')}) AS part FROM z GROUP BY 1, 2),
  s AS (SELECT p.v, p.d, CASE WHEN much < 1.5 THEN whole WHEN much < 8 THEN greatest(whole, 0.9 * part) ELSE greatest(whole, 0.6 * part) END AS s FROM p LEFT JOIN t ON t.v = p.v AND t.d = p.d),
  o AS (SELECT v, d FROM (SELECT *, row_number() OVER (PARTITION BY v ORDER BY s DESC, d) AS n FROM s WHERE s >= 85) WHERE n = 1)
  SELECT c_custkey, m.v AS domain, CASE WHEN m.v NOT IN ({_DOMAINS}) THEN o.d END AS suggestion FROM m LEFT JOIN o ON o.v = m.v""")
def domain_suggestions(spark, sf) -> DataFrame:
    """Mistyped, shortened, longer and unknown domains, and the known one that each is most like."""
    ship(spark)
    k, known = F.col("c_custkey"), sorted(_FREE + _HELD)
    d, at = F.element_at(F.array(*map(F.lit, known)), (k % 15 + 1).cast("int")), (k % 7).cast("int")
    cut = lambda n: F.substr(d, n, F.lit(99))
    how = k % 5
    value = F.when(how == 0, d).when(how == 1, F.concat(F.substr(d, F.lit(1), at), F.lit("x"), cut(at + 1))).when(how == 2, F.concat(F.substr(d, F.lit(1), at), cut(at + 2))).when(how == 3, F.concat(F.lit("mail."), d)).otherwise(F.concat(F.lit("q"), at, F.lit(".zz")))
    rows = table(spark, sf, "customer").select("c_custkey", value.alias("domain"))
    found = ratio.nearest_values(rows, "domain", known, 85.0, "suggestion")
    return found.withColumn("suggestion", F.when(~F.col("domain").isin(known), F.col("suggestion")))

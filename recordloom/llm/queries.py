"""The registered query of each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..runtime import table
from . import asof, audit, decontaminate, lines, packing, paragraphs, quality, shards, simhash, suffixes, topk, toxicity, urlrules

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
THRESHOLD = 0.3


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def fold(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def _scored(docs: DataFrame, score, held_out: Column) -> DataFrame:
    scored = docs.select("doc_id", held_out.alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(4) == 2
    return _scored(docs, toxicity.toxicity_score(docs, table(spark, sf_dir, "labels"), ~held_out), F.coalesce(held_out, F.lit(False)))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = paragraphs.near_duplicate_paragraphs(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "kind", "start", "n_words", "class_id", F.col("keeper.id").alias("keeper_doc_id"), F.col("keeper.start").alias("keeper_start"), "kept")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), 200)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, span: n + span["length"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised("embedding").alias("vector"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(table(spark, sf_dir, "pages"), urlrules.rule_table(spark, RULES))


def _fingerprint(column: str) -> Column:
    """16 hexadecimal digits of a little-endian 64-bit word; reverse() on a binary column would go by characters."""
    digits = F.hex(column)
    return F.lower(F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(8))]))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select(F.col("id").alias("doc_id"), _fingerprint("fp").alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(5) == 0
    return _scored(docs, quality.quality_score(docs, table(spark, sf_dir, "labels"), ~held_out), F.coalesce(held_out, F.lit(False)))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), end_id=0, capacity=2048)


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = shards.write_shards(table(spark, sf_dir, "documents"), vocabulary(), end_id=2)
    found = shards.read_shards(spark, manifest)
    return found.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def filters() -> dict[str, Column]:
    """The audit's conditions under which a text fails; copies are the filter E."""
    words, text = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), F.col("text")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]", "")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = audit.failure_masks(table(spark, sf_dir, "documents"), filters(), "E")
    return audit.all_orders(audit.mask_counts(masks, table(spark, sf_dir, "labels")), "ABCDE")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_frequency(table(spark, sf_dir, "documents")).withColumn("base_failed", lines.base_failed())
    kept = ~F.col("base_failed") & ~F.col("depleted")
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "removed_chars", "n_removed_lines")


HOUR = 3_600_000_000


def _floored(at: Column, digits: Column) -> Column:
    """A time in microseconds, floored to six hours where the crc32 of an id is odd."""
    return F.when(F.crc32(digits) % 2 == 1, at - F.pmod(at, F.lit(6 * HOUR))).otherwise(at)


def op13_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, sales = table(spark, sf_dir, "clicks"), table(spark, sf_dir, "sales")
    clicks = clicks.select("click_id", "client_id", _floored(asof.micros(clicks, "ts"), F.col("click_id").cast("string")).alias("t"))
    digits, total = F.col("sale_id").cast("string"), F.col("total")
    cents = F.when((total > float("-inf")) & (total < float("inf")), F.floor(100 * total + 0.5)).cast("long")
    ids = F.when(F.crc32(digits) % 3 != 0, F.array("sale_id", -1 - F.col("sale_id"))).otherwise(F.array("sale_id"))
    orders = sales.select("client_id", _floored(asof.micros(sales, "sold_at"), digits).alias("t"), cents.alias("total_cents"), F.explode(ids).alias("sale_id"))
    found = asof.as_of(clicks, orders, "click_id", "client_id", "t", "t", ["total_cents", "sale_id"], 720 * HOUR)
    return found.select(F.col("id").alias("click_id"), F.col("key").alias("client_id"), F.col("t").alias("ts_us"), "found.best.sale_id", (F.col("t") - F.col("found.t")).alias("lag_us"),
                        "found.best.total_cents", F.coalesce("found.n", F.lit(0)).cast("long").alias("n_tied"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_toxicity, op2_substring_dedup, op3_suffix_array_dedup, op4_exact_topk, op5_benchmark_decontamination, op6_url_filters, op7_simhash, op8_quality, op9_best_fit_packing, op10_token_shards, op11_filter_audit, op12_quality_rules, op13_as_of_join)}


_OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.vector AS DOUBLE[]), CAST(c.vector AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
) WHERE rank <= 20
"""

_OP6_SQL = """
WITH r(rule, h, p, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
a AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*', 0, 's') AS raw FROM a),
c AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*', 0, 's') AS path, row_number() OVER () AS row_no FROM b),
d AS (SELECT c.*, r.rule, r.v, row_number() OVER (PARTITION BY row_no ORDER BY length(r.rule) DESC NULLS LAST) AS k
  FROM c LEFT JOIN r ON (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM d WHERE k = 1
"""


_OP11_SQL = """
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
m AS (SELECT doc_id, part, CASE WHEN len(words) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max(quality) AS good, max(toxic) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f(x, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits FROM f p, f q, f r, f s, f t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
s AS (SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit, coalesce(list_sum(bits[1 : k - 1]), 0) AS earlier FROM o, range(1, 6) r(k)),
g AS (SELECT part, filter_order, step, bit,
  sum(CASE WHEN mask & CAST(bit + earlier AS INTEGER) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & bit > 0 AND mask & CAST(earlier AS INTEGER) = 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & bit > 0 AND mask & CAST(earlier AS INTEGER) > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & bit > 0 AND mask & CAST(earlier AS INTEGER) = 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & bit > 0 AND mask & CAST(earlier AS INTEGER) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM g
"""

_OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
ln AS (SELECT row, doc_id, source, line, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words FROM (SELECT row, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)),
ls AS (SELECT row, doc_id, source, line, translate(array_to_string(words, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm, length(array_to_string(words, '')) AS chars
  FROM ln WHERE len(words) > 0),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM ls GROUP BY row),
above AS (SELECT source, norm FROM ls GROUP BY source, norm HAVING count(DISTINCT doc_id) > 20),
lost AS (SELECT row, sum(chars) AS removed_chars, count(DISTINCT norm) AS n_removed_lines FROM ls SEMI JOIN above a ON ls.source IS NOT DISTINCT FROM a.source AND ls.norm = a.norm GROUP BY row),
win AS (SELECT row, k, array_to_string(words[k : k + 7], ' ') AS run FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS k FROM w WHERE len(words) > 8)),
again AS (SELECT row, k FROM (SELECT row, k, count(*) OVER (PARTITION BY row, run) AS n FROM win) WHERE n > 1),
rep AS (SELECT row, count(DISTINCT k + j) AS n_repeat_words FROM again, range(0, 8) r(j) GROUP BY row),
s AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars, coalesce(n_removed_lines, 0) AS n_removed_lines
  FROM w LEFT JOIN dup USING (row) LEFT JOIN rep USING (row) LEFT JOIN lost USING (row)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (removed_chars > 0 AND word_chars - removed_chars < 0.5 * word_chars) AS kept, removed_chars, n_removed_lines FROM b
"""

#: crc32 by its table, which is made by rule; ids are spelled in decimal digits.
_OP13_SQL = """
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
ids AS (SELECT DISTINCT click_id AS id FROM clicks UNION SELECT sale_id FROM sales),
crc AS (SELECT id, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM ids, tab),
q AS (SELECT DISTINCT click_id, client_id, CASE WHEN h % 2 = 1 THEN us - us % 21600000000 ELSE us END AS ts_us
  FROM (SELECT click_id, client_id, epoch_us(ts) AS us, h FROM clicks JOIN crc ON click_id = id)),
o AS (SELECT client_id, CASE WHEN h % 2 = 1 THEN us - us % 21600000000 ELSE us END AS t, CAST(floor(100 * total + 0.5) AS BIGINT) AS total_cents, unnest(CASE WHEN h % 3 <> 0 THEN [sale_id, -1 - sale_id] ELSE [sale_id] END) AS sale_id
  FROM (SELECT sale_id, client_id, total, epoch_us(sold_at) AS us, h FROM sales JOIN crc ON sale_id = id) WHERE client_id IS NOT NULL AND us IS NOT NULL),
g AS (SELECT *, count(*) OVER (PARTITION BY client_id, t) AS n_tied, row_number() OVER (PARTITION BY client_id, t ORDER BY total_cents DESC NULLS LAST, sale_id DESC) AS k FROM o),
j AS (SELECT q.click_id, q.client_id, q.ts_us, a.t, a.sale_id, a.total_cents, a.n_tied, q.ts_us - a.t <= 2592000000000 AS near
  FROM q ASOF LEFT JOIN (SELECT * FROM g WHERE k = 1) a ON q.client_id = a.client_id AND q.ts_us >= a.t)
SELECT click_id, client_id, ts_us, CASE WHEN near THEN sale_id END AS sale_id, CASE WHEN near THEN ts_us - t END AS lag_us, CASE WHEN near THEN total_cents END AS total_cents,
  CASE WHEN near THEN n_tied ELSE 0 END AS n_tied FROM j
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_topk": _OP4_SQL, "op6_url_filters": _OP6_SQL, "op11_filter_audit": _OP11_SQL, "op12_quality_rules": _OP12_SQL, "op13_as_of_join": _OP13_SQL}

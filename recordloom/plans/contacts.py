"""Queries of contacts, links and listings, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import contacts, scores, text
from ..operators import consolidating, ranking
from ..runtime import table
from ..sources import pages
from ..streaming import incremental
from .book import query as _query


@_query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_nationkey % 2 = 0 THEN '06' ELSE '07' END || lpad(CAST(c_custkey AS VARCHAR), 7, '2') ELSE '09' || lpad(CAST(c_custkey AS VARCHAR), 8, '2') END AS phone FROM customer""")
def area_codes(spark, sf):
    k = F.col("c_custkey").cast("string")
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat_ws("-", F.lit(""), F.lpad(k, 7, "2"))).otherwise(F.concat(F.lit("(09) "), F.lpad(k, 8, "2")))
    province = F.when(F.col("c_nationkey") % 2 == 0, "Carchi").otherwise("Other")
    return table(spark, sf, "customer").select("c_custkey", contacts.area_filled(raw, province).alias("phone"))


@_query("""SELECT c_custkey, unnest(CASE WHEN c_custkey % 10 IN (2, 4, 5, 6, 7, 8) THEN ['+506' || (c_custkey % 10) || lpad(CAST(c_custkey AS VARCHAR), 7, '0'), '+50688888888'] ELSE ['+50688888888'] END) AS phone FROM customer""")
def phones_in_text(spark, sf):
    number = F.concat((F.col("c_custkey") % 10).cast("string"), F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
    body = F.concat(F.lit("tel. +506 "), number, F.lit("; mobile 8888-8888, again +506 88888888; room 12"))
    return table(spark, sf, "customer").select("c_custkey", F.explode(contacts.phones_in(body, "CR")).alias("phone"))


@_query("""SELECT * FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'FALTA' WHEN c_custkey % 5 = 0 THEN 'REVISAR' ELSE 'OK' END AS email_quality,
  CASE WHEN c_custkey % 3 = 0 THEN 'FALTA' WHEN c_custkey % 7 = 0 THEN 'REVISAR' ELSE 'OK' END AS phone_quality FROM customer) WHERE email_quality <> 'OK' OR phone_quality <> 'OK'""")
def contact_issues(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select("c_custkey", F.when(k % 4 != 0, "a@b.cr").alias("email"), F.when(k % 3 != 0, F.when(k % 7 == 0, "2222").otherwise("+50622222222")).alias("phone"), F.when(k % 5 == 0, "b.com").alias("hint"))
    return consolidating.issues(consolidating.clean_view(c, "email", "phone", "hint")).select("c_custkey", "email_quality", "phone_quality")


@_query("SELECT doc_id, contains(low, 'license') OR contains(low, 'under') AS present FROM (SELECT doc_id, lower(strip_accents(coalesce(text, ''))) AS low FROM documents)")
def names_present(spark, sf):
    words = F.array(F.lit("Lícense"), F.lit("UNDER"), F.lit("by"))
    return table(spark, sf, "documents").select("doc_id", scores.name_present(text.text("text"), words).alias("present"))


@_query("SELECT page_id, CASE WHEN page_id % 3 < 2 THEN url END AS target FROM pages")
def unwrapped_links(spark, sf):
    """Search results: redirects with the target as an encoded parameter, plain links, and script links, which have none."""
    k = F.col("page_id") % 3
    found = F.when(k == 0, F.concat(F.lit("https://search.example/l/?rut=1&uddg="), F.url_encode("url"))).when(k == 1, F.col("url")).otherwise("JavaScript:void(0)")
    return table(spark, sf, "pages").select("page_id", pages.unwrapped(found).alias("target"))


@_query("""SELECT page_id, len(c) AS n, md5(array_to_string(c, '|')) AS cards_md5 FROM (SELECT page_id, list_filter(string_split(html, '<p')[2:], lambda x: regexp_matches(x, '[Tt]he')) AS c FROM pages)""")
def gated_cards(spark, sf):
    """Parts of a listing that pass a pattern, whole."""
    c = pages.cards("html", "<p", "[Tt]he")
    return table(spark, sf, "pages").select("page_id", c.alias("c")).select("page_id", F.size("c").cast("long").alias("n"), F.md5(F.array_join("c", "|")).alias("cards_md5"))


@_query("""WITH e AS (SELECT DISTINCT c_custkey % 97 AS a, (c_custkey * 7) % 89 AS b FROM customer), one AS (SELECT b AS node FROM e WHERE a = 1), two AS (SELECT b FROM e WHERE a IN (SELECT node FROM one))
  SELECT node, min(hop)::INTEGER AS hop FROM (SELECT 1 AS node, 0 AS hop UNION ALL SELECT node, 1 FROM one UNION ALL SELECT b, 2 FROM two) GROUP BY 1""")
def two_hops(spark, sf):
    c = table(spark, sf, "customer").select((F.col("c_custkey") % 97).alias("a"), (F.col("c_custkey") * 7 % 89).alias("b"))
    return incremental.two_hops(c, spark.range(1, 2).select(F.col("id").alias("node")), "a", "b", "node")


@_query("""SELECT c_custkey, coalesce(s_suppkey, -1) AS s_suppkey FROM (SELECT c_custkey, 'u' || c_custkey % 700 || '@x.cr' AS mail FROM customer) LEFT JOIN (SELECT s_suppkey, 'u' || s_suppkey % 80 || '@x.cr' AS mail FROM supplier) USING (mail)""")
def email_merge(spark, sf):
    """By exact address; a repeated one meets each of its like, as a left join does."""
    mail = lambda k, n: F.concat(F.lit("u"), (F.col(k) % n).cast("string"), F.lit("@x.cr"))
    c = table(spark, sf, "customer").select("c_custkey", mail("c_custkey", 700).alias("mail"))
    s = table(spark, sf, "supplier").select("s_suppkey", mail("s_suppkey", 80).alias("mail"))
    return c.join(s, "mail", "left").select("c_custkey", F.coalesce("s_suppkey", F.lit(-1)).alias("s_suppkey"))


@_query("""SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(b.text, '') AS item FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN benchmark b ON b.item_id = d.doc_id""")
def two_lookups(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.lit(-1).alias("quality"), F.lit("").alias("item"))
    first = ranking.overwrite_from(d, table(spark, sf, "labels"), "doc_id", ["quality"])
    return ranking.overwrite_from(first, table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("item")), "doc_id", ["item"])


@_query(r"""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'stage' || c_nationkey WHEN 1 THEN 'clinica' || lower(c_mktsegment) ELSE '' END AS stem FROM customer""")
def place_domains(spark, sf):
    k = F.col("c_custkey") % 4
    place = F.when(k == 0, F.concat(F.lit("Stäge "), F.col("c_nationkey").cast("string"), F.lit(" S.A."))).when(k == 1, F.concat(F.lit("Clínica "), F.col("c_mktsegment"), F.lit(" SRL de algo"))).when(k == 2, "No")
    return table(spark, sf, "customer").select("c_custkey", text.place_domain(place, ("sa", "s.a", "srl")).alias("stem"))


@_query("""SELECT name_id, unnest(['https://x.example/' || g || '-' || a, 'https://x.example/' || g || '-' || a || '-b'][1:1]) AS url FROM (SELECT min(p_partkey) AS name_id, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS g FROM part GROUP BY p_name)""")
def candidate_urls(spark, sf):
    """Two-word names have one candidate; those with more are in the tests."""
    n = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("name_id"))
    return n.select("name_id", F.explode(text.candidate_urls("https://x.example/", text.parse_family_first("p_name"))).alias("url"))


@_query("""SELECT name_id, '"' || upper(a) || '" "' || upper(g) || '" cardio CR' AS query FROM (SELECT min(p_partkey) AS name_id, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS g FROM part GROUP BY p_name)""")
def search_queries(spark, sf):
    n = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("name_id"), F.first("p_name").alias("p"))
    return n.select("name_id", text.search_query(text.parse_family_first("p"), F.lit("cardio"), F.lit("CR")).alias("query"))


@_query("""SELECT doc_id, CASE WHEN lang = 'en' THEN NULL ELSE lang IN ('de', 'fr') END AS agrees FROM documents""")
def category_agreement(spark, sf):
    """Equal, held or holding names agree; null without one."""
    mine = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    others = F.array(F.lit("De"), F.lit(" fr_x/"), F.lit(""))
    return table(spark, sf, "documents").select("doc_id", text.agrees(mine, others).alias("agrees"))

"""Queries of directories in running text and in tables of mixed headers, group reports, and claims from page to best value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import contacts, scores, text
from ..operators import claims, consolidating
from ..runtime import run_folder, table
from ..sources import tabular
from .book import query as _query

POSTS = [(r"^MEDICO/A GENERAL\b", "GENERAL"), (r"^MEDICO/A ESPECIALISTA EN PEDIATRIA\b", "PEDIATRIA")]
CITIES = ["Quito", "San Lorenzo", "Loja", "Ibarra"]
_POST_SQL = "CASE client_id % 4 WHEN 0 THEN 'MÉDICO/A GENERAL' WHEN 1 THEN 'Médico/a Especialista en Pediatría' WHEN 2 THEN 'MEDICO/A DENTISTA' ELSE 'AUXILIAR' END"
_CITY_SQL = "CASE client_id % 5 WHEN 0 THEN 'QUITO' WHEN 1 THEN 'san lorenzo' WHEN 2 THEN 'LOJÁ' WHEN 3 THEN 'Ibarra' ELSE 'Elsewhere' END"
_KNOWN = "client_id % 4 < 2 AND client_id % 5 < 4"
_PAIR = "CASE WHEN client_id % 4 = 0 THEN 'GENERAL' ELSE 'PEDIATRIA' END AS category, CASE client_id % 5 WHEN 0 THEN 'Quito' WHEN 1 THEN 'San Lorenzo' WHEN 2 THEN 'Loja' ELSE 'Ibarra' END AS city"


def _directory(spark, sf) -> DataFrame:
    """Clients as entries of a directory; names without letters that title case treats on its own."""
    k = F.col("client_id")
    post = F.element_at(F.array(*map(F.lit, ("MÉDICO/A GENERAL", "Médico/a Especialista en Pediatría", "MEDICO/A DENTISTA", "AUXILIAR"))), (k % 4 + 1).cast("int"))
    city = F.element_at(F.array(*map(F.lit, ("QUITO", "san lorenzo", "LOJÁ", "Ibarra", "Elsewhere"))), (k % 5 + 1).cast("int"))
    return table(spark, sf, "clients").select("client_id", F.upper(text.match_name("name")).alias("n"), post.alias("post"), city.alias("city"))


@_query(f"""SELECT client_id // 30 AS page, 'Client ' || upper(translate(CAST(client_id AS VARCHAR), '0123456789', 'abcdefghij')[1]) || translate(CAST(client_id AS VARCHAR), '0123456789', 'abcdefghij')[2:] AS name, {_PAIR}, '2' || lpad(CAST(client_id AS VARCHAR), 7, '0') AS phone,
    CASE WHEN client_id % 3 = 0 THEN 'c' || client_id || '@salud.gob.ec' ELSE 'c' || client_id || '@iess.ec' END AS email FROM clients WHERE {_KNOWN} AND client_id % 7 <> 0""")
def directory_entries(spark, sf) -> DataFrame:
    """Pages of thirty entries in running text, with headings, line breaks within entries, and a tail without an address."""
    k, d = F.col("client_id"), _directory(spark, sf)
    letters = F.translate(k.cast("string"), "0123456789", "abcdefghij")
    phone = F.when(k % 7 == 0, "none").otherwise(F.concat(F.lit("(593) "), F.lit("2"), F.lpad(k.cast("string"), 7, "0")))
    mail = F.when(k % 3 == 0, F.concat(F.lit("c"), k, F.lit("@salud.gob"))).otherwise(F.concat(F.lit("c"), k, F.lit("@iess.ec")))
    entry = F.concat(k % 30 + 1, F.lit(" CLIENT\n "), letters, F.lit(" "), "post", F.lit("\n"), "city", F.lit(" "), phone, F.lit(" "), mail, F.when(k % 3 == 0, "\n").otherwise(" \n"))
    body = F.concat(F.lit("No. Apellidos y Nombres\nPuesto Correo Electrónico institucional"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("client_id", entry.alias("e")))), lambda x: x["e"]), "Art. 7 de la Ley, x\n"), F.lit("31 LAST ONE MEDICO/A GENERAL QUITO (593) 22222222 no address"))
    pages = d.groupBy(F.floor(k / 30).alias("page")).agg(body.alias("body"))
    return tabular.directory_text(pages, ["page"], "body", POSTS, CITIES)


#: Headers of the kinds of files, with their separators; the last lacks a column that is required.
_HEADERS = [(",", ["Apellidos y Nombres", "Puesto Institucional", "Ciudad", "Teléfono", "Correo Electrónico"]), (";", ["correo", "x", "Nombre del servidor", "CARGO", "Cantón"]), ("\t", ["No.", "Nombres y APELLIDOS", "Puesto", "Extensión", "Ciudad de labores", "Correo"]), ("|", ["Nombre", "Correo"])]
ROLES = {"name": [("apellidos",), ("nombre",)], "post": [("puesto",), ("cargo",)], "place": [("ciudad",), ("canton",)], "phone": [("telefono",)], "email": [("correo",)], "unit": [("unidad",)]}


@_query("""SELECT client_id, CAST(client_id AS VARCHAR) || ', "x"' AS name, 'P;' || client_id % 4 AS post, 'City ' || client_id % 5 AS place, CASE WHEN (client_id // 50) % 4 = 0 THEN '2' || client_id ELSE '' END AS phone, 'c' || client_id || '@x.ec' AS email, '' AS unit
  FROM clients WHERE (client_id // 50) % 4 < 3""")
def mixed_headers(spark, sf) -> DataFrame:
    """Files of fifty clients each, of four kinds: other separators, headers, orders of columns, lines before the header."""
    k, folder = F.col("client_id"), run_folder(spark, "mixed")
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    name, post, place, mail = quote(F.concat(k, F.lit(', "x"'))), quote(F.concat(F.lit("P;"), k % 4)), F.concat(F.lit("City "), k % 5), F.concat(F.lit("c"), k, F.lit("@x.ec"))
    rows = [F.concat_ws(",", name, post, place, F.concat(F.lit("2"), k), mail), F.concat_ws(";", mail, F.lit(""), name, post, place), F.concat_ws("\t", k, name, post, F.lit("ext"), place, mail), F.concat_ws("|", name, mail)]
    kind = (F.col("file") % 4 + 1).cast("int")
    before = [F.lit(""), F.lit("Directory of\n\n"), F.lit("a\tb\n" * 9), F.lit("")]
    head = F.element_at(F.array(*[F.concat(b, F.lit(sep.join(h) + "\n")) for b, (sep, h) in zip(before, _HEADERS)]), kind)
    lines = table(spark, sf, "clients").select(F.floor(k / 50).alias("file"), "client_id", *[r.alias(f"r{n}") for n, r in enumerate(rows)])
    files = lines.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("client_id", F.element_at(F.array(*[f"r{n}" for n in range(4)]), kind).alias("l")))).alias("ls"))
    whole = files.select("file", F.concat(head, F.array_join(F.transform("ls", lambda x: x["l"]), "\n")).alias("value"))
    whole.write.partitionBy("file").text(folder)
    found = tabular.read_tabular(spark, folder, "correo", ROLES, ("name", "post", "place", "email"))
    return found.select(F.regexp_extract("email", r"^c(\d+)@", 1).cast("long").alias("client_id"), *ROLES)


@_query("""WITH v AS (SELECT nation_id, 'x' AS kind, segment AS v, count(*) AS n FROM clients WHERE segment IS NOT NULL GROUP BY 1, 3 UNION ALL SELECT nation_id, 'y', source, count(*) FROM clients WHERE source IS NOT NULL GROUP BY 1, 3),
  l AS (SELECT nation_id, string_agg(v || ': ' || n, ', ' ORDER BY n DESC, v) FILTER (kind = 'x') AS segments, string_agg(v || ': ' || n, ', ' ORDER BY n DESC, v) FILTER (kind = 'y') AS sources FROM v GROUP BY 1)
  SELECT c.nation_id, count(*) AS n, count(*) FILTER (email IS NOT NULL AND email <> '') AS with_email, count(*) FILTER (balance > 0) AS in_credit, count(*) FILTER (email IS NOT NULL AND email <> '' AND balance > 0) AS both,
    count(*) FILTER (segment = 'retail') AS retail, count(*) FILTER (segment = 'export') AS export, count(*) FILTER (segment = 'online') AS online, count(*) FILTER (segment = 'public') AS public, count(*) FILTER (segment = 'wholesale') AS wholesale,
    count(*) FILTER (client_id = master_id) AS masters, 70 AS goal, greatest(70 - count(*), 0) AS gap, coalesce(any_value(segments), '') AS segments, coalesce(any_value(sources), '') AS sources
  FROM clients c LEFT JOIN l ON l.nation_id = c.nation_id WHERE c.nation_id IS NOT NULL GROUP BY c.nation_id""")
def group_summary(spark, sf) -> DataFrame:
    """Fifteen metrics a nation."""
    mail, credit, segment = text.has_value("email"), F.col("balance") > 0, F.col("segment")
    counts = {"with_email": mail, "in_credit": credit, "both": mail & credit, **{s: segment == s for s in ("retail", "export", "online", "public", "wholesale")}, "masters": F.col("client_id") == F.col("master_id")}
    return consolidating.group_report(table(spark, sf, "clients").where("nation_id is not null"), ["nation_id"], counts, {"segments": "segment", "sources": "source"}, 70)


_SIGMOID = "round(1 / (1 + exp(-(ln({p} / (1 - {p})) + {w}))), 4)"


@_query(f"""WITH c AS (SELECT client_id, coalesce(name, '') AS name, list_transform(list_filter(string_split(coalesce(name, ''), ' '), lambda t: length(t) >= 4), lambda t: lower(translate(t, '{text.ACCENTED}', '{text.PLAIN}'))) AS words,
    CASE client_id % 5 WHEN 0 THEN 0.1 WHEN 1 THEN 1.6 ELSE 0.6 END AS tier, CASE client_id % 4 WHEN 0 THEN 'gmail.com' ELSE 'clinic.cr' END AS domain FROM clients),
  n AS (SELECT *, CASE WHEN len(words) = 0 THEN 0.3 WHEN client_id % 3 = 2 THEN 0.0 WHEN client_id % 3 = 0 THEN 0.9 ELSE 0.5 END AS near, CASE WHEN len(words) = 0 THEN 0.3 WHEN client_id % 3 = 2 THEN 0.0 ELSE 0.5 END AS far FROM c),
  k AS (SELECT client_id, name, 'email' AS attribute, 'dr' || client_id || '@' || domain AS value, CASE domain WHEN 'gmail.com' THEN 'personal' ELSE 'clinic' END AS subkind,
      {_SIGMOID.format(p='(0.2 + 0.3 * near)', w="tier - 0.3 + CASE WHEN near < 0.85 THEN 0 WHEN domain = 'gmail.com' THEN 0.4 ELSE 0.6 END")} AS confidence FROM n
    UNION ALL SELECT client_id, name, 'phone', '+5062' || lpad(CAST(client_id AS VARCHAR), 7, '0'), 'landline', {_SIGMOID.format(p='(0.2 + 0.3 * far)', w='tier + 0.4')} FROM n)
  SELECT name, attribute, value, subkind, confidence, client_id FROM (SELECT *, row_number() OVER (PARTITION BY name, attribute ORDER BY confidence DESC, client_id) AS o FROM k) WHERE o = 1""")
def best_of_pages(spark, sf) -> DataFrame:
    """A page a client: its text gives addresses and phones, these get their nearness to the name, then claims, of which the surest of
    each name stays."""
    k, name = F.col("client_id"), F.coalesce("name", F.lit(""))
    domain = F.when(k % 4 == 0, "gmail.com").otherwise("clinic.cr")
    body = F.concat(F.lit("About "), F.when(k % 3 < 2, name).otherwise("us"), F.when(k % 3 == 1, F.repeat(F.lit(". "), 300)).otherwise(" "), F.lit("dr"), k, F.lit("@"), domain, F.lit(", not logo@2x.png"), F.repeat(F.lit(" -"), 300), F.lit(" tel +5062"), F.lpad(k.cast("string"), 7, "0"), F.lit(" or 12"))
    url = F.when(k % 5 == 0, "https://facebook.com/x").when(k % 5 == 1, "https://x.gob/y").otherwise("https://x.cr")
    p = table(spark, sf, "clients").select("client_id", name.alias("name"), body.alias("body"), url.alias("url"))
    words = F.split("name", " ")
    near = lambda found: F.transform(found, lambda v: F.struct(v.alias("value"), scores.proximity(F.col("body"), v, words).alias("proximity")))
    p = p.withColumn("mails", contacts.emails_in("body")).withColumn("phones", contacts.phones_in("body", "CR"))
    p = p.withColumn("mails", near(F.col("mails"))).withColumn("phones", near(F.col("phones")))
    made = claims.page_claims(p, ["client_id", "name"], "url", "phones", "mails", F.lit("CR"))
    return claims.best_claims(made, "name", "client_id").select("name", "attribute", "value", "subkind", "confidence", "client_id")

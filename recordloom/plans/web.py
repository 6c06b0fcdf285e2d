"""Queries of pages to records.  The tables hold no such pages, so each row or group of rows is written as one, in several
layouts, with stray tags and gaps; the SQL works from the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import ship, spread, table
from ..sources import files, pages
from .book import query as _query


def _html(*parts) -> Column:
    """Strings as they are, columns as their text; null as nothing."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _either(number: Column, *choices) -> Column:
    """The choice whose place is the remainder of a number."""
    out = F.lit(None).cast("string")
    for k, c in reversed(list(enumerate(choices))):
        out = F.when(number % len(choices) == k, c if isinstance(c, Column) else F.lit(c)).otherwise(out)
    return out


def _if(known: Column, html: Column) -> Column:
    return F.when(known.isNotNull(), html).otherwise("")


def _profile_html() -> Column:
    key, name = F.col("client_id"), F.col("name")
    first, rest = F.regexp_extract(name, r"^(\S*)\s*(.*)$", 1), F.regexp_extract(name, r"^(\S*)\s*(.*)$", 2)
    heading = _either(key, _html('<p>Intro<h1 class="x" itemprop="name">', first, " <b>", rest, "</b></h1>"), _html('</i><div data-id="doctor-name"><span>', first, "</span> ", rest, "</p></div>"),
                      _html('<img src="a"><h1 itemprop="name">', first, "<br/>", rest, "</h1>"), _html("<h1>", name, "</h1>"), _html("<h1 ITEMPROP='name'>\n", first, "<wbr>\n\t", rest, "</em></h1>"), "")
    specialty = _either(key, _html('<a href="/es/especialidad/x">', F.col("segment"), " &amp; more</a>"), _html('<div itemprop="medicalSpecialty"><p>', F.col("segment"), "<p>more</div>"))
    phones = _html('<span itemprop="telephone"> 22', F.lpad(key.cast("string"), 8, "0"), '</span><a href="tel:+506', F.lpad(key.cast("string"), 8, "0"), '">call</a><b data-phone-id=1>123</b><span itemprop="telephone">22', F.lpad(key.cast("string"), 8, "0"), "</span>")
    mail = _if(F.col("email"), _html('<a href="mailto:', F.col("email"), '?subject=x">mail</a><a href="mailto:">none</a>'))
    clinic = _if(F.col("city"), _html('<div itemtype="https://schema.org/MedicalOrganization" itemscope><span itemprop="name">Center ', F.col("city"), "</span><br>\n <i>Street ", key % 90, "</i></div>"))
    scripts = _html('<script type="application/ld+json">{"@graph": [{"@type": "Physician", "name": "N', key, '"}, {"@type": "Other"}]}</script><script type="application/ld+json">{broken</script>')
    return _html("<html><head>", scripts, "</head><body>", _if(name, heading), _if(F.col("segment"), F.when(key % 6 == 5, "").otherwise(specialty)), phones, mail, clinic,
                 '<section itemprop="description"><script>no</script>Since <b>', key % 40 + 1980, "</b>.</section></body></html>")


@_query(r"""WITH c AS (SELECT *, client_id % 6 AS k, lpad(CAST(client_id AS VARCHAR), 8, '0') AS d FROM clients)
  SELECT client_id, CASE WHEN k IN (3, 5) OR name IS NULL THEN '' WHEN k = 4 THEN trim(regexp_replace(name, '\s+', ' ', 'g')) ELSE trim(regexp_replace(name, '\s+', ' ', 'g')) END AS name,
    CASE WHEN segment IS NULL THEN '' WHEN client_id % 2 = 0 THEN segment || ' & more' ELSE segment || ' more' END AS specialty,
    ['22' || d, '+506' || d] AS phones, CASE WHEN email IS NULL THEN [] ELSE [email] END AS emails,
    CASE WHEN city IS NULL THEN [] ELSE ['Center ' || city || ' | Street ' || client_id % 90] END AS clinics, 'Since ' || (client_id % 40 + 1980) || '.' AS bio, ['N' || client_id] AS listed
  FROM c WHERE k <> 5 AND (segment IS NOT NULL OR (k <> 3 AND name IS NOT NULL))""")
def profile_records(spark, sf) -> DataFrame:
    ship(spark)
    found = spread(table(spark, sf, "clients").select("client_id", "name", "segment", "email", "city")).select("client_id", pages.profile_record()(_profile_html()).alias("p"))
    return found.where("p is not null").select("client_id", "p.*")


def _card_html() -> Column:
    key, region = F.col("c_custkey"), F.col("c_nationkey")
    name, street = _html('<h5 class="a profile-address-card__name">\nOffice ', key % 50, "</h5>"), _html('<span data-test-id="address-info-street">Road ', key % 30, " &amp; <i>4</i>,</span>")
    city, province = _html('<span class="city" content="City ', key % 20, '"></span>'), _html('<span class="province region" content="Region ', region, '"></span>')
    card = '<div class="profile-address-card card card-border-x">'
    online = _html(card, '<h5 class="profile-address-card__name">Consulta en l&iacute;nea</h5></div>')
    cards = _either(key, _html(card, name, street, city, province, "</div>", card, name, street, city, province, "</div>"), _html(card, name, "</div>", street, city, province), _html(street, city), _html(online, card, name, city, "</div>", province, street))
    special = F.when(key % 3 == 0, "").otherwise(_html('<div data-test-id="doctor-specializations"><a>', F.lower("c_mktsegment"), "</a> · <a>care</a> ·</div>"))
    modal = _html('<div data-test-id="address-insurances-modal"><div><a href="/a/b/c" title="Insurer ', key % 9, '">x</a><a href="/a/b" title="No insurer">y</a><a href="/a/b/d" title="Insurer ', key % 4, '">z</a></div></div><a href="/a/b/e" title="Outside">o</a>')
    service = _html('[{"name": "First", "priceMin": 10}, {"name": " Visit ', key, ' ", "priceMin": ', key * 3, ', "isDefaultServiceForHighlight": true}]')
    services = _either(key, F.replace(service, F.lit('"'), F.lit("&quot;")), "[{broken", F.lit("[]"), F.lit("[{&quot;name&quot;: &quot;Only&quot;}]"), F.lit("{&quot;name&quot;: &quot;no list&quot;}"))
    phone = _html('<button data-target="address-77-', key + 1_000_000_000, '-1-phone"></button><button data-target="address-78-', key + 1_000_000_000, '-2-phone"></button><i id="address-79-123-1-phone"></i>')
    return _html("<body>", cards, special, modal, '<div :services="', services, '"></div>', phone)


@_query("""WITH c AS (SELECT c_custkey AS id, c_custkey % 4 AS k, 'Office ' || c_custkey % 50 AS office, 'Road ' || c_custkey % 30 || ' & 4' AS street, 'City ' || c_custkey % 20 AS city, 'Region ' || c_nationkey AS region, lower(c_mktsegment) AS seg FROM customer)
  SELECT id AS c_custkey, [CAST(id + 1000000000 AS VARCHAR)] AS phones, k = 3 AS remote, CASE WHEN k = 2 THEN [] ELSE [office] END AS offices, [street] AS streets, [city] AS cities, CASE WHEN k = 2 THEN [] ELSE [region] END AS regions,
    CASE WHEN id % 3 = 0 THEN seg ELSE seg || ' · care' END AS specialties, list_concat(['Insurer ' || id % 9], CASE WHEN id % 9 = id % 4 THEN [] ELSE ['Insurer ' || id % 4] END) AS insurers,
    CASE WHEN id % 5 = 0 THEN id * 3 END AS price_min, CASE id % 5 WHEN 0 THEN 'Visit ' || id WHEN 3 THEN 'Only' ELSE '' END AS price_service FROM c""")
def address_card_records(spark, sf) -> DataFrame:
    """The list of specialties that a page lacks is the row's own."""
    ship(spark)
    found = spread(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")).select("c_custkey", F.lower("c_mktsegment").alias("own"), pages.address_cards()(_card_html()).alias("p")).select("c_custkey", "own", "p.*")
    return found.withColumn("specialties", F.coalesce("specialties", "own")).drop("own")


def _as_pages(rows: DataFrame, key: str, size: int, html: Column) -> DataFrame:
    """(page, html): pages of ``size`` neighbouring keys each."""
    return rows.select(F.floor(F.col(key) / size).alias("page"), F.struct(F.col(key), html.alias("html")).alias("part")).groupBy("page").agg(
        F.concat(F.lit("<html><body>"), F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["html"]), "\n"), F.lit("</body></html>")).alias("html"))


@_query("""SELECT c_custkey // 20 AS page, CAST(c_custkey AS VARCHAR) AS result_id, 'Dr. "' || c_name || '"' AS name, 'https://x.org/' || c_custkey AS url, lower(c_mktsegment) AS specialty,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Town & ' || c_nationkey ELSE '' END AS city, CAST(c_custkey % 6 AS VARCHAR) AS rating, CAST(c_custkey % 100 AS VARCHAR) AS reviews
  FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0""")
def listing_card_records(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    card = _html('<div data-test-id="result-item" data-result-id="', key, '"><a data-doctor-url="', F.when(key % 11 != 0, _html("https://x.org/", key)), '" data-doctor-name="', F.when(key % 13 != 0, _html(" Dr. &quot;", F.col("c_name"), "&quot;")),
                 '" data-test-entity-type="', F.when(key % 7 == 0, "facility").otherwise("doctor"), '" data-eec-specialization-name="', F.lower("c_mktsegment"), '" data-eec-stars-rating="', key % 6,
                 F.when(F.col("c_nationkey") % 2 == 0, _html('" data-eec-address-cities="Town &amp; ', F.col("c_nationkey"))), '" data-eec-opinions-count="', key % 100, '">x</a></div>')
    listed = _as_pages(table(spark, sf, "customer"), "c_custkey", 20, card)
    return listed.select("page", F.explode(pages.listing_records(F.col("html"))).alias("r")).select("page", "r.*")


@_query("""SELECT p_partkey // 10 AS page, CASE WHEN (p_partkey // 10) % 2 = 0 THEN 'a' ELSE 'b' END AS layout, p_name || ' <' || p_partkey || '>' AS title,
    CASE WHEN (p_partkey // 10) % 2 = 1 AND p_partkey % 3 = 1 THEN 'https://y.org/' || p_partkey ELSE 'https://x.org/?a=' || p_partkey || '&b=' || replace(p_type, ' ', '+') END AS url,
    CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'Made by ' || p_brand || ', size ' || p_size END AS snippet
  FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 8 <> 7""")
def search_hit_records(spark, sf) -> DataFrame:
    """Even pages in one engine's layout, odd ones in the other's, some behind its redirect; results without link or behind a
    script are no hits."""
    ship(spark)
    key, odd = F.col("p_partkey"), F.floor(F.col("p_partkey") / 10) % 2 == 1
    url = _html("https://x.org/?a=", key, "&b=", F.replace("p_type", F.lit(" "), F.lit("+")))
    target = F.when(key % 8 == 7, "javascript:void(0)").when(odd & (key % 3 == 0), _html("//engine.org/l/?uddg=", F.url_encode(url), "&amp;rut=1")).when(odd & (key % 3 == 1), _html("//y.org/", key)).otherwise(F.replace(url, F.lit("&"), F.lit("&amp;")))
    target = F.when((key % 8 == 7) & ~odd, "").otherwise(target)
    title = _html(F.regexp_replace("p_name", " ", "  <b></b>"), " &lt;", key, "&gt;")
    note = _html("Made by <b>", F.col("p_brand"), "</b>, size ", F.col("p_size"))
    one = _html('<li class="b_algo x">', F.when(key % 9 != 0, _html('<h2 class="t"><a href="', target, '">', title, "</a></h2>")).otherwise(_html('<h2><span><a href="', target, '">', title, "</a></span></h2>")), F.when(key % 4 != 0, _html('<div class="b_caption"><div><p>', note, "</p></div></div>")), "</li>")
    two = _html('<div class="links result web-result">', F.when(key % 9 != 0, _html('<a class="result__a" href="', target, '">', title, "</a>")), F.when(key % 4 != 0, _html('<a class="result__snippet">', note, "</a>")), "</div>")
    found = _as_pages(table(spark, sf, "part"), "p_partkey", 10, F.when(odd, two).otherwise(one))
    return spread(found, 2000).select("page", F.explode(pages.search_hits()(F.col("html"))["hits"]).alias("h")).select("page", "h.*")


@_query("""SELECT vendor_id // 5 AS page, CASE WHEN vendor_id % 2 = 0 THEN 'Physician' ELSE 'MedicalClinic' END AS kind, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS name, '/v/' || vendor_id AS url,
    CASE WHEN vendor_id % 3 = 0 THEN '' ELSE 'Road ' || vendor_id END AS street, CASE WHEN vendor_id % 3 = 1 THEN 'Nation ' || nation_id ELSE '' END AS locality,
    CASE vendor_id % 4 WHEN 0 THEN '+593 ' || vendor_id WHEN 1 THEN '04 ' || vendor_id ELSE '' END AS phone, CAST(CASE WHEN vendor_id % 3 = 0 THEN 0 ELSE 1 END AS INTEGER) AS parts FROM vendors WHERE name IS NOT NULL
  UNION ALL SELECT vendor_id // 5, 'Review', 'Review ' || vendor_id, '', '', '', '', 0 FROM vendors WHERE vendor_id % 10 = 4""")
def microdata_records(spark, sf) -> DataFrame:
    """Cards whose address is an item in the item; reviews that stand in a card without being its property are items too."""
    ship(spark)
    key = F.col("vendor_id")
    address = _html('<p itemprop="address" itemscope itemtype="http://schema.org/PostalAddress"><span itemprop="streetAddress">Road <b>', key, "</b></span>", F.when((key % 3 == 1) & F.col("nation_id").isNotNull(), _html('<span itemprop="addressLocality">Nation ', F.col("nation_id"), "</span>")), '<span itemprop="name">no name</span></p>')
    phone = _either(key, _html('<meta itemprop="telephone" content="+593 ', key, '">'), _html('<span itemprop="telephone">04 ', key, "</span>"), "", "")
    card = _html('<div class="negocio" itemscope itemtype="http://schema.org/', _either(key, "Physician", "MedicalClinic"), '"><a itemprop="url" href="/v/', key, '">', F.when(F.col("name").isNotNull(), _html('<h2 itemprop="name">', F.col("name"), "</h2>")), "</a>",
                 F.when(key % 3 != 0, address), phone, F.when(key % 10 == 4, _html('<div itemscope itemtype="http://schema.org/Review/"><i itemprop="name">Review ', key, "</i></div>")), "</div>")
    found = _as_pages(table(spark, sf, "vendors"), "vendor_id", 5, card)
    return spread(found, 2000).select("page", F.explode(pages.microdata()(F.col("html"))["records"]).alias("r")).select("page", "r.*")


@_query("""SELECT url, CASE WHEN max(page_id) FILTER (page_id % 3 <> 0 AND page_id * 3600 > m - 7 * 86400) IS NOT NULL THEN 'cached' WHEN count(*) FILTER (page_id % 2 = 0 AND page_id % 10 NOT IN (4, 6)) > 0 THEN 'fetched'
    WHEN count(*) FILTER (page_id % 2 = 0) > 0 THEN 'refused' ELSE 'missing' END AS state, coalesce('cache ' || max(page_id) FILTER (page_id % 3 <> 0 AND page_id * 3600 > m - 7 * 86400), 'page ' || max(page_id) FILTER (page_id % 2 = 0 AND page_id % 10 NOT IN (4, 6))) AS html
  FROM (SELECT *, (SELECT max(page_id) FROM pages) * 3600 AS m FROM pages) WHERE url IS NOT NULL GROUP BY url, m""")
def fetch_states(spark, sf) -> DataFrame:
    """What a crawl has of each url: a snapshot of the last week, or an answer of today, some of which are refusals by status or by
    their text, or nothing."""
    p = table(spark, sf, "pages").select("page_id", "url")
    k, at = F.col("page_id"), F.timestamp_seconds(F.col("page_id") * 3600)
    cache = p.where(k % 3 != 0).select("url", at.alias("at"), _html("cache ", k).alias("html"))
    answers = p.where(k % 2 == 0).select("url", at.alias("at"), F.when(k % 10 == 4, F.lit("<title>CAPTCHA</title>")).otherwise(_html("page ", k)).alias("html"), F.when(k % 10 == 6, 429).otherwise(200).alias("status"))
    newest = p.agg(F.max(at)).first()[0]
    return files.settled(p, cache, answers, "url", "at", "html", "status", F.lit(newest).cast("timestamp"))


@_query(r"""WITH b AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g') AS s FROM pages),
  c AS (SELECT page_id, regexp_replace(regexp_replace(s, '(?is)^.*?<body[^>]*>', ''), '(?is)</body>.*$', '') AS s FROM b), d AS (SELECT page_id, regexp_replace(s, '<[^>]*>', ' ', 'g') AS s FROM c),
  e AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(s, '&nbsp;', ' '), '&quot;', '"'), '&#39;', chr(39)), '&apos;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS s FROM d),
  f AS (SELECT page_id, trim(regexp_replace(s, '[\s\x0b\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}]+', ' ', 'g')) AS s FROM e) SELECT page_id, CAST(length(s) AS INTEGER) AS chars, md5(s) AS digest FROM f""")
def page_texts(spark, sf) -> DataFrame:
    """The text of a page's body, without scripts and styles."""
    t = pages.body_text("html")
    return table(spark, sf, "pages").select("page_id", F.length(t).alias("chars"), F.md5(t).alias("digest"))

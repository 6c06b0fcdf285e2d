from pyspark.sql import functions as F

from recordloom.functions import contacts, rules, text
from recordloom.operators import claims, consolidating, matching
from recordloom.sources import pages


def test_claims_of_nulls_and_empty_lists(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, "u.co", [], []), (3, None, ["x", None], [None, "A@Gmail.com"])], "id int, url string, phones array<string>, mails array<string>")
    got = claims.profile_claims(df, ["id"], "phones", "mails", claims.country_by_suffix(F.col("url"), "u", {"co": "CO"}, "CR")).collect()
    assert [(r["id"], r["attribute"], r["value"], r["subkind"]) for r in got] == [(3, "email", "a@gmail.com", "personal")]


def test_page_claims_of_nulls(spark):
    df = spark.createDataFrame([(1, None, None, [("a@b.cr", 0.9), (None, 0.5)])], "id int, url string, phones array<struct<value:string,proximity:double>>, mails array<struct<value:string,proximity:double>>")
    got = claims.page_claims(df, ["id"], "url", "phones", "mails").collect()
    assert [(r["value"], r["subkind"]) for r in got] == [("a@b.cr", "clinic")]
    assert claims.page_claims(df, ["id"], "url", "phones", "mails", skip=("b.cr",)).count() == 0


def test_best_claim_ties_and_join(spark):
    c = spark.createDataFrame([("N A", "phone", "1", 0.5, 2), ("N A", "phone", "2", 0.5, 1), ("N B", "email", "e", 0.4, 1)], "name string, attribute string, value string, confidence double, at int")
    best = claims.best_claims(c, "name", "at")
    records = spark.createDataFrame([("n", None, "a"), ("n", "x", "a")], "f string, s string, g string")
    got = claims.with_best_claims(records, claims.name_as_key("f", "s", "g"), best, "name").collect()
    assert sorted((r["s"] or "", r["found_phone"], r["found_email"]) for r in got) == [("", "2", ""), ("x", "", "")]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "id int, w array<string>, s string")
    assert matching.known_by_surname(none, none.withColumnRenamed("id", "k"), "w", "w", "s").count() == 0
    assert matching.first_contained(none, none.withColumnsRenamed({"id": "b", "w": "v"}), "id", "b", "w", "v").count() == 0
    assert [tuple(r) for r in consolidating.rates(none, {"any": F.col("id").isNotNull()}).collect()] == [("any", 0, 0, 0.0)]


def test_known_by_surname_keeps_repeated_rows(spark):
    left = spark.createDataFrame([(1, ["A", "B"]), (1, ["A", "B"]), (2, ["B", "C", "D", "E"])], "id int, w array<string>")
    known = spark.createDataFrame([(["A", "B", "C"], "A"), (["B", "C", "D", "Z"], "B"), ([], "")], "v array<string>, s string")
    got = matching.known_by_surname(left, known, "w", "v", "s")
    assert sorted(r["id"] for r in got.collect()) == [1, 1, 2]


def test_small_columns(spark):
    row = spark.createDataFrame([(None, '[{"ESPECIALIDAD":"PEDIATRÍA"},{"x":1}]', "Río Dos")], "none string, raw string, place string")
    got = row.select(
        text.nested_names(F.array("none", "raw", F.lit("[broken"))).alias("names"),
        rules.first_pattern(F.col("none"), [("A", "x")]).alias("post"),
        rules.place_suffix(F.col("place"), ["dos"]).alias("place"),
        rules.province(F.col("none"), F.col("none"), {"P": ["q"]}, F.lit("P"), F.lit(False)).alias("province"),
        contacts.common_addresses(F.lit("Ana"), F.lit("Soto"), F.lit("Vega"), "x").alias("five"),
        contacts.common_addresses("none", F.lit("Soto"), "none").alias("nobody"),
        F.size(pages.autocompleted("none")).alias("rows"),
        F.size(pages.cards("none", "<li")).alias("cards"),
        text.candidate_urls("u/", text.parse_family_first(F.lit("SOTO VEGA ANA MARIA"))).alias("urls"),
    ).first()
    assert got["names"] == "Pediatría | [broken"
    assert (got["post"], got["place"], got["province"]) == (None, "dos", None)
    assert got["five"] == ["ana.soto@x.com", "anasoto@x.com", "asoto@x.com", "ana.soto.vega@x.com", "sotovegaana@x.com"]
    assert (got["nobody"], got["rows"], got["cards"]) == ([], 0, 0)
    assert got["urls"] == ["u/ana-maria-soto-vega", "u/ana-maria-soto", "u/ana-soto"]

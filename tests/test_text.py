import pytest
from pyspark.sql import functions as F

from recordloom.functions import contacts, ratio, scores, text
from recordloom.sources import files, pages


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [
    ("SOTO VEGA ANA MARIA", ("SOTO", "VEGA", "ANA MARIA")),
    ("SOTO VEGA MARIA DE LOS ANGELES", ("SOTO", "VEGA", "MARIA DE LOS ANGELES")),
    ("SOTO PI#AR LUIS", ("SOTO", "PIÑAR", "LUIS")),
    ("SOTO", ("SOTO", None, "")),
    ("  SOTO   VEGA\nANA  ", ("SOTO", "VEGA", "ANA")),
    ("DE LA ROSA X", ("DE", "LA", "ROSA X")),
    ("", ("", None, "")),
])
def test_family_first(spark, raw, want):
    assert tuple(one(spark, text.parse_family_first("c"), c=raw))[:3] == want


@pytest.mark.parametrize("raw,want", [
    ("Luis Alberto Soto De Prado", ("SOTO", "DE PRADO", "LUIS ALBERTO")),
    ("Ana Soto", ("SOTO", None, "ANA")),
    ("Maria Del Pilar Soto De La Rosa", ("SOTO", "DE LA ROSA", "MARIA DEL PILAR")),
    ("", ("", None, "")),
])
def test_given_first(spark, raw, want):
    assert tuple(one(spark, text.parse_given_first("c"), c=raw))[:3] == want


def test_display_initials_and_titles(spark):
    name = text.parse_family_first("c")
    assert one(spark, text.display_name(name), c="SOTO VEGA ANA MARIA") == "Soto Vega, Ana Maria"
    assert one(spark, text.initials(name), c="SOTO VEGA ANA") == "S.V.A."
    assert one(spark, text.title_case("c"), c="o'neill pérez-gómez") == "O'Neill Pérez-Gómez"
    assert tuple(one(spark, text.split_title("c"), c="Dra. Ana Soto")) == ("Dra", "Ana Soto")
    assert one(spark, text.slug("c"), c=" Niño, Straße! ") == "nino-strasse"
    assert one(spark, text.clean_spaces("c"), c="a  b ") == "a b"
    assert one(spark, text.match_tokens("c"), c="Dr. José de la Peña") == ["JOSE", "PENA"]


def test_normalisers_are_idempotent(spark):
    for f in (text.base_clean, text.slug, text.match_name, text.title_case):
        first = one(spark, f("c"), c="  Dr. José  PI#AR-López ")
        assert one(spark, f("c"), c=first) == first


@pytest.mark.parametrize("raw,want", [("\nfoo@bar.com", "foo@bar.com"), ('"foo\n@bar.com"', "foo@bar.com"), ("FOO@Bar.com;", "foo@bar.com"), ("no-arroba", None), ("a b@c.d", None), ("x@y", None)])
def test_emails(spark, raw, want):
    got = one(spark, contacts.email_parts("c"), c=raw)
    assert (got and got["address"]) == want


def test_email_flags_and_extraction(spark):
    assert one(spark, contacts.email_parts("c"), c="a@gmail.com")["is_freemail"]
    assert one(spark, contacts.emails_in("c"), c="x a@b.com, img@2x.png <a href='mailto:c@d.org?s=1'>") == ["a@b.com", "c@d.org"]


@pytest.mark.parametrize("raw,country,want", [("506 8765-4321", "CR", "+50687654321"), ("+50622345678", "CR", "+50622345678"), ("123", "CR", None), ("6123-4567", "PA", "+50761234567"), ("300 123 4567", "CO", "+573001234567"), ("0991234567", "EC", "+593991234567")])
def test_phones(spark, raw, country, want):
    got = one(spark, contacts.phone_parts("c", country), c=raw)
    assert (got and got["e164"]) == want


def test_hypotheses(spark):
    got = one(spark, contacts.hypotheses(text.parse_family_first("c"), F.lit("x.org")), c="SOTO VEGA ANA MARIA")
    assert [got[0]["address"], got[1]["address"]] == ["ana.soto@x.org", "asoto@x.org"]
    assert len({h["address"] for h in got}) == len(got)
    assert one(spark, contacts.hypotheses(text.parse_family_first("c"), F.lit("")), c="SOTO ANA") == []


@pytest.mark.parametrize("prior,signals,want", [
    (0.40, ["source_tier_2", "phonenumbers_valid", "single_source", "phone_type_mobile"], 0.6888),
    (0.40, ["source_tier_2", "single_source"], 0.4737),
    (0.47, ["source_tier_1", "single_source", "mx_ok"], 0.8557),
    (0.30, ["is_inferred_from_pattern", "mx_ok", "email_domain_matches_affiliation", "source_tier_2"], 0.6576),
    (0.30, ["source_tier_2", "mx_ok", "contradicted_by_tier1"], 0.1046),
    (0.30, ["unknown", "source_tier_2", "source_tier_2", "mx_ok"], 0.5873),
])
def test_confidence(spark, prior, signals, want):
    got = one(spark, scores.confidence(F.array(*map(F.lit, signals)), F.lit(prior)), c="")
    assert round(got, 4) == want


def test_buckets_tiers_and_pairs(spark):
    assert [one(spark, scores.bucket(F.lit(p)), c="") for p in (0.9, 0.7, 0.4)] == ["auto_publish", "human_review", "hypothesis"]
    assert [one(spark, scores.tier(F.lit(u)), c="") for u in ("http://x.gob.pa", "https://facebook.com/a", "http://a.com", None)] == [1, 3, 2, 2]
    same = {"name_token_sort": F.lit(1.0), "name_token_set": F.lit(1.0)}
    assert round(one(spark, scores.pair_probability(same | {"specialty_match": F.lit(1.0)}), c=""), 4) == 0.7685
    assert round(one(spark, scores.pair_probability(same), c=""), 4) == 0.4256
    assert round(one(spark, scores.pair_probability({"email_overlap": F.lit(1.0)}), c=""), 4) == 0.8176
    empty = F.expr("cast(array() as array<string>)")
    assert one(spark, scores.jaccard(empty, empty), c="") == 0.0


def test_ratios():
    assert round(ratio.ratio("clinicabiblia.com", "clinicabiblica.com"), 2) == 97.14
    assert round(ratio.ratio("acme.com", "me.com"), 1) == 85.7
    for a, b in (("abc", "acb"), ("", "x"), ("soto vega", "vega soto ana")):
        assert ratio.token_set(a, b) == ratio.token_set(b, a) and ratio.ratio(a, b) == ratio.ratio(b, a)


def test_name_score(spark):
    cases = [(("MORA", "SALAS", "ELENA"), ("Mora", "SALAS", "ELENA"), 1.0), (("SOTO", "RIVAS", "LUIS"), ("SOTO", "SOTO", "ANA"), 0.1111), (("MORA", "", "ELENA"), ("MORA", "SALAS", "ELENA"), 0.25)]
    rows = [(*a, *b, want) for a, b, want in cases]
    df = spark.createDataFrame(rows, "a string, b string, c string, x string, y string, z string, want double")
    score = ratio.name_score(ratio.agreement(F.col("a"), F.col("x")), ratio.agreement(F.col("b"), F.col("y"), 0.5, 1.0), ratio.agreement(F.col("c"), F.col("z")))
    assert all(round(r["s"], 4) == r["want"] for r in df.select(score.alias("s"), "want").collect())


def test_nearest(spark):
    for domain, want in (("gmial.com", "gmail.com"), ("gmail.com", None), ("clinicabiblia.com", "clinicabiblica.com"), ("zzzzzzzzz", None), ("", None), (None, None)):
        df = spark.createDataFrame([(domain,)], "c string")
        assert df.select(contacts.suggested_domain(F.col("c"))).first()[0] == want, domain
    variants = {"CARD": ["CARDIOLOGIA", "CARDIOLOGO"], "PED": ["PEDIATRIA"]}
    for raw, want in (("Cardiología", "CARD"), ("cardiologa", "CARD"), ("pediatrria", "PED"), ("xyz", None), (None, None)):
        df = spark.createDataFrame([(raw,)], "c string")
        assert df.select(contacts.nearest_category(F.col("c"), variants)).first()[0] == want, raw


def test_proximity(spark):
    words = F.array(F.lit("soto"), F.lit("ana"))
    far = "ana@x.org" + " " * 300 + "Soto"
    for body, target, want in (("Soto ana@x.org", "ana@x.org", 0.9), (far, "ana@x.org", 0.5), ("nothing", "ana@x.org", 0.0), ("Soto", "", 0.5)):
        assert one(spark, scores.proximity(F.col("b"), F.col("t"), words), b=body, t=target) == want


def test_pages(spark):
    html = '<html><title>A &amp; B - Care - City - Site</title><body><script>x</script><h1 itemprop="name">Ana  Soto</h1><a href="tel:+506 1">t</a><a href="mailto:a@b.c?x">m</a><script type="application/ld+json">{"g":[{"@type":"Physician","name":"N"}]}</script></body></html>'
    assert one(spark, pages.title("c"), c=html) == "A & B - Care - City - Site"
    assert tuple(one(spark, pages.title_parts(pages.title("c")), c=html)) == ("A & B", "Care")
    got = one(spark, pages.profile()(F.col("c")), c=html)
    assert (got["name"], got["phones"], got["emails"], got["listed"]) == ("Ana Soto", ["+506 1"], ["a@b.c"], ["N"])


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Nombre;Especialidad;Email\nPeña;X;\n".encode("cp1252"))
    df = files.read_delimited(spark, f"file://{tmp_path}/a.csv", ";", ("utf-8", "cp1252"))
    got = files.bind_roles(df).first()
    assert (got["name"], got["category"], got["email"], got["phone"]) == ("Peña", "X", "", "")
    with pytest.raises(ValueError):
        files.bind_roles(df, required=("assigned",))
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n{"a": 2')
    assert [r["a"] for r in files.read_json_lines(spark, f"file://{tmp_path}/b.jsonl", "a int").collect()] == [1]
    for raw, want in (('{"Type":0,"Data":"{\\"n\\":3}"}', 3), ('{"Type":0,"Data":{"n":4}}', 4)):
        row = spark.range(1).select(F.lit(raw).alias("raw"))
        assert files.open_envelope(row, "raw", "n int").first()["data"]["n"] == want
    files.write_sheets({"s": df}, f"file://{tmp_path}/out")
    files.write_sheets({"s": df}, f"file://{tmp_path}/out")
    assert spark.read.parquet(f"file://{tmp_path}/out/s").count() == 1

"""Token joins, leaders, components and registry matches against plain loops."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from recordloom.functions import ratio, scores
from recordloom.operators import calibration, components, matching
from recordloom.runtime import ship

rng = random.Random(5)


def sets(n, words, most, hot=0.0):
    return [sorted({rng.choice(words) for _ in range(rng.randint(0, most))} | ({"EVERY"} if rng.random() < hot else set())) for _ in range(n)]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_token_joins(spark, least, monkeypatch):
    monkeypatch.setattr(matching, "HOT", 8)
    words = [f"W{k}" for k in range(25)]
    a, b = sets(120, words, 5, 0.9), sets(90, words, 4, 0.7)
    left = spark.createDataFrame([(i, w + w[:1]) for i, w in enumerate(a)] + [(999, None)], "a long, u array<string>").repartition(3)
    right = spark.createDataFrame(list(enumerate(b)) + [(999, None)], "b long, v array<string>").repartition(2)
    got = sorted(map(tuple, matching.shared_tokens(left, right, "a", "b", "u", "v", least).collect()))
    assert got == sorted((i, j, len({*x} & {*y})) for (i, x), (j, y) in itertools.product(enumerate(a), enumerate(b)) if len({*x} & {*y}) >= least)
    for back in (1, 3):
        got = sorted(map(tuple, matching.contained(left, right, "a", "b", "u", "v", least, back).collect()))
        want = []
        for (i, x), (j, y) in itertools.product(enumerate(a), enumerate(b)):
            x, y = {*x}, {*y}
            if len(x & y) >= least and (x <= y or (len(y) >= back and y <= x)):
                want.append((i, j, len(x & y)))
        assert got == sorted(want)


def test_a_token_of_every_row_is_no_key(spark):
    rows = [(k, ["EVERY", f"A{k}", f"B{k % 150}"]) for k in range(300)]
    left, right = spark.createDataFrame(rows, "a long, u array<string>"), spark.createDataFrame(rows, "b long, v array<string>")
    found = matching.shared_tokens(left, right, "a", "b", "u", "v", 2)
    assert found.count() == 600
    met = matching._meet(*(df.withColumn("_rl_t", F.explode(F.slice(matching._ordered(c, ["EVERY"]), 1, 2))) for df, c in ((left, "u"), (right, "v"))), ["EVERY"]).count()
    assert met <= 900  # not 90,000


@pytest.mark.parametrize("pairs", [[(k, k + 1) for k in range(400)], [(0, k) for k in range(1, 3000)], [(7, 7), (1, None), (None, 2)], [], [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)]])
def test_components(spark, pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    edges = spark.createDataFrame(rng.sample(pairs, len(pairs)), "u long, v long")
    assert sorted(map(tuple, components.connected(edges, "u", "v").collect())) == sorted((x, root(x)) for x in parent)


def test_first_fit(spark):
    for n, m in ((1, 0), (30, 40), (40, 200)):
        edges = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)} if m else set()
        edges |= {(k, k + 1) for k in range(12)} if m else set()
        leaders, home = [], {}
        for k in range(n):
            near = [x for x in leaders if (x, k) in edges]
            home[k] = near[0] if near else k
            leaders += [] if near else [k]
        got = components.first_fit(spark.range(n).withColumnRenamed("id", "node"), spark.createDataFrame(list(edges), "a long, b long"))
        assert {r["node"]: r["leader"] for r in got.collect()} == home and got.count() == n


def test_leaders_are_the_loop(spark):
    words = [f"W{k}" for k in range(7)]
    rows = [(rng.choice("pq") if k % 9 else None, w, f"s{rng.randint(0, 2)}", k, rng.choice(["", "", f"m{k}"]), f"u{k}") for k, w in enumerate(sets(70, words, 4))]
    kept = []
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        home = next((x for x in kept if x["g"] == r[0] and r[1] and x["w"] and ({*r[1]} <= {*x["w"]} or {*x["w"]} <= {*r[1]})), None)
        if home is None:
            kept.append({"g": r[0], "w": r[1], "src": r[2], "pos": r[3], "mail": r[4], "n": 1, "url": ""})
            continue
        home["n"] += 1
        if r[2] not in home["src"].split("+"):
            home["src"], home["url"] = f"{home['src']}+{r[2]}", r[5]
        home["mail"] = home["mail"] or r[4]
    df = spark.createDataFrame(rows, "g string, words array<string>, src string, pos long, mail string, url string").repartition(5)
    got = matching.leader_dedupe(df, ["g"], "words", ["src", "pos"], "src", ["mail"], url="url").collect()
    assert sorted((r["pos"], r["src"], r["mail"], r["members"], r["url_2"]) for r in got) == sorted((k["pos"], k["src"], k["mail"], k["n"], k["url"]) for k in kept)
    assert matching.leader_dedupe(df.limit(0), ["g"], "words", ["src", "pos"], "src", ["mail"]).count() == 0


def test_registry(spark):
    ship(spark)
    registry = [(1, "ANA MARIA SOTO VEGA", "QUITO", "a@x"), (2, "ANA SOTO RUIZ", "LOJA", "b@x"), (3, "ANA SOTO RUIZ", "CUENCA", "b@x"), (4, "LUIS MORA PAZ", "QUITO", "c@x"), (5, "LUIS MORA PAS", "QUITO", "d@x"), (6, "EVA LEON", "LOJA", ""), (7, "EVA LEON DIAZ", "LOJA", "e@x"), (8, "EVA LEON RIOS", "LOJA", "f@x")]
    docs = [(1, "ANA SOTO", "QUITO"), (2, "MARIA SOTO VEGA", ""), (3, "ANA SOTO RUIZ", ""), (4, "LUIS MORA PAR", "QUITO"), (5, "EVA LEON", "LOJA"), (6, "EVA", "LOJA"), (7, None, None), (8, "ANA SOTO RUIZ PEREZ GIL", "LOJA"), (2, "MARIA SOTO VEGA", "")]
    d = spark.createDataFrame(docs, "id long, n string, place string").select("id", F.split("n", " ").alias("w"), F.coalesce("place", F.lit("")).alias("place"))
    g = spark.createDataFrame(registry, "rid long, n string, rplace string, email string").select("rid", F.split("n", " ").alias("rw"), "rplace", "email")
    got = sorted((r["id"], r["label"], r["email"], r["rid"], r["candidates"], r["rule"]) for r in matching.match_registry(d, g, "id", "w", "place", "rid", "rw", "rplace", "email", ratio.scorer("token_set")).collect())
    sure = "contencion_unica"
    assert got == [(1, "alta", "a@x", 1, 3, None), (2, "alta", "a@x", 1, 1, sure), (2, "alta", "a@x", 1, 1, sure), (3, "alta", "b@x", 2, 2, sure), (4, "ambiguo", "", 4, 2, None),
                   (5, "ambiguo", "", 7, 2, None), (6, "sin_match", "", None, 0, None), (7, "sin_match", "", None, 0, None), (8, "alta", "b@x", 2, 2, sure)]


def test_strict_scores(spark):
    ship(spark)
    part = "struct<family_name_1:string,family_name_2:string,given_name:string>"
    rows = [(("SOTO", "VEGA", "ANA MARIA"), ("Sóto", "Vega", "Ana"), 1.0), (("SOTO", None, "ANA"), ("SOTO", None, "ANA"), 1.0), (("SOTO", "VEGA", "ANA"), ("SOTO", None, "ANA"), 0.25), (("SOTO", "VEGA", ""), ("SOTO", "VEGA", "ANA"), 0.7), (("", "", ""), ("SOTO", "", "ANA"), 0.0)]
    df = spark.createDataFrame(rows, f"a {part}, b {part}, want double")
    for r in df.select(ratio.strict_name_score(F.col("a"), F.col("b")).alias("s"), "want").collect():
        assert r["s"] == pytest.approx(r["want"])


def test_ruling_names_out_changes_nothing():
    letters = "abcde .-"
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(300)] + ["ana soto", "soto ana", "ana  soto", "ana ana", "x" * 40]
    names, values = ratio.Names([n for n in pool[::2] if n]), pool[1::2] + ["ana soto vega", "zzz", ""]
    for v in values:
        bound = names.bounds(v)
        scores = [ratio.weighted(v, n) for n in names.names]
        assert all(s <= b + 1e-9 for s, b in zip(scores, bound))
        for least in (0.0, 60.0, 88.0):
            top = max((s for s in scores if s >= least), default=None)
            assert names.best(v, least) == (None if not v or top is None else names.names[scores.index(top)]), (v, least)


def test_nearest_values(spark):
    ship(spark)
    df = spark.createDataFrame([("gmial.com",), ("gmail.com",), (None,), ("",), ("zzz",), ("gmial.com",)], "d string")
    got = [tuple(r) for r in ratio.nearest_values(df, "d", ["gmail.com", "ymail.com"], 85.0, "near").collect()]
    assert sorted(got, key=str) == sorted([("gmial.com", "gmail.com"), ("gmail.com", "gmail.com"), (None, None), ("", None), ("zzz", None), ("gmial.com", "gmail.com")], key=str)


def test_calibration(spark):
    rows = [(x / 20, y / 10, None if x == y else 1.0, int(3 * x / 20 - y / 10 + ((x * 7 + y * 13) % 11) / 20 > 1)) for x in range(20) for y in range(15)]
    df = spark.createDataFrame(rows + [(0.5, 0.5, 1.0, None)], "one double, two double, three double, y int")
    got = calibration.calibrate(df, ["one", "two", "three"], "y")
    assert set(got) == {"one", "two", "three", "bias"} and got["one"] > 1 > 0 > got["two"]
    p = df.where("y is not null").withColumn("p", scores.pair_probability({c: F.col(c) for c in ("one", "two", "three")}, got))
    assert p.where((F.col("p") >= 0.5).cast("int") == F.col("y")).count() > 0.85 * len(rows)
    for few in (df.limit(150), df.where("y = 1").union(df.where("y = 1")).union(df.where("y = 1"))):
        with pytest.raises(ValueError):
            calibration.calibrate(few, ["one"], "y")

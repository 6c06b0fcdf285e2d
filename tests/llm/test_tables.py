"""Filter audit, line rules and as-of join: against SQL on whole tables, and against brute force on odd rows."""

import datetime
import glob
import os
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import asof, audit, lines, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
rng = np.random.default_rng(11)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", ["op4_exact_topk", "op6_url_filters", "op11_filter_audit", "op12_quality_rules", "op13_as_of_join"])
def test_against_sql(spark, db, name):
    df, cursor = queries.queries()[name](spark, SF), db.execute(queries.oracle_sql()[name])
    columns, at = sorted(df.columns), [d[0] for d in cursor.description]
    assert sorted(at) == columns
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    assert got and got == sorted((tuple(r[at.index(c)] for c in columns) for r in cursor.fetchall()), key=str)


def fails(text):
    words = WORD.findall(text)
    return [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text))]


def audit_rows():
    long = " ".join(f"w{k}" for k in range(120))
    texts = ["", None, "A", "a # b", long, long.upper(), long + " w1" * 60, "word " * 5000, "é " * 150, long, "\x0b x"]
    rows = [(int(i), texts[int(k)], ["en", "de", None, ""][int(p)]) for i, k, p in zip(rng.permutation(400), rng.integers(0, len(texts), 400), rng.integers(0, 4, 400))]
    return rows + [(7, "same", "en"), (7, "same", "en"), (None, "same", "fr"), (900, "same", "fr"), (None, "alone", "fr")]


@pytest.mark.parametrize("parts", [1, 5, 60])
def test_masks_and_orders(spark, parts):
    rows = audit_rows()
    labels = [(int(i), int(i) % 2, int(i) % 3 == 0) for i in range(0, 950, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mask", F.lit("x")).withColumn("fp", F.lit(1)).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        masks = audit.failure_masks(docs, queries.filters(), "E")
        got = [(r["doc_id"], r["part"], r["mask"]) for r in masks.collect()]
        least = {}
        for i, t, _ in rows:
            if i is not None:
                least[t or ""] = min(i, least.get(t or "", i))
        want = [(i, p or "", sum(f << k for k, f in enumerate([*fails(t or ""), i is not None and i > least[t or ""]]))) for i, t, p in rows]
        assert Counter(got) == Counter(want)
        known = spark.createDataFrame([(i, q, int(t)) for i, q, t in labels] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
        out = {(r["part"], r["filter_order"], r["step"]): r for r in audit.all_orders(audit.mask_counts(masks, known), "ABCDE").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    good, toxic = {i for i, q, _ in labels if q}, {i for i, _, t in labels if t}
    assert len(out) == 600 * len({p for _, p, _ in want})
    for part in {p for _, p, _ in want}:
        here = [(i, m) for i, p, m in want if p == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                bit, r = 1 << "ABCDE".index(f), out[part, "".join(order), step]
                removed = [(i, m) for i, m in left if m & bit]
                gone = sum(1 for i, m in here if m & bit) - len(removed)
                left = [(i, m) for i, m in left if not m & bit]
                total[f] += len(removed)
                assert (r["kept"], r["removed"], r["redundant"], r["unique_fails"]) == (len(left), len(removed), gone, sum(m == bit for _, m in here))
                assert (r["good_lost"], r["toxic_lost"]) == (sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed))
        assert all(r["shapley"] == total[r["filter_order"][r["step"] - 1]] for k, r in out.items() if k[0] == part)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    masks = audit.failure_masks(docs, queries.filters(), "E")
    assert masks.count() == 0
    assert audit.all_orders(audit.mask_counts(masks, spark.createDataFrame([], "doc_id long, quality int, toxic int")), "ABCDE").count() == 0


def repeated(words):
    seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    return len({k + j for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for j in range(8)})


def test_line_figures():
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", "é", " ", "\n", "\n", "a b c d e f g h ", "\t", "\x0b", "#", "*|", " ", "日本"], rng.integers(0, 60)))
        got, words = lines.figures(text), WORD.findall(text)
        kept = [x for x in text.split("\n") if WORD.search(x)]
        assert got["n_words"] == len(words) and got["word_chars"] == sum(map(len, words)) and got["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert got["n_dup_lines"] == len(kept) - len(set(kept)) and got["n_repeat_words"] == repeated(words)
        assert sum(x["chars"] for x in got["lines"]) == got["word_chars"]
    assert lines.figures(None) == lines.figures("") and lines.figures("")["lines"] == []
    long = lines.figures("x y z " * 200_000)
    assert long["n_words"] == long["n_repeat_words"] == 600_000


def test_shared_lines(spark):
    rows = [(k, f"Menu  of the SITE\n{'own words ' * 5}{k}", "a") for k in range(5)] + [(10, "menu of the site", "a"), (11, "menu of the site", "b"), (12, None, "a"), (13, "", None)]
    rows += [(20, "menu of the site", None)] * 9 + [(None, "menu of the site", None), (None, "Menu of the site", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("row", F.lit(5)).withColumn("line", F.lit("x")).repartition(4)
    out = lines.line_frequency(docs, most=5).collect()
    assert len(out) == len(rows)
    got = {r["id"]: (r["removed_chars"], r["depleted"]) for r in out}
    assert got == {**{k: (13, False) for k in range(5)}, 10: (13, True), 11: (0, False), 12: (0, False), 13: (0, False), 20: (0, False), None: (0, False)}
    assert {r["removed_chars"] for r in lines.line_frequency(docs, most=6).collect()} == {0}
    hosts = {r["id"]: r["removed_chars"] for r in lines.line_frequency(docs, most=1).collect()}
    assert hosts[20] == hosts[None] == 13 and hosts[11] == 0  # rows without a host make one; rows without an id are one document
    assert lines.line_frequency(docs.limit(0)).count() == 0


def brute(clicks, orders, back):
    out = []
    for i, k, t in clicks:
        near = [o for o in orders if k is not None and t is not None and o[0] == k and o[1] is not None and t - back <= o[1] <= t]
        at = max((o[1] for o in near), default=None)
        tied = [(o[2] is not None, o[2] or 0, o[3]) for o in near if o[1] == at]
        best = max(tied, default=None)
        out.append((i, k, t, at, best and (best[1] if best[0] else None), best and best[2], len(tied)))
    return out


@pytest.mark.parametrize("back", [3, 200, 10**7])
def test_as_of(spark, back, monkeypatch):
    monkeypatch.setattr(asof, "HOT", 4)
    monkeypatch.setattr(asof, "DEEP", 2 if back == 200 else 10_000)
    monkeypatch.setattr(asof, "BITS", 2 if back == 200 else 6)
    for span in (20, 3000, 10**9):
        pick = lambda n: [None if x < 0 else int(x) for x in rng.integers(-1, n, 600)]
        clicks = [(i, 1 if i % 3 == 0 else k, t if t is None else t - span // 2) for i, (k, t) in enumerate(zip(pick(6), pick(span)))] + [(None, 1, 5)]
        orders = [(1 if i % 3 == 0 else k, t if t is None else t - span // 2, v, i) for i, (k, t, v) in enumerate(zip(pick(7), pick(span), pick(4)))]
        left = spark.createDataFrame(clicks + clicks[:50], "click_id long, client_id long, t long").withColumn("key", F.lit("x")).withColumn("found", F.lit(0))
        right = spark.createDataFrame(orders, "client_id long, at long, total long, sale_id long").withColumn("salt", F.lit(1)).repartition(3)
        out = asof.as_of(left, right, "click_id", "client_id", "t", "at", ["total", "sale_id"], back).select("id", "key", "t", "found.t", "found.best.total", "found.best.sale_id", F.coalesce("found.n", F.lit(0)))
        assert Counter(map(tuple, out.collect())) == Counter(brute(clicks, orders, back))
    assert asof.as_of(left, right.limit(0), "click_id", "client_id", "t", "at", ["total", "sale_id"], back).where("found is null").count() == 601
    assert asof.as_of(left.limit(0), right, "click_id", "client_id", "t", "at", ["total", "sale_id"], back).count() == 0


def test_micros_do_not_depend_on_the_zone(spark):
    at = datetime.datetime(2024, 3, 31, 2, 30, 0, 123456)
    df = spark.createDataFrame([(at,), (None,)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert [r[0] for r in df.select(asof.micros(df, "t")).collect()] == [1711852200123456, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

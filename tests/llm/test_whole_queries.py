"""The registered queries of the models and the token operators on the given tables."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from recordloom.llm import queries, simhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ids(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    return {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in rows}


def crc(tokens):
    return zlib.crc32(np.array(tokens, "<u4").tobytes())


def test_op9(spark, ids):
    out = [r.asDict() for r in queries.op9_best_fit_packing(spark, SF).collect()]
    pieces, bins = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(ids)
    for k, tokens in ids.items():
        tokens, own = tokens + [0], sorted(pieces[k], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and [r["start"] for r in own] == list(np.cumsum([0, *(r["length"] for r in own)])[:-1])
        assert sum(r["length"] for r in own) == len(tokens) and all(r["ids_crc32"] == crc(tokens[r["start"] : r["start"] + r["length"]]) for r in own)
        assert len(own) == 1 if len(tokens) <= 2048 else all(r["length"] == 2048 for r in own[1:])
    for held in bins.values():
        held.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in held] == list(np.cumsum([0, *(r["length"] for r in held)])[:-1]) and sum(r["length"] for r in held) <= 2048
    assert len(bins) <= 1.02 * sum(r["length"] for r in out) / 2048 + 1


def test_op10(spark, ids):
    out, at = sorted(map(tuple, queries.op10_token_shards(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())), 0
    want = []
    for k in sorted(ids):
        tokens = ids[k] + [2]
        want.append((k, at, len(tokens), crc(tokens)))
        at += len(tokens)
    assert out == want


@pytest.mark.parametrize("name, label, least, most", [("op1_toxicity", "toxic", 0.5, 0.05), ("op8_quality", "quality", 0.95, 0.1)])
def test_held_out_rows(spark, name, label, least, most):
    """Recall of label 1 and false positives on rows whose labels the model has not seen; scores depend on the text alone."""
    sf = "/root/testdata/sf0.01"
    scored = queries.queries()[name](spark, sf)
    rows = scored.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "doc_id").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    by_text = {}
    assert all(by_text.setdefault(r["text"] or "", r["score"]) == r["score"] for r in rows)
    up = [r["predicted"] for r in rows if r["held_out"] and r[label] == 1]
    down = [r["predicted"] for r in rows if r["held_out"] and r[label] == 0]
    assert sum(up) >= least * len(up) and sum(down) <= most * len(down) + 1


def test_filters_keep_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long, "a"), (2, long, "b"), (2, long, "c"), (3, None, "d"), (4, "", "e"), (None, long + " more", "f"), (5, "short", "g"), (5, "short", "h"), (6, "x " * 200_000, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("score", F.lit(1)).withColumn("component_id", F.lit("c"))
    kept = simhash.keep_one(docs, shingle=5, words=12, width=32, radius=36, similarity=0.8)
    assert kept.columns == docs.columns
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert (False, 1) in found and (False, 2) not in found and (False, 6) in found
    assert simhash.keep_one(docs.limit(0), shingle=5, words=12, width=32, radius=36, similarity=0.8).count() == 0
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    left = toxicity.drop_toxic(docs, labels, F.lit(True))  # one label only: all texts score alike, and none is known to be toxic
    assert left.columns == docs.columns and left.count() == len(rows)
    assert toxicity.drop_toxic(docs.limit(0), labels, F.lit(True)).count() == 0


def test_one_of_each_group(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "  ", "c"), (4, "one two", "d"), (4, "one two", "e"), (5, "one two", "f"), (4, "other words here", "g"), (None, "one two", "h"), (None, "lonely text", "i")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, x string"), shingle=5, words=12, width=32, radius=36, similarity=0.8).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept) == [(False, 1, ""), (False, 4, "one two"), (False, 4, "other words here"), (True, 0, "lonely text")]

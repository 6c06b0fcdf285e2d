"""Benchmark decontamination by spaced seeds.

A fixed mask picks some positions of a run of tokens and ignores the others, so a substituted token at an ignored
position leaves the seed as it is.  The hashes of all masks at all positions of the benchmark are brought to the
documents, whose own hashes are looked up as they are made.  Each hit gives a diagonal; along it the document is laid
against the whole benchmark item and substitutions are counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..runtime import ship

#: Fixed masks; 1 is a position that counts.  Any two of 13 positions leave one of weight 6 whole.
MASKS = ("111111", "1111011", "11011011", "1101001101", "10110100011")
#: Those of items under SHORT tokens: any substitutions that are allowed leave three tokens in a row whole.
BRIEF, SHORT = ("111", "11", "1"), 14
#: Items under so many tokens are found verbatim only.
VERBATIM = 6
#: Benchmark tokens that one pass over the documents carries along; more are taken in several passes.
PASS_TOKENS = 2_000_000
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")


def tokens(text: str) -> list[str]:
    """Lower-cased words between white space, without punctuation at their ends."""
    return [_EDGE.sub("", w) for w in text.lower().split()]


class Seeds:
    """The benchmark, in token numbers, with its sorted seed hashes."""

    def __init__(self, items: list[tuple[int, str]], overlap: int, similarity: float):
        self.overlap, self.similarity = overlap, similarity
        self.names, texts = [], []
        for item, text in items:
            if words := tokens(text or ""):
                self.names.append(item)
                texts.append(words)
        self.number = {w: n for n, w in enumerate(sorted({w for t in texts for w in t}), 1)}  # 0: any other token
        self.items = [np.array([self.number[w] for w in t], np.int64) for t in texts]
        rng = np.random.default_rng(20)
        self.masks = MASKS + BRIEF
        self.factor = rng.integers(1, 2**63, (len(self.masks), 16), dtype=np.uint64) | np.uint64(1)
        hashes, item, at = [], [], []
        self.used: set[int] = set()
        for i, x in enumerate(self.items):
            own = range(len(MASKS)) if len(x) >= SHORT else [len(MASKS) + 3 - min(3, len(x))]
            self.used.update(own)
            for m in own:
                h, ok = self.hashes(x, m)
                p = np.flatnonzero(ok)
                hashes.append(h[p])
                item.append(np.full(len(p), i))
                at.append(p)
        empty = [np.empty(0, np.int64)]
        h = np.concatenate([*hashes, np.empty(0, np.uint64)])
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.at = h[order], np.concatenate(item + empty)[order], np.concatenate(at + empty)[order]
        self.bits = max(16, int(np.ceil(np.log2(max(1, len(h)) * 16))))
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self.hash >> np.uint64(64 - self.bits)] = True
        self.memo: dict[str, int] = {}

    def hashes(self, x: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, whether all counted positions hold benchmark tokens) for each position of the mask."""
        span, n = len(self.masks[mask]), len(x) - len(self.masks[mask]) + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        h, ok, known = np.full(n, mask, np.uint64), np.ones(n, bool), x > 0
        u = x.astype(np.uint64)
        for j in range(span):
            if self.masks[mask][j] == "1":
                h = (h ^ u[j : j + n]) * self.factor[mask, j]
                h ^= h >> np.uint64(29)
                ok &= known[j : j + n]
        return h, ok

    def numbers(self, text: str) -> np.ndarray:
        words = text.lower().split()
        memo = self.memo
        try:
            return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(memo) > 500_000:
                memo.clear()
            for w in set(words).difference(memo):
                memo[w] = self.number.get(_EDGE.sub("", w), 0)
            return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))

    def hits(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(item, first token, tokens, similarity) of the best overlap with each item."""
        if not text or not len(self.hash):
            return []
        x = self.numbers(text)
        diagonals: set[tuple[int, int]] = set()
        for m in sorted(self.used):
            h, ok = self.hashes(x, m)
            p = np.flatnonzero(ok)
            p = p[self.table[h[p] >> np.uint64(64 - self.bits)]]
            lo, hi = np.searchsorted(self.hash, h[p], "left"), np.searchsorted(self.hash, h[p], "right")
            for q, s, e in zip(p[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                diagonals.update((int(i), q - int(a)) for i, a in zip(self.item[s:e], self.at[s:e]))
        best: dict[int, tuple[int, int, float]] = {}
        for i, d in sorted(diagonals):
            y = self.items[i]
            s, e = max(0, d), min(len(x), d + len(y))
            need = min(self.overlap, len(y))
            if e - s < need:
                continue
            same = x[s:e] == y[s - d : e - d]
            run = np.concatenate([[0], np.cumsum(same)])
            inside = run[need:] - run[:-need]
            ok = np.flatnonzero(inside >= (need if len(y) < VERBATIM else np.ceil(self.similarity * need - 1e-9)))
            if len(ok):
                first, last = int(ok[0]), int(ok[-1]) + need
                found = (s + first, last - first, float(run[last] - run[first]) / (last - first))
                if i not in best or (found[1], found[2]) > best[i][1:]:
                    best[i] = found
        return [(self.names[i], *best[i]) for i in sorted(best)]


_HITS = "array<struct<item_id:long,first_token:int,n_tokens:int,similarity:double>>"


def passes(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows, by parts of bounded size."""
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    total = rows.agg(F.coalesce(F.sum(F.size(F.split("t", r"\s+"))), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // PASS_TOKENS)) if total > PASS_TOKENS else 1
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else rows
        yield [(r["i"], r["t"]) for r in part.orderBy("i", "t").collect()]


def overlaps(spark: SparkSession, items: list[tuple[int, str]], overlap: int = 13, similarity: float = 0.8):
    """A column function: the benchmark items that a text overlaps, each with its best overlap."""
    shared = spark.sparkContext.broadcast(Seeds(items, overlap, similarity))

    @F.pandas_udf(_HITS)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seeds = shared.value
        for texts in parts:
            yield pd.Series([[dict(zip(("item_id", "first_token", "n_tokens", "similarity"), h)) for h in seeds.hits(t)] for t in texts], dtype=object)

    return lambda text: found(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", overlap: int = 13, similarity: float = 0.8) -> DataFrame:
    """(id, item_id, first_token, n_tokens, similarity): the documents that overlap a benchmark item, a row for each item.

    An overlap is a stretch, without insertions, in which each ``overlap`` tokens in a row (or all of a shorter item's)
    agree in at least ``similarity`` of their positions; items under 6 tokens must agree in all.  Tokens are lower-cased words
    without punctuation at the ends.  Null and empty texts on either side overlap nothing; repeated rows give repeated
    rows; empty tables give none.  Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    out = None
    for items in passes(benchmark):
        hits = docs.select(F.col(id_col), overlaps(spark, items, overlap, similarity)(F.col(text_col)).alias("hits")).select(id_col, F.inline("hits"))
        out = hits if out is None else out.unionByName(hits)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", overlap: int = 13, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with all their columns; null and empty texts stay, repeated rows go or
    stay alike, an empty table stays empty, and an empty benchmark takes nothing out."""
    spark = docs.sparkSession
    ship(spark)
    for items in passes(benchmark):
        docs = docs.withColumn("_rl_hits", overlaps(spark, items, overlap, similarity)(F.col(text_col))).where(F.size("_rl_hits") == 0).drop("_rl_hits")
    return docs

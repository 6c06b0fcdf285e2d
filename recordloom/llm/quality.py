"""Quality scores by an SVM on Naive Bayes features (Wang and Manning, 2012).

A text's features are indicators of its byte n-grams and of n-grams of word shapes, hashed to a fixed number of columns.
Each indicator is scaled by the log ratio of how often documents of either class hold it, rows are brought to unit
length, and a linear hinge-loss model is fitted by dual coordinate descent.  The sample of labelled rows is bounded;
scoring reads every text whole and shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import ship
from .learning import balanced, calibrate, dual_coordinate_descent, labelled_sample, probability

#: Columns of the hashed features; labelled rows of each label that the model is fitted on.
COLUMNS, SAMPLE = 1 << 18, 3000
_RUNS = [(re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() else "a" if m[0].islower() else "Aa"), (re.compile(r"\d+"), "0"), (re.compile(r"(\W)\1+"), r"\1\1")]
_SAME = 1


class Features:
    """Distinct feature columns of a text; word shapes are remembered."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}
        self.flags = np.zeros(COLUMNS, bool)

    def _shape(self, word: str) -> int:
        for pattern, by in _RUNS:
            word = pattern.sub(by, word)
        return xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) & 0x7FFFFFFF | 2

    def shapes(self, text: str) -> np.ndarray:
        words = text.split()
        memo = self.memo
        try:
            codes = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(memo) > 500_000:
                memo.clear()
            for w in set(words).difference(memo):
                memo[w] = len(memo) << 32 | self._shape(w)
            codes = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        shape = codes & 0xFFFFFFFF
        if len(codes) > 1:
            shape[1:][codes[1:] == codes[:-1]] = _SAME  # the word before, again
        return shape

    def __call__(self, text: str) -> np.ndarray:
        flags, mul = self.flags, np.uint32(0x9E3779B1)
        shift = np.uint32(32 - COLUMNS.bit_length() + 1)
        data = np.frombuffer(text.encode(), np.uint8)
        for s in range(0, max(1, len(data)), 1 << 20):
            x = data[s : s + (1 << 20) + 2].astype(np.uint32) + np.uint32(1)
            h = x
            for n in range(3):
                if n:
                    h = h[:-1] * np.uint32(257) + x[n:]
                if not len(h):
                    break
                flags[((h + np.uint32(n << 28)) * mul) >> shift] = True
        shape = self.shapes(text).astype(np.uint32)
        h = shape
        for n in range(3):
            if n:
                h = h[:-1] * np.uint32(0x01000193) + shape[n:]
            if not len(h):
                break
            flags[((h ^ np.uint32(0x5BD1E995 + n)) * mul) >> shift] = True
        at = np.flatnonzero(flags)
        flags[at] = False
        return at


class Model:
    def __init__(self, sample: list[tuple[str, int]], smoothing: float = 1.0, c: float = 1.0):
        features = Features()
        rows = [features(t) for t, _ in sample]
        y = np.array([1 if label else -1 for _, label in sample])
        held = np.arange(len(rows)) % 5 == 4  # for calibration
        fit = np.flatnonzero(~held)
        counts = np.full((2, COLUMNS), smoothing)
        for i in fit:
            counts[int(y[i] > 0), rows[i]] += 1
        counts /= counts.sum(axis=1, keepdims=True)
        self.ratio = np.log(counts[1] / counts[0]) if (y[fit] > 0).any() and (y[fit] < 0).any() else np.zeros(COLUMNS)
        unit = [self._unit(rows[i]) for i in fit]
        w = dual_coordinate_descent([(np.append(at, COLUMNS), np.append(v, 1.0)) for at, v in unit], y[fit].astype(float), COLUMNS + 1, balanced(y[fit], c))
        self.bias, self.weight, self.square = float(w[-1]), (w[:-1] * self.ratio).astype(np.float32), (self.ratio**2).astype(np.float32)
        margins = np.array([self.margin(rows[i]) for i in np.flatnonzero(held)])
        self.a, self.b = calibrate(margins, y[held]) if held.any() else (1.0, 0.0)
        self.a = max(self.a, 0.0)

    def _unit(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.ratio[at]
        return at, v / max(1e-12, float(np.sqrt(v @ v)))

    def margin(self, at: np.ndarray) -> float:
        return self.bias + float(self.weight[at].sum(dtype=np.float64)) / max(1e-6, float(np.sqrt(self.square[at].sum(dtype=np.float64))))

    def score(self, at: np.ndarray) -> float:
        return probability(self.margin(at), self.a, self.b)


def quality_score(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", sample: int = SAMPLE):
    """A column function: the probability, from 0 to 1, that a text has label 1.

    The model is fitted on at most ``sample`` labelled documents of each label, chosen by a hash of their ids among the
    rows of ``labels`` for which ``learn`` holds; only texts are read.  Null and empty texts get the score of a text
    without features.  With no labelled rows, or one label only, all texts get the share of label 1, softened.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(Model(labelled_sample(docs, labels, label, learn, {0: sample, 1: sample}, id_col, text_col)))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, features = shared.value, Features()
        for texts in parts:
            yield pd.Series([model.score(features(t or "")) for t in texts], dtype="float64")

    return lambda text: score(text)

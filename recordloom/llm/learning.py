"""What the two classifiers share: labelled samples, linear SVMs by dual coordinate descent, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: dict[int, int], id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """(text, label) of a bounded sample: at most ``most[y]`` documents of each label y, chosen by a hash of their ids.

    ``learn`` says of a row of labels whether it may be used.  A document labelled several times has its largest label;
    of several documents with one id the first text in order is used."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(*most)).where(learn).groupBy(id_col).agg(F.max(label).alias("y"))
    order = [F.xxhash64(id_col), F.col(id_col)]
    chosen = None
    for y, n in most.items():
        part = known.where(F.col("y") == y).orderBy(*order).limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), id_col)  # bounded by ``most``
    rows = rows.groupBy(id_col).agg(F.min("text").alias("text"), F.max("y").alias("y"))
    return [(r["text"], r["y"]) for r in rows.orderBy(*order).collect()]


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, cost: np.ndarray, epochs: int = 12, seed: int = 7) -> np.ndarray:
    """Weights of the L2-regularised hinge-loss SVM (Hsieh et al., 2008); rows are (indices, values), y is -1 or 1."""
    w, alpha = np.zeros(dims), np.zeros(len(rows))
    square = np.array([float(v @ v) for _, v in rows])
    rng = np.random.default_rng(seed)
    active = np.flatnonzero(square > 0)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(active).tolist():
            at, v = rows[i]
            gradient = y[i] * float(w[at] @ v) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if (step := new - alpha[i]) != 0.0:
                w[at] += step * y[i] * v
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def balanced(y: np.ndarray, c: float) -> np.ndarray:
    """A cost for each row so that both classes weigh the same."""
    n, up = len(y), max(1, int((y > 0).sum()))
    return np.where(y > 0, c * n / (2 * up), c * n / (2 * max(1, n - up)))


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a * margin + b))) of label 1, by Newton's method on softened targets."""
    up = int((y > 0).sum())
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (len(y) - up + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g = np.array([((p - target) * margin).sum() + 1e-4 * a, (p - target).sum()])
        s = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * margin * margin).sum() + 1e-4, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def probability(margin: float, a: float, b: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35))))

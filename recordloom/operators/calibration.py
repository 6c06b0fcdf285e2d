"""Coefficients of the pair score from labelled pairs."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

#: Labelled pairs that a calibration takes at least.
LEAST = 200


def calibrate(pairs: DataFrame, features: list[str], label: str, regularisation: float = 0.01) -> dict[str, float]:
    """{feature: coefficient, "bias": intercept} of a logistic regression, for scores.pair_probability to be used with.

    A feature that a pair lacks counts as 0, as it does in the score; pairs without a label are left out.  Fewer than LEAST
    labelled pairs, or pairs of one label only, are an error: the coefficients would be noise."""
    known = pairs.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_rl_y"), *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    counts = {r["_rl_y"]: r["count"] for r in known.groupBy("_rl_y").count().collect()}
    if sum(counts.values()) < LEAST or len(counts) < 2:
        raise ValueError(f"{LEAST} labelled pairs of both labels are needed, not {counts}")
    rows = VectorAssembler(inputCols=features, outputCol="_rl_x").transform(known)
    model = LogisticRegression(featuresCol="_rl_x", labelCol="_rl_y", regParam=regularisation, maxIter=50, standardization=False).fit(rows)
    return {**dict(zip(features, map(float, model.coefficients))), "bias": float(model.intercept)}

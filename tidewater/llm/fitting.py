"""Bounded fitting of the two classifiers: labelled samples and a logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import scratch

#: Penalty of the logistic fit.
RIDGE = 1e-2
STEPS = 50


def remainder(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))


def labelled_sample(labels: DataFrame, column: str, learn, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids that may be learnt from: __id, __label (0 or 1), __rank (random, 0 to 1).

    The ids with the smallest hash are taken.  Rows without id or label are left
    out; an id labelled both ways counts as 1.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & learn)
    per_id = usable.groupBy(F.col("doc_id").cast("bigint").alias("__id")).agg(F.max((F.col(column) > 0).cast("int")).alias("__label"))
    rank = F.pmod(F.xxhash64(F.lit(11), "__id"), F.lit(1 << 40)) / float(1 << 40)
    taken = per_id.orderBy(F.xxhash64(F.lit(10), "__id"), "__id").limit(rows)
    return scratch(taken.withColumn("__rank", rank).coalesce(1), "labelled")


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the constant first) of a logistic regression by Newton steps; zeros but the constant without both classes."""
    design = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(design.shape[1])
    if not len(y) or y.min() == y.max():
        w[0] = 0.0 if not len(y) else (3.0 if y[0] else -3.0)
        return w
    def loss(v: np.ndarray) -> float:
        z = design @ v
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + RIDGE / 2 * (v @ v))

    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        slope = design.T @ (y - p) - RIDGE * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def probability(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    z = w[0] + x @ w[1:]
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

"""Bounded labelled samples, and small models in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sampled(keys: DataFrame, rows: int, stratum: str | None = None, seed: int = 7) -> DataFrame:
    """About ``rows`` of the ids of ``keys`` (which has a ``doc_id``), in each stratum an equal part of that, chosen by a
    hash of the id: the same in every run, one row for each id. Never more than twice as many."""
    part = F.col(stratum) if stratum else F.lit(0)
    counts = keys.groupBy(part.alias("_stratum")).agg(F.count("*").alias("_n"))
    each = rows / max(1, counts.count())
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) / float(1 << 53)
    share = F.least(F.lit(1.0), F.lit(float(each)) / F.col("_n"))
    drawn = keys.withColumn("_own", part).join(counts, F.col("_own").eqNullSafe(F.col("_stratum"))).where(chance < share)
    return drawn.drop("_own", "_stratum", "_n").dropDuplicates(["doc_id"]).limit(2 * rows)


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, y) with one row for each labelled id: the largest label where an id has several."""
    rows = labels.where(F.col(name).isNotNull() & F.col("doc_id").isNotNull())
    return rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(name) > 0).cast("int").alias("y"))


def with_sample(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The documents of a bounded sample of ids, with its columns; a broadcast of ``2 * rows`` short rows at most. An id
    of several rows counts with one, that of the smallest hash of its text."""
    kept = [c for c in docs.columns if c != "doc_id"]
    first = docs.join(F.broadcast(sample.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("_order"), *kept)).alias("_row"))
    return first.select("doc_id", *[F.col(f"_row.`{c}`").alias(c) for c in kept]).join(F.broadcast(sample), "doc_id")


def held_back(doc_id: Column) -> Column:
    """A fixed fifth of the ids, kept from fitting for calibration."""
    return F.pmod(F.xxhash64(F.lit(99), doc_id), F.lit(5)) == 0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last coefficient is the intercept."""
    x1 = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.ones(len(y)) if weight is None else weight
    b = np.zeros(x1.shape[1])
    penalty = np.full(len(b), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x1 @ b)
        g = x1.T @ (w * (y - p)) - penalty * b
        h = (x1 * (w * p * (1 - p))[:, None]).T @ x1 + np.diag(penalty + 1e-9)
        step = np.linalg.solve(h, g)
        b += step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return b


def logit(x: np.ndarray, b: np.ndarray) -> np.ndarray:
    return x @ b[:-1] + b[-1]

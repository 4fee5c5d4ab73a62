"""Bounded samples of labelled rows, and small logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out from learning. Null id: fold 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS, F.lit(1)).cast("int")


def labelled_sample(labels: DataFrame, label: Column, rows: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled ids outside fold 0, in the order of a hash of the id: a random
    choice that no order of the input sways. Its bound makes it fit to be broadcast. An id
    labelled more than once takes its highest label; rows without id or label are left out."""
    usable = labels.select(F.col(doc_id).alias("doc_id"), label.alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull()
    )
    return (
        usable.where(fold("doc_id") != 0)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id")
        .limit(rows)
    )


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of a small dense logistic regression by Newton steps; the last one is the bias."""
    x = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w

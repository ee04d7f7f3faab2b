"""Bounded samples of labelled rows, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F


def remainder(mod: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo ``mod`` (a null id has none)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def sample(docs: DataFrame, labels: DataFrame, label: str, usable, per_class: int) -> DataFrame:
    """(doc_id, text, y): at most ``per_class`` labelled rows of each class, taken
    in the order of a hash of the id; ids with contradicting labels and
    null texts are left out.  The id list is bounded by 2 * per_class."""
    rows = (labels.where(usable).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("hi"))
            .where("y = hi").select("doc_id", F.col("y").cast("int").alias("y")))
    one = [rows.where(F.col("y") == v).orderBy(F.xxhash64("doc_id")).limit(per_class) for v in (0, 1)]
    ids = F.broadcast(one[0].union(one[1]))
    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(ids, "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, balanced: bool = True, ridge: float = 1e-3) -> np.ndarray:
    """Weights (last one the intercept) of a logistic fit by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) if balanced else np.full(len(y), 1 / len(y))
    b = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        g = x.T @ (w * (p - y)) + ridge * b
        h = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b -= step * min(1.0, 4 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return b


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))

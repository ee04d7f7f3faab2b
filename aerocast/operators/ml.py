"""Train/test split of exact size, standardisation, logistic regression by
Newton steps on an aggregated Gram matrix, and metrics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

_DIGITS = 3         # hexadecimal digits per step of the selection: 4,096 buckets


def split_hash(key: str, seed: int = 42) -> Column:
    """Order of the split: MD5 of seed and key, as hexadecimal text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def nth_smallest_prefix(hashes: DataFrame, col: str, n: int) -> str:
    """The shortest prefix with which exactly n hashes are at or below it.

    Distributed selection: counts per next _DIGITS digits (at most 4,096
    rows reach the driver) tell the bucket that holds the n-th hash; only
    that bucket is counted further.  No sort, no rank, and no data move."""
    prefix, below = "", 0
    while True:
        size = len(prefix) + _DIGITS
        inside = hashes.where(F.col(col).startswith(prefix)) if prefix else hashes
        counts = inside.groupBy(F.substring(col, 1, size).alias("p")).count().collect()
        for p, count in sorted((r["p"], r["count"]) for r in counts):
            if below + count >= n:
                break
            below += count
        prefix = p
        if below + count == n:
            return prefix
        if len(prefix) >= 32:
            raise ValueError("the split's key repeats where the split would part equal keys")


def exact_split(df: DataFrame, key: str, num: int = 1, den: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ceil(n * num / den) test rows: those of the
    smallest hashes of ``key``, which must be unique.  The same row always
    lands on the same side, whatever the partitioning or a task retry."""
    h = split_hash(key, seed)
    hashes = df.select(h.alias("h"))
    n = hashes.count()
    take = -(-n * num // den)
    if not 0 < take < n:
        side = F.lit(take > 0)
        return df.where(~side), df.where(side)
    prefix = nth_smallest_prefix(hashes, "h", take)
    test = F.substring(h, 1, len(prefix)) <= prefix
    return df.where(~test), df.where(test)


def standard_params(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and *population* std of each column (two numbers per column
    reach the driver)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = train.agg(*aggs).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0) for c in cols}


def standardized(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "_z") -> DataFrame:
    """(x − mean)/std; a constant column is only shifted."""
    return df.select("*", *(((F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0)).alias(c + suffix)
                            for c, (m, s) in params.items()))


def standardize(train: DataFrame, test: DataFrame, cols: list[str], suffix: str = "_z"
                ) -> tuple[DataFrame, DataFrame, dict]:
    """Both sides with the parameters of train."""
    params = standard_params(train, cols)
    return standardized(train, params, suffix), standardized(test, params, suffix), params


@dataclass
class LogisticModel:
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    residual: float         # largest absolute gradient component, per row
    steps: int

    def margin(self) -> Column:
        z = F.lit(float(self.intercept))
        for f, w in zip(self.features, self.coefficients):
            z = z + F.lit(float(w)) * F.col(f).cast("double")
        return z

    def predict(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``prediction``: 1 where the probability is 0.5 or more."""
        return df.withColumn(prediction, (self.margin() >= 0).cast("int"))


def _gram(df: DataFrame, features: list[str], label: str, weight: Column, w: np.ndarray):
    """(rows, log loss, gradient, Hessian) at w, from one aggregation of
    k(k + 1)/2 + k + 2 sums."""
    z = F.lit(float(w[-1]))
    for f, v in zip(features, w):
        z = z + F.lit(float(v)) * F.col(f).cast("double")
    d = (df.select(*(F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)), F.lit(1.0).alias(f"x{len(features)}"),
                   F.col(label).cast("double").alias("y"), weight.cast("double").alias("n"), z.alias("z"))
         .withColumn("p", 1 / (1 + F.exp(-F.col("z")))))
    k = len(w)
    loss = F.log1p(F.exp(-F.abs("z"))) + F.greatest("z", F.lit(0.0)) - F.col("y") * F.col("z")
    sums = [F.sum("n"), F.sum(F.col("n") * loss)]
    sums += [F.sum(F.col("n") * (F.col("p") - F.col("y")) * F.col(f"x{i}")) for i in range(k)]
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    sums += [F.sum(F.col("n") * F.col("p") * (1 - F.col("p")) * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in upper]
    row = [x or 0.0 for x in d.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()]
    h = np.zeros((k, k))
    for (i, j), v in zip(upper, row[2 + k:]):
        h[i, j] = h[j, i] = v
    return row[0], row[1], np.array(row[2:2 + k]), h


def fit_logistic(train: DataFrame, features: list[str], label: str, C: float = 1.0, weight: str | None = None,
                 tol: float = 1e-12, max_steps: int = 100) -> LogisticModel:
    """L2 logistic regression with the objective C·Σ log-loss + ½‖w‖², the
    intercept unpenalised, by Newton steps (iteratively reweighted least
    squares).  A step is one aggregation over the rows, which are scanned
    where they lie; rows may be groups of equal rows with a ``weight``.  A
    step that does not lower the objective is halved.  Without rows all
    coefficients are 0."""
    k = len(features) + 1
    penalty = np.append(np.full(k - 1, 1.0 / C), 0.0)
    n_of = F.col(weight) if weight else F.lit(1)

    def at(w):
        n, loss, g, h = _gram(train, features, label, n_of, w)
        return n, loss + 0.5 * float(penalty @ (w * w)), g + penalty * w, h + np.diag(penalty)
    w, steps = np.zeros(k), 0
    n, f, g, h = at(w)
    while n and steps < max_steps and np.abs(g).max() > tol * n:
        step = np.linalg.lstsq(h, g, rcond=None)[0]
        share = 1.0
        while True:
            new = at(w - share * step)
            if new[1] <= f * (1 + 1e-12) or share < 1e-6:
                break
            share /= 2
        w, steps = w - share * step, steps + 1
        n, f, g, h = new
        if np.abs(share * step).max() < 1e-13:
            break
    return LogisticModel(features, w[:-1], float(w[-1]), float(np.abs(g).max() / n) if n else 0.0, steps)


def classification_metrics(pred: DataFrame, label: str, prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """accuracy, per-class precision/recall/f1/support, macro and weighted
    averages, and the confusion matrix — from one grouped count (of rows,
    or of groups of ``weight`` equal rows)."""
    count = F.sum(weight) if weight else F.count(F.lit(1))
    cm = pred.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).agg(count.alias("count"))
    cells = {(r["y"], r["p"]): r["count"] for r in cm.collect()}   # ≤ classes² rows
    classes = sorted({k[0] for k in cells} | {k[1] for k in cells})
    total = sum(cells.values())
    rows = []
    correct = sum(cells.get((c, c), 0) for c in classes)
    rows.append(("accuracy", "all", correct / total if total else None))
    f1s = []
    for c in classes:
        tp = cells.get((c, c), 0)
        fp = sum(cells.get((o, c), 0) for o in classes if o != c)
        fn = sum(cells.get((c, o), 0) for o in classes if o != c)
        support = tp + fn
        prec = tp / (tp + fp) if tp + fp else 0.0
        rec = tp / support if support else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        rows += [("precision", str(c), prec), ("recall", str(c), rec), ("f1", str(c), f1),
                 ("support", str(c), float(support))]
        f1s.append((prec, rec, f1, support))
    if f1s:
        k = len(f1s)
        for i, name in enumerate(["precision", "recall", "f1"]):
            rows.append((name, "macro avg", sum(x[i] for x in f1s) / k))
            rows.append((name, "weighted avg", sum(x[i] * x[3] for x in f1s) / total if total else None))
    for (y, p), n in sorted(cells.items()):
        rows.append(("confusion", f"{y}->{p}", float(n)))
    spark = pred.sparkSession
    return spark.createDataFrame(rows, "metric string, label string, value double")


def coefficient_table(model: LogisticModel, features: list[str]) -> list[tuple[str, float]]:
    """Features by coefficient, largest first."""
    return sorted(zip(features, (float(x) for x in model.coefficients)), key=lambda t: -t[1])

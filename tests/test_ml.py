import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerocast.operators.ml import classification_metrics, coefficient_table, exact_split, fit_logistic, standardize


@pytest.mark.parametrize("n", [1, 2, 5, 7, 1000, 2001])
def test_split_has_the_exact_size(spark, n):
    df = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k")).repartition(5)
    tr, te = exact_split(df, "k")
    want = sorted((hashlib.md5(f"42:k{i}".encode()).hexdigest(), f"k{i}") for i in range(n))[:-(-n // 5)]
    assert sorted(r.k for r in te.collect()) == sorted(k for _, k in want)
    assert tr.count() + te.count() == n and tr.join(te, "k").count() == 0


def test_split_edges(spark):
    df = spark.createDataFrame([], "k string")
    assert [x.count() for x in exact_split(df, "k")] == [0, 0]
    twice = spark.range(10).select(F.lit("same").alias("k"))
    with pytest.raises(ValueError):                    # equal keys are not parted
        exact_split(twice, "k")
    tr, te = exact_split(spark.range(9).select("id"), "id", 2, 3)
    assert (tr.count(), te.count()) == (3, 6)


def test_standardize(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 17).cast("double").alias("x"), F.lit(3).alias("one"))
    tr, te = exact_split(df, "k")
    trz, _, params = standardize(tr, te, ["x", "one"])
    xs = np.array([r.x for r in tr.collect()])
    assert abs(params["x"][1] - xs.std(ddof=0)) < 1e-9
    z = np.array([r.x_z for r in trz.collect()])
    assert abs(z.mean()) < 1e-9 and abs(z.std(ddof=0) - 1) < 1e-9
    assert {r.one_z for r in trz.collect()} == {0.0}


def test_logistic_matches_newton_solution(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(400, 2))
    y = (X[:, 0] - 0.5 * X[:, 1] + rng.normal(size=400) > 0).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X, y)], "a double, b double, y double")
    model = fit_logistic(df, ["a", "b"], "y", C=1.0)
    # objective: C·Σ logloss + ½‖w‖² (intercept free) — Newton iterations
    A = np.hstack([X, np.ones((400, 1))])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-A @ w))
        g = A.T @ (p - y) + np.r_[w[:2], 0]
        H = A.T @ (A * (p * (1 - p))[:, None]) + np.diag([1, 1, 0])
        w -= np.linalg.solve(H, g)
    assert np.allclose(list(model.coefficients) + [model.intercept], w, atol=1e-9)
    assert model.residual < 1e-9 and model.steps < 12


def test_weighted_groups_give_the_same_fit(spark):
    rng = np.random.default_rng(2)
    X = rng.integers(0, 4, size=(500, 2)).astype(float)
    y = (X.sum(axis=1) + rng.normal(size=500) > 3).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(X, y)], "a double, b double, y int")
    one = fit_logistic(df, ["a", "b"], "y", C=0.5)
    groups = df.groupBy("a", "b", "y").agg(F.count("*").alias("n"))
    two = fit_logistic(groups, ["a", "b"], "y", C=0.5, weight="n")
    assert np.allclose(one.coefficients, two.coefficients, atol=1e-10) and abs(one.intercept - two.intercept) < 1e-10
    m1 = {(r.metric, r.label): r.value for r in classification_metrics(one.predict(df), "y").collect()}
    m2 = {(r.metric, r.label): r.value for r in classification_metrics(two.predict(groups), "y", weight="n").collect()}
    assert m1 == m2 and m1["support", "0"] + m1["support", "1"] == 500
    ranked = coefficient_table(one, ["a", "b"])
    assert [w for _, w in ranked] == sorted(one.coefficients, reverse=True)


def test_separable_and_empty_and_constant(spark):
    """Separable rows stay finite by the penalty; a constant column and a
    single class do no harm."""
    df = spark.createDataFrame([(float(i), 1.0, int(i >= 5)) for i in range(10)], "a double, c double, y int")
    model = fit_logistic(df, ["a", "c"], "y", C=10.0)
    assert model.residual < 1e-8 and {r.y == r.prediction for r in model.predict(df).collect()} == {True}
    assert fit_logistic(df.where("y = 7"), ["a"], "y").coefficients.tolist() == [0.0]
    only = fit_logistic(df.where("y = 1"), ["a"], "y", max_steps=20)
    assert np.isfinite(only.coefficients).all() and np.isfinite(only.intercept)

"""Evaluation, fairness and drift numbers against hand-computed values."""

import math

import pytest

from cohort_spark.operators import drift as C
from cohort_spark.operators import fairness as B
from cohort_spark.operators import metrics as V


def test_chi2_sf():
    assert C.chi2_sf(1.829182, 4) == pytest.approx(0.767139, abs=1e-6)
    assert C.chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert C.chi2_sf(10.0, 3) == pytest.approx(0.018566, abs=1e-6)


def test_report_and_fairness(spark):
    rows = [(1, 1, "a"), (1, 0, "a"), (0, 0, "b"), (0, 1, "b"), (1, 1, "b"), (0, 0, "a")]
    df = spark.createDataFrame(rows, "y int, p int, g string")
    rep = {r.label: r for r in V.classification_report(df, "y", "p").collect()}
    assert rep["1"].precision == pytest.approx(2 / 3) and rep["1"].recall == pytest.approx(2 / 3)
    assert rep["accuracy"].f1 == pytest.approx(4 / 6)
    dp = B.demographic_parity_difference(df, "p", "g").collect()[0][0]
    assert dp == pytest.approx(abs(1 / 3 - 2 / 3))
    eo = B.equalized_odds_difference(df, "y", "p", "g").collect()[0][0]
    assert eo == pytest.approx(max(abs(0.5 - 1.0), abs(0.0 - 0.5)))


def test_auc_matches_pairs(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.5), (0, 0.5)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = {r["class"]: r.auc for r in V.roc_auc_ovr(df, "y", {1: "s"}).collect()}
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / (len(pos) * len(neg))
    assert got["1"] == pytest.approx(want)


def test_ks(spark):
    a = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    b = spark.createDataFrame([(float(i) + 30.0,) for i in range(100)], "x double")
    r = C.ks_drift(a, b, ["x"], exact_up_to=0).collect()[0]
    assert r.statistic == pytest.approx(0.3)
    lam = math.sqrt(50) * 0.3
    want = sum(2 * (-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert r.p_value == pytest.approx(want)


def test_chi2_drift_matches_spark_ml(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest
    from pyspark.sql import functions as F

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    a, b = ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)
    ours = C.chi2_drift(a, b, ["event_type"]).collect()[0]
    both = ev.withColumn("label", (F.col("ts") >= cut).cast("double"))
    idx = StringIndexer(inputCol="event_type", outputCol="et").fit(both).transform(both)
    vec = VectorAssembler(inputCols=["et"], outputCol="f").transform(idx)
    ml = ChiSquareTest.test(vec, "f", "label").collect()[0]
    assert ours.statistic == pytest.approx(float(ml.statistics[0]), rel=1e-9)
    assert ours.p_value == pytest.approx(float(ml.pValues[0]), abs=1e-9)
    assert ours.dof == int(ml.degreesOfFreedom[0])


def test_roc_drop_intermediate(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 200)
    s = np.round(rng.random(200) * 20) / 20 + y * 0.1
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    got = sorted((r.threshold, r.fpr, r.tpr) for r in V.roc_curve(df, "y", "s", 1, drop_intermediate=True).collect())
    th = np.unique(s)[::-1]
    tps = np.cumsum([((s == t) & (y == 1)).sum() for t in th])
    fps = np.cumsum([((s == t) & (y == 0)).sum() for t in th])
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    want = sorted([(float("inf"), 0.0, 0.0)] + [(float(th[i]), fps[i] / fps[-1], tps[i] / tps[-1]) for i in keep])
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w)


def test_exact_ks_equals_enumeration():
    """Every order of two samples of up to 8 values each."""
    import itertools
    from math import comb

    from cohort_spark.operators.drift import exact_ks_p

    for n_a, n_b in itertools.product(range(1, 9), repeat=2):
        found = []
        for taken in itertools.combinations(range(n_a + n_b), n_a):
            chosen, i, j, d = set(taken), 0, 0, 0.0
            for k in range(n_a + n_b):
                i, j = i + (k in chosen), j + (k not in chosen)
                d = max(d, abs(i * n_b - j * n_a))
            found.append(d)
        for far in sorted(set(found)):
            want = sum(x >= far for x in found) / comb(n_a + n_b, n_a)
            assert exact_ks_p(n_a, n_b, far / (n_a * n_b)) == pytest.approx(want, rel=1e-9), (n_a, n_b, far)


def test_ks_takes_the_exact_value_for_small_samples(spark):
    a = spark.createDataFrame([(float(i), 1.0) for i in range(8)], "x double, y double")
    b = spark.createDataFrame([(float(i) + 3.5, None) for i in range(8)], "x double, y double")
    from cohort_spark.operators.drift import exact_ks_p, ks_drift

    got = {r["column"]: r for r in ks_drift(a, b).collect()}
    assert got["x"].p_value == pytest.approx(exact_ks_p(8, 8, 0.5)) and got["y"].p_value is None
    large = ks_drift(a, b, ["x"], exact_up_to=7).collect()[0]
    assert large.p_value != got["x"].p_value

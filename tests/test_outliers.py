"""Outlier treatment on a literal table."""

import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import outliers as O
from fixed_values import OUTLIERS, rows


@pytest.fixture()
def data(spark):
    return spark.createDataFrame(rows(OUTLIERS), "NP3TOT long, NP2SPCH long, NP1DPRS long, ENROLL_AGE long, COHORT long")


def test_iqr(data):
    out = O.outlier_to_null(data, ["NP2SPCH", "NP1DPRS"], "iqr")
    q1, q3 = data.agg(F.percentile("NP2SPCH", 0.25), F.percentile("NP2SPCH", 0.75)).collect()[0]
    assert out.agg(F.max("NP2SPCH")).collect()[0][0] <= q3 + (q3 - q1)
    assert out.agg(F.stddev("NP1DPRS")).collect()[0][0] < data.agg(F.stddev("NP1DPRS")).collect()[0][0]


def test_auto_columns_and_report(data):
    out = O.outlier_to_null(data, None, "zscore", 2.0)
    assert "COHORT" in out.columns
    assert out.where("NP3TOT IS NULL").count() > 0
    rep = O.outlier_report(data, out)
    assert set(rep.columns) >= {"Column", "Original_Mean", "Cleaned_Mean", "Original_Std", "Cleaned_Std", "Points_Modified"}
    assert rep.where("Points_Modified > 0").count() > 0


def test_threshold_sensitivity(data):
    strict = O.outlier_to_null(data, None, "zscore", 2.0).where("NP3TOT IS NULL").count()
    loose = O.outlier_to_null(data, None, "zscore", 3.0).where("NP3TOT IS NULL").count()
    assert strict > loose


def test_zscore_median_sets_nulls_to_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,), (100.0,)], "x double")
    got = sorted(r.x for r in O.outlier_zscore_median(df, ["x"], 1.5).collect())
    assert got == [1.0, 2.0, 2.5, 2.5, 3.0]


def test_isolation_flags_extremes(spark):
    vals = [float(i % 50) for i in range(1000)] + [1000.0, 2000.0, -500.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = [r.x for r in O.outlier_isolation_median(df, ["x"], share=0.1).collect()]
    assert 1000.0 not in out and 2000.0 not in out and -500.0 not in out
    assert len(out) == len(vals)


def test_isolation_large_input_path(spark):
    from pyspark.sql import functions as F

    base = spark.range(80000).select((F.col("id") % 1000).cast("double").alias("x"))
    extremes = spark.range(400).select((1e6 + F.col("id")).cast("double").alias("x"))  # 0.5% far away
    df = base.unionByName(extremes)
    out = O.outlier_isolation_median(df, ["x"], share=0.05, n_trees=100)
    assert out.where("x > 5000").count() == 0
    assert out.count() == 80400


def test_weighted_quantile_matches_expanded():
    import numpy as np

    rng = np.random.default_rng(2)
    vals = rng.normal(size=30)
    cnts = rng.integers(1, 20, size=30)
    expanded = np.repeat(vals, cnts)
    for q in (0.0, 0.05, 0.1, 0.5, 0.93, 1.0):
        assert O._weighted_quantile(vals, cnts, q) == pytest.approx(float(np.percentile(expanded, q * 100)))


def test_a_value_with_a_billion_copies_is_one_row():
    import numpy as np

    us, trees = O.smallest_uniforms(5.0, 10**9, 100, 3 * 256 / 10**9, 42)
    assert len(us) == pytest.approx(3 * 256 * 100, rel=0.05) and (np.diff(us) >= 0).all()
    per_tree = np.bincount(trees, minlength=100)
    assert per_tree.min() > 256 and per_tree.std() < 60
    all_of_few, t = O.smallest_uniforms(1.0, 3, 4, 1.0, 7)
    assert len(all_of_few) == 12 and np.bincount(t).tolist() == [3, 3, 3, 3]


def test_drawn_hashes_are_uniform():
    import numpy as np

    us = np.concatenate([O.smallest_uniforms(float(v), 50, 10, 0.2, 3)[0] for v in range(300)])
    assert len(us) == pytest.approx(300 * 500 * 0.2, rel=0.03)
    assert np.histogram(us, bins=10, range=(0, 0.2))[0].std() < 0.03 * len(us) / 10 * 3


def test_copies_are_sampled_as_often_as_they_occur(spark):
    from cohort_spark.operators.outliers import _draws

    counts = spark.createDataFrame([(0.0, 900_000), (1.0, 90_000)] + [(2.0 + i, 1) for i in range(10_000)], "v double, n long")
    drawn = counts.mapInPandas(_draws(50, 0.002, 1), "t long, u double, v double").toPandas()
    share = drawn["v"].clip(upper=2).value_counts(normalize=True)
    assert share[0.0] == pytest.approx(0.9, abs=0.01) and share[1.0] == pytest.approx(0.09, abs=0.01) and share[2.0] == pytest.approx(0.01, abs=0.004)


def test_flags_do_not_depend_on_other_columns_or_partitions(spark):
    df = spark.range(3000).select("id", (F.col("id") % 97 + F.when(F.col("id") % 100 == 0, 5000).otherwise(0)).cast("double").alias("x"))
    a = sorted(r.x for r in O.outlier_isolation_median(df, ["x"]).collect())
    b = sorted(r.x for r in O.outlier_isolation_median(df.select("x").repartition(7), ["x"]).collect())
    assert a == b and max(a) < 5000


def test_clean_table_deduplicates_once(spark):
    from cohort_spark.operators.outliers import clean_table

    rows = [(i % 50, float(i % 7), None if i % 9 == 0 else float(i % 13)) for i in range(400)]
    out = clean_table(spark.createDataFrame(rows, "k long, a double, b double"), ["a", "b"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan  # the result starts from the kept rows
    assert out.count() == len(set(rows))
    empty = clean_table(spark.createDataFrame([], "k long, a double, v void"), ["a"])
    assert empty.count() == 0

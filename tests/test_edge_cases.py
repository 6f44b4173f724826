"""Dotted names, missing predictions and keys, empty sides, and exact modes."""

import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import columns as P
from cohort_spark.operators import drift as C
from cohort_spark.operators import fairness as B
from cohort_spark.operators import metrics as V
from cohort_spark.operators import missing as M
from cohort_spark.operators import outliers as O
from cohort_spark.operators import sample as R
from cohort_spark.operators import stats as A
from cohort_spark.sources.tables import read_table


def test_dotted_names(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0, "a", 0, 0), (2, float("nan"), "b", 1, 0), (3, 2.0, "a", 1, 1)],
                               "`p.id` long, `SEX_0.0` double, `g.x` string, `y.t` int, `y.p` int")
    path = str(tmp_path / "t.parquet")
    df.write.parquet(path)
    back = read_table(spark, path)
    assert back.columns == df.columns and back.where("`SEX_0.0` is null").count() == 1
    x, y = P.split_target(back, "y.t", "p.id")
    assert x.columns == ["p.id", "SEX_0.0", "g.x", "y.p"] and y.columns == ["p.id", "y.t"]
    assert P.select_by_type(back, "string").columns == ["g.x"]
    assert {r[0]: r["count"] for r in A.value_counts(back, "g.x").collect()} == {"a": 2, "b": 1}
    assert {r[0]: r.accuracy for r in A.group_accuracy(back, "g.x", "y.t", "y.p").collect()} == {"a": 1.0, "b": 0.0}
    assert {r[0]: r[1] for r in A.group_min(back, "g.x", "p.id").collect()} == {"a": 1, "b": 2}
    assert V.accuracy(back, "y.t", "y.p").first()[0] == pytest.approx(2 / 3)
    assert M.handle_missing_values(back).where("`SEX_0.0` = 1.5").count() == 1


def test_missing_predictions_are_misses(spark):
    df = spark.createDataFrame([("m", "g", 1, 1), ("m", "g", 1, None), ("m", "h", None, 1)], "model string, grp string, y int, p int")
    assert V.accuracy(df, "y", "p").first()[0] == 0.5
    assert V.model_accuracies(df, "y", "p").first()["accuracy"] == 0.5
    assert {r.grp: r.accuracy for r in A.group_accuracy(df, "grp", "y", "p").collect()} == {"g": 0.5, "h": None}
    rep = B.bias_report(df.where("y is not null"), "y", "p", ["grp"])
    assert {r.accuracy for r in rep.collect()} == {0.5}


def test_splits_need_unique_keys_and_enough_rows(spark):
    bad = spark.range(100).select(F.when(F.col("id") < 50, F.col("id")).alias("k"), F.lit("a").alias("g"))
    for call in (lambda: R.split_column(bad, "k", 0.6), lambda: R.train_val_test_split(spark.range(50).select((F.col("id") % 10).alias("k")), "k")):
        with pytest.raises(ValueError):
            call()
    good = spark.range(10).select(F.col("id").alias("k"), F.lit("a").alias("g"))
    with pytest.raises(ValueError):
        R.undersample(good, "g", "a", 50, "k")
    with pytest.raises(ValueError):
        R.oversample(good, "g", "b", 5, "k")
    assert R.undersample(good, "g", "a", 4, "k").count() == 4 and R.oversample(good, "g", "b", 0, "k").count() == 0


def test_drift_of_empty_sides_and_tiny_differences(spark):
    a = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit("u").alias("s"))
    b = a.select(F.lit(None).cast("double").alias("x"), F.lit(None).cast("string").alias("s"))
    for left, right in ((a, b), (b, a)):
        r = C.ks_drift(left, right, ["x"]).first()
        assert r.statistic is None and r.p_value is None and r.drift is None
        assert C.chi2_drift(left, right, ["s"], with_p=False).first().statistic is None
        assert {x.score for x in C.feature_drift_score(left, right, ["x"], ["s"]).collect()} == {None}
        assert C.jensen_shannon(left, right, ["s"]).first().jensen_shannon is None
    one = spark.range(20000).select(F.when(F.col("id") == 7, 8.0).otherwise(F.col("id").cast("double")).alias("x"))
    r = C.ks_drift(spark.range(20000).select(F.col("id").cast("double").alias("x")), one, ["x"]).first()
    assert r.p_value == pytest.approx(1.0) and not r.drift


def test_profile_and_correlation_edges(spark):
    empty = spark.createDataFrame([], "x double, s string")
    assert A.profile_report(empty)["overview"].first()["missing_cell_share"] is None
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, float("nan")), (3.0, 5.0, 1.0)], "a double, c double, n double")
    corr = {(r.col_a, r.col_b): r.corr for r in A.correlation_matrix(df).collect()}
    assert corr["a", "c"] is None and corr["c", "c"] is None
    assert corr["a", "a"] == pytest.approx(1.0) and corr["a", "n"] == pytest.approx(-1.0)


def test_integer_modes_are_exact(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(big,), (big + 1,), (big + 3,), (big + 3,)], "x long")
    assert M.modes_of(df, ["x"]) == {"x": big + 3}


def test_isolation_forest_on_repeated_rows_and_internal_names(spark):
    base = spark.range(20000).select((F.col("id") % 500).cast("double").alias("v"))
    tails = spark.range(200).select((1e6 + F.col("id") % 5).alias("v"))
    out = O.outlier_isolation_median(base.unionByName(tails), ["v"], share=0.05, n_trees=50)
    assert out.count() == 20200 and out.where("v > 5000").count() == 0


def test_preprocessor_fills_unseen_rows_from_the_fitted_ones(spark, tmp_path):
    from cohort_spark.operators.encode import apply_preprocessor, fit_preprocessor
    from cohort_spark.sources import load_preprocessor, save_preprocessor

    fit = spark.createDataFrame([(i, float(i), float(i % 3), float(i % 3)) for i in range(60)], "k long, x double, a double, b double")
    pre = fit_preprocessor(fit, ["x"], ["a", "b"])
    pre = load_preprocessor(spark, save_preprocessor(spark, pre, str(tmp_path / "pre")))
    one = spark.createDataFrame([(100, 5.0, None, 2.0), (101, 5.0, None, None)], "k long, x double, a double, b double")
    out = {r.k: r for r in apply_preprocessor(one, pre).collect()}
    assert [out[100][f"a_{v}.0"] for v in range(3)] == [0.0, 0.0, 1.0]
    assert [out[101][f"a_{v}.0"] for v in range(3)] == [0.0, 1.0, 0.0]  # no comparable donor: the mean of the fit


def test_rbf_svm_is_saved_and_loaded(spark, tmp_path):
    from cohort_spark.operators.models import assemble, fit_svm
    from cohort_spark.sources import load_model, save_model

    df = assemble(spark.createDataFrame([(float(i % 2), float(i % 2) + 0.01 * i, 1.0 - i % 2) for i in range(40)], "label double, a double, b double"), ["a", "b"])
    model = fit_svm(df, kernel="rbf", n_components=16, max_iter=5)
    loaded = load_model(save_model(model, str(tmp_path / "svm")))
    assert [r.prediction for r in loaded.transform(df).collect()] == [r.prediction for r in model.transform(df).collect()]


def test_machine_local_checkpoints_are_refused_on_a_cluster():
    from cohort_spark.session import refuse_machine_local

    for master, folder in (("local[4]", "file:/tmp/x"), ("local-cluster[3,2,3000]", "file:///tmp/x"), ("yarn", "hdfs:///ckpt"), ("spark://h:7077", None)):
        refuse_machine_local(master, folder)
    with pytest.raises(RuntimeError):
        refuse_machine_local("spark://h:7077", "file:///tmp/x")

"""Sources, encoding, sampling of folds and Spark ML wrappers."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohort_spark import sources as S
from cohort_spark.operators import encode as E
from cohort_spark.operators import models as L

SF = "/root/testdata/sf0.001"


def test_read_csv_blank_and_nan(spark):
    d = tempfile.mkdtemp(prefix="cohort-csv-")
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("PATNO,ENROLL_DATE,SCORE\n1,01/2020,NaN\n2,,3.5\n")
    df = S.read_table(spark, os.path.join(d, "t.csv"), schema="PATNO long, ENROLL_DATE string, SCORE double")
    rows = {r.PATNO: r for r in df.collect()}
    assert rows[1].SCORE is None and rows[2].ENROLL_DATE is None and rows[2].SCORE == 3.5
    names = [n for n, _ in S.read_dir(spark, d, ".csv")]
    assert names == ["t"]


def test_one_hot_unknown_level_is_zero(spark):
    train = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id long, SEX double")
    score = spark.createDataFrame([(3, 2.0), (4, None)], "id long, SEX double")
    lv = E.levels_of(train, ["SEX"])
    out = E.one_hot(score, ["SEX"], lv)
    assert out.columns == ["id", "SEX_0.0", "SEX_1.0"]
    assert all(r["SEX_0.0"] == 0.0 and r["SEX_1.0"] == 0.0 for r in out.collect())


def test_get_dummies_and_label_encode(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id long, g string")
    out = E.get_dummies(df)
    assert out.columns == ["id", "g_b", "g_c"]
    got = {r.id: (r.g_b, r.g_c) for r in out.collect()}
    assert got[3] == (False, False) and got[1] == (True, False)
    enc = {r.id: r.code for r in E.label_encode(df, "g", "code").collect()}
    assert enc == {1: 1, 2: 0, 3: None, 4: 2}


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    vals = sorted(r.x for r in E.standard_scale(df, ["x"]).collect())
    assert vals[0] == pytest.approx(-1.5 / 1.118033988749895)
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r.x for r in E.standard_scale(const, ["x"]).collect()] == [0.0, 0.0]


def test_stratified_folds(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    f = L.stratified_folds(df, "y", "k", 3)
    counts = {(r.y, r.fold): r["count"] for r in f.groupBy("y", "fold").count().collect()}
    assert sum(counts.values()) == 300
    per_class = {}
    for (y, fold), n in counts.items():
        per_class.setdefault(y, []).append(n)
    assert all(max(v) - min(v) <= 1 for v in per_class.values())


def test_models_fit_and_predict(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    df = L.assemble(e.select("vec_id", (F.col("label") % 3).cast("double").alias("label"), "embedding"), "embedding")
    lr = L.fit_logistic(df, "label", C=1.0, max_iter=20)
    pred = L.predict_batch(lr, df, ["vec_id"])
    assert pred.count() == df.count() and "probability" in pred.columns
    rf = L.fit_random_forest(df, "label", n_trees=5, max_depth=3)
    imp = L.feature_importance(rf, [f"e{i}" for i in range(64)], 10)
    assert imp.count() == 10
    est = L.LogisticRegression(labelCol="label", maxIter=10)
    cv = L.grid_search(est, {est.regParam: [0.01, 0.1]}, df, "label", folds=2, stratify_key="vec_id")
    assert len(cv.avgMetrics) == 2


def test_class_moments_match_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4))
    y = rng.integers(0, 3, size=200)
    rows = [(int(c), *map(float, r)) for c, r in zip(y, x)]
    df = spark.createDataFrame(rows, "y int, a double, b double, c double, d double").repartition(5)
    mom = E.class_moments(df, ["a", "b", "c", "d"], "y")
    for cls in range(3):
        xs = x[y == cls]
        n, s, xx = mom[str(cls)]
        assert n == len(xs)
        assert np.allclose(s, xs.sum(axis=0)) and np.allclose(xx, xs.T @ xs)
    proj = E.lda_project(df, ["a", "b", "c", "d"], "y")
    assert proj.columns == ["y", "LD1", "LD2"] and proj.count() == 200


def test_svm_grid_and_boosted_grid(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    df = L.assemble(e.select("vec_id", (F.col("label") % 2).cast("double").alias("label"), "embedding"), "embedding")
    model, scores = L.svm_grid_search(df, "label", "vec_id", Cs=(1.0,), kernels=("linear", "rbf"), gammas=("auto",),
                                      folds=2, max_iter=10)
    assert len(scores) == 2 and model.transform(df).count() == df.count()
    ovr, grid = L.boosted_grid("label", depths=(2,), steps=(0.1,), iters=(3,), subsamples=(1.0, 0.9))
    assert len(list(grid.values())[0]) == 2


def test_permutation_importance_signal_and_noise(spark):
    rows = [(i, float(i % 2), float((i * 7919) % 13), float(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, signal double, noise double, label double")
    model = L.fit_logistic(L.assemble(df, ["signal", "noise"]), "label", C=10.0, max_iter=50)
    imp = {r.feature: r.importance for r in L.permutation_importance(model, df, ["signal", "noise"], "label", "k").collect()}
    assert imp["signal"] > 0.3 and abs(imp["noise"]) < 0.05
    again = {r.feature: r.importance for r in L.permutation_importance(model, df, ["signal", "noise"], "label", "k").collect()}
    assert again == imp


def test_score_records_with_categorical_features(spark):
    from cohort_spark.plans import flows

    rows = [(i, f"{float(i % 7)}, {float(i % 2)}", float(i % 2)) for i in range(200)]
    rec = spark.createDataFrame(rows, "k long, record string, label double")
    from cohort_spark.functions.scalar import parse_feature_record

    parsed = parse_feature_record(rec, "record", ["x", "g"])
    pre = E.fit_preprocessor(parsed, ["x"], ["g"])
    assert pre.feature_columns() == ["x", "g_0.0", "g_1.0"]
    model = L.fit_logistic(L.assemble(E.apply_preprocessor(parsed, pre), pre.feature_columns()), "label", C=10.0)
    out = flows.score_records(rec, "record", ["x", "g"], pre, model, ["k", "label"])
    acc = out.where("prediction = label").count() / out.count()
    assert acc > 0.95


def test_bucketed_stages_join_without_shuffle(spark):
    from cohort_spark.session import scratch_path

    a = spark.range(2000).selectExpr("id AS k", "id * 2 AS x")
    b = spark.range(2000).selectExpr("id AS k", "id % 7 AS y")
    sa = S.stage_table(a, scratch_path(spark, "bucket-a"), bucket_by=["k"], buckets=8, name="bucket_a")
    sb = S.stage_table(b, scratch_path(spark, "bucket-b"), bucket_by=["k"], buckets=8, name="bucket_b")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a sort-merge join, as for large tables
    try:
        joined = sa.join(sb, "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lda_keeps_its_digits_far_from_the_origin(spark):
    rows = [(float(i % 2), i % 7 + 3.0 * (i % 2), (i * 5) % 11 - 2.0 * (i % 2)) for i in range(200)]
    near = spark.createDataFrame(rows, "y double, a double, b double")
    far = near.select("y", (F.col("a") + 1e8).alias("a"), (F.col("b") - 1e8).alias("b"))
    p, q = (sorted(r.LD1 for r in E.lda_project(d, ["a", "b"], "y").collect()) for d in (near, far))
    spread = lambda v: [x - v[0] for x in v]
    assert spread(q) == pytest.approx(spread(p), abs=1e-6) or spread(q) == pytest.approx([v[-1] - x for v in [p] for x in reversed(v)], abs=1e-6)


def test_metric_log_and_daily_table_survive_a_rerun(spark, tmp_path):
    from cohort_spark import sources as S

    rows = spark.createDataFrame([("r1", "m", "acc", 0.5), ("r1", "m", "n", 3.0)], "run string, model string, metric string, value double")
    for value in (rows, rows, rows.where("metric = 'acc'").withColumn("value", F.lit(0.75))):
        log = S.append_metrics(value, str(tmp_path / "log"))
    S.append_metrics(rows.withColumn("run", F.lit("r2")), str(tmp_path / "log"))
    assert sorted((r.run, r.metric, r.value) for r in spark.read.schema("run string, model string, metric string, value double").parquet(str(tmp_path / "log")).collect()) == [
        ("r1", "acc", 0.75), ("r1", "n", 3.0), ("r2", "acc", 0.5), ("r2", "n", 3.0)] and log.columns == ["run", "model", "metric", "value"]
    for day, n in ((1, 5), (2, 7), (1, 6)):
        S.write_table(spark.range(n).withColumn("day", F.lit(day)), str(tmp_path / "t"), partition_by=["day"], replace_partitions=True)
    assert dict(spark.read.parquet(str(tmp_path / "t")).groupBy("day").count().collect()) == {1: 6, 2: 7}


def test_lda_with_partitions_that_hold_no_rows(spark):
    rows = [(float(i % 2), i % 7 + 3.0 * (i % 2), (i * 5) % 11 - 2.0 * (i % 2)) for i in range(40)]
    whole = spark.createDataFrame(rows, "y double, a double, b double").coalesce(1)
    part = F.when(F.col("a") >= 0, F.lit(1))  # all rows in one of the partitions
    spread = whole.repartition(6, part)
    nulls = spread.unionByName(spark.createDataFrame([(None, 1.0, 2.0)], spread.schema))  # a partition with only a missing label
    want = sorted(r.LD1 for r in E.lda_project(whole, ["a", "b"], "y").collect())
    assert sorted(r.LD1 for r in E.lda_project(spread, ["a", "b"], "y").collect()) == pytest.approx(want)
    assert E.lda_project(nulls, ["a", "b"], "y").count() == 41

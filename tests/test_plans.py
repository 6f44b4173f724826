"""Physical-plan properties the design relies on (checked on the sf0.001 tables)."""

import __spark_entry__ as E
from cohort_spark.operators.ordered import global_rank

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_row_per_key_is_a_partial_aggregate(spark):
    p = plan(E.queries()["earliest_per_key"](spark, SF))
    assert "partial_min" in p and "Window" not in p


def test_assessment_flow_single_exchange(spark):
    p = plan(E.queries()["assessment_flow"](spark, SF))
    assert p.count("Exchange hashpartitioning") == 1


def test_participant_flow_pushes_filters_and_prunes(spark):
    df = E.queries()["participant_flow"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in p
    assert "In(c_mktsegment" in p
    assert "c_name" not in p  # dropped column is never read


def test_global_rank_has_no_single_partition_window(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id")
    p = plan(global_rank(df, ["k", "id"], "_r"))
    assert "SinglePartition" not in p and "Window" not in p


def test_split_is_a_projection(spark):
    p = plan(E.queries()["train_test_split"](spark, SF))
    assert "Exchange" not in p and "Window" not in p and "Join" not in p


def test_wide_correlation_takes_the_moment_path(spark):
    from pyspark.sql import functions as F

    from cohort_spark.operators import stats as A

    df = spark.range(500).select(*[((F.col("id") * (i + 3)) % 17).cast("double").alias(f"c{i}") for i in range(16)])
    out = A.correlation_matrix(df)  # 136 pairs > 100: per-partition moments, one scan
    assert "Aggregate" not in plan(out)  # the result is a small driver-built table, not a per-batch aggregate
    assert out.count() == 256


def test_ks_drift_has_few_exchanges(spark, monkeypatch):
    """Two before the checkpoint (distinct values, range), two after (totals, maximum); rows are never shuffled again."""
    import re

    from cohort_spark.operators import ordered

    before = []
    keep = ordered.reliable
    monkeypatch.setattr(ordered, "reliable", lambda df: (before.append(plan(df)), keep(df))[1])
    after = plan(E.queries()["ks_drift"](spark, SF))
    count = lambda p: len(re.findall(r"(?<!Broadcast)Exchange ", p))
    assert sum(map(count, before)) + count(after) <= 4 and "Window" not in after


def test_folds_leave_features_where_they_are(spark):
    from pyspark.sql import functions as F

    from cohort_spark.operators import models as L

    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("y"), F.array(F.lit(1.0)).alias("features"))
    p = plan(L.stratified_folds(df, "y", "k"))
    assert "Exchange" not in p and "Join" not in p

"""The mergeable profile: merged days equal the whole, exact numbers where counts are held, sketches within their error."""

import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import profile as P
from cohort_spark.operators.stats import column_statistics


@pytest.fixture(scope="module")
def frame(spark):
    n = F.col("id")
    return spark.range(6000).select(
        n.alias("key"), (n % 7).cast("int").alias("code"), F.when(n % 5 != 0, (n * 7919 % 6007) / 7 + 1e8).alias("far"), F.when(n % 3 != 0, F.concat(F.lit("s"), (n % 11).cast("string"))).alias("text"),
        F.lit(None).cast("double").alias("none"), F.when(n % 2 == 0, float("nan")).otherwise((n % 13).cast("double")).alias("nan"), (n % 3).cast("string").alias("day"))


def days(frame):
    return [frame.where(F.col("day") == str(d)).drop("day") for d in range(3)]


def test_merged_equals_recomputed(frame):
    parts = [P.profile_day(d) for d in days(frame)]
    merged = P.merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2])).toPandas().set_index("column")
    whole = P.merge_profiles(P.profile_day(frame.drop("day"))).toPandas().set_index("column")
    for c in ("numeric", "n", "missing", "zeros", "least", "most", "length"):
        pd.testing.assert_series_equal(merged[c], whole[c].reindex(merged.index), check_dtype=False)
    for c in ("mean", "m2"):
        pd.testing.assert_series_equal(merged[c], whole[c].reindex(merged.index), rtol=1e-9)
    for c in merged.index:
        a, b = merged.loc[c, "counts"], whole.loc[c, "counts"]
        assert (a is None) == (b is None) and (a is None or [tuple(x) for x in a] == [tuple(x) for x in b])


def test_table_is_exact_for_few_values_and_close_otherwise(frame):
    parts = [P.profile_day(d) for d in days(frame)]
    got = P.profile_table(P.merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2]))).toPandas().set_index("column")
    want = column_statistics(frame.drop("day").withColumn("nan", F.when(~F.isnan("nan"), F.col("nan")))).toPandas().set_index("column")
    exact = [c for c in got.index if got.loc[c, "exact"]]
    assert set(exact) == {"code", "text", "none", "nan"}
    for c in want.index:
        for f in ("count", "missing", "zeros", "min", "max", "avg_length", "mean", "std"):
            assert got.loc[c, f] == pytest.approx(want.loc[c, f], rel=1e-9, nan_ok=True), (c, f)
        if c in exact:
            assert got.loc[c, "distinct"] == want.loc[c, "distinct"] and (got.loc[c, "top"] == want.loc[c, "top"] or pd.isna(want.loc[c, "top"]))
            assert got.loc[c, "median"] == pytest.approx(want.loc[c, "median"], nan_ok=True)
        else:
            assert got.loc[c, "distinct"] == pytest.approx(want.loc[c, "distinct"], rel=0.05)
    key = frame.toPandas()["key"]
    assert abs((key < got.loc["key", "median"]).mean() - 0.5) < 0.01


def test_a_day_run_twice_counts_once(frame):
    path = tempfile.mkdtemp(prefix="profile-") + "/p"
    for d, rows in enumerate(days(frame)):
        P.update_profile(rows, path, str(d))
    again = P.update_profile(days(frame)[1], path, "1")
    assert {r["n"] + r["missing"] for r in again.collect()} == {6000}

"""De-duplication on the reference's literal fixture (8 rows, IDs 1,2,3,2,4,5,1,6)."""

import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import dedup as D

ROWS = [(1, "John", 30, "New York"), (2, "Jane", 25, "London"), (3, "Bob", 35, "Paris"), (2, "Jane", 25, "London"),
        (4, "Alice", 28, "Berlin"), (5, "Charlie", 32, "Tokyo"), (1, "John", 30, "New York"), (6, "David", 27, "Sydney")]


@pytest.fixture()
def data(spark):
    return spark.createDataFrame(ROWS, "ID long, Name string, Age long, City string")


def test_all_columns(data):
    out = D.handle_duplicates(data)
    assert out.count() == 6
    assert out.count() == out.distinct().count()


def test_subset(data):
    out = D.handle_duplicates(data, subset=["Name", "Age"])
    assert out.count() == 6
    assert out.groupBy("Name", "Age").count().where("count > 1").count() == 0


def test_keep_last(data):
    out = D.handle_duplicates(data, keep="last")
    assert out.count() == 6
    assert "David" in [r.Name for r in out.collect()]


def test_keep_none(data):
    assert D.handle_duplicates(data, keep=False).count() == 4


def test_analyze(data):
    assert D.analyze_duplicates(data, subset=["Name"]).count() == 4
    assert D.analyze_duplicates(data).count() == 4


def test_reindex(data):
    out = D.handle_duplicates(data, reindex=True)
    assert sorted(r["index"] for r in out.collect()) == list(range(6))


def test_empty_and_no_duplicates(spark):
    empty = spark.createDataFrame([], "A long, B string")
    assert D.handle_duplicates(empty).count() == 0
    nd = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "A long, B string")
    assert D.handle_duplicates(nd).count() == 3
    assert D.count_duplicates(nd).collect()[0][0] == 0


def test_earliest_per_key_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "2020-01-01", 7), (2, None, 1), (2, None, 0)],
                               "k long, d string, t long").withColumn("d", F.to_date("d"))
    got = {r.k: (r.d, r.t) for r in D.earliest_per_key(df, "k", "d", ["t"]).collect()}
    assert str(got[1][0]) == "2020-01-01"
    assert got[2] == (None, 0)


def test_count_duplicates(data):
    assert D.count_duplicates(data).collect()[0]["n_duplicates"] == 2


def test_daily_state_equals_the_whole(spark, tmp_path):
    from cohort_spark.operators import dedup as D

    df = spark.range(500).selectExpr("id % 37 AS k", "CASE WHEN id % 5 = 0 THEN NULL ELSE (id * 31) % 97 END AS t", "id AS v", "CAST(id % 4 AS STRING) AS day")
    whole = sorted(map(tuple, D.earliest_per_key(df.drop("day"), "k", "t", ["v"]).collect()))
    for day in ("0", "1", "2", "2", "3"):
        out = D.update_earliest(df.where(f"day = '{day}'").drop("day"), str(tmp_path / "s"), day, "k", "t", ["v"])
    assert sorted(map(tuple, out.collect())) == whole

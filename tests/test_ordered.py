"""Distributed ranks, running sums and quantiles against single-process references,
including a key that holds a third of all rows and several partition counts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.operators.ordered import cumulative_sums, exact_quantiles, global_rank


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_global_rank(spark, parts):
    df = spark.range(500).select(((F.col("id") * 7919) % 500).alias("k"))
    got = [r.k for r in global_rank(df, ["k"], "_r", partitions=parts).orderBy("_r").collect()]
    assert got == sorted(got) and len(got) == 500
    ranks = sorted(r._r for r in global_rank(df, ["k"], "_r", partitions=parts).collect())
    assert ranks == list(range(1, 501))


def test_cumulative_sums_hot_group(spark):
    rows = [("hot" if i % 3 == 0 else f"g{i % 5}", i, float(i % 7)) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, o long, v double")
    got = {(r.g, r.o): r.cum_v for r in cumulative_sums(df, ["g"], ["o"], ["v"], partitions=6).collect()}
    acc = {}
    for g, o, v in sorted(rows, key=lambda t: (t[0], t[1])):
        acc[g] = acc.get(g, 0.0) + v
        assert got[(g, o)] == pytest.approx(acc[g])


def test_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=1001), 2)
    y = np.concatenate([np.zeros(600), rng.normal(size=401)])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = {(r.column, r.q): r.value for r in exact_quantiles(df, ["x", "y"], [0.1, 0.25, 0.5, 0.9]).collect()}
    for c, arr in (("x", x), ("y", y)):
        for q in (0.1, 0.25, 0.5, 0.9):
            assert got[(c, q)] == pytest.approx(float(np.percentile(arr, q * 100)))


def test_running_sums_carry_over_partitions_and_batches(spark):
    """Groups that span, begin or end at partitions; missing and NaN groups; the next row's value; integers and doubles."""
    rng = np.random.default_rng(5)
    groups = [None, float("nan"), 1.0, 2.0, 3.0]
    rows = [(groups[int(g)], i, int(v), float(v) / 3) for i, (g, v) in enumerate(zip(rng.choice(5, 3000, p=[0.1, 0.1, 0.6, 0.15, 0.05]), rng.integers(-5, 9, 3000)))]
    df = spark.createDataFrame(rows, "g double, o long, v long, w double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for parts in (1, 4, 23):
            got = {(str(r.g), r.o): r for r in cumulative_sums(df, ["g"], ["o"], ["v", "w"], partitions=parts, lead=["o"]).collect()}
            assert len(got) == len(rows)
            for g in groups:
                mine = [r for r in rows if str(r[0]) == str(g)]
                total, part = 0, 0.0
                for k, r in enumerate(mine):
                    total, part = total + r[2], part + r[3]
                    o = got[str(g), r[1]]
                    assert o.cum_v == total and o.cum_w == pytest.approx(part)
                    assert o.next_o == (mine[k + 1][1] if k + 1 < len(mine) else None)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_running_sums_shuffle_rows_once(spark):
    df = spark.range(1000).selectExpr("id % 7 AS g", "id AS o", "1 AS v")
    plan = cumulative_sums(df, ["g"], ["o"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan  # what was shuffled stands in the checkpoint
    assert cumulative_sums(df.limit(0), ["g"], ["o"], ["v"]).count() == 0
    assert cumulative_sums(df, [], ["o"], ["v"]).agg(F.max("cum_v")).collect()[0][0] == 1000


@pytest.mark.parametrize("gathered,bins", [(200_000, 4096), (3, 2), (3, 64), (50, 5)])
def test_quantiles_by_narrowing(spark, monkeypatch, gathered, bins):
    from cohort_spark.operators import ordered

    monkeypatch.setattr(ordered, "GATHERED", gathered)
    monkeypatch.setattr(ordered, "BINS", bins)
    rng = np.random.default_rng(8)
    n = 700
    data = {"a": rng.normal(size=n), "b": np.exp(rng.normal(size=n) * 30), "c": np.where(rng.random(n) < 0.7, 0.0, rng.normal(size=n)), "d": rng.integers(0, 3, n) * 1.0,
            "e": np.full(n, 7.5), "f": rng.choice([1e308, -1e308, 5e-324, 0.0, 1.0], n)}
    df = spark.createDataFrame([tuple(float(data[c][i]) for c in data) + (None if i else 4.0, float("nan") if i % 2 else float(i)) for i in range(n)],
                               ", ".join(f"{c} double" for c in data) + ", g double, h double")
    data |= {"g": np.array([4.0]), "h": np.arange(0, n, 2) * 1.0}
    probs = [0.0, 0.013, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column, r.q): r.value for r in exact_quantiles(df, list(data), probs).collect()}
    for c, arr in data.items():
        for q in probs:
            with np.errstate(over="ignore", invalid="ignore"):
                s = np.sort(arr)
                p = q * (len(s) - 1)
                want = s[int(p)] + (p - int(p)) * (s[min(int(p) + 1, len(s) - 1)] - s[int(p)]) if p != int(p) else s[int(p)]
            assert got[c, q] == pytest.approx(want, rel=1e-12) or (np.isinf(want) and np.isinf(got[c, q])), (c, q)
    assert exact_quantiles(df.limit(0), ["a"], [0.5]).count() == 0


def test_infinite_values_are_quantiles(spark, monkeypatch):
    from cohort_spark.operators import ordered

    monkeypatch.setattr(ordered, "GATHERED", 2)
    df = spark.createDataFrame([(float("-inf"),)] * 3 + [(float(i),) for i in range(5)] + [(float("inf"),)] * 3, "x double")
    got = {r.q: r.value for r in exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: float("-inf"), 0.5: 2.0, 1.0: float("inf")}

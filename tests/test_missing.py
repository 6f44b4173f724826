"""Missing values on a literal table (nulls 2, 2, 1, 5, 1, 2)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohort_spark.operators import missing as M
from cohort_spark.operators import stats as A
from fixed_values import MISSING, rows

SCHEMA = "AV133STDY double, TAUSTDY double, GAITSTDY double, PISTDY double, NP4DYSTN double, NP4TOT double"


@pytest.fixture()
def data(spark):
    return spark.createDataFrame(rows(MISSING), SCHEMA)


def test_identify(data):
    got = M.handle_missing_values(data, identify_only=True)
    assert got == {"AV133STDY": 2, "TAUSTDY": 2, "GAITSTDY": 1, "PISTDY": 5, "NP4DYSTN": 1, "NP4TOT": 2}
    long = {r["column"]: r["n_missing"] for r in A.missing_counts(data).collect()}
    assert long == got


def test_default_handling(data):
    out = M.handle_missing_values(data)
    assert "PISTDY" not in out.columns
    means = out.agg(*[F.avg(c).alias(c) for c in out.columns]).collect()[0]
    assert means["AV133STDY"] == pytest.approx(3.0)
    assert means["TAUSTDY"] == pytest.approx(3.67, abs=0.01)
    assert means["GAITSTDY"] == pytest.approx(2.5)
    nulls = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in out.columns]).collect()[0]
    assert all(v == 0 for v in nulls)


def test_threshold(data):
    out = M.handle_missing_values(data, drop_threshold=0.5)
    assert "PISTDY" not in out.columns and "AV133STDY" in out.columns


def test_custom_strategy(data):
    strategy = {"AV133STDY": "median", "TAUSTDY": "constant",
                "GAITSTDY": lambda c: F.coalesce(c, F.min(c).over(Window.partitionBy()))}
    out = M.handle_missing_values(data, strategy=strategy, constant_value=100)
    assert out.agg(F.median("AV133STDY")).collect()[0][0] == 3.0
    assert sorted(r[0] for r in out.select("TAUSTDY").distinct().collect()) == [2.0, 4.0, 5.0, 100.0]
    assert out.agg(F.min("GAITSTDY")).collect()[0][0] == 1.0


def test_errors(data):
    with pytest.raises(ValueError):
        M.handle_missing_values(data, strategy="invalid_strategy")
    with pytest.raises(TypeError):
        M.handle_missing_values("not_a_dataframe")


def test_drop_sparse_and_classify(data):
    assert "PISTDY" not in M.drop_sparse_columns(data, 0.5).columns
    cat, num = M.classify_columns(data, 4)
    assert "PISTDY" in cat and "AV133STDY" in cat and "GAITSTDY" in num and "NP4DYSTN" in num


@pytest.mark.parametrize("max_cells,n", [(20000, 40), (2, 40), (20000, 300)])
def test_knn_impute_matches_brute_force(spark, max_cells, n):
    import math

    rows = [(i, float(i % 3) if i % 4 else None, float(i % 5) if i % 3 else None, float(i % 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, s double")
    got = {r.id: (r.a, r.b) for r in M.knn_impute(df, ["a", "b", "s"], 5, max_cells=max_cells).collect()}
    cols = ["a", "b", "s"]
    data = [dict(zip(["id", *cols], r)) for r in rows]
    for t in ("a", "b"):
        mean = sum(r[t] for r in data if r[t] is not None) / sum(1 for r in data if r[t] is not None)
        for r in data:
            if r[t] is not None:
                continue
            cands = []
            for d in data:
                if d[t] is None:
                    continue
                common = [o for o in cols if o != t and r[o] is not None and d[o] is not None]
                if not common:
                    continue
                dist = math.sqrt(len(cols) / len(common) * sum((r[o] - d[o]) ** 2 for o in common))
                key = tuple((d[c] is None, d[c] if d[c] is not None else 0) for c in cols)
                cands.append((dist, -len(common), key, d[t]))
            cands.sort()
            want = sum(c[3] for c in cands[:5]) / len(cands[:5]) if cands else mean
            idx = 0 if t == "a" else 1
            assert got[r["id"]][idx] == pytest.approx(want), (t, r)

"""Operators on a table where one key holds a third of all rows (results vs plain Python)."""

import random
from collections import Counter, defaultdict

import pytest

from cohort_spark.operators import dedup as D
from cohort_spark.operators import joins as J
from cohort_spark.operators import stats as A
from cohort_spark.operators.ordered import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 400)
        rows.append((key, rnd.randint(0, 50), i, rnd.choice(["a", "b", None])))
    df = spark.createDataFrame(rows, "k long, t long, id long, s string").repartition(6)
    return rows, df


def test_earliest_per_key(skewed):
    rows, df = skewed
    want = {}
    for k, t, i, s in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        want.setdefault(k, (t, i))
    got = {r.k: (r.t, r.id) for r in D.earliest_per_key(df, "k", "t", ["id"]).collect()}
    assert got == want


def test_keep_none_and_analyze(skewed):
    rows, df = skewed
    c = Counter(r[0] for r in rows)
    assert D.handle_duplicates(df, ["k"], keep=False).count() == sum(1 for r in rows if c[r[0]] == 1)
    assert D.analyze_duplicates(df, ["k"]).count() == sum(1 for r in rows if c[r[0]] > 1)


def test_value_counts_and_quantiles(skewed):
    rows, df = skewed
    vc = {r.k: r["count"] for r in A.value_counts(df, "k").collect()}
    assert vc == dict(Counter(r[0] for r in rows))
    import numpy as np

    q = {r.q: r.value for r in exact_quantiles(df, ["k"], [0.1, 0.5, 0.9]).collect()}
    ks = np.array([r[0] for r in rows], dtype=float)
    for p in (0.1, 0.5, 0.9):
        assert q[p] == pytest.approx(float(np.percentile(ks, p * 100)))


def test_unique_outer_fold_with_hot_key(skewed, spark):
    rows, df = skewed
    first = D.earliest_per_key(df, "k", "t", ["id"]).select("k", "t")
    second = D.earliest_per_key(df.where("s = 'a'"), "k", "id", []).select("k", "id")
    out = J.outer_join_all([first, second], "k", unique_keys=True)
    by_k = defaultdict(list)
    for k, t, i, s in rows:
        if s == "a":
            by_k[k].append(i)
    got = {r.k: r.id for r in out.collect()}
    assert got[0] == min(by_k[0])
    assert set(got) == {r[0] for r in rows}

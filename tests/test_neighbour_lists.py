"""The rows that KNN filling sends to its comparisons: a few per recipient, however many blocks the donors fill."""

import random

import pytest
from test_neighbours import brute

from cohort_spark.operators import missing as M
from cohort_spark.operators import neighbours as N


def test_recipients_are_sent_to_few_blocks(spark, monkeypatch):
    rnd = random.Random(6)
    gaps = (0.6, 0.5, 0.4, 0.4, 0.35)

    def row():
        a = rnd.gauss(0, 50)
        full = (a, a / rnd.randrange(1, 17) + rnd.random(), rnd.random() * 100, float(rnd.randrange(30)), float(rnd.randrange(12)))
        return tuple(None if rnd.random() < g else v for v, g in zip(full, gaps))

    rows = [row() for _ in range(5000)]
    monkeypatch.setattr(N, "DONORS", 200)  # some 25 cells, or 40 blocks of lists
    sent, whole = [], N._compare
    monkeypatch.setattr(N, "_compare", lambda ask, *a: sent.append(ask.count()) or whole(ask, *a))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, c0 double, c1 double, c2 double, c3 double, c4 double")
    got = {r["id"]: tuple(r[1:]) for r in M.knn_impute(df, [f"c{i}" for i in range(5)], 5).collect()}
    for i, want in enumerate(brute(rows[:40], rows, 5, 5)):
        assert got[i] == pytest.approx(want), (rows[i], got[i], want)
    asking = sum(None in r and any(v is not None for v in r) for r in rows)
    assert sum(sent) < 8 * asking, (sent, asking)

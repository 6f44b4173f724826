"""Operator 12 against brute force: windows, ties, copies, odd rows."""

import math
import random

import pytest

from cohort_spark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, id string, raw string, qid long"


def brute(rows, positives=5, negatives=5, every=100):
    seen, use = set(), []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * x) for x in v)
        if (i, label, q) not in seen:
            seen.add((i, label, q))
            use.append((i, label, q))
    last = lambda i: (i is None, i or 0)
    out = []
    for a, la, qa in use:
        if a is None or a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(qa, q)), last(i), lb, i) for i, lb, q in use if len(q) == len(qa) and (i, lb, q) != (a, la, qa)]
        scored.sort(key=lambda x: x[:2])
        for p in [x for x in scored if x[2] == la][:positives]:
            near = [x for x in scored if x[2] != la and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]]
            out += [(a, p[3], r, x[3], -p[0], -x[0]) for r, x in enumerate(near[:negatives], 1)]
    return sorted(out, key=str)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in hn.hard_negatives(df, **kw).collect()), key=str)


@pytest.mark.parametrize("seed,size", [(1, 3), (2, 8)])
def test_equals_brute_force(spark, monkeypatch, seed, size):
    monkeypatch.setattr(hn, "BLOCK", 40)
    monkeypatch.setattr(hn, "QUERIES", 4)
    rnd = random.Random(seed)
    pool = [[rnd.gauss(0, 1) * rnd.choice([0.3, 1, 4]) for _ in range(size)] for _ in range(150)]
    rows = [(i, rnd.choice(pool), rnd.randrange(3)) for i in range(0, 3000, 10)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.9, 0.1], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 2), (4, [1.0, 1.0], None),
            (None, [0.9, 0.0], 2), (5, [0.9, 0.0], 2), (6, [0.0, 0.0], 1), (7, [], 1), (100, [], 2), (8, [1.0], 3), (200, [float("inf")], 1),
            (300, [-1.0, 0.0], 1), (9, [0.95, 0.0], 2), (10, [0.95, 0.0], 2)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []


def test_hot_vector_is_cut_in_its_class(spark):
    rows = [(i, [1.0, 0.5], 1) for i in range(400)] + [(i, [1.0, 0.4], 2) for i in range(400, 900)]
    assert mined(spark, rows) == brute(rows)


def test_large_components_are_exact_and_saturate(spark):
    big = float(2**28)
    rows = [(0, [big, 1.0], 1), (1, [big, 1.0], 1), (2, [big, 0.0], 2), (3, [big, 2.0], 2), (4, [big, 1.0], 2)]
    assert mined(spark, rows, scale=1.0) == [(0, 1, 1, 4, 2**56 + 1, 2**56 + 1), (0, 1, 2, 2, 2**56 + 1, 2**56)]  # beyond exact doubles
    rows = [(i, [float(2**40), float(i)], label) for i, label in ((0, 1), (1, 1), (2, 2), (3, 2))]
    assert [(r[3], r[4], r[5]) for r in mined(spark, rows, scale=1.0)] == [(2, hn.LONG, hn.LONG), (3, hn.LONG, hn.LONG)]


def test_feasible_ranges_lose_nothing():
    import numpy as np

    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.standard_normal((500, 6))).astype(np.int64)
    b = hn.Bucket(v)
    for q in v[:40]:
        s = v @ q
        low = int(np.sort(s)[-20])
        assert set(np.flatnonzero(s >= low)) <= set(b.feasible(q, low)) if low > 0 else True
        assert len(b.feasible(q, int(s.max()))) < len(v)

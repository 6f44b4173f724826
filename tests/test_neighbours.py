"""KNN filling against brute force: many presence masks, continuous values, ties, copies, unseen rows."""

import math
import random

import pytest

from cohort_spark.operators import missing as M
from cohort_spark.operators import neighbours as N


def brute(rows, donors, d, k):
    """Every row filled; rows and donors are tuples with None."""
    miss = lambda v: v is None or v != v
    out = []
    for r in rows:
        new = list(r)
        for t in range(d):
            if not miss(r[t]):
                continue
            cands = []
            for q in donors:
                both = [i for i in range(d) if not miss(r[i]) and not miss(q[i])]
                if miss(q[t]) or not both:
                    continue
                total = 0.0
                for i in both:
                    total += (r[i] - q[i]) ** 2
                cands.append((math.sqrt(d / len(both) * total), -len(both), tuple((miss(v), 0 if miss(v) else v) for v in q), q[t]))
            cands.sort()
            have = [q[t] for q in donors if not miss(q[t])]
            new[t] = sum(c[3] for c in cands[:k]) / len(cands[:k]) if cands else sum(have) / len(have) if have else None
        out.append(tuple(new))
    return out


def compare(spark, rows, d, k=5, donors=None, **kw):
    schema = "id long, " + ", ".join(f"c{i} double" for i in range(d))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    cols = [f"c{i}" for i in range(d)]
    if donors is not None:
        pats, means = M.knn_donors(spark.createDataFrame([(i, *r) for i, r in enumerate(donors)], schema), cols)
        kw |= {"donors": pats, "means": means}
    got = {r["id"]: tuple(r[1:]) for r in M.knn_impute(df, cols, k, **kw).collect()}
    for i, want in enumerate(brute(rows, rows if donors is None else donors, d, k)):
        assert got[i] == pytest.approx(want), (rows[i], got[i], want)


def test_over_64_masks_of_continuous_values(spark):
    rnd = random.Random(3)
    rows = [tuple(rnd.gauss(i, 1 + i) if rnd.random() < 0.7 else None for i in range(9)) for _ in range(400)]
    assert len({tuple(v is None for v in r) for r in rows}) > 64
    compare(spark, rows, 9)


@pytest.mark.parametrize("max_cells", [1, 7, 16_384])
def test_ties_and_copies(spark, monkeypatch, max_cells):
    monkeypatch.setattr(N, "DONORS", 16)
    monkeypatch.setattr(N, "RECIPIENTS", 8)
    rnd = random.Random(4)
    rows = [tuple(rnd.choice([None, float("nan"), -1.0, 0.0, 1.0, 2.0]) for _ in range(4)) for _ in range(300)] + [(1.0, None, 2.0, 0.0)] * 100
    compare(spark, rows, 4, max_cells=max_cells)


def test_unseen_rows_and_no_donors(spark):
    rnd = random.Random(5)
    donors = [tuple(rnd.gauss(0, 1) if rnd.random() < 0.8 else None for _ in range(3)) for _ in range(80)]
    rows = [tuple(rnd.gauss(0, 3) if rnd.random() < 0.5 else None for _ in range(3)) for _ in range(60)] + [(None, None, None)]
    compare(spark, rows, 3, donors=donors)
    compare(spark, [(1.0, None), (2.0, None), (None, None)], 2)
    compare(spark, [(None, None)], 2, donors=[(1.0, 5.0), (2.0, None)])


def test_bounds_never_exceed_distances(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    y = np.where(rng.random((300, 5)) < 0.8, rng.normal(size=(300, 5)) * [1, 2, 3, 4, 50], np.nan)
    df = spark.createDataFrame([(*[None if v != v else float(v) for v in r], 1) for r in y], "d0 double, d1 double, d2 double, d3 double, d4 double, cnt long")
    dealt, cells = N.build_cells(df, 5, 1000)
    x = np.where(rng.random((50, 5)) < 0.6, rng.normal(size=(50, 5)) * [1, 2, 3, 4, 50], np.nan)
    low, _ = cells.bounds(x)
    pruned = 0
    for r in dealt.toPandas().to_numpy(dtype="float64"):
        off = (x - r[:5]) ** 2
        n = (~np.isnan(off)).sum(axis=1)
        dist = np.sqrt(5 / np.maximum(n, 1) * np.nansum(off, axis=1))
        assert (low[n > 0, int(r[6])] <= dist[n > 0] + 1e-9).all()
        pruned += (low[:, int(r[6])] > 0).sum()
    assert len(cells.rows) > 5 and pruned > 1000


def test_a_recipient_meets_few_of_the_donors(spark, monkeypatch):
    """The kernel compares what the sorted windows leave, not all pairs, and still finds the first donors."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(2)
    y = np.where(rng.random((3000, 6)) < 0.6, np.round(rng.normal(size=(3000, 6)) * [1, 2, 3, 40, 5, 6], 3), np.nan)
    y[:, 5] = np.where(np.isnan(y[:, 5]), np.nan, np.round(y[:, 5]))  # ties
    y[0, 0], y[1, 3] = np.inf, 1e200
    names = [f"d{i}" for i in range(6)]
    right = pd.DataFrame(y, columns=names).assign(cnt=1)
    asks = [(j, t) for j in range(len(y)) for t in range(6) if np.isnan(y[j, t]) and not np.isnan(y[j]).all()]
    left = pd.DataFrame(y[[j for j, _ in asks]], columns=names).assign(rid=[j for j, _ in asks], target=np.array([t for _, t in asks], np.int32), cap=np.inf)
    seen, whole = [], N._distances
    monkeypatch.setattr(N, "_distances", lambda x, r, *a: seen.append(len(r)) or whole(x, r, *a))
    out = N._nearest(6, 5)(left, right)
    assert sum(seen) < 0.1 * len(asks) * len(y)
    got = {key: g["y"].tolist() for key, g in out.groupby(["rid", "target"])}
    for j, t in [asks[i] for i in range(0, len(asks), 97)]:
        both = ~np.isnan(y) & ~np.isnan(y[j])
        n = both.sum(axis=1)
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            dist = np.sqrt(6 / n * np.where(both, (y - y[j]) ** 2, 0).sum(axis=1))
        ok = np.flatnonzero((n > 0) & ~np.isnan(y[:, t]))
        first = sorted(ok, key=lambda q: (dist[q], -n[q], [(np.isnan(v), 0 if np.isnan(v) else v) for v in y[q]]))[:5]
        assert got[j, t] == [y[q, t] for q in first]

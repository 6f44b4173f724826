"""Softmax boosting against a plain NumPy version, saved models, staged scores, a resumed search."""

import numpy as np
import pytest

from cohort_spark import sources as S
from cohort_spark.operators import boosting as B
from cohort_spark.operators import models as L


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(400, 4)), 2)
    y = (x[:, 0] + x[:, 1] > 0.4).astype(int) + (x[:, 2] * x[:, 3] > 0.2)
    df = spark.createDataFrame([(i, float(c), *map(float, r)) for i, (c, r) in enumerate(zip(y, x))], "k long, label double, a double, b double, c double, d double").repartition(5)
    return x, y, L.assemble(df, ["a", "b", "c", "d"])


def plain(x, y, edges, depth, step, rounds, lam=1.0, least=1.0):
    """Margins after every round, growing each tree by recursion on the raw values."""
    classes = sorted(set(y))
    m, out = np.zeros((len(y), len(classes))), []
    for _ in range(rounds):
        e = np.exp(m - m.max(axis=1, keepdims=True))
        prob = e / e.sum(axis=1, keepdims=True)
        add = np.zeros_like(m)
        for k, c in enumerate(classes):
            g, h = prob[:, k] - (y == c), 2 * prob[:, k] * (1 - prob[:, k])

            def split(rows, level):
                best, G, H = None, g[rows].sum(), h[rows].sum()
                for f in range(x.shape[1]) if level < depth else ():
                    for cut in edges[f]:
                        left = x[rows, f] <= cut
                        hl, hr = h[rows][left].sum(), h[rows][~left].sum()
                        if hl >= least and hr >= least:
                            gain = g[rows][left].sum() ** 2 / (hl + lam) + g[rows][~left].sum() ** 2 / (hr + lam) - G**2 / (H + lam)
                            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, f, cut)
                if best is None:
                    add[rows, k] = -step * G / (H + lam)
                else:
                    left = x[rows, best[1]] <= best[2]
                    split(rows[left], level + 1)
                    split(rows[~left], level + 1)

            split(np.arange(len(y)), 0)
        m = m + add
        out.append(m)
    return out


def test_equals_plain_version(frame, monkeypatch):
    monkeypatch.setattr(B, "REFRESH", 3)
    x, y, df = frame
    model = B.fit_softmax_trees(df, max_depth=3, step=0.3, n_iter=7, bins=16)
    margins = plain(x, y, B.bin_edges(df, "features", 4, 16), 3, 0.3, 7)
    got = {r.k: (r.probability.toArray(), r.prediction) for r in model.transform(df).collect()}
    want = B.softmax(margins[-1])
    for i in range(len(y)):
        assert got[i][0] == pytest.approx(want[i], abs=1e-9) and got[i][1] == float(margins[-1][i].argmax())
    staged = model.staged_accuracies(df, "label", [1, 4, 7])
    assert staged == {n: pytest.approx(np.mean(margins[n - 1].argmax(axis=1) == y)) for n in (1, 4, 7)}
    assert model.first(4).staged_accuracies(df, "label", [4])[4] == pytest.approx(staged[4])


def test_saved_model_and_subsample(frame, tmp_path):
    _, _, df = frame
    model = B.fit_softmax_trees(df, max_depth=2, step=0.3, n_iter=4, subsample=0.8)
    again = S.load_model(S.save_model(model, str(tmp_path / "m")))
    assert [r.prediction for r in again.transform(df).orderBy("k").collect()] == [r.prediction for r in model.transform(df).orderBy("k").collect()]
    assert B.fit_softmax_trees(df, max_depth=2, step=0.3, n_iter=4, subsample=0.8).rounds() == model.rounds()


def test_search_shares_fits_and_resumes(frame, tmp_path, monkeypatch):
    _, _, df = frame
    fits, keep = [], B.fit_softmax_trees
    monkeypatch.setattr(B, "fit_softmax_trees", lambda *a, **kw: (fits.append(a[4]), keep(*a, **kw))[1])
    args = dict(depths=(2,), iters=(2, 5), subsamples=(1.0,), folds=2, log=str(tmp_path / "log"))
    _, scores = B.boosted_grid_search(df, "label", "k", steps=(0.3,), **args)
    assert len(scores) == 2 and fits[:2] == [5, 5] and len(fits) == 3
    fits.clear()
    model, scores = B.boosted_grid_search(df, "label", "k", steps=(0.3, 0.1), **args)
    assert len(scores) == 4 and len(fits) == 3 and len(model.rounds()) in (2, 5)

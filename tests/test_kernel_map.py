"""The RBF map on landmarks: measured error, exactness on landmarks, a curved boundary, saved maps, a resumed search."""

import math

import numpy as np
import pytest

from cohort_spark import sources as S
from cohort_spark.operators import models as L


@pytest.fixture(scope="module")
def rings(spark):
    rows = []
    for i in range(240):
        r, a = (1.0, 3.0)[i % 2] + 0.1 * math.sin(7 * i), 2 * math.pi * i / 120
        rows.append((i, float(i % 2), r * math.cos(a), r * math.sin(a)))
    return L.assemble(spark.createDataFrame(rows, "k long, label double, a double, b double"), ["a", "b"])


def test_error_falls_with_landmarks_and_ends_at_zero(rings):
    errors = [L.nystroem_map(rings, "label", 0.5, m).getOrDefault("error") for m in (4, 16, 60, 240)]
    assert errors[0] > errors[1] > errors[2] > errors[3] and errors[2] < 0.01 and errors[3] < 1e-6
    m = L.nystroem_map(rings, "label", 0.5, 20)
    marks = np.array(m.getOrDefault("landmarks")).reshape(-1, 2)
    other = np.array([[0.3, -1.0], [2.0, 2.0]])
    assert np.allclose(m.mapping()(marks) @ m.mapping()(other).T, L.rbf_kernel(marks, other, 0.5), atol=1e-6)


def test_accuracy_is_that_of_the_exact_kernel(spark, rings, tmp_path):
    pdf = rings.select("label", "a", "b").toPandas()
    x, y = pdf[["a", "b"]].to_numpy(), pdf["label"].to_numpy() * 2 - 1
    k = L.rbf_kernel(x, x, 0.5)
    exact = np.mean(np.sign(k @ np.linalg.solve(k + 0.1 * np.eye(len(y)), y)) == y)  # kernel ridge on the whole kernel
    rbf = L.fit_svm(rings, C=1.0, kernel="rbf", gamma=0.5, n_components=40)
    path = S.save_model(rbf, str(tmp_path / "svm"))
    for model in (rbf, S.load_model(path)):
        got = L.accuracy(model.transform(rings), "label", "prediction").collect()[0][0]
        assert got >= exact - 0.01 and rbf.stages[0].getOrDefault("error") < 0.05
    linear = L.fit_svm(rings, C=1.0, kernel="linear", max_iter=20)
    assert L.accuracy(linear.transform(rings), "label", "prediction").collect()[0][0] < 0.8


def test_a_search_goes_on_where_it_ended(rings, tmp_path, monkeypatch):
    fits, keep = [], L.fit_svm
    monkeypatch.setattr(L, "fit_svm", lambda *a, **kw: (fits.append(kw["C"]), keep(*a, **kw))[1])
    grid = dict(kernels=("linear",), folds=2, max_iter=5, log=str(tmp_path / "log"))
    L.svm_grid_search(rings, "label", "k", Cs=(0.1,), **grid)
    assert fits == [0.1, 0.1, 0.1]
    fits.clear()
    _, scores = L.svm_grid_search(rings, "label", "k", Cs=(0.1, 1.0), **grid)
    assert fits[:2] == [1.0, 1.0] and len(fits) == 3 and len(scores) == 2

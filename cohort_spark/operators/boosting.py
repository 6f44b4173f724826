"""Boosted trees for several classes as one model (L3): softmax gradients, second-order leaf values, histogram splits.

Feature values are put into quantile bins once, and each task packs its rows into a few binary blocks, checkpointed. Every level
of a round is one job: tasks sum gradients and hessians per (class, node, feature, bin) and the sums are combined by a tree
reduction; the driver only sees these tables, whose size does not depend on the rows. A round grows one tree per class from
the same softmax probabilities. Margins are stored with the blocks every few rounds, so a job only adds the latest trees.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.operators.ordered import fused_single_row, reliable

REFRESH = 10  # rounds between stored margins
SUMS = 64e6  # bytes of sums in one job


def _walk(tree: dict, x: np.ndarray) -> np.ndarray:
    """Leaf values of rows (bins or raw values, by how the tree's cuts are given); a value up to the cut goes left."""
    at = np.zeros(len(x), np.int64)
    feature, cut, left, value = (np.asarray(tree[k]) for k in ("feature", "cut", "left", "value"))
    for _ in range(tree["depth"]):
        inner = left[at] > 0
        rows = np.flatnonzero(inner)
        if not len(rows):
            break
        n = at[rows]
        at[rows] = left[n] + (x[rows, feature[n]] > cut[n])
    return value[at]


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class SoftmaxTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted model: ``trees`` is a list of rounds, each a tree per class. Adds ``probability`` and ``prediction``."""

    trees = Param(Params._dummy(), "trees", "rounds of one tree per class, as JSON", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "labels in order", TypeConverters.toListFloat)
    input_col = Param(Params._dummy(), "input_col", "vector column", TypeConverters.toString)

    def __init__(self, trees: str = "[]", classes: Sequence[float] = (), input_col: str = "features"):
        super().__init__()
        self._set(trees=trees, classes=[float(c) for c in classes], input_col=input_col)

    def rounds(self) -> list:
        return json.loads(self.getOrDefault(self.trees))

    def first(self, n: int) -> "SoftmaxTrees":
        """The model after its first ``n`` rounds."""
        return SoftmaxTrees(json.dumps(self.rounds()[:n]), self.getOrDefault(self.classes), self.getOrDefault(self.input_col))

    def staged_accuracies(self, df: DataFrame, label: str, rounds: Sequence[int]) -> dict[int, float]:
        """Accuracy on ``df`` after each of ``rounds``, in one pass."""
        grown, classes, ends = self.rounds(), np.array(self.getOrDefault(self.classes)), sorted(set(rounds))

        @F.pandas_udf("array<double>")
        def staged(x: pd.Series) -> pd.Series:
            m = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            margins, out = np.zeros((len(m), len(classes))), []
            for n, trees in enumerate(grown, 1):
                for k, t in enumerate(trees):
                    margins[:, k] += _walk(t, m)
                if n in ends:
                    out.append(classes[margins.argmax(axis=1)])
            out += [out[-1] if out else np.full(len(m), classes[0])] * (len(ends) - len(out))
            return pd.Series(list(np.stack(out, axis=1)))

        got = df.select(qcol(label).cast("double").alias("y"), staged(vector_to_array(qcol(self.getOrDefault(self.input_col)))).alias("p"))
        row = got.agg(*[F.avg((F.col("p")[i] == F.col("y")).cast("double")).alias(f"a{i}") for i in range(len(ends))]).first()
        return {n: row[f"a{i}"] for i, n in enumerate(ends)}

    def _transform(self, df: DataFrame) -> DataFrame:
        grown, n_classes, classes = self.rounds(), len(self.getOrDefault(self.classes)), self.getOrDefault(self.classes)

        @F.pandas_udf("array<double>")
        def probability(x: pd.Series) -> pd.Series:
            m = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            margins = np.zeros((len(m), n_classes))
            for trees in grown:
                for k, t in enumerate(trees):
                    margins[:, k] += _walk(t, m)
            return pd.Series(list(softmax(margins)) if len(m) else [])

        out = df.withColumn("_p", probability(vector_to_array(qcol(self.getOrDefault(self.input_col)))))
        best = F.array_position("_p", F.array_max("_p")).cast("int") - 1
        return out.withColumn("probability", array_to_vector("_p")).withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in classes]), best + 1)).drop("_p")


def bin_edges(df: DataFrame, features_col: str, p: int, bins: int) -> list[list[float]]:
    """Distinct approximate quantiles of each feature: the cuts that splits may use."""
    x = df.select(vector_to_array(qcol(features_col)).alias("x"))
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    got = fused_single_row(x, {f"q{i}": F.percentile_approx(F.col("x")[i], probs, 10_000) for i in range(p)})
    return [sorted(set(got[f"q{i}"] or [])) for i in range(p)]


def _used(block: int, n: int, round_: int, subsample: float, seed: int) -> np.ndarray:
    return np.ones(n, bool) if subsample >= 1 else np.random.default_rng([seed, round_, block]).random(n) < subsample


def fit_softmax_trees(df: DataFrame, label: str = "label", max_depth: int = 3, step: float = 0.1, n_iter: int = 50, subsample: float = 1.0, seed: int = 42,
                      features_col: str = "features", bins: int = 64, reg_lambda: float = 1.0, min_child: float = 1.0) -> SoftmaxTrees:
    """L3: ``n_iter`` rounds of one tree per class. Gradients are p - [y = k], hessians 2 p (1 - p); a split must gain, and each child must
    hold hessians of ``min_child``; a leaf is -step * G / (H + reg_lambda). With ``subsample`` a round uses a seeded share of the rows."""
    rows = df.select(qcol(label).cast("double").alias("y"), vector_to_array(qcol(features_col)).alias("x")).where("y is not null")
    classes = sorted(r[0] for r in rows.select("y").distinct().collect())  # one row per class
    k_all, p = len(classes), len(rows.first()["x"])
    edges = bin_edges(df, features_col, p, bins)
    width = max((len(e) for e in edges), default=0) + 1
    shared = df.sparkSession.sparkContext.broadcast((edges, classes))

    def pack(batches):
        cuts, known = shared.value
        for pdf in batches:
            m = np.vstack(pdf["x"].to_numpy())
            b = np.stack([np.searchsorted(c, m[:, i], side="left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8 if width <= 256 else np.uint16)
            y = np.searchsorted(known, pdf["y"].to_numpy()).astype(np.int32)
            yield pd.DataFrame({"x": [b.tobytes()], "y": [y.tobytes()], "m": [np.zeros((len(y), k_all)).tobytes()]})

    blocks = reliable(rows.mapInPandas(pack, "x binary, y binary, m binary").withColumn("block", F.monotonically_increasing_id()))
    kind = np.uint8 if width <= 256 else np.uint16

    def read(r, fresh):
        y = np.frombuffer(r["y"], np.int32)
        x = np.frombuffer(r["x"], kind).reshape(len(y), p)
        m = np.frombuffer(r["m"], np.float64).reshape(len(y), k_all).copy()
        for trees in fresh:
            for k, t in enumerate(trees):
                m[:, k] += _walk(t, x)
        return x, y, m

    def level_sums(fresh, growing, open_, round_):
        """Gradient and hessian sums per (class, open node, feature, bin)."""
        def sums(r):
            x, y, m = read(r, fresh)
            use = _used(r["block"], len(y), round_, subsample, seed)
            prob = softmax(m)
            out = np.zeros((k_all, max(map(len, open_), default=0), p, width, 2))
            for k in range(k_all):
                if not open_[k]:
                    continue
                g, h = prob[:, k] - (y == k), 2 * prob[:, k] * (1 - prob[:, k])
                node = _nodes(growing[k], x)
                for j, n in enumerate(open_[k]):
                    at = np.flatnonzero((node == n) & use)
                    for f in range(p):
                        out[k, j, f, :, 0] += np.bincount(x[at, f], g[at], width)
                        out[k, j, f, :, 1] += np.bincount(x[at, f], h[at], width)
            return out
        return blocks.rdd.map(sums).treeReduce(np.add)

    at_once = max(1, int(SUMS // (16 * k_all * p * width)))  # nodes of a class whose sums travel in one job
    rounds, fresh = [], []
    for t in range(n_iter):
        growing = [{"feature": [0], "cut": [0], "left": [0], "value": [0.0], "depth": 0} for _ in classes]
        open_ = [[0] for _ in classes]
        for level in range(max_depth):
            if not any(open_):
                break
            grown: list[list[int]] = [[] for _ in classes]
            for a in range(0, max(map(len, open_)), at_once):
                part = [o[a:a + at_once] for o in open_]
                total = level_sums(fresh, growing, part, t)
                for k in range(k_all):
                    grown[k] += _grow(growing[k], part[k], total[k], step, reg_lambda, min_child, level == 0)
            open_ = grown
        rounds.append(growing)
        fresh.append(growing)
        if len(fresh) == REFRESH and t + 1 < n_iter:
            done = list(fresh)

            def store(batches):
                for pdf in batches:
                    pdf["m"] = [read(r, done)[2].tobytes() for _, r in pdf.iterrows()]
                    yield pdf

            blocks, fresh = reliable(blocks.mapInPandas(store, "x binary, y binary, m binary, block long")), []
    real = [[{**tree, "cut": [edges[f][c] if left else 0.0 for f, c, left in zip(tree["feature"], tree["cut"], tree["left"])]} for tree in trees] for trees in rounds]
    return SoftmaxTrees(json.dumps(real), classes, features_col)


def _nodes(tree: dict, x: np.ndarray) -> np.ndarray:
    """The node that each row of bins has come to."""
    return _walk({**tree, "value": np.arange(len(tree["left"]))}, x)


def _grow(tree: dict, open_: list[int], total: np.ndarray, step: float, lam: float, least: float, root: bool) -> list[int]:
    """Split the open nodes by their sums (node, feature, bin, gradient and hessian); returns the new open nodes."""
    out = []
    for j, n in enumerate(open_):
        g, h = total[j, 0, :, 0].sum(), total[j, 0, :, 1].sum()
        if root:
            tree["value"][n] = float(-step * g / (h + lam))
        gl, hl = np.cumsum(total[j, :, :, 0], axis=1)[:, :-1], np.cumsum(total[j, :, :, 1], axis=1)[:, :-1]
        gr, hr = g - gl, h - hl
        gain = gl**2 / (hl + lam) + gr**2 / (hr + lam) - g**2 / (h + lam)
        gain = np.where((hl >= least) & (hr >= least), gain, -np.inf)
        if not gain.size or not gain.max() > 1e-9:
            continue
        f, c = divmod(int(gain.argmax()), gain.shape[1])
        at = len(tree["left"])
        tree["feature"][n], tree["cut"][n], tree["left"][n] = f, c, at
        for gs, hs in ((gl[f, c], hl[f, c]), (gr[f, c], hr[f, c])):
            tree["feature"].append(0)
            tree["cut"].append(0)
            tree["left"].append(0)
            tree["value"].append(float(-step * gs / (hs + lam)))
        out += [at, at + 1]
    tree["depth"] += bool(out)
    return out


def boosted_grid_search(df: DataFrame, label: str, key: str, depths: Sequence[int] = (3, 6, 10), steps: Sequence[float] = (0.01, 0.1, 0.3), iters: Sequence[int] = (50, 100, 200),
                        subsamples: Sequence[float] = (0.8, 0.9, 1.0), folds: int = 3, seed: int = 42, features_col: str = "features", log: str | None = None, run: str = "boosted", **kw):
    """L5 for boosted trees: one fit of the most rounds settles every number of rounds, scored after each in one pass, so the axis of
    ``iters`` costs one fit instead of one each. Class-stratified folds; the best setting (the first of equals) is refitted on all of ``df``.
    Returns (model, {(depth, step, rounds, subsample): mean accuracy}). With ``log`` results are kept in that metric log and a
    rerun fits only what is missing."""
    from cohort_spark.operators.models import _logged, stratified_folds
    from cohort_spark.sources.tables import append_metrics

    spark = df.sparkSession
    known = {r["metric"]: r["value"] for r in _logged(spark, log).where(F.col("run") == run).collect()} if log else {}  # one row per setting
    data = reliable(stratified_folds(df, label, key, folds, seed, "_fold"))
    scores: dict = {}
    for depth in depths:
        for rate in steps:
            for share in subsamples:
                name = {n: f"accuracy depth={depth} step={rate} rounds={n} subsample={share} folds={folds} seed={seed}" for n in iters}
                if not all(x in known for x in name.values()):
                    parts = []
                    for f in range(folds):
                        model = fit_softmax_trees(data.where(F.col("_fold") != f), label, depth, rate, max(iters), share, seed, features_col, **kw)
                        parts.append(model.staged_accuracies(data.where(F.col("_fold") == f), label, iters))
                    known |= {name[n]: float(np.mean([x[n] for x in parts])) for n in iters}
                    if log:
                        append_metrics(spark.createDataFrame([(run, "boosted trees", name[n], known[name[n]]) for n in iters], "run string, model string, metric string, value double"), log)
                scores |= {(depth, rate, n, share): known[name[n]] for n in iters}
    best = max(scores, key=lambda s: scores[s])
    return fit_softmax_trees(data, label, best[0], best[1], best[2], best[3], seed, features_col, **kw), scores

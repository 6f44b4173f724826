"""Classification with Spark ML.

Fits are distributed Spark ML estimators; grid search is ``CrossValidator``
with parallel fits. Multi-class boosting and SVM use ``OneVsRest``; the RBF
kernel is approximated on landmark rows (Nyström) so that the linear SVM still
trains distributed.
"""


import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.operators.metrics import accuracy


def assemble(df: DataFrame, features: Sequence[str] | str, out: str = "features") -> DataFrame:
    """Feature vector from numeric columns, or from one array column. Names with a dot (one-hot
    names such as ``SEX_0.0``) are aliased for the assembler, which resolves columns by name."""
    if isinstance(features, str):
        return df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))
    feats = list(features)
    if not any("." in f for f in feats):
        return VectorAssembler(inputCols=feats, outputCol=out, handleInvalid="error").transform(df)
    safe = [f"_asm{i}" for i in range(len(feats))]
    tmp = df.select("*", *[F.col("`" + f + "`").alias(a) for f, a in zip(feats, safe)])
    return VectorAssembler(inputCols=safe, outputCol=out, handleInvalid="error").transform(tmp).drop(*safe)


def fit_logistic(df: DataFrame, label: str = "label", C: float = 1.0, max_iter: int = 100,
                 features_col: str = "features"):
    """L1: L2-regularised multinomial logistic regression; ``C`` maps to regParam = 1 / (C · n)."""
    n = df.count()
    est = LogisticRegression(featuresCol=features_col, labelCol=label, regParam=1.0 / (C * n), elasticNetParam=0.0,
                             maxIter=max_iter, standardization=False, family="multinomial")
    return est.fit(df)


def fit_random_forest(df: DataFrame, label: str = "label", n_trees: int = 100, max_depth: int = 10,
                      min_leaf: int = 1, seed: int = 42, features_col: str = "features"):
    """L2: random forest (depth capped at 30 by Spark)."""
    est = RandomForestClassifier(featuresCol=features_col, labelCol=label, numTrees=n_trees,
                                 maxDepth=min(max_depth, 30), minInstancesPerNode=min_leaf, seed=seed)
    return est.fit(df)


def boosted_trees(label: str = "label", max_depth: int = 3, step: float = 0.1, n_iter: int = 50,
                  subsample: float = 1.0, seed: int = 42, features_col: str = "features") -> OneVsRest:
    """L3 estimator: gradient-boosted trees, one-vs-rest for more than two classes."""
    gbt = GBTClassifier(featuresCol=features_col, labelCol=label, maxDepth=max_depth, stepSize=step, maxIter=n_iter,
                        subsamplingRate=subsample, seed=seed)
    return OneVsRest(classifier=gbt, featuresCol=features_col, labelCol=label, parallelism=4)


def fit_boosted_trees(df: DataFrame, label: str = "label", **kw):
    """L3: fit :func:`boosted_trees`."""
    return boosted_trees(label, **kw).fit(df)


class NystroemFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Low-rank RBF kernel map z(x) = K(x, L) K(L, L)^(-1/2) on landmark rows L, so z(x)·z(y) approximates exp(-γ|x − y|²)
    and equals it where x or y is a landmark.

    The landmarks are params, so a saved map is its params; mapping is one vectorised pandas UDF per batch. ``error`` is the mean
    absolute kernel error that :func:`nystroem_map` measured on other rows."""

    landmarks = Param(Params._dummy(), "landmarks", "landmark rows, one after the other", TypeConverters.toListFloat)
    n_in = Param(Params._dummy(), "n_in", "number of input features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    error = Param(Params._dummy(), "error", "mean absolute kernel error on a sample", TypeConverters.toFloat)
    input_col = Param(Params._dummy(), "input_col", "vector column to map", TypeConverters.toString)
    output_col = Param(Params._dummy(), "output_col", "mapped vector column", TypeConverters.toString)

    def __init__(self, landmarks: Sequence[float] = (), n_in: int = 1, gamma: float = 1.0, error: float = 0.0, input_col: str = "features", output_col: str = "kernel"):
        super().__init__()
        self._set(landmarks=[float(x) for x in landmarks], n_in=n_in, gamma=gamma, error=error, input_col=input_col, output_col=output_col)

    def mapping(self):
        """The map of a matrix of rows."""
        marks = np.array(self.getOrDefault(self.landmarks)).reshape(-1, self.getOrDefault(self.n_in))
        gamma = self.getOrDefault(self.gamma)
        values, vectors = np.linalg.eigh(rbf_kernel(marks, marks, gamma))
        keep = values > 1e-10 * max(values.max(initial=0.0), 1e-300)  # landmarks that depend on others add nothing
        root = vectors[:, keep] / np.sqrt(values[keep])
        return lambda x: rbf_kernel(x, marks, gamma) @ root

    def _transform(self, df: DataFrame) -> DataFrame:
        import pandas as pd

        to, width = self.mapping(), self.getOrDefault(self.n_in)

        @F.pandas_udf("array<double>")
        def mapped(x: pd.Series) -> pd.Series:
            return pd.Series(list(to(np.vstack(x.to_numpy()) if len(x) else np.zeros((0, width)))))

        tmp = df.withColumn("_arr", vector_to_array(F.col(self.getOrDefault(self.input_col))))
        return tmp.withColumn(self.getOrDefault(self.output_col), array_to_vector(mapped(F.col("_arr")))).drop("_arr")


def rbf_kernel(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    far = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2.0 * x @ y.T
    return np.exp(-gamma * np.maximum(far, 0.0))


def nystroem_map(df: DataFrame, label: str, gamma: float, n_landmarks: int = 200, seed: int = 42, features_col: str = "features", tested: int = 300) -> NystroemFeatures:
    """A kernel map on a seeded sample of different rows, as many of each class, with its error measured on ``tested`` other rows. Only
    these bounded samples reach the driver."""
    rows = df.select(qcol(label).alias("y"), vector_to_array(qcol(features_col)).alias("x")).where("y is not null")
    classes = sorted(r[0] for r in rows.select("y").distinct().collect())  # one row per class
    share = -(-n_landmarks // max(1, len(classes)))

    def pick(part: DataFrame, salt: int, n: int) -> list:
        return [r["x"] for r in part.select("x").distinct().orderBy(F.xxhash64(F.lit(salt), "x"), "x").limit(n).collect()]

    marks = np.array([x for c in classes for x in pick(rows.where(F.col("y") == F.lit(c)), seed, share)])
    other = np.array(pick(rows, seed + 1, tested))
    width = marks.shape[1]
    made = NystroemFeatures(marks.ravel().tolist(), width, gamma, 0.0, features_col)
    z = made.mapping()(other)
    error = float(np.abs(rbf_kernel(other, other, gamma) - z @ z.T).mean())
    return made._set(error=error)


def rbf_gamma(df: DataFrame, features_col: str, n_features: int, gamma: str | float = "scale") -> float:
    """'scale' = 1 / (p · var(X)), 'auto' = 1 / p."""
    if isinstance(gamma, (int, float)):
        return float(gamma)
    if gamma == "auto":
        return 1.0 / n_features
    v = (df.select(F.explode(vector_to_array(features_col)).alias("v")).agg(F.var_pop("v")).collect()[0][0]) or 1.0
    return 1.0 / (n_features * v)


def fit_svm(df: DataFrame, label: str = "label", C: float = 1.0, kernel: str = "linear", gamma: str | float = "scale",
            n_components: int = 200, seed: int = 42, features_col: str = "features", max_iter: int = 100):
    """L4: one-vs-rest linear SVM (regParam = 1 / (C · n)); ``kernel='rbf'`` first maps the features to
    ``n_components`` landmarks (:func:`nystroem_map`, which measures the kernel error: ``model.stages[0].error``). Returns a fitted pipeline."""
    from cohort_spark.operators.ordered import reliable

    n = df.count()
    svc = LinearSVC(labelCol=label, regParam=1.0 / (C * n), maxIter=max_iter)
    if kernel == "rbf":
        p = len(df.select(features_col).first()[0])
        kernel_map = nystroem_map(df, label, rbf_gamma(df, features_col, p, gamma), n_components, seed, features_col)
        svc.setFeaturesCol("kernel")
        ovr = OneVsRest(classifier=svc, featuresCol="kernel", labelCol=label, parallelism=4)
        mapped = reliable(kernel_map.transform(df))  # the Python mapping runs once, not once per iteration
        return PipelineModel(stages=[kernel_map, ovr.fit(mapped)])
    svc.setFeaturesCol(features_col)
    ovr = OneVsRest(classifier=svc, featuresCol=features_col, labelCol=label, parallelism=4)
    return ovr.fit(df)


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 3, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Fold number per row: within each class, rows ordered by md5('<seed>:<key>') are cut into
    ``folds`` runs (class shares equal in every fold, up to one row).

    Only (label, hash, key) are put in order, to find the last row of each run; the folds are then comparisons, so the
    frame with its feature vectors is neither shuffled nor joined. Rows without a label get no fold."""
    from cohort_spark.operators.ordered import kth_in_order
    from cohort_spark.operators.sample import seeded_hash

    sizes = sorted((r[0], r[1]) for r in df.where(qcol(label).isNotNull()).groupBy(qcol(label)).count().collect())  # one row per class
    cuts, before = {}, 0
    for cls, n in sizes:
        for f in range(1, folds):
            k = n * f // folds
            if k:
                cuts[cls, f] = before + k
        before += n
    h = seeded_hash(key, seed)
    last = kth_in_order(df.where(qcol(label).isNotNull()), [label, h, qcol(key)], list(cuts.values())) if cuts else {}
    fold = F.lit(0)
    for (cls, f), k in sorted(cuts.items(), key=lambda x: x[0][1]):  # a row beyond the last of run f - 1 is at least in run f
        _, at, row = last[k]
        beyond = (h > F.lit(at)) | ((h == F.lit(at)) & (qcol(key) > F.lit(row)))
        fold = F.when((qcol(label) == F.lit(cls)) & beyond, f).otherwise(fold)
    for cls, n in sizes:  # a class of fewer rows than folds: its first runs are empty
        empty = sum(1 for f in range(1, folds) if n * f // folds == 0)
        if empty:
            fold = F.when((qcol(label) == F.lit(cls)) & (fold == 0), empty).otherwise(fold)
    return df.withColumn(out, F.when(qcol(label).isNotNull(), fold.cast("int")))


def grid_search(est: Estimator, grid: dict, df: DataFrame, label: str = "label", folds: int = 3,
                metric: str = "accuracy", parallelism: int = 4, seed: int = 42, stratify_key: str | None = None):
    """Exhaustive grid with k-fold cross-validation, refit of the best setting.
    ``grid`` maps Param -> list of values. With ``stratify_key`` the folds are stratified by
    class (:func:`stratified_folds`), as a classifier's cross-validation does by default."""
    b = ParamGridBuilder()
    for param, values in grid.items():
        b = b.addGrid(param, list(values))
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    cv = CrossValidator(estimator=est, estimatorParamMaps=b.build(), evaluator=ev, numFolds=folds,
                        parallelism=parallelism, seed=seed)
    if stratify_key:
        df = stratified_folds(df, label, stratify_key, folds, seed, "_fold")
        cv.setFoldCol("_fold")
    return cv.fit(df)


def param_sweep(make_est, values: Sequence, train: DataFrame, test: DataFrame, label: str = "label",
                param_name: str = "value") -> DataFrame:
    """Fit one model per value and report weighted F1 on ``test`` as ``(value, f1)``."""
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    rows = [(float(v), float(ev.evaluate(make_est(v).fit(train).transform(test)))) for v in values]
    return train.sparkSession.createDataFrame(rows, f"{param_name} double, f1 double")


def predict_batch(model, df: DataFrame, keep: Sequence[str] = (), features_col: str = "features") -> DataFrame:
    """Class (and probabilities when the model has them) for a whole table. Only the feature
    vector and the kept columns (under plain aliases) reach the model, since Spark ML resolves
    columns by name."""
    safe = {c: f"_keep{i}" for i, c in enumerate(keep)}
    src = df.select(*[F.col("`" + c + "`").alias(a) for c, a in safe.items()], F.col("`" + features_col + "`"))
    out = model.transform(src)
    probs = [F.col("probability")] if "probability" in out.columns else []
    return out.select(*[F.col(a).alias(c) for c, a in safe.items()], F.col("prediction"), *probs)


def feature_importance(model, names: Sequence[str], k: int = 10) -> DataFrame:
    """Impurity importances, the ``k`` largest as ``(feature, importance)``."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray()
    rows = sorted(((names[i], float(v)) for i, v in enumerate(imp)), key=lambda t: (-t[1], t[0]))[:k]
    return spark.createDataFrame(rows, "feature string, importance double")


def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str, key: str,
                           seed: int = 42, assemble_fn=None) -> DataFrame:
    """Accuracy drop when one feature's values are permuted across rows.

    The permutation pairs the row of rank i in key order with the row of rank i
    in ``md5(seed:key)`` order; one equi-join on the rank attaches the permuted copy of every feature. One scoring
    pass then does for all features: each row is scored as it is and once per feature with that feature's permuted
    value, and one aggregate gives every accuracy.
    """
    from cohort_spark.operators.ordered import global_rank, reliable
    from cohort_spark.operators.sample import seeded_hash

    assemble_fn = assemble_fn or (lambda d: assemble(d, list(features)))
    by_key = global_rank(df, [qcol(key)], "_rk")
    by_hash = global_rank(df.select(*[qcol(c) for c in [key, *features]]), [seeded_hash(key, seed), qcol(key)], "_rh")
    perm = [f"_perm{i}" for i in range(len(features))]
    donors = by_hash.select(F.col("_rh").alias("_rk"), *[qcol(f).alias(p) for f, p in zip(features, perm)])
    both = reliable(by_key.join(donors, "_rk"))
    at = {f: i for i, f in enumerate(features)}
    copies = both.withColumn("_f", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))))  # -1: the row as it is
    copies = copies.select("_f", *[F.when(F.col("_f") == at[c], F.col(f"_perm{at[c]}")).otherwise(qcol(c)).alias(c) if c in at else qcol(c) for c in df.columns])
    scored = model.transform(assemble_fn(copies).select("_f", qcol(label).alias("_label"), "features"))
    hit = F.coalesce((F.col("prediction") == F.col("_label")).cast("double"), F.lit(0.0))  # a missing prediction is a miss
    acc = {r["_f"]: r["a"] for r in scored.groupBy("_f").agg(F.avg(hit).alias("a")).collect()}  # one row per feature
    rows = [(f, float(acc[-1]), float(acc[i]), float(acc[-1] - acc[i])) for i, f in enumerate(features)] if acc else []
    return df.sparkSession.createDataFrame(rows, "feature string, base_accuracy double, permuted_accuracy double, "
                                                 "importance double")


def svm_grid_search(df: DataFrame, label: str, key: str, Cs=(0.1, 1.0, 10.0), kernels=("linear", "rbf"),
                    gammas=("scale", "auto"), folds: int = 3, seed: int = 42, max_iter: int = 100, log: str | None = None, run: str = "svm"):
    """L4 + L5: cross-validated grid over C, kernel and gamma (gamma only matters for ``rbf``),
    class-stratified folds, refit of the best setting on all of ``df``.
    Returns (best model, rows of (C, kernel, gamma, mean accuracy)). With ``log`` every setting's result is written to that
    metric log (S6) under ``run`` as it ends, and a rerun starts with the settings that are not there yet."""
    from cohort_spark.operators.ordered import reliable
    from cohort_spark.sources.tables import append_metrics

    spark = df.sparkSession
    known = {r["metric"]: r["value"] for r in _logged(spark, log).where(F.col("run") == run).collect()} if log else {}  # one row per setting
    data = reliable(stratified_folds(df, label, key, folds, seed, "_fold"))
    settings = [(c, k, g) for c in Cs for k in kernels for g in (gammas if k == "rbf" else ("scale",))]
    scores = []
    for c, k, g in settings:
        name = f"accuracy C={float(c)} kernel={k} gamma={g} folds={folds} seed={seed} iterations={max_iter}"
        if name not in known:
            accs = []
            for f in range(folds):
                model = fit_svm(data.where(F.col("_fold") != f), label, C=c, kernel=k, gamma=g, seed=seed,
                                max_iter=max_iter)
                accs.append(accuracy(model.transform(data.where(F.col("_fold") == f)), label, "prediction").collect()[0][0])
            known[name] = float(sum(accs) / len(accs))
            if log:
                append_metrics(spark.createDataFrame([(run, "SVM", name, known[name])], "run string, model string, metric string, value double"), log)
        scores.append((float(c), k, g, known[name]))
    best = scores[max(range(len(scores)), key=lambda i: (scores[i][3], -i))]  # first setting wins ties
    model = fit_svm(data, label, C=best[0], kernel=best[1], gamma=best[2], seed=seed, max_iter=max_iter)
    return model, scores


def _logged(spark, path: str) -> DataFrame:
    """The metric log at ``path``; empty before its first row."""
    from pyspark.errors import AnalysisException

    from cohort_spark.sources.tables import METRIC_SCHEMA

    try:
        return spark.read.schema(METRIC_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], METRIC_SCHEMA)


def boosted_grid(label: str = "label", depths=(3, 6, 10), steps=(0.01, 0.1, 0.3), iters=(50, 100, 200),
                 subsamples=(0.8, 0.9, 1.0), seed: int = 42):
    """L3 + L5: a one-vs-rest estimator and the grid of boosted-tree classifiers to search (the
    ``classifier`` parameter of one-vs-rest is the grid axis)."""
    ovr = boosted_trees(label, seed=seed)
    gbts = [GBTClassifier(labelCol=label, maxDepth=d, stepSize=st, maxIter=it, subsamplingRate=ss, seed=seed)
            for d in depths for st in steps for it in iters for ss in subsamples]
    return ovr, {ovr.classifier: gbts}

"""Encoding and scaling.

A fitted preprocessor is a small table of numbers (means, standard deviations,
category levels); applying it is a single projection of column expressions, so
scoring a large table needs no Python per row and no vector round trip.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.operators.ordered import fused_single_row, global_rank

MAX_LEVELS = 1000  # guard: one-hot width must stay bounded


def level_name(v) -> str:
    """Text of a category level as it appears in an encoded column name (``SEX_0.0``)."""
    if isinstance(v, float) and v.is_integer():
        return f"{v:.1f}"
    return str(v)


def scale_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column (one aggregate)."""
    st = fused_single_row(df, {**{f"m{i}": F.avg(qcol(c)) for i, c in enumerate(cols)},
                               **{f"s{i}": F.stddev_pop(qcol(c)) for i, c in enumerate(cols)}})
    return {c: (st[f"m{i}"], st[f"s{i}"]) for i, c in enumerate(cols)}


def standard_scale(df: DataFrame, cols: Sequence[str], stats: dict | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column is divided by 1."""
    stats = stats or scale_stats(df, cols)
    ex = {}
    for c in cols:
        m, s = stats[c]
        ex[c] = (qcol(c) - F.lit(m)) / F.lit(s if s not in (None, 0.0) else 1.0)
    return df.select(*[ex[c].alias(c) if c in ex else qcol(c) for c in df.columns])


def levels_of(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list]:
    """Sorted distinct non-null levels per column; refuses unbounded domains."""
    cols = list(cols)
    if not cols:
        return {}
    nd = fused_single_row(df, {f"d{i}": F.approx_count_distinct(qcol(c), 0.05) for i, c in enumerate(cols)})
    wide = [c for i, c in enumerate(cols) if nd[f"d{i}"] > max_levels * 1.2]
    if wide:  # checked before any level set is collected
        raise ValueError(f"more than {max_levels} levels: {wide}")
    sets = fused_single_row(df, {f"l{i}": F.array_sort(F.collect_set(qcol(c))) for i, c in enumerate(cols)})
    out = {c: list(sets[f"l{i}"]) for i, c in enumerate(cols)}
    big = [c for c, v in out.items() if len(v) > max_levels]
    if big:
        raise ValueError(f"more than {max_levels} levels: {big}")
    return out


def one_hot(df: DataFrame, cols: Sequence[str], levels: dict | None = None, keep_original: bool = False) -> DataFrame:
    """One 0/1 double column ``col_level`` per observed level (sorted); an unknown level or a
    missing value gives all zeros. Encoded columns replace the originals, appended at the end."""
    levels = levels or levels_of(df, cols)
    dummies = [F.coalesce((qcol(c) == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{level_name(v)}")
               for c in cols for v in levels[c]]
    rest = [qcol(c) for c in df.columns if keep_original or c not in set(cols)]
    return df.select(*rest, *dummies)


def get_dummies(df: DataFrame, cols: Sequence[str] | None = None, drop_first: bool = True) -> DataFrame:
    """Boolean indicator per level (first sorted level omitted when ``drop_first``); a missing
    value is all false. Default columns: the text columns. Other columns come first."""
    from cohort_spark.operators.columns import columns_of_kind

    cols = list(cols if cols is not None else columns_of_kind(df, "string"))
    levels = levels_of(df, cols)
    dummies = []
    for c in cols:
        lv = levels[c][1:] if drop_first else levels[c]
        dummies += [F.coalesce(qcol(c) == F.lit(v), F.lit(False)).alias(f"{c}_{level_name(v)}") for v in lv]
    return df.select(*[qcol(c) for c in df.columns if c not in set(cols)], *dummies)


CODES_BROADCAST = 100_000  # codes of a label column that are broadcast (counted first)


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Sorted distinct values -> 0 .. n-1 (exact, distributed ranks of the distinct values)."""
    out = out or col
    codes = global_rank(df.select(qcol(col)).where(qcol(col).isNotNull()).distinct(), [col], "_code")
    codes = codes.select(qcol(col), (F.col("_code") - 1).cast("int").alias("_enc"))
    if codes.count() <= CODES_BROADCAST:  # else a shuffle join, whose skewed partitions Spark splits
        codes = F.broadcast(codes)
    joined = df.join(codes, on=col, how="left")
    res = joined.withColumn(out, F.col("_enc"))
    cols = [c for c in df.columns] + ([out] if out not in df.columns else [])
    return res.select(*[qcol(c) for c in cols])


@dataclass
class Preprocessor:
    """Fitted E5 model: scaling numbers, category levels, the output column order, and what KNN filling
    needs of the fitted rows: column means and the staged table of donor patterns with counts."""
    numerical: list[str]
    categorical: list[str]
    passthrough: list[str]
    scale: dict = field(default_factory=dict)
    levels: dict = field(default_factory=dict)
    knn_k: int = 5
    knn_cols: list = field(default_factory=list)
    knn_means: dict = field(default_factory=dict)
    knn_path: str | None = None

    def feature_columns(self) -> list[str]:
        """Scaled numeric columns, then one-hot columns (the model inputs)."""
        return [*self.numerical] + [f"{c}_{level_name(v)}" for c in self.categorical for v in self.levels[c]]

    def output_columns(self) -> list[str]:
        return self.feature_columns() + [*self.passthrough]

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def from_json(s: str) -> "Preprocessor":
        return Preprocessor(**json.loads(s))


def fit_preprocessor(df: DataFrame, numerical: Sequence[str], categorical: Sequence[str],
                     knn_k: int = 5, donors_path: str | None = None) -> Preprocessor:
    """E5 (fit): population scaling for numeric columns; KNN filling then sorted levels for
    categorical columns; everything else passes through. The donor patterns are written to
    ``donors_path`` (default: the shared checkpoint folder), so rows seen later are filled from the
    rows of the fit."""
    from cohort_spark.operators.missing import _numeric, knn_donors, knn_impute
    from cohort_spark.session import scratch_path

    num, cat = list(numerical), list(categorical)
    knn_cols = [c for c in cat if c in set(_numeric(df))]  # distances need numeric codes
    path, means, filled = None, {}, df
    if knn_cols:
        patterns, means = knn_donors(df, knn_cols)
        path = donors_path or scratch_path(df.sparkSession, "knn-donors")
        patterns.write.mode("overwrite").parquet(path)
        filled = knn_impute(df, knn_cols, knn_k, donors=df.sparkSession.read.parquet(path), means=means)
    return Preprocessor(numerical=num, categorical=cat, knn_cols=knn_cols,
                        passthrough=[c for c in df.columns if c not in set(num) | set(cat)],
                        scale={c: list(v) for c, v in scale_stats(df, num).items()},
                        levels={c: [float(x) if isinstance(x, (int, float)) else x for x in v]
                                for c, v in levels_of(filled, cat).items()},
                        knn_k=knn_k, knn_means=means, knn_path=path)



def apply_preprocessor(df: DataFrame, pre: Preprocessor, impute: bool = True) -> DataFrame:
    """E5 (apply): scaled numeric columns, one-hot columns, then pass-through columns."""
    from cohort_spark.operators.missing import knn_impute

    x = df
    if impute and pre.knn_cols:
        x = knn_impute(df, pre.knn_cols, pre.knn_k, donors=df.sparkSession.read.parquet(pre.knn_path), means=pre.knn_means)
    num = [((qcol(c) - F.lit(m)) / F.lit(s if s not in (None, 0.0) else 1.0)).alias(c)
           for c, (m, s) in ((c, pre.scale[c]) for c in pre.numerical)]
    hot = [F.coalesce((qcol(c).cast("double") == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{level_name(v)}")
           if isinstance(v, float) else
           F.coalesce((qcol(c) == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{level_name(v)}")
           for c in pre.categorical for v in pre.levels[c]]
    return x.select(*num, *hot, *[qcol(c) for c in pre.passthrough])


def class_moments(df: DataFrame, features: Sequence[str], label: str) -> dict:
    """Per class: row count, feature sums and the cross-product matrix XᵀX."""
    centre, parts = centred_moments(df, features, label)
    return {c: (n, s + n * centre, xx + np.outer(centre, s) + np.outer(s, centre) + n * np.outer(centre, centre)) for c, (n, s, xx) in parts.items()}


def centred_moments(df: DataFrame, features: Sequence[str], label: str) -> tuple[np.ndarray, dict]:
    """The features' means over all rows, and per class the row count, feature sums and cross-product matrix of the features less those means.

    Each task folds its rows into one (count, sums, XᵀX) per class with NumPy
    (``mapInPandas``); the per-task results — classes × (1 + p + p²) numbers per
    partition — are summed element-wise by one grouped aggregate. Rows with a
    missing feature are left out.
    """
    import pandas as pd

    feats = list(features)
    p = len(feats)
    cols = [f"f{i}" for i in range(p)]
    means = fused_single_row(df, {c: F.avg(qcol(f).cast("double")) for f, c in zip(feats, cols)})
    centre = np.array([means[c] or 0.0 for c in cols])  # scatter is the same from any origin; from this one it loses no digits
    base = df.select(qcol(label).cast("string").alias("_cls"),
                     *[qcol(f).cast("double").alias(c) for f, c in zip(feats, cols)])

    def fold(batches):
        acc: dict = {}
        for pdf in batches:
            for cls, g in pdf.groupby("_cls"):
                x = g[cols].to_numpy(dtype="float64")
                x = x[~np.isnan(x).any(axis=1)] - centre  # rows with a missing feature are left out
                n0, s0, xx0 = acc.get(cls, (0, np.zeros(p), np.zeros((p, p))))
                acc[cls] = (n0 + len(x), s0 + x.sum(axis=0), xx0 + x.T @ x)
        if acc:  # an empty partition has no numbers, and an empty list column no type
            yield pd.DataFrame({"_cls": list(acc), "n": [v[0] for v in acc.values()],
                                "vals": [np.concatenate([v[1], v[2].ravel()]).tolist() for v in acc.values()]})

    part = base.mapInPandas(fold, "_cls string, n long, vals array<double>")
    summed = (part.select("_cls", "n", F.posexplode("vals").alias("i", "v"))
              .groupBy("_cls", "i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect())
    out: dict = {}
    for r in summed:
        n, vals = out.setdefault(r["_cls"], [0, np.zeros(p + p * p)])
        vals[r["i"]] = r["v"]
        out[r["_cls"]][0] = r["n"]
    return centre, {c: (n, v[:p], v[p:].reshape(p, p)) for c, (n, v) in out.items()}


def lda_project(df: DataFrame, features: Sequence[str], label: str, n_components: int | None = None,
                out_prefix: str = "LD") -> DataFrame:
    """Linear discriminant projection to min(features, classes - 1) axes.

    Class counts, sums and cross-product sums come from :func:`centred_moments`
    (a scan for the means and one for the centred moments); the p×p eigen-problem is solved on the driver and the projection
    is a column expression.
    """
    feats = list(features)
    p = len(feats)
    _, mom = centred_moments(df, feats, label)
    classes = sorted(mom)
    n_tot = sum(m[0] for m in mom.values())
    mu = sum(m[1] for m in mom.values()) / n_tot
    sw = np.zeros((p, p))
    sb = np.zeros((p, p))
    for n, s_, xx in mom.values():
        m = s_ / n
        sw += xx - n * np.outer(m, m)
        sb += n * np.outer(m - mu, m - mu)
    k = n_components or min(p, len(classes) - 1)
    vals, vecs = np.linalg.eig(np.linalg.pinv(sw) @ sb)
    order = np.argsort(-vals.real)[:k]
    w = vecs[:, order].real
    proj = [sum(qcol(f).cast("double") * float(w[i, j]) for i, f in enumerate(feats)).alias(f"{out_prefix}{j + 1}")
            for j in range(k)]
    return df.select(*[qcol(c) for c in df.columns if c not in set(feats)], *proj)

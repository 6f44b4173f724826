"""Outlier treatment.

Each method needs a handful of numbers per column (mean, std, quartiles,
median); they come from one fused aggregate plus the distributed quantile
helper, then a single projection rewrites the columns.
"""


import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.operators.columns import columns_of_kind
from cohort_spark.operators.dedup import drop_duplicate_rows
from cohort_spark.operators.missing import drop_sparse_columns, impute_mean_mode, medians_of
from cohort_spark.operators.ordered import exact_quantiles, fused_single_row, reliable
from cohort_spark.session import scratch_path
from cohort_spark.sources import stage_table


def _quartiles(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[float, float]]:
    out: dict[str, dict[float, float]] = {c: {} for c in cols}
    if cols:
        for r in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).collect():
            out[r["column"]][round(r["q"], 2)] = r["value"]
    return out


def outlier_zscore_median(df: DataFrame, cols: Sequence[str] | None = None, t: float = 3.0) -> DataFrame:
    """O1: |z| (population std) not below ``t`` -> column median. A missing value fails the
    test and is also set to the median; a constant column (z undefined) becomes its median."""
    cols = list(cols or columns_of_kind(df, "number"))
    st = fused_single_row(df, {**{f"m{i}": F.avg(qcol(c)) for i, c in enumerate(cols)},
                               **{f"s{i}": F.stddev_pop(qcol(c)) for i, c in enumerate(cols)}})
    med = medians_of(df, cols)
    exprs = {}
    for i, c in enumerate(cols):
        mean, sd = st[f"m{i}"], st[f"s{i}"]
        z = F.abs((qcol(c) - F.lit(mean)) / F.lit(sd)) if sd not in (None, 0) else F.lit(None)
        exprs[c] = F.when(z < t, qcol(c)).otherwise(F.lit(med.get(c)))
    return df.select(*[exprs[c].alias(c) if c in exprs else qcol(c) for c in df.columns])


def outlier_iqr_median(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """O2: outside [Q1 - k·IQR, Q3 + k·IQR] (or missing) -> column median."""
    cols = list(cols or columns_of_kind(df, "number"))
    qs = _quartiles(df, cols)
    exprs = {}
    for c in cols:
        q1, med, q3 = qs[c].get(0.25), qs[c].get(0.5), qs[c].get(0.75)
        if q1 is None:
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        exprs[c] = F.when((qcol(c) >= lo) & (qcol(c) <= hi), qcol(c)).otherwise(F.lit(med))
    return df.select(*[exprs[c].alias(c) if c in exprs else qcol(c) for c in df.columns])


def outlier_to_null(df: DataFrame, cols: Sequence[str] | None = None, method: str = "zscore",
                    t: float = 2.0) -> DataFrame:
    """Z (sample std) greater than ``t`` -> NULL, or outside [Q1 - IQR, Q3 + IQR] -> NULL.
    Constant columns (std or IQR of 0) and non-numeric columns are left alone."""
    num = set(columns_of_kind(df, "number"))
    cols = [c for c in (cols or columns_of_kind(df, "number")) if c in df.columns and c in num]
    exprs = {}
    if method == "zscore":
        st = fused_single_row(df, {**{f"m{i}": F.avg(qcol(c)) for i, c in enumerate(cols)},
                                   **{f"s{i}": F.stddev_samp(qcol(c)) for i, c in enumerate(cols)}})
        for i, c in enumerate(cols):
            mean, sd = st[f"m{i}"], st[f"s{i}"]
            if sd in (None, 0) or (isinstance(sd, float) and math.isnan(sd)):
                continue
            exprs[c] = F.when(F.abs((qcol(c) - F.lit(mean)) / F.lit(sd)) > t, F.lit(None)).otherwise(qcol(c))
    elif method == "iqr":
        qs = _quartiles(df, cols)
        for c in cols:
            q1, q3 = qs[c].get(0.25), qs[c].get(0.75)
            if q1 is None or q3 - q1 == 0:
                continue
            lo, hi = q1 - (q3 - q1), q3 + (q3 - q1)
            exprs[c] = F.when((qcol(c) < lo) | (qcol(c) > hi), F.lit(None)).otherwise(qcol(c))
    else:
        raise ValueError("method must be 'zscore' or 'iqr'")
    return df.select(*[exprs[c].alias(c) if c in exprs else qcol(c) for c in df.columns])


def outlier_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per numeric column of ``before``: mean and sample std before and after, and the
    number of missing values after (``Points_Modified``)."""
    cols = columns_of_kind(before, "number")
    b = fused_single_row(before, {**{f"m{i}": F.avg(qcol(c)) for i, c in enumerate(cols)},
                                  **{f"s{i}": F.stddev_samp(qcol(c)) for i, c in enumerate(cols)}})
    a = fused_single_row(after, {**{f"m{i}": F.avg(qcol(c)) for i, c in enumerate(cols)},
                                 **{f"s{i}": F.stddev_samp(qcol(c)) for i, c in enumerate(cols)},
                                 **{f"n{i}": F.count_if(qcol(c).isNull()) for i, c in enumerate(cols)}})
    rows = [(c, b[f"m{i}"], a[f"m{i}"], b[f"s{i}"], a[f"s{i}"], int(a[f"n{i}"])) for i, c in enumerate(cols)]
    return before.sparkSession.createDataFrame(
        rows, "Column string, Original_Mean double, Cleaned_Mean double, Original_Std double, "
              "Cleaned_Std double, Points_Modified bigint")


# ------------------------------------------------------------------ isolation forest (O3)

def _c(n: float) -> float:
    """Average path length of an unsuccessful search in a binary search tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow_1d(sample: np.ndarray, rng: np.random.Generator, depth_limit: int):
    """One isolation tree on 1-D data, returned as leaf intervals (upper bounds, path lengths)."""
    bounds, values = [], []

    def rec(lo_b, hi_b, pts, depth):
        if depth >= depth_limit or len(pts) <= 1 or pts.min() == pts.max():
            bounds.append(hi_b)
            values.append(depth + _c(len(pts)))
            return
        split = rng.uniform(pts.min(), pts.max())
        rec(lo_b, split, pts[pts < split], depth + 1)
        rec(split, hi_b, pts[pts >= split], depth + 1)

    rec(-np.inf, np.inf, sample, 0)
    return np.array(bounds), np.array(values)


def merge_trees(trees: list, m: int):
    """One step function from many 1-D trees: sorted breakpoints and the mean path length between them."""
    cuts = np.unique(np.concatenate([b[:-1] for b, _ in trees])) if trees else np.array([])
    probe = np.concatenate([cuts, [np.inf]])  # the value just below each cut uses the left leaf
    total = np.zeros(len(probe))
    for b, v in trees:
        total += v[np.searchsorted(b, probe, side="left")]
    return cuts, total / max(len(trees), 1), _c(m)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit integers over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def smallest_uniforms(value: float, copies: int, trees: int, p: float, seed: int, first: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The uniform hashes up to ``p`` among those of ``copies`` rows in each of ``trees`` trees, in order, and their trees.

    Order statistics of ``copies * trees`` uniforms are drawn directly: each survives the one before by a factor
    ``(1 - e) ** (1 / left)`` with a fresh uniform ``e``, so the work is that of the hashes returned, not of the copies. Every
    hash belongs to another (row, tree); the draw depends on the value, the seed and the count alone.
    """
    bits = int(np.float64(value + 0.0).view(np.uint64))
    rng = np.random.default_rng([seed, bits])
    total = copies * trees
    kept, log_left, done = [], 0.0, 0
    while done < total:
        size = min(total - done, int(1.3 * (total - done) * p) + 16)
        e = rng.random(size)
        if not done and first is not None:
            e[0] = first
        steps = log_left + np.cumsum(np.log1p(-e) / (total - done - np.arange(size)))
        u = -np.expm1(steps)
        kept.append(u[u <= p])
        done += size
        if len(kept[-1]) < size:
            break
        log_left = steps[-1]
    us = np.concatenate(kept) if kept else np.zeros(0)
    slots = rng.choice(total, len(us), replace=False) if len(us) else np.zeros(0, np.int64)
    return us, slots % trees


def _draws(trees: int, p: float, seed: int):
    """Per batch of ``(v, n)``: the rows ``(t, u, v)`` whose hash in tree ``t`` is at most ``p``."""
    import pandas as pd

    def run(batches):
        salt = _mixed(np.array([seed + 1], np.uint64))[0]
        for pdf in batches:
            v, n = pdf["v"].to_numpy(dtype="float64") + 0.0, pdf["n"].to_numpy()
            e = ((_mixed(v.view(np.uint64) ^ salt) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
            first = -np.expm1(np.log1p(-e) / (n.astype(np.float64) * trees))  # the smallest of a value's hashes decides whether there are any
            parts = [(*smallest_uniforms(float(v[i]), int(n[i]), trees, p, seed, float(e[i])), v[i]) for i in np.flatnonzero(first <= p)]
            yield pd.DataFrame({"t": np.concatenate([t for _, t, _ in parts]).astype("int64") if parts else np.zeros(0, "int64"),
                                "u": np.concatenate([u for u, _, _ in parts]) if parts else np.zeros(0),
                                "v": np.concatenate([np.full(len(u), x) for u, _, x in parts]) if parts else np.zeros(0)})
    return run


def fit_isolation_forest(df: DataFrame, c: str, n_trees: int = 100, max_samples: int = 256, seed: int = 42):
    """Isolation forest on one column, sampled and grown in Spark tasks.

    Each tree takes the ``max_samples`` rows with its smallest uniform hashes. Rows are counted per value (map-side); a value
    with ``n`` copies stays one row, from which the hashes below a cut are drawn as order statistics
    (:func:`smallest_uniforms`). The cut keeps about three times the needed rows over all values, whatever the counts;
    a per-tree window keeps the smallest, and each tree is grown in one ``applyInPandas`` group of at most ``max_samples``
    values. The sample does not depend on partitions or other columns. Only the leaves (trees x <= max_samples) reach the driver.
    """
    import pandas as pd

    from cohort_spark.operators.ordered import reliable

    counts = df.where(qcol(c).isNotNull()).groupBy(qcol(c).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    n = df.where(qcol(c).isNotNull()).count()
    if not n:
        return None
    m = min(max_samples, n)
    depth_limit = int(math.ceil(math.log2(max(m, 2))))
    p = min(1.0, 3.0 * m / n)
    while True:
        drawn = reliable(counts.mapInPandas(_draws(n_trees, p, seed), "t long, u double, v double"))
        sizes = dict(drawn.groupBy("t").count().collect())  # one row per tree
        if p >= 1.0 or (len(sizes) == n_trees and min(sizes.values()) >= m):
            break
        p = min(1.0, p * 3)
    w = Window.partitionBy("t").orderBy("u", "v")
    chosen = drawn.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= m)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["t"].iloc[0])
        rng = np.random.default_rng([seed, t])
        b, v = _grow_1d(pdf.sort_values(["u", "v"])["v"].to_numpy(dtype="float64"), rng, depth_limit)
        return pd.DataFrame({"t": t, "leaf": np.arange(len(b)), "upper": b, "path": v})

    leaves = chosen.select("t", "u", "v").groupBy("t").applyInPandas(
        grow, "t long, leaf long, upper double, path double").collect()  # trees x <= max_samples leaves
    by_tree: dict = {}
    for r in leaves:
        by_tree.setdefault(r["t"], []).append((r["leaf"], r["upper"], r["path"]))
    trees_out = []
    for t in sorted(by_tree):
        lv = sorted(by_tree[t])
        trees_out.append((np.array([x[1] for x in lv]), np.array([x[2] for x in lv])))
    return merge_trees(trees_out, m)


MAX_RANGES = 1000  # flagged value ranges expressed as a column condition


def _weighted_quantile(values: np.ndarray, counts: np.ndarray, q: float) -> float:
    """Linear-interpolation quantile of a multiset given as sorted distinct values with counts."""
    order = np.argsort(values, kind="stable")
    v, c = values[order], counts[order]
    ends = np.cumsum(c)
    pos = q * (ends[-1] - 1)
    lo, hi = int(math.floor(pos)), int(math.ceil(pos))
    v_lo = v[np.searchsorted(ends, lo, side="right")]
    v_hi = v[np.searchsorted(ends, hi, side="right")]
    return float(v_lo + (pos - lo) * (v_hi - v_lo))


def outlier_isolation_median(df: DataFrame, cols: Sequence[str], share: float = 0.1, n_trees: int = 100,
                             max_samples: int = 256, seed: int = 42) -> DataFrame:
    """O3: per column, an isolation forest on that column alone; the ``share`` of rows with the
    highest anomaly score is set to the column median (missing values too).

    Trees are sampled and grown in Spark tasks (:func:`fit_isolation_forest`) and merged into one
    step function per column (bounded by trees × max_samples breakpoints). The score only depends
    on which step a value falls in, so one vectorised pass counts rows per step; the exact
    ``share`` quantile of the score and the flagged value ranges follow from those counts on the
    driver, and the rewrite itself is a plain range condition on the column (JVM-side).
    """
    import pandas as pd

    spark = df.sparkSession
    med = medians_of(df, cols)
    out = df
    for j, c in enumerate(cols):
        fitted = fit_isolation_forest(df, c, n_trees, max_samples, seed + j)
        if fitted is None:
            continue
        cuts, mean_path, cn = fitted
        bc = spark.sparkContext.broadcast(cuts)

        @F.pandas_udf("int")
        def step(v: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bc.value, v.to_numpy(dtype="float64"), side="right").astype("int32"))

        counts = (df.where(qcol(c).isNotNull()).select(step(qcol(c).cast("double")).alias("i"))
                  .groupBy("i").count().collect())  # one row per occupied step: <= trees x max_samples
        idx = np.array([r["i"] for r in counts])
        cnt = np.array([r["count"] for r in counts])
        score = -np.power(2.0, -mean_path[idx] / cn)
        thr = _weighted_quantile(score, cnt, share)
        flagged = sorted(int(i) for i, sc in zip(idx, score) if sc < thr)
        ranges = []
        for i in flagged:  # merge adjacent steps into value ranges [lo, hi)
            lo = cuts[i - 1] if i > 0 else -np.inf
            hi = cuts[i] if i < len(cuts) else np.inf
            if ranges and ranges[-1][1] == lo:
                ranges[-1][1] = hi
            else:
                ranges.append([lo, hi])
        v = qcol(c).cast("double")
        if len(ranges) <= MAX_RANGES:
            hit = F.lit(False)
            for lo, hi in ranges:
                cond = F.lit(True)
                if np.isfinite(lo):
                    cond = cond & (v >= F.lit(float(lo)))
                if np.isfinite(hi):
                    cond = cond & (v < F.lit(float(hi)))
                hit = hit | cond
        else:  # very fragmented: look the step up again
            bad = F.array(*[F.lit(i) for i in flagged])
            hit = F.array_contains(bad, step(v))
        out = out.withColumn(c, F.when(qcol(c).isNotNull() & ~hit, qcol(c)).otherwise(F.lit(med.get(c))))
    return out


def clean_table(df: DataFrame, outlier_cols: Sequence[str], sparse_t: float = 0.6) -> DataFrame:
    """Whole-row de-duplication, drop sparse columns (share > ``sparse_t``), mean/mode
    filling, then isolation-forest treatment of ``outlier_cols``.

    The later steps scan the rows some ten times, so the de-duplicated table is kept: it is shuffled and written once."""
    out = drop_duplicate_rows(df)
    # Parquet has no void columns
    out = reliable(out) if "void" in dict(out.dtypes).values() else stage_table(out, scratch_path(df.sparkSession, "clean-rows"))
    out = drop_sparse_columns(out, sparse_t)
    out = impute_mean_mode(out)
    return outlier_isolation_median(out, [c for c in outlier_cols if c in out.columns])

"""Aggregations, statistics and data-quality tables.

Per-column statistics are computed in one fused aggregate per batch of columns
and returned in long form ``(column, ...)``. Quantiles, medians and modes use
the distributed helpers in :mod:`cohort_spark.operators.ordered` (no task holds
all values of a column). Only O(columns) numbers ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.operators.columns import columns_of_kind
from cohort_spark.operators.ordered import (exact_quantiles, fused_single_row, modes, quantiles_of_ranged,
                                            ranged_counts, reliable, unpivot_values, value_counts_long)


def _long_from_row(df: DataFrame, per_col: dict[str, dict[str, Column]], types: dict[str, str],
                   batch: int = 100) -> DataFrame:
    """Aggregates of ``df`` in batches of about ``batch`` expressions (bounded generated code);
    each column's statistics become one output row, without a driver round trip."""
    items = list(per_col.items())
    if not items:
        raise ValueError("no columns")
    per = max(1, batch // max(1, len(items[0][1])))
    parts = []
    for start in range(0, len(items), per):
        aggs, structs = [], []
        for i, (c, stats) in enumerate(items[start:start + per], start=start):
            fields = [F.lit(c).alias("column")]
            for name, e in stats.items():
                aggs.append(e.cast(types[name]).alias(f"_{i}_{name}"))
                fields.append(F.col(f"_{i}_{name}").alias(name))
            structs.append(F.struct(*fields))
        parts.append(df.agg(*aggs).select(F.explode(F.array(*structs)).alias("s")).select("s.*"))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def group_min(df: DataFrame, key: str, col: str, alias: str | None = None) -> DataFrame:
    """A1: minimum of ``col`` per key."""
    return df.groupBy(qcol(key)).agg(F.min(qcol(col)).alias(alias or f"min_{col}"))


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: ``(column, n_missing)`` for every column, one scan."""
    cols = list(cols or df.columns)
    return _long_from_row(df, {c: {"n_missing": F.count_if(qcol(c).isNull())} for c in cols},
                          {"n_missing": "bigint"})


def missing_ratio(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: ``(column, missing_ratio)`` — share of NULL per column."""
    cols = list(cols or df.columns)
    return _long_from_row(df, {c: {"missing_ratio": F.avg(qcol(c).isNull().cast("double"))} for c in cols},
                          {"missing_ratio": "double"})


def missing_ratio_map(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """A3 as a driver dict (O(columns)); used to decide which columns to drop or fill."""
    cols = list(cols or df.columns)
    vals = fused_single_row(df, {f"r{i}": F.avg(qcol(c).isNull().cast("double")) for i, c in enumerate(cols)})
    return {c: (vals[f"r{i}"] if vals[f"r{i}"] is not None else 0.0) for i, c in enumerate(cols)}


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """A4: ``(column, n_distinct)`` — distinct non-null values per column."""
    cols = list(cols or df.columns)
    fn = (lambda c: F.approx_count_distinct(qcol(c))) if approx else (lambda c: F.count_distinct(qcol(c)))
    return _long_from_row(df, {c: {"n_distinct": fn(qcol(c))} for c in cols}, {"n_distinct": "bigint"})


def distinct_counts_map(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> dict[str, int]:
    cols = list(cols or df.columns)
    return {r["column"]: r["n_distinct"] for r in distinct_counts(df, cols, approx).collect()}


def small_distinct_counts(df: DataFrame, cols: Sequence[str], bound: int) -> dict[str, int]:
    """Exact distinct count of every column whose count is at most ``bound``; other columns map
    to ``bound + 1``. A HyperLogLog estimate screens the columns first, so exact sets are only
    built for low-cardinality columns (no shuffle of every value of a near-unique column)."""
    cols = list(cols)
    if not cols:
        return {}
    est = fused_single_row(df, {f"a{i}": F.approx_count_distinct(qcol(c), 0.05) for i, c in enumerate(cols)})
    cand = [c for i, c in enumerate(cols) if est[f"a{i}"] <= 2 * bound + 10]
    exact = {}
    if cand:
        sets = fused_single_row(df, {f"s{i}": F.size(F.collect_set(qcol(c))) for i, c in enumerate(cand)})
        exact = {c: sets[f"s{i}"] for i, c in enumerate(cand)}
    return {c: (exact[c] if c in exact and exact[c] <= bound else bound + 1) for c in cols}


def distinct_values(df: DataFrame, cols: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """A5: ``(column, value)`` — the distinct non-null values of each column, as text. With
    ``limit``, only columns with at most ``limit`` distinct values are listed (screened first, so
    near-unique columns are never expanded)."""
    cols = list(cols or df.columns)
    if limit is not None:
        nd = small_distinct_counts(df, cols, limit)
        cols = [c for c in cols if nd[c] <= limit]
        if not cols:
            return df.sparkSession.createDataFrame([], "column string, value string")
    return unpivot_values(df, cols, "string").distinct()


STAT_NAMES = ("count", "mean", "std", "min", "q25", "q50", "q75", "max", "median", "mode")


def describe_stats(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
                   accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear), max, median and smallest mode per numeric column.

    ``exact=False`` takes the quartiles from ``percentile_approx`` (relative rank error about
    1/``accuracy``) inside the single statistics aggregate instead of the exact selection."""
    cols = list(cols or columns_of_kind(df, "number"))
    if not exact:
        stats = {c: {"count": F.count(qcol(c)), "mean": F.avg(qcol(c)), "std": F.stddev_samp(qcol(c)),
                     "min": F.min(qcol(c).cast("double")), "max": F.max(qcol(c).cast("double")),
                     **{n: F.percentile_approx(qcol(c).cast("double"), p, accuracy)
                        for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))}} for c in cols}
        types = {"count": "bigint", "mean": "double", "std": "double", "min": "double", "max": "double",
                 "q25": "double", "q50": "double", "q75": "double"}
        out = _long_from_row(df, stats, types).join(modes(value_counts_long(df, cols)), "column", "left")
        return out.withColumn("median", F.col("q50")).select("column", *STAT_NAMES)
    basic = _long_from_row(df, {c: {"count": F.count(qcol(c)), "mean": F.avg(qcol(c)), "std": F.stddev_samp(qcol(c)),
                                    "min": F.min(qcol(c).cast("double")), "max": F.max(qcol(c).cast("double"))}
                                for c in cols},
                           {"count": "bigint", "mean": "double", "std": "double", "min": "double", "max": "double"})
    ranged = ranged_counts(value_counts_long(df, cols), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    vc = ranged.drop("_pid")  # one checkpoint shared by quantiles and modes
    q = quantiles_of_ranged(ranged, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(*[F.first(F.when(F.col("q") == p, F.col("value")), ignorenulls=True).alias(n)
                                   for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    out = (basic.join(qw, "column", "left").join(modes(vc), "column", "left")
           .withColumn("median", F.col("q50")))
    return out.select("column", *STAT_NAMES)


def value_counts(df: DataFrame, col: str, normalize: bool = True, sort: bool = True) -> DataFrame:
    """``(col, count, share)`` per non-null value, most frequent first (``sort=False`` when the
    result feeds a join and order is irrelevant)."""
    counts = df.where(qcol(col).isNotNull()).groupBy(qcol(col)).agg(F.count(F.lit(1)).alias("count"))
    total = df.where(qcol(col).isNotNull()).count()  # one number
    out = counts.withColumn("share", F.col("count") / F.lit(float(total)) if total else F.lit(None).cast("double"))
    if not normalize:
        out = out.drop("share")
    return out.orderBy(F.col("count").desc(), qcol(col)) if sort else out


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, pairwise-complete (each pair uses
    the rows where both are present), long form ``(col_a, col_b, corr)`` including the diagonal.

    One scan whatever the number of columns: every partition accumulates centred moment matrices
    (counts, sums, squares and cross products over jointly present values) with NumPy, and the
    per-partition matrices are combined by a tree aggregation. A constant column, or a pair
    without two joint rows, has a NULL correlation; NaN counts as missing.
    """
    cols = list(cols or columns_of_kind(df, "number"))
    import numpy as np
    import pandas as pd

    p = len(cols)
    centre = fused_single_row(df, {f"m{i}": F.avg(F.nanvl(qcol(c).cast("double"), F.lit(None))) for i, c in enumerate(cols)})
    mu = np.array([centre[f"m{i}"] if centre[f"m{i}"] is not None else 0.0 for i in range(p)])
    names = [f"x{i}" for i in range(p)]
    narrow = df.select(*[qcol(c).cast("double").alias(n) for c, n in zip(cols, names)])

    def moments(batches):
        acc = np.zeros((4, p, p))
        for pdf in batches:
            x = pdf[names].to_numpy(dtype="float64") - mu
            m = (~np.isnan(x)).astype("float64")
            x0 = np.nan_to_num(x)
            acc[0] += m.T @ m  # rows where both are present
            acc[1] += x0.T @ m  # sum of a where b is present
            acc[2] += (x0 * x0).T @ m  # sum of a² where b is present
            acc[3] += x0.T @ x0  # sum of a·b
        yield pd.DataFrame({"vals": [acc.ravel().tolist()]})

    parts = narrow.mapInPandas(moments, "vals array<double>")
    total = parts.rdd.map(lambda r: np.array(r.vals)).treeAggregate(
        np.zeros(4 * p * p), lambda a, b: a + b, lambda a, b: a + b)  # one array per partition, merged in a tree
    n, sa, saa, sab = total.reshape(4, p, p)
    sb, sbb = sa.T, saa.T
    with np.errstate(invalid="ignore", divide="ignore"):
        cov = n * sab - sa * sb
        va, vb = n * saa - sa * sa, n * sbb - sb * sb
        flat = (va <= 1e-12 * n * saa) | (vb <= 1e-12 * n * sbb)  # constant up to rounding
        corr = np.where(flat, np.nan, cov / np.sqrt(va * vb))
    rows = [(a, b, None if not np.isfinite(corr[i, j]) else float(corr[i, j]))
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def correlated_columns(df: DataFrame, cols: Sequence[str] | None = None, t: float = 0.9) -> DataFrame:
    """Pairs with |corr| > t, reported by the later column (the diagonal is excluded)."""
    cols = list(cols or columns_of_kind(df, "number"))
    pos = {c: i for i, c in enumerate(cols)}
    cm = correlation_matrix(df, cols)
    order = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(pos[c]))])
    return (cm.where((order[F.col("col_a")] < order[F.col("col_b")]) & (F.abs("corr") > t))
            .select(F.col("col_b").alias("column"), F.col("col_a").alias("correlated_with"), "corr"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """A10: equal-width histogram between min and max, last bin closed; empty bins included.
    ``(bin, lower, upper, count)``."""
    return histograms(df, [col], bins).drop("column")


def histograms(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """A10 for many columns at once: ``(column, bin, lower, upper, count)``.

    One aggregate for every column's range, then one scan in which each row emits its
    (column, bin) pairs, counted with a map-side-combined aggregate; the empty bins come from a
    bins × columns edge table.
    """
    spark = df.sparkSession
    cols = list(cols)
    rng = fused_single_row(df, {**{f"lo{i}": F.min(qcol(c).cast("double")) for i, c in enumerate(cols)},
                                **{f"hi{i}": F.max(qcol(c).cast("double")) for i, c in enumerate(cols)}})
    structs, edges = [], []
    for i, c in enumerate(cols):
        lo, hi = rng[f"lo{i}"], rng[f"hi{i}"]
        if lo is None:
            continue
        width = hi - lo
        v = qcol(c).cast("double")
        idx = F.lit(0) if width == 0 else F.least(F.floor((v - F.lit(lo)) / F.lit(width) * bins), F.lit(bins - 1))
        structs.append(F.struct(F.lit(c).alias("column"), F.when(v.isNotNull(), idx.cast("int")).alias("bin")))
        edges += [(c, b, lo + width * b / bins, lo + width * (b + 1) / bins) for b in range(bins)]
    schema = "column string, bin int, lower double, upper double, count bigint"
    if not structs:
        return spark.createDataFrame([], schema)
    pairs = (df.select(F.explode(F.filter(F.array(*structs), lambda s_: s_["bin"].isNotNull())).alias("s"))
             .select("s.column", "s.bin"))
    counted = pairs.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = spark.createDataFrame(edges, "column string, bin int, lower double, upper double")  # columns x bins
    return (grid.join(counted, ["column", "bin"], "left")
            .select("column", "bin", "lower", "upper", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def box_stats(df: DataFrame, cols: Sequence[str] | None = None, whis: float = 1.5) -> DataFrame:
    """Box-plot numbers per numeric column: quartiles, whiskers at ``whis`` IQR, outlier count."""
    cols = list(cols or columns_of_kind(df, "number"))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(*[F.first(F.when(F.col("q") == p, F.col("value")), ignorenulls=True).alias(n)
                                   for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    fences = qw.select("column", (F.col("q1") - whis * F.col("iqr")).alias("_lo"),
                       (F.col("q3") + whis * F.col("iqr")).alias("_hi"))
    long = unpivot_values(df, cols).join(F.broadcast(fences), "column")  # fences: one row per column
    inside = (F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi"))
    ends = long.groupBy("column").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"))
    return qw.join(ends, "column").select("column", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high",
                                          "n_outliers")


def hit_rate(y: str, p: str) -> Column:
    """Share of the labelled rows whose prediction equals the label; a missing prediction is a miss."""
    return F.avg(F.when(qcol(y).isNotNull(), qcol(y).eqNullSafe(qcol(p)).cast("double")))


def group_accuracy(df: DataFrame, group: str, y: str, p: str) -> DataFrame:
    """Accuracy per sensitive group ``(group, n, accuracy)``."""
    return df.groupBy(qcol(group)).agg(F.count(F.lit(1)).alias("n"), hit_rate(y, p).alias("accuracy"))


# ---------------------------------------------------------------------------- data quality


def validate_table(df: DataFrame, expected: Sequence[str], raise_error: bool = False) -> DataFrame:
    """Q1: ``(check, passed, detail)`` for non-empty, expected columns present, no missing values."""
    spark = df.sparkSession
    absent = [c for c in expected if c not in df.columns]
    stats = fused_single_row(df, {"n": F.count(F.lit(1)),
                                  **{f"m{i}": F.count_if(qcol(c).isNull()) for i, c in enumerate(df.columns)}})
    n = stats["n"]
    with_nulls = [c for i, c in enumerate(df.columns) if stats[f"m{i}"]]
    rows = [("non_empty", n > 0 and len(df.columns) > 0, f"rows={n} columns={len(df.columns)}"),
            ("columns_present", not absent, "missing: " + ",".join(absent) if absent else ""),
            ("no_missing_values", not with_nulls, "with missing: " + ",".join(with_nulls) if with_nulls else "")]
    if raise_error:
        for check, ok, detail in rows:
            if not ok:
                raise ValueError(f"{check} failed: {detail}")
    return spark.createDataFrame(rows, "check string, passed boolean, detail string")


def column_statistics(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Q2: per column — count, missing, zeros, distinct, mean, std, min, median, max, most frequent
    value (as text, smallest on ties) and average text length.

    Two scans: one fused aggregate, and one count of every (column, value) from which the distinct
    count, the median and the most frequent value all follow. ``approx=True`` estimates the distinct counts with
    HyperLogLog; :mod:`cohort_spark.operators.profile` keeps sketches of daily batches and merges them."""
    cols = list(cols or df.columns)
    num = set(columns_of_kind(df, "number"))
    stats = {}
    for c in cols:
        col = qcol(c)
        isnum = c in num
        stats[c] = {
            "count": F.count(qcol(col)), "missing": F.count_if(col.isNull()),
            "zeros": F.count_if(col == 0) if isnum else F.lit(None),
            **({"distinct": F.approx_count_distinct(col)} if approx else {}),
            "mean": F.avg(qcol(col)) if isnum else F.lit(None),
            "std": F.stddev_samp(qcol(col)) if isnum else F.lit(None),
            "min": F.min(col.cast("double")) if isnum else F.lit(None),
            "max": F.max(col.cast("double")) if isnum else F.lit(None),
            "avg_length": F.avg(F.length(col.cast("string"))) if not isnum else F.lit(None),
        }
    types = {"count": "bigint", "missing": "bigint", "zeros": "bigint", **({"distinct": "bigint"} if approx else {}), "mean": "double",
             "std": "double", "min": "double", "max": "double", "avg_length": "double"}
    basic = _long_from_row(df, stats, types)
    number = F.when(F.col("column").isin([c for c in cols if c in num]), F.col("value").cast("double"))
    counts = value_counts_long(df, cols, "string").withColumn("number", number)
    ranged = reliable(counts.repartitionByRange(F.col("column"), F.col("number"), F.col("value")).withColumn("_pid", F.spark_partition_id()))
    med = quantiles_of_ranged(ranged.where("number is not null").select("_pid", "column", F.col("number").alias("value"), "n"), [0.5]).select("column", F.col("value").alias("median"))
    best = ranged.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("b"), F.count(F.lit(1)).alias("distinct"))
    found = best.select("column", F.col("b.value").alias("top"), *([] if approx else ["distinct"]))
    out = basic.join(F.broadcast(found.join(med, "column", "left")), "column", "left")  # one row per column
    if not approx:
        out = out.withColumn("distinct", F.coalesce("distinct", F.lit(0)))
    return out.select("column", "count", "missing", "zeros", "distinct", "mean", "std", "min", "median", "max", "top", "avg_length")


def infer_schema_constraints(df: DataFrame, max_domain: int = 20) -> DataFrame:
    """Q3: ``(column, dtype, required, domain)`` — type, whether a value is always present, and the
    set of values of a text column with at most ``max_domain`` distinct values.

    Distinct counts come first, so ``collect_set`` only runs on columns already
    known to have a bounded domain.
    """
    spark = df.sparkSession
    strings = columns_of_kind(df, "string")
    nd = small_distinct_counts(df, strings, max_domain) if strings else {}
    small = [c for c in strings if nd.get(c, max_domain + 1) <= max_domain]
    nulls = fused_single_row(df, {f"m{i}": F.count_if(qcol(c).isNull()) for i, c in enumerate(df.columns)})
    meta = spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), nulls[f"m{i}"] == 0) for i, f in enumerate(df.schema.fields)],
        "column string, dtype string, required boolean")
    if small:
        dom = _long_from_row(df, {c: {"domain": F.array_sort(F.collect_set(qcol(c)))} for c in small},
                             {"domain": "array<string>"})
        return meta.join(dom, "column", "left")
    return meta.withColumn("domain", F.lit(None).cast("array<string>"))


def profile_report(df: DataFrame, hist_bins: int = 10) -> dict[str, DataFrame]:
    """Q4: overview, variables, correlations, missing values and duplicates as result tables."""
    num = columns_of_kind(df, "number")
    n_cols = len(df.columns)
    nulls = sum(F.count_if(qcol(c).isNull()) for c in df.columns) if df.columns else F.lit(0)
    whole = F.struct(*[qcol(c) for c in df.columns])
    over = (df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.cast("bigint").alias("n_missing_cells"),
                   (F.count(F.lit(1)) - F.count_distinct(whole)).alias("n_duplicates"))
            .select("n_rows", F.lit(n_cols).cast("bigint").alias("n_columns"), "n_missing_cells",
                    F.try_divide("n_missing_cells", F.col("n_rows") * F.lit(n_cols)).alias("missing_cell_share"),
                    "n_duplicates"))
    out = {"overview": over, "variables": column_statistics(df), "missing": missing_counts(df)}
    if num:
        out["correlations"] = correlation_matrix(df, num)
        out["histograms"] = histograms(df, num, hist_bins)
    return out

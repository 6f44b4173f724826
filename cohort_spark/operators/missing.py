"""Missing values (M1-M7).

Decisions that depend on data (which columns to drop, classify or fill) are
taken from one fused aggregate of per-column numbers; the filling itself is a
single projection of ``coalesce`` expressions, so the table is scanned once for
the statistics and once for the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.functions.names import qcol
from cohort_spark.operators.columns import columns_of_kind, drop_strict
from cohort_spark.operators.neighbours import MAX_CELLS, nearest_means
from cohort_spark.operators.ordered import exact_quantiles, fused_single_row, modes, reliable, value_counts_long
from cohort_spark.operators.stats import missing_ratio_map, small_distinct_counts

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INT_FLOAT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _INT_FLOAT)]


def medians_of(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians (linear interpolation) of numeric columns, distributed; O(columns) result."""
    if not cols:
        return {}
    rows = exact_quantiles(df, cols, [0.5]).collect()
    return {r["column"]: r["value"] for r in rows}


def modes_of(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column (smallest on ties), typed like the column."""
    out: dict[str, object] = {}
    by_type: dict[str, list[str]] = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:  # integers are counted as such: doubles would merge neighbours above 2**53
        kind = "bigint" if isinstance(types[c], _INTEGERS) else "double" if isinstance(types[c], _INT_FLOAT) else "string"
        by_type.setdefault(kind, []).append(c)
    for kind, names in by_type.items():
        out.update({r["column"]: r["mode"] for r in modes(value_counts_long(df, names, kind)).collect()})
    return out


def _fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.select(*[F.coalesce(qcol(c), F.lit(values[c])).alias(c) if values.get(c) is not None else qcol(c)
                       for c in df.columns])


def drop_sparse_columns(df: DataFrame, t: float = 0.5, cols: Sequence[str] | None = None) -> DataFrame:
    """M1: drop columns whose share of missing values is greater than ``t``."""
    ratios = missing_ratio_map(df, cols or df.columns)
    return df.drop(*[c for c, r in ratios.items() if r > t])


def classify_columns(df: DataFrame, t: int = 9, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """M2: (categorical, numeric): categorical = fewer than ``t`` distinct values (any type);
    numeric = the remaining integer or floating columns."""
    cols = [c for c in df.columns if c not in set(exclude)]
    nd = small_distinct_counts(df, cols, t)  # only "fewer than t?" matters
    cat = [c for c in cols if nd[c] < t]
    num = [c for c in _numeric(df) if c in set(cols) and c not in set(cat)]
    return cat, num


def classify_columns_table(df: DataFrame, t: int = 9) -> DataFrame:
    """M2 as a table ``(column, kind)`` with kind categorical / numeric / other."""
    cat, num = classify_columns(df, t)
    rows = [(c, "categorical" if c in cat else "numeric" if c in num else "other") for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column string, kind string")


def impute_low_missing(df: DataFrame, categorical: Sequence[str], numerical: Sequence[str],
                       t: float = 0.05) -> DataFrame:
    """M3: columns with a missing share below ``t``: numeric -> median, categorical -> smallest mode."""
    ratios = missing_ratio_map(df, list(dict.fromkeys([*categorical, *numerical])))
    num = [c for c in numerical if ratios[c] < t and ratios[c] > 0]
    cat = [c for c in categorical if ratios[c] < t and ratios[c] > 0]
    fills: dict[str, object] = {}
    fills.update(medians_of(df, num))
    fills.update(modes_of(df, [c for c in cat if c not in fills]))
    return _fill(df, fills)


def impute_mean_mode(df: DataFrame) -> DataFrame:
    """M4: numeric columns -> mean truncated toward zero, text columns -> smallest mode."""
    num = _numeric(df)
    txt = columns_of_kind(df, "string")
    stats = fused_single_row(df, {f"m{i}": F.avg(qcol(c)).cast("bigint") for i, c in enumerate(num)}) if num else {}
    fills: dict[str, object] = {c: stats[f"m{i}"] for i, c in enumerate(num)}
    fills.update(modes_of(df, txt))
    return _fill(df, fills)


def _fill_rules(strategy, types: dict, constant_value) -> dict[str, str | Callable[[Column], Column]]:
    """The strategy per column, checked before any job runs: ``median``, ``constant`` or a function of the column."""
    if not isinstance(strategy, dict):
        raise ValueError(f"a strategy maps columns to rules; got {type(strategy).__name__}")
    known = {"median": True, "constant": constant_value is not None}
    wrong = {c: r for c, r in strategy.items() if not callable(r) and not known.get(r if isinstance(r, str) else None, False)}
    if wrong:
        raise ValueError(f"no such rule (median, constant with a value, or a function): {wrong}")
    return {c: r for c, r in strategy.items() if c in types}


def handle_missing_values(df, identify_only: bool = False, drop_threshold: float | None = None,
                          strategy: dict[str, str | Callable[[Column], Column]] | None = None,
                          constant_value=None):
    """M5: count, drop and fill missing values.

    ``identify_only`` returns ``{column: n_missing}``. Otherwise columns without any value go, with
    ``drop_threshold`` also those whose missing share is greater; the others are filled by one
    projection: by ``strategy`` (``'median'``, ``'constant'`` with ``constant_value``, or a function
    ``Column -> Column`` per column; other columns stay), or, without one, numeric columns with
    their mean and the rest with their smallest mode.
    """
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a Spark DataFrame, got {type(df).__name__}")
    types = dict(df.dtypes)
    rules = None if strategy is None or identify_only else _fill_rules(strategy, types, constant_value)
    present = fused_single_row(df, {"rows": F.count(F.lit(1)), **{f"c{i}": F.count(qcol(c)) for i, c in enumerate(df.columns)}})
    missing = {c: present["rows"] - present[f"c{i}"] for i, c in enumerate(df.columns)}
    if identify_only:
        return missing
    most = present["rows"] if drop_threshold is None else min(present["rows"] - 1, drop_threshold * present["rows"])
    kept = [c for c in df.columns if missing[c] < present["rows"] and missing[c] <= most or not present["rows"] and drop_threshold is not None]
    out = df.select(*[qcol(c) for c in kept])
    if rules is None:
        num = [c for c in _numeric(out)]
        means = fused_single_row(out, {c: F.avg(qcol(c)) for c in num}) if num else {}
        return _fill(out, {**means, **modes_of(out, [c for c in kept if c not in set(num)])})
    values = dict.fromkeys((c for c, r in rules.items() if r == "constant"), constant_value)
    values.update(medians_of(out, [c for c, r in rules.items() if r == "median" and c in set(kept)]))
    return _fill(out, values).select(*[rules[c](qcol(c)).alias(c) if callable(rules.get(c)) else qcol(c) for c in kept])


def _present(c: str) -> Column:
    """The column as a double; NaN is missing too."""
    v = qcol(c).cast("double")
    return F.when(~F.isnan(v), v)


def knn_donors(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, float]]:
    """What :func:`knn_impute` needs of the rows it was fitted on: their distinct value patterns with counts
    (columns ``_d0``, ``_d1``, … and ``_cnt``) and the column means."""
    means = fused_single_row(df, {f"m{i}": F.avg(_present(c)) for i, c in enumerate(cols)})
    patterns = df.groupBy(*[_present(c).alias(f"_d{i}") for i, c in enumerate(cols)]).agg(F.count(F.lit(1)).alias("_cnt"))
    return patterns, {c: means[f"m{i}"] for i, c in enumerate(cols)}


def knn_impute(df: DataFrame, cols: Sequence[str], k: int = 5, max_cells: int = MAX_CELLS,
               donors: DataFrame | None = None, means: dict[str, float] | None = None) -> DataFrame:
    """M6: fill missing values (NULL or NaN) of ``cols`` with the mean of the ``k`` nearest rows that have the value.

    Distance is the NaN-aware Euclidean distance over ``cols``: squared
    differences over the coordinates present in both rows, scaled by
    (number of coordinates / number present). Each column is imputed from the
    original values (not from other imputed columns). A row with no comparable
    donor gets the column mean. Donors are the rows of ``df`` itself, or those that
    ``donors`` and ``means`` (from :func:`knn_donors`) keep of the rows of a fit. Equal distances are ordered by more shared
    coordinates first, then by the donor's values (smallest first, missing ones last), so the
    result does not depend on row order.

    Scale: rows are first reduced to distinct value patterns with counts; the patterns with gaps, all
    their missing columns at once, look up their donors in the lists of
    :mod:`cohort_spark.operators.neighbours`, whatever the number of presence masks.
    """
    cols = list(cols)
    d = len(cols)
    if means is None or donors is None:
        patterns, own = knn_donors(df, cols)
        donors, means = (patterns if donors is None else donors), means or own
    names = [f"d{i}" for i in range(d)]
    missing = fused_single_row(df, {f"n{i}": F.count_if(_present(c).isNull()) for i, c in enumerate(cols)})
    targets = [i for i in range(d) if missing[f"n{i}"]]
    out = df
    if targets:
        given = reliable(donors.select(*[F.col(f"_d{i}").cast("double").alias(n) for i, n in enumerate(names)], F.col("_cnt").cast("long").alias("cnt")))
        gaps = F.lit(False)
        for i in targets:
            gaps = gaps | _present(cols[i]).isNull()
        asking = reliable(df.where(gaps).select(*[_present(c).alias(n) for c, n in zip(cols, names)]).distinct()
                          .withColumn("rid", F.monotonically_increasing_id()))
        found = nearest_means(asking, given, d, k, targets, max_cells)
        x = df
        if found is not None:
            wide = asking.join(found, "rid").groupBy(F.struct(*names).alias("_r")).agg(*[F.max(F.when(F.col("target") == i, F.col("imp"))).alias(f"_imp{i}") for i in targets])
            x = df.withColumn("_pat", F.struct(*[_present(c).alias(n) for c, n in zip(cols, names)])).join(wide, F.col("_pat").eqNullSafe(F.col("_r")), "left")
        fill = {cols[i]: F.coalesce(*([F.col(f"_imp{i}")] if found is not None else []), F.lit(means[cols[i]]).cast("double")) for i in targets}
        out = x.select(*[F.coalesce(_present(c), fill[c]).alias(c) if c in fill else qcol(c) for c in df.columns])
    return out


def drop_id_columns(df: DataFrame, cols: Sequence[str], numerical: Sequence[str] | None = None):
    """M7: drop id and date columns before encoding; also remove them from the numeric list."""
    out = drop_strict(df, cols)
    if numerical is None:
        return out
    return out, [c for c in numerical if c not in set(cols)]

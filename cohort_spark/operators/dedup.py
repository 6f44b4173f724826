"""De-duplication, ordering and top-k.

"First row per key" is computed as a grouped ``min`` over a struct whose fields
are the sort keys followed by the remaining columns, not as a window: the
aggregate combines map-side, so a key holding a third of all rows is reduced in
every task before the shuffle instead of landing whole in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.functions.names import qcol
from cohort_spark.operators.ordered import global_rank


def _order_fields(order: Sequence[str]) -> list[Column]:
    """Struct fields whose comparison gives ascending order with NULLs last; ``max`` of the
    same struct gives the last row in that order."""
    fields = []
    for i, c in enumerate(order):
        fields.append(qcol(c).isNull().alias(f"_n{i}"))
        fields.append(qcol(c).alias(f"_o{i}"))
    return fields


def first_row_struct(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[Column, dict[str, str]]:
    """Struct whose ``min`` is the first row in ``order`` (NULLs last) and whose ``max`` is the
    last, and the field holding each non-key column. Each order column is carried once (after
    its NULL flag), followed by the columns not in ``order``."""
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in set(order)]
    st = F.struct(*_order_fields(order), *[qcol(c).alias(f"_r{i}") for i, c in enumerate(rest)])
    fields = {c: f"_o{i}" for i, c in enumerate(order)}
    fields.update({c: f"_r{i}" for i, c in enumerate(rest)})
    return st, fields


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """One row per key: the smallest (or largest) in ``order``, NULLs last."""
    st, fields = first_row_struct(df, keys, order)
    agg = F.max if last else F.min
    grouped = df.groupBy(*[qcol(k) for k in keys]).agg(agg(st).alias("_best"))
    return grouped.select(*[qcol(c) if c in keys else F.col("_best").getField(fields[c]).alias(c) for c in df.columns])


def earliest_per_key(df: DataFrame, key: str | Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest ``ts`` per key (missing dates last), ties broken by ``tie``
    and then by the remaining columns, so the choice is deterministic."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != ts and c not in tie]
    return _first_by(df, keys, [ts, *tie, *rest])


def update_earliest(day_rows: DataFrame, path: str, day: str, key: str | Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """D1 kept up daily: the first row per key of all days up to ``day``, from the state stored for the latest day before
    and the new day's rows alone. The state of each day is a partition of ``path``; running a day again replaces its own,
    so it leaves the same tables (states of later days must then be run again too)."""
    spark = day_rows.sparkSession
    whole = day_rows
    try:
        stored = spark.read.schema(_with_day(day_rows)).parquet(path)
        before = stored.where(F.col("_day") < day).agg(F.max("_day")).collect()[0][0]
    except AnalysisException as e:  # the first day: there is no state yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        before = None
    if before is not None:
        whole = stored.where(F.col("_day") == before).select(*[qcol(c) for c in day_rows.columns]).unionByName(day_rows)
    state = earliest_per_key(whole, key, ts, tie).withColumn("_day", F.lit(day))
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day").parquet(path)
    return spark.read.schema(_with_day(day_rows)).parquet(path).where(F.col("_day") == day).drop("_day")


def _with_day(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("_day", T.StringType())])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct."""
    return df.dropDuplicates()


def handle_duplicates(df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first",
                      order: Sequence[str] | None = None, reindex: bool = False,
                      index_col: str = "index") -> DataFrame:
    """D3: keep the first / last / no row of each duplicate group of ``subset``.

    Spark rows have no positional order, so "first" means smallest in ``order``
    (default: all columns). ``keep=False`` drops every row of a repeated group.
    ``reindex`` adds a 0-based ``index_col`` in ``order`` (exact, distributed ranks).
    """
    if subset is not None and not isinstance(subset, (list, tuple)):
        raise TypeError("subset must be a list of column names")
    subset = list(subset) if subset else list(df.columns)
    order = list(order) if order else [c for c in df.columns]
    if keep is False:
        if set(subset) == set(df.columns):
            counted = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"))
            out = counted.where("_n = 1").select(*[qcol(c) for c in df.columns])
        else:
            rest = [c for c in df.columns if c not in subset]
            counted = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"),
                                              F.min(F.struct(*[qcol(c) for c in rest])).alias("_row"))
            out = counted.where("_n = 1").select(*[qcol(c) for c in subset], *[F.col("_row").getField(c).alias(c) for c in rest]).select(*[qcol(c) for c in df.columns])
    elif keep in ("first", "last"):
        if set(subset) == set(df.columns):
            out = df.dropDuplicates()
        else:
            out = _first_by(df, subset, order, last=(keep == "last"))
    else:
        raise ValueError("keep must be 'first', 'last' or False")
    if reindex:
        ranked = global_rank(out, [*[qcol(c).asc_nulls_last() for c in order]], rank_col="_rank")
        out = ranked.withColumn(index_col, F.col("_rank") - 1).drop("_rank")
    return out


def analyze_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Every row whose ``subset`` values occur more than once (NULLs equal, as in pandas).

    Implemented as a semi join against the repeated keys; AQE splits a skewed key.
    """
    subset = list(subset) if subset else list(df.columns)
    dup_keys = df.groupBy(*[qcol(c) for c in subset]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    cond = None
    for c in subset:
        e = df[c].eqNullSafe(dup_keys[c])
        cond = e if cond is None else cond & e
    return df.join(dup_keys, cond, "left_semi")


def count_duplicates(df: DataFrame) -> DataFrame:
    """Number of rows beyond the first of each whole-row group (one row)."""
    whole = F.struct(*[qcol(c) for c in df.columns])
    return df.agg((F.count(F.lit(1)) - F.count_distinct(whole)).alias("n_duplicates"))


def sort_rows(df: DataFrame, keys: Sequence[str], ascending: bool = True) -> DataFrame:
    """Multi-key sort with missing values last (Spark's default puts them first)."""
    cols = [qcol(k).asc_nulls_last() if ascending else qcol(k).desc_nulls_last() for k in keys]
    return df.orderBy(*cols)


def top_k(df: DataFrame, col: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` largest values of ``col`` (a top-k report: the limit is the feature)."""
    return df.orderBy(qcol(col).desc_nulls_last(), *[qcol(t) for t in tie]).limit(k)

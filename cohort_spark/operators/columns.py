"""Projections, filters and table information."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.functions.names import qcol


def drop_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop named columns; an absent name is an error (Spark's ``drop`` would ignore it)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def rename_key(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename the participant key (e.g. ``PATNO`` -> ``Participant_ID``)."""
    if old not in df.columns:
        raise KeyError(old)
    return df.withColumnRenamed(old, new)


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Names of numeric (``'number'``), string (``'string'``) or date-time (``'datetime'``) columns."""
    want = {"number": (T.NumericType,), "string": (T.StringType,),
            "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType), "bool": (T.BooleanType,)}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, want)]


def select_by_type(df: DataFrame, kind: str = "number") -> DataFrame:
    """Keep only numeric or only string columns."""
    return df.select(*[qcol(c) for c in columns_of_kind(df, kind)])


def filter_isin(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is in ``values`` (NULL never is)."""
    return df.where(qcol(col).isin(list(values)))


def filter_eq(df: DataFrame, col: str, v) -> DataFrame:
    """P5: rows equal to ``v``."""
    return df.where(qcol(col) == F.lit(v))


def filter_ne_keep_null(df: DataFrame, col: str, v) -> DataFrame:
    """Rows not equal to ``v``; a missing value passes (pandas ``!=``)."""
    return df.where(~qcol(col).eqNullSafe(F.lit(v)))


def split_target(df: DataFrame, label: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(features, label). The row key, when given, stays on both sides."""
    keep = [key] if key else []
    x = df.select(*[qcol(c) for c in df.columns if c != label])
    y = df.select(*[qcol(c) for c in [*keep, label]])
    return x, y


def attach_target(df: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Re-attach the label on the row key (never by position)."""
    return df.join(labels.select(qcol(key), qcol(label)), on=key, how="inner")


def unique_names(names: Sequence[str]) -> tuple[list[str], list[int]]:
    """Positions of the first occurrence of each name, in order."""
    seen, keep = set(), []
    for i, n in enumerate(names):
        if n not in seen:
            seen.add(n)
            keep.append(i)
    return [names[i] for i in keep], keep


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first of equally named columns."""
    names = df.columns
    kept, positions = unique_names(names)
    tmp = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return tmp.select(*[F.col(f"_c{i}").alias(n) for i, n in zip(positions, kept)])


def first_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """P10: the first ``n`` rows in ``order`` (a top-n report: the limit is the feature)."""
    return df.orderBy(*order).limit(n)


def table_info(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, non_null, n_rows)`` from one aggregate over the table."""
    spark = df.sparkSession
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(qcol(c)).alias(f"_nn{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    meta = spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
                                 "position int, column string, dtype string")
    stacked = one.select(F.col("_n").alias("n_rows"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.col(f"_nn{i}").alias("non_null")) for i in range(len(df.columns))
    ])).alias("s")).select("n_rows", "s.position", "s.non_null")
    return meta.join(F.broadcast(stacked), "position").select("position", "column", "dtype", "non_null", "n_rows")

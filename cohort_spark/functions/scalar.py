"""Scalar functions (F1-F10, P12), all built from ``pyspark.sql.functions``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol

# Java date patterns for the Python formats the workflows use.
PY_TO_SPARK_FORMAT = {"%m/%Y": "MM/yyyy", "%Y-%m-%d": "yyyy-MM-dd", "%Y-%m-%d %H:%M:%S": "yyyy-MM-dd HH:mm:ss"}
# Formats tried, in order, when a date column's format is not given.
INFERRED_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "MM/yyyy", "yyyy/MM/dd")


def _col(c: str | Column) -> Column:
    return qcol(c) if isinstance(c, str) else c


def parse_date(c: str | Column, fmt: str | None = "MM/yyyy", coerce: bool = True) -> Column:
    """string -> timestamp. ``coerce``: bad values become NULL; else the query fails on them.

    ``fmt`` may be a Python (``%m/%Y``) or Java (``MM/yyyy``) pattern; ``None`` tries common formats.
    """
    col = _col(c).cast("string")

    def parse(f):  # wall-clock result, independent of the session time zone
        return F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz")

    if fmt is None:
        return F.coalesce(*[parse(f) for f in INFERRED_FORMATS])
    fmt = PY_TO_SPARK_FORMAT.get(fmt, fmt)
    if coerce:
        return parse(fmt)
    parsed = parse(fmt)
    return F.when(col.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit(f"value does not match {fmt}: "), col)).cast("timestamp_ntz"))


def parse_date_columns(df: DataFrame, fmt: str | None = None) -> DataFrame:
    """parse every column whose name contains "date" (any case), bad values -> NULL."""
    return df.select(*[
        parse_date(f.name, fmt).alias(f.name) if "date" in f.name.lower() and f.dataType.simpleString() == "string"
        else qcol(f.name) for f in df.schema.fields])


def cut_labels(c: str | Column, edges: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """label bins between consecutive ``edges``; outside (or NULL) -> NULL.

    ``right=False``: [a, b) bins, as the resampling and bias scripts use.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    col = _col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (col >= lo) & (col < hi) if not right else (col > lo) & (col <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def cut_equal_width(df: DataFrame, c: str, n: int, out: str, label: str = "Bin {i}") -> DataFrame:
    """``n`` equal-width right-open bins between min and max of ``c``.

    As with right-open bins over [min, max], the maximum itself falls outside and
    gets the string ``'nan'`` (faithful to the workflow's bias report).
    One aggregate (two numbers) feeds the bin expression.
    """
    mm = df.agg(F.min(qcol(c)).alias("lo"), F.max(qcol(c)).alias("hi")).collect()[0]
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.withColumn(out, F.lit("nan"))
    edges = [lo + (hi - lo) * i / n for i in range(n + 1)]
    labels = [label.format(i=i + 1) for i in range(n)]
    return df.withColumn(out, F.coalesce(cut_labels(c, edges, labels), F.lit("nan")))


def fill_value(c: str | Column, v) -> Column:
    """replace NULL by a constant."""
    return F.coalesce(_col(c), F.lit(v))


def truncate_mean(c: str | Column) -> Column:
    """aggregate — mean truncated toward zero (``int(mean)``)."""
    return F.avg(_col(c)).cast("bigint")


def mask_replace(c: str | Column, keep: Column, v) -> Column:
    """keep values where ``keep`` holds, otherwise ``v`` (a NULL condition counts as false)."""
    return F.when(keep, _col(c)).otherwise(v if isinstance(v, Column) else F.lit(v))


def binarize(c: str | Column, cls) -> Column:
    """F8: one-vs-rest indicator 1/0."""
    return (_col(c) == F.lit(cls)).cast("int")


# Family names and the name fragments that select them, tried in this order.
MODEL_FAMILIES = (
    (("XGB", "BOOST"), "xgboost"),
    (("RF", "FOREST"), "random_forest"),
    (("LR", "LOGISTIC"), "logistic_regression"),
    (("SVM",), "svm"),
)


def model_family(c: str | Column, strict: bool = True) -> Column:
    """model family from a model name by upper-case substring; unknown -> error (or NULL)."""
    up = F.upper(_col(c))
    expr = None
    for frags, fam in MODEL_FAMILIES:
        cond = None
        for fr in frags:
            cond = up.contains(fr) if cond is None else cond | up.contains(fr)
        expr = F.when(cond, F.lit(fam)) if expr is None else expr.when(cond, F.lit(fam))
    if strict:
        return expr.otherwise(F.raise_error(F.concat(F.lit("no model family is known for "),
                                                     _col(c))).cast("string"))
    return expr


def slice_label(c: str | Column, prefix: str = "AGE_") -> Column:
    """slice name such as ``AGE_Bin 1``."""
    return F.concat(F.lit(prefix), _col(c).cast("string"))


def model_path(c: str | Column, folder: str = "models", suffix: str = "") -> Column:
    """file name from a model name: lower case, spaces -> underscores."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), F.replace(F.lower(_col(c)), F.lit(" "), F.lit("_")), F.lit(suffix))


def parse_feature_record(df: DataFrame, c: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Split a text record such as ``"1.5, 2.3, 3.8"``, trim, cast to double, name by position."""
    parts = F.transform(F.split(qcol(c), sep), lambda x: F.trim(x).cast("double"))
    tmp = df.withColumn("_parts", parts)
    return tmp.select(*[x for x in df.columns if x != c],
                      *[F.get(F.col("_parts"), i).alias(n) for i, n in enumerate(names)])

"""Exact, repeatable sampling and splits.

Randomness comes from ``md5('<seed>:<key>')`` — the same in every engine and
independent of partitioning — and exact sizes come from the distributed global
rank (no global sort into one task, no ``limit`` over a huge n).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.functions.scalar import cut_labels
from cohort_spark.operators.joins import union_groups
from cohort_spark.operators.ordered import global_rank


def seeded_hash(key: str | Column, seed: int | str) -> Column:
    """Hex md5 of ``'<seed>:<key>'``."""
    k = qcol(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def _ranked(df: DataFrame, key: str, seed) -> DataFrame:
    return global_rank(df, [seeded_hash(key, seed), qcol(key)], "_r")


def _within_first(df: DataFrame, key: str, seed, ks: Sequence[int]) -> list[Column]:
    """For each k: true for the first ``k`` rows in hash order (exact; keys unique and not NULL).

    The k-th (hash, key) pairs are found by one :func:`kth_in_order` call on the
    two-column projection; the tests themselves are comparisons, so the table is
    neither joined nor materialised.
    """
    from cohort_spark.operators.ordered import kth_in_order

    want = [k for k in ks if k > 0]
    thr = kth_in_order(df, [seeded_hash(key, seed), qcol(key)], want, unique=True) if want else {}
    h, kv = seeded_hash(key, seed), qcol(key)
    out = []
    for k in ks:
        if k <= 0:
            out.append(F.lit(False))
        elif k not in thr:  # fewer than k rows: all of them
            out.append(F.lit(True))
        else:
            t = thr[k]
            out.append((h < F.lit(t[0])) | ((h == F.lit(t[0])) & (kv <= F.lit(t[1]))))
    return out


def _size_of(df: DataFrame, key: str) -> int:
    """Row count; raises if ``key`` is missing anywhere. That it is unique is seen where the keys are put in order."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count(qcol(key)).alias("k")).collect()[0]
    if r["n"] != r["k"]:
        raise ValueError(f"the key {key} must not be missing: {r['n']} rows, {r['k']} keys")
    return r["n"]


def _unique_size_of(df: DataFrame, key: str) -> int:
    """Row count; raises unless ``key`` is unique and never missing."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(qcol(key)).alias("k")).collect()[0]
    if r["n"] != r["k"]:
        raise ValueError(f"the key {key} must be unique and not missing: {r['n']} rows, {r['k']} different keys")
    return r["n"]


def split_column(df: DataFrame, key: str, test: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """Label each row ``train`` or ``test``; the test part has exactly ceil(n·test) rows."""
    n = _size_of(df, key)
    n_test = math.ceil(n * test)
    (is_test,) = _within_first(df, key, seed, [n_test])
    return df.withColumn(out, F.when(is_test, "test").otherwise("train"))


def train_test_split(df: DataFrame, key: str, test: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """R1 as two frames (train, test)."""
    s = split_column(df, key, test, seed, "_split")
    return s.where("_split = 'train'").drop("_split"), s.where("_split = 'test'").drop("_split")


def train_val_test_split(df: DataFrame, key: str, seed: int = 42, holdout: float = 0.3,
                         test_of_holdout: float = 0.5, out: str = "split") -> DataFrame:
    """R2: 70/15/15 in two cuts — holdout = ceil(0.3·n), test = ceil(0.5·holdout), val = the rest."""
    n = _size_of(df, key)
    n_hold = math.ceil(n * holdout)
    n_test = math.ceil(n_hold * test_of_holdout)
    is_test, is_hold = _within_first(df, key, seed, [n_test, n_hold])
    return df.withColumn(out, F.when(is_test, "test").when(is_hold, "val").otherwise("train"))


def undersample(df: DataFrame, col: str, v, n: int, key: str, seed: int = 1) -> DataFrame:
    """Exactly ``n`` rows of group ``v``, without replacement; a smaller group is an error."""
    g = df.where(qcol(col) == F.lit(v))
    size = _size_of(g, key)
    if n > size:
        raise ValueError(f"cannot take {n} rows without replacement from the {size} rows with {col} = {v}")
    (first_n,) = _within_first(g, key, seed, [n])
    return g.where(first_n)


def draw_index(j: Column, seed, m: int) -> Column:
    """1-based row index for draw ``j`` out of ``m`` rows: first 8 hex digits of md5('<seed>:<j>') mod m."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), j.cast("string"))), 1, 8), 16, 10).cast("long")
    return (h % F.lit(m)) + 1


def oversample(df: DataFrame, col: str, v, n: int, key: str, seed: int = 1) -> DataFrame:
    """``n`` draws with replacement from group ``v``.

    Draw j picks the row of rank ``draw_index(j)`` in the group's hash order; the
    draws are a distributed range joined to the ranked group on the rank.
    """
    g = df.where(qcol(col) == F.lit(v))
    m = _unique_size_of(g, key)
    if n <= 0:
        return df.limit(0)
    if m == 0:
        raise ValueError(f"cannot draw {n} rows: none has {col} = {v}")
    spark = df.sparkSession
    ranked = _ranked(g, key, seed)
    draws = spark.range(n).select(draw_index(F.col("id"), seed, m).alias("_r"))
    return draws.join(ranked, "_r").drop("_r")


# The age bins and their labels used by the resampling step.
AGE_EDGES = (0, 50, 60, 70, 80, 100)
AGE_LABELS = ("Under 50", "50-59", "60-69", "70-79", "80 and above")


def balance_groups(df: DataFrame, age: str, key: str, group_col: str = "Age_Group", reference: str = "70-79",
                   shrink: str = "60-69", extend: str = "80 and above", seed: int = 1,
                   edges: Sequence[float] = AGE_EDGES, labels: Sequence[str] = AGE_LABELS) -> DataFrame:
    """Bin ages; shrink the ``shrink`` group to the size of ``reference`` and add draws with
    replacement to ``extend`` until it reaches that size; other rows (missing bin too) stay."""
    binned = df.withColumn(group_col, cut_labels(age, edges, labels))
    sizes = dict(binned.groupBy(group_col).count().collect())  # one row per bin
    target = sizes.get(reference, 0)
    keep = binned.where(~F.col(group_col).eqNullSafe(F.lit(shrink)))
    under = undersample(binned, group_col, shrink, target, key, seed)
    extra = oversample(binned, group_col, extend, target - sizes.get(extend, 0), key, seed)
    return union_groups([keep, under, extra])

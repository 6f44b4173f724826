"""Key joins and set operations.

All joins are equi-joins on the participant key; the physical strategy is left
to Catalyst and AQE (broadcast only when the runtime size is small, skewed
partitions split by AQE's skew-join rule). NULL keys follow SQL semantics
(never match) unless ``null_safe=True`` asks for the pandas behaviour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol


def _cond(l: DataFrame, r: DataFrame, lk: str, rk: str, null_safe: bool):
    return l[lk].eqNullSafe(r[rk]) if null_safe else l[lk] == r[rk]


def join_inner_suffix(l: DataFrame, r: DataFrame, lk: str, rk: str,
                      suffixes: tuple[str, str] = ("", "_drop"), null_safe: bool = False) -> DataFrame:
    """Inner join on differently named keys; both keys kept, overlapping names suffixed."""
    overlap = set(l.columns) & set(r.columns)
    ls, rs = suffixes
    lq = l.select(*[qcol(c).alias(c + ls if c in overlap else c) for c in l.columns])
    rq = r.select(*[qcol(c).alias(c + rs if c in overlap else c) for c in r.columns])
    lk2 = lk + ls if lk in overlap else lk
    rk2 = rk + rs if rk in overlap else rk
    return lq.join(rq, _cond(lq, rq, lk2, rk2, null_safe), "inner")


def join_left_dropkey(l: DataFrame, r: DataFrame, lk: str, rk: str, null_safe: bool = False) -> DataFrame:
    """Left join, then drop the right key."""
    clash = (set(l.columns) & set(r.columns)) - {rk}
    if clash:
        raise ValueError(f"overlapping columns need suffixes: {sorted(clash)}")
    rr = r.withColumnRenamed(rk, "_rk") if rk in l.columns else r
    rkey = "_rk" if rk in l.columns else rk
    return l.join(rr, _cond(l, rr, lk, rkey, null_safe), "left").drop(rkey)


def _fold_names(dfs: Sequence[DataFrame], key: str, suffix: str, skip: Sequence[str] = ()) -> list[tuple[int, str, str]]:
    """(input index, source column, output name): first copy bare, second ``suffix``, later copies dropped."""
    taken: set[str] = {key}
    plan = []
    for i, d in enumerate(dfs):
        for c in d.columns:
            if c == key or c in skip:
                continue
            name = c if c not in taken else c + suffix
            if name in taken:
                continue
            taken.add(name)
            plan.append((i, c, name))
    return plan


def outer_join_all(dfs: Sequence[DataFrame], key: str, suffix: str = "_dup", unique_keys: bool = False) -> DataFrame:
    """Fold of full outer joins on ``key`` with the key coalesced.

    Output names are fixed before joining: the first copy of a name stays bare,
    the second gets ``suffix``, further copies are dropped (the repeated-name
    removal after the fold keeps the first occurrence).

    ``unique_keys=True`` (each input has at most one row per key, e.g. after
    :func:`earliest_per_key`) replaces the chain of joins by one union and one
    grouped aggregate: all inputs are co-partitioned once instead of
    re-shuffling the growing result at every step. NULL keys never match.
    """
    plan = _fold_names(dfs, key, suffix)
    if unique_keys:
        slots = [f"_s{i}" for i in range(len(dfs))]
        structs = {i: F.struct(*[qcol(c).alias(n) for j, c, n in plan if j == i]) for i in range(len(dfs))}
        types = {i: dfs[i].select(structs[i].alias("x")).schema[0].dataType for i in range(len(dfs))}
        parts = []
        for i, d in enumerate(dfs):
            parts.append(d.select(qcol(key).alias(key), *[
                (structs[i] if j == i else F.lit(None).cast(types[j])).alias(slots[j]) for j in range(len(dfs))]))
        allp = parts[0]
        for p in parts[1:]:
            allp = allp.unionByName(p)
        merged = (allp.where(qcol(key).isNotNull()).groupBy(qcol(key).alias(key))
                  .agg(*[F.first(s_, ignorenulls=True).alias(s_) for s_ in slots])
                  .unionByName(allp.where(qcol(key).isNull())))
        return merged.select(qcol(key), *[F.col(slots[j]).getField(n).alias(n) for j, _, n in plan])
    pieces = []
    for i, d in enumerate(dfs):
        sel = [qcol(key).alias(f"_k{i}")] + [qcol(c).alias(n) for j, c, n in plan if j == i]
        pieces.append(d.select(*sel))
    acc = pieces[0].withColumnRenamed("_k0", key)
    for i, p in enumerate(pieces[1:], start=1):
        acc = (acc.join(p, acc[key] == p[f"_k{i}"], "full_outer")
               .withColumn(key, F.coalesce(qcol(key), F.col(f"_k{i}"))).drop(f"_k{i}"))
    return acc


def inner_join_all(dfs: Sequence[DataFrame], key: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Fold of inner joins on ``key``; overlapping names get ``_x`` / ``_y`` at each step."""
    acc = dfs[0]
    for d in dfs[1:]:
        overlap = (set(acc.columns) & set(d.columns)) - {key}
        lq = acc.select(*[qcol(c).alias(c + suffixes[0] if c in overlap else c) for c in acc.columns])
        rq = d.select(*[qcol(c).alias(c + suffixes[1] if c in overlap else c) for c in d.columns])
        acc = lq.join(rq, on=key, how="inner")
    return acc


def join_on_group_min(df: DataFrame, key: str, ts: str, where=None, min_name: str = "earliest_date") -> DataFrame:
    """Per-key minimum of ``ts`` (over rows matching ``where``) joined back to the
    whole table on (key, ts): ties and rows of other kinds on that date are kept."""
    src = df.where(where) if where is not None else df
    mins = src.groupBy(key).agg(F.min(qcol(ts)).alias(min_name))
    return df.join(mins, (df[key] == mins[key]) & (df[ts] == mins[min_name]), "inner").drop(mins[key])


def freq_outer_join(a: DataFrame, b: DataFrame, col: str, names: tuple[str, str] = ("share_a", "share_b"),
                    normalize: bool = True) -> DataFrame:
    """Align two frequency tables of ``col`` on the value; a value missing on one side gets 0."""
    from cohort_spark.operators.stats import value_counts

    fa = value_counts(a, col, normalize, sort=False).select(col, F.col("share" if normalize else "count").alias(names[0]))
    fb = value_counts(b, col, normalize, sort=False).select(col, F.col("share" if normalize else "count").alias(names[1]))
    return (fa.join(fb, on=col, how="full_outer")
            .select(col, F.coalesce(names[0], F.lit(0)).alias(names[0]), F.coalesce(names[1], F.lit(0)).alias(names[1])))


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack rows; the union of all columns, gaps NULL."""
    acc = dfs[0]
    for d in dfs[1:]:
        acc = acc.unionByName(d, allowMissingColumns=True)
    return acc


def union_groups(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack same-schema pieces (by name)."""
    acc = dfs[0]
    for d in dfs[1:]:
        acc = acc.unionByName(d)
    return acc


def same_columns(a: DataFrame, b: DataFrame, raise_error: bool = True) -> DataFrame:
    """Set equality of column names; one-row result, or an error when they differ."""
    sa, sb = set(a.columns), set(b.columns)
    if raise_error and sa != sb:
        raise ValueError(f"the tables differ in columns: only left {sorted(sa - sb)}, only right {sorted(sb - sa)}")
    spark = a.sparkSession
    return spark.createDataFrame([(sa == sb, sorted(sa - sb), sorted(sb - sa))],
                                 "same boolean, only_a array<string>, only_b array<string>")


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """U4: expected names absent from ``df``, in expected order."""
    have = set(df.columns)
    return [c for c in expected if c not in have]

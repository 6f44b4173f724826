"""Ordered helpers shared by the operators: exact global ranks, running sums,
exact quantiles and modes — all without a single global window task.

A global ``row_number() over (order by ...)`` or a running sum over the whole
table runs in one task. Here the table is range-partitioned on the order
columns instead; each partition computes local positions, and only one number
per partition (or per partition and group) travels to the driver to turn local
positions into global ones. The ranged table is checkpointed to the shared
checkpoint folder first, so that the per-partition totals and the rows always
agree even when executors are lost and work is recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.functions.names import qcol
from cohort_spark.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the in-partition row number in the low 33 bits


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [qcol(c) if isinstance(c, str) else c for c in cols]


def reliable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def global_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str = "_rank",
                partitions: int | None = None) -> DataFrame:
    """Add ``rank_col``: the 1-based position of each row in the total order ``order``.

    ``order`` must be a total order (end it with a unique key) for the rank to be
    deterministic. Cost: one range shuffle, one checkpoint, one small count job.
    """
    order_cols = _as_cols(order)
    n = _partitions(df, partitions)
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("long"), _LOCAL_BITS)))
    ranged = reliable(ranged)
    counts = dict(ranged.groupBy("_pid").count().collect())  # one row per partition
    offsets, acc = [], 0
    for pid in range(max(counts) + 1 if counts else 0):
        offsets.append(acc)
        acc += counts.get(pid, 0)
    if not offsets:
        return ranged.drop("_pid", "_local").withColumn(rank_col, F.lit(None).cast("long"))
    offset_of = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_pid") + 1)
    return ranged.withColumn(rank_col, offset_of + F.col("_local") + 1).drop("_pid", "_local")


def kth_in_order(df: DataFrame, order: Sequence[str | Column], ks: Sequence[int],
                 partitions: int | None = None, unique: bool = False) -> dict[int, tuple]:
    """Values of the order columns at 1-based positions ``ks`` of the total order ``order``.

    Only the order columns are range-partitioned and checkpointed; per-partition
    counts locate the partitions that hold the positions, and only those
    partitions are sorted, where they lie. Positions outside 1..n are omitted. With ``unique`` the partitions
    are sorted first, and a repeated row raises ``ValueError``.
    """
    cols = [c.alias(f"_k{i}") if isinstance(c, Column) else qcol(c).alias(f"_k{i}") for i, c in enumerate(order)]
    names = [f"_k{i}" for i in range(len(cols))]
    n = _partitions(df, partitions)
    ranged = df.select(*cols).repartitionByRange(n, *[F.col(c) for c in names])
    if unique:
        ranged = ranged.sortWithinPartitions(*names)
    ranged = reliable(ranged.withColumn("_pid", F.spark_partition_id()))
    if unique:
        parts = ranged.mapInArrow(_repeats(names), "_pid int, n long, repeats long").collect()  # one row per partition
        counts = {r["_pid"]: r["n"] for r in parts}
        if sum(r["repeats"] for r in parts):
            raise ValueError(f"{sum(r['repeats'] for r in parts)} rows repeat an earlier one")
    else:
        counts = dict(ranged.groupBy("_pid").count().collect())  # one row per partition
    spans, acc = [], 0
    for pid in sorted(counts):
        spans.append((acc, acc + counts[pid], pid))
        acc += counts[pid]
    where: dict[int, tuple[int, int]] = {}
    for k in ks:
        for lo, hi, pid in spans:
            if lo < k <= hi:
                where[k] = (pid, k - lo)
    if not where:
        return {}
    pids = sorted({p for p, _ in where.values()})
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)) + 1
    local = ranged.where(F.col("_pid").isin(pids))
    if not unique:
        local = local.sortWithinPartitions(*names)  # the filter keeps rows in their partitions
    hit = local.withColumn("_rn", at).where(F.struct("_pid", "_rn").isin([F.struct(F.lit(p), F.lit(r).cast("long")) for p, r in where.values()]))
    found = {(r["_pid"], r["_rn"]): tuple(r[c] for c in names) for r in hit.collect()}  # len(ks) rows
    return {k: found[pr] for k, pr in where.items()}


def _repeats(names: list[str]):
    """Per sorted partition: its rows, and how many equal the row before."""
    def run(batches):
        import pyarrow as pa

        pid, n, repeats, last = None, 0, 0, None
        for b in batches:
            if b.num_rows:
                cols = [b.column(c) for c in names]
                repeats += int((~_starts(cols, last)).sum())
                last, n, pid = _key(cols, b.num_rows - 1), n + b.num_rows, b.column("_pid")[0].as_py()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([n], pa.int64()), pa.array([repeats], pa.int64())], names=["_pid", "n", "repeats"])
    return run


def _key(cols: list, i: int) -> tuple:
    """The values of row ``i``; NaN equals itself."""
    values = [c[i].as_py() for c in cols]
    return tuple("NaN" if isinstance(v, float) and v != v else v for v in values)


def _starts(cols: list, last: tuple | None):
    """Whether each row differs from the one before in any of ``cols`` (the first: from ``last``)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(cols[0]) if cols else 0
    out = np.zeros(n, bool)
    for c in cols:
        x, y = c.slice(1), c.slice(0, max(n - 1, 0))
        differ = pc.fill_null(pc.not_equal(x, y), True).to_numpy(zero_copy_only=False)
        same = pc.and_(x.is_null(), y.is_null()).to_numpy(zero_copy_only=False)
        if pa.types.is_floating(c.type):
            same = same | pc.fill_null(pc.and_(pc.is_nan(x), pc.is_nan(y)), False).to_numpy(zero_copy_only=False)
        out[1:] |= differ & ~same
    out[:1] = last is None or _key(cols, 0) != last
    return out


def range_sorted(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """``df`` in the total order (groups, order), range-partitioned and checkpointed, with its partition number
    ``_pid``: the input of :func:`carried_sums`."""
    cols = [*[qcol(g) for g in groups], *_as_cols(order)]
    n = _partitions(df, partitions)
    return reliable(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).withColumn("_pid", F.spark_partition_id()))


def carried_sums(ranged: DataFrame, groups: Sequence[str], values: Sequence[str], prefix: str = "cum_", lead: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``values`` per group over :func:`range_sorted` rows, without another shuffle; for each
    ``lead`` column also ``next_<column>``, its value in the group's next row (NULL in the last).

    A scan with carried offsets: only the first group of a partition can have begun in an earlier one, so one
    small row per partition (its first and last group and their sums) gives every offset; these are broadcast into a
    second pass over the sorted partitions. Missing values count as 0.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    kinds = {f.name: f.dataType for f in ranged.schema.fields}
    whole = {v: isinstance(kinds[v], (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for v in values}
    type_of = {g: kinds[g].simpleString() for g in [*groups, *lead]}
    src = ranged.select("_pid", *[qcol(c) for c in ranged.columns if c != "_pid"],
                        *[qcol(v).cast("long" if whole[v] else "double").alias(f"_v{i}") for i, v in enumerate(values)])
    numbers = [f"_v{i}" for i in range(len(values))]

    def arrays(b):
        return [b.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in numbers]

    def sums(x, starts, carry):
        """Running sums that begin again at ``starts``; rows before the first start go on from ``carry``."""
        out, cuts = np.empty_like(x), np.flatnonzero(starts)
        for a, z in zip([0, *cuts], [*cuts, len(x)]):
            if a < z:
                out[a:z] = np.cumsum(x[a:z]) + (carry if a == 0 and not (len(starts) and starts[0]) else 0)
        return out

    def edges(batches):
        pid = first = last = None
        heads, tails, single, first_row = [0] * len(values), [0] * len(values), True, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(g) for g in groups]
            starts = _starts(keys, last) if groups else np.array([last is None] + [False] * (b.num_rows - 1))
            if first is None:
                pid, first, first_row = b.column("_pid")[0].as_py(), [c[0].as_py() for c in keys], [b.column(c)[0].as_py() for c in lead]
                starts[0] = False
            cuts = np.flatnonzero(starts)
            for i, x in enumerate(arrays(b)):
                if single:
                    heads[i] += x[:cuts[0] if len(cuts) else len(x)].sum()
                tails[i] = x[cuts[-1]:].sum() if len(cuts) else tails[i] + x.sum()
            single = single and not len(cuts)
            last, end = (_key(keys, b.num_rows - 1) if groups else ()), [c[b.num_rows - 1].as_py() for c in keys]
        if first is not None:
            cols = [pa.array([pid], pa.int32()), pa.array([single])]
            for src_values, names_ in ((first, groups), (end, groups), (first_row, lead)):
                cols += [pa.array([v], type_in[g]) for v, g in zip(src_values, names_)]
            cols += [pa.array([x.item() if hasattr(x, "item") else x], pa.int64() if whole[v] else pa.float64()) for part in (heads, tails) for x, v in zip(part, values)]
            yield pa.RecordBatch.from_arrays(cols, names=edge_names)

    from pyspark.sql.pandas.types import to_arrow_type

    type_in = {g: to_arrow_type(kinds[g]) for g in [*groups, *lead]}
    edge_names = ["_pid", "single", *[f"f{i}" for i in range(len(groups))], *[f"l{i}" for i in range(len(groups))], *[f"r{i}" for i in range(len(lead))],
                  *[f"h{i}" for i in range(len(values))], *[f"t{i}" for i in range(len(values))]]
    edge_types = ["int", "boolean", *[type_of[g] for g in groups], *[type_of[g] for g in groups], *[type_of[c] for c in lead],
                  *["long" if whole[v] else "double" for v in values] * 2]
    rows = sorted(src.mapInArrow(edges, ", ".join(f"{n} {t}" for n, t in zip(edge_names, edge_types))).collect(), key=lambda r: r["_pid"])  # one per partition
    same = lambda v: "NaN" if isinstance(v, float) and v != v else v
    offsets, follow, now, acc = {}, {}, None, [0] * len(values)
    for k, r in enumerate(rows):
        begin, end = (tuple(same(r[f"{p}{i}"]) for i in range(len(groups))) for p in "fl")
        offsets[r["_pid"]] = acc if k and begin == now else [0] * len(values)
        heads, tails = ([r[f"{p}{i}"] for i in range(len(values))] for p in "ht")
        acc = [o + h for o, h in zip(offsets[r["_pid"]], heads)] if r["single"] else tails
        if k and begin == now:
            follow[rows[k - 1]["_pid"]] = [r[f"r{i}"] for i in range(len(lead))]
        now = end

    def scan(batches):
        last, carry, held = None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(g) for g in groups]
            starts = _starts(keys, last) if groups else np.array([last is None] + [False] * (b.num_rows - 1))
            if carry is None:
                pid = b.column("_pid")[0].as_py()
                carry = offsets[pid]
                starts[0] = False
            if held is not None:  # the batch before waits for its last row's follower
                yield finish(held, [b.column(c).slice(0, 1) if not starts[0] else None for c in lead])
            done = []
            for i, x in enumerate(arrays(b)):
                done.append(sums(x, starts, carry[i]))
            carry = [d[-1].item() for d in done]
            last = _key(keys, b.num_rows - 1) if groups else ()
            held = (b, starts, done)
        if held is not None:
            after = follow.get(pid)
            yield finish(held, [pa.array([after[i]], type_in[c]) if after else None for i, c in enumerate(lead)])

    kept = [c for c in ranged.columns if c != "_pid"]
    out_names = [*kept, *[f"{prefix}{v}" for v in values], *[f"next_{c}" for c in lead]]

    def finish(held, following):
        b, starts, done = held
        cols = [b.column(c) for c in kept] + [pa.array(d, pa.int64() if whole[v] else pa.float64()) for d, v in zip(done, values)]
        for c, after in zip(lead, following):
            x = b.column(c)
            tail = after if after is not None else pa.nulls(1, x.type)
            moved = pa.concat_arrays([x.slice(1), tail.cast(x.type)])
            ends = np.append(starts[1:], False)
            cols.append(pc.if_else(pa.array(ends), pa.nulls(len(x), x.type), moved))
        return pa.RecordBatch.from_arrays(cols, names=out_names)

    field = lambda n, t, null=True: T.StructField(n, t, null)
    schema = T.StructType([*[field(c, kinds[c]) for c in kept], *[field(f"{prefix}{v}", T.LongType() if whole[v] else T.DoubleType()) for v in values],
                           *[field(f"next_{c}", kinds[c]) for c in lead]])
    return src.mapInArrow(scan, schema)


def cumulative_sums(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column],
                    values: Sequence[str], prefix: str = "cum_",
                    partitions: int | None = None, lead: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``values`` within each group of ``groups`` in ``order`` (see :func:`carried_sums`).

    ``order`` must be unique within a group (aggregate to distinct values first).
    A hot group spans many range partitions, so no task holds more than one
    partition's share of it; the rows are shuffled once.
    """
    return carried_sums(range_sorted(df, groups, order, partitions), groups, values, prefix, lead)


def unpivot_values(df: DataFrame, cols: Sequence[str], value_type: str = "double",
                   name_col: str = "column", value_col: str = "value", ids: Sequence[str] = ()) -> DataFrame:
    """Long form ``(column, value)`` of the listed columns, nulls removed."""
    cast = df.select(*ids, *[qcol(c).cast(value_type).alias(c) for c in cols])
    return (cast.unpivot([qcol(i) for i in ids], [qcol(c) for c in cols], name_col, value_col)
            .where(F.col(value_col).isNotNull()))


def value_counts_long(df: DataFrame, cols: Sequence[str], value_type: str = "double") -> DataFrame:
    """``(column, value, n)``: count of each non-null value of each column (map-side combined)."""
    return (unpivot_values(df, cols, value_type)
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    counts: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """``(column, q, value)``: linear-interpolation quantiles (pandas / ``percentile`` / ``quantile_cont``).

    A selection, not a sort. Without ``counts``: one scan brackets every wanted position between two
    approximate percentiles, one scan counts the rows below each bracket and aggregates the values inside
    it, and only that narrow band (some ten-thousandths of the rows per position) is put in order; no
    exchange carries the table. With ``counts`` (distinct values that the caller has already counted):
    they are range-partitioned by (column, value), and only the partitions that hold wanted positions are
    ranked. In either way no task holds all values of a column.
    """
    if counts is not None:
        return quantiles_of_ranged(ranged_counts(counts, _partitions(df, partitions)), probs)
    return _bracketed_quantiles(df, cols, [float(q) for q in probs])


BRACKET_ACCURACY = 10_000  # of percentile_approx: its rank error is at most one ten-thousandth of the rows
BINS = 4096  # counted per position and round
GATHERED = 200_000  # distinct values, over all positions, that may be returned as such


def _bracketed_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles by narrowing. A position's interval starts between two approximate percentiles; while it may hold
    more values than may be returned, one scan counts it into fixed bins (with each bin's smallest and largest value), and the bin
    that holds the position is the next interval. A bracket that misses its position is widened and tried again."""
    import math

    spark = df.sparkSession
    number = lambda c: F.when(~F.isnan(qcol(c).cast("double")), qcol(c).cast("double"))  # noqa: E731  NaN is missing
    x = df.select(*[number(c).alias(f"x{i}") for i, c in enumerate(cols)])
    todo, found, slack, rows_of = [(i, q) for i in range(len(cols)) for q in probs], {}, 2.0 / BRACKET_ACCURACY, None
    while todo:
        ends = fused_single_row(x, {f"e{k}": F.percentile_approx(f"x{i}", F.array(F.lit(max(0.0, q - slack)), F.lit(min(1.0, q + slack))), F.lit(BRACKET_ACCURACY))
                                    for k, (i, q) in enumerate(todo)} | ({} if rows_of else {f"n{i}": F.count(f"x{i}") for i in range(len(cols))}))
        rows_of = rows_of or {i: ends[f"n{i}"] for i in range(len(cols))}
        open_ = {}
        for k, (i, q) in enumerate(todo):
            if rows_of[i]:
                open_[k] = {"x": f"x{i}", "lo": ends[f"e{k}"][0] if q - slack > 0 else -math.inf, "hi": ends[f"e{k}"][1] if q + slack < 1 else math.inf,
                            "pos": q * (rows_of[i] - 1), "rows": (2 * slack + 2.0 / BRACKET_ACCURACY) * rows_of[i] if slack < 0.5 else rows_of[i]}
        below = fused_single_row(x, {f"b{k}": F.count_if(F.col(t["x"]) < F.lit(t["lo"])) for k, t in open_.items()} | {f"a{k}": F.min(F.when(F.col(t["x"]) > F.lit(t["hi"]), F.col(t["x"])))
                                                                                                                   for k, t in open_.items()}) if open_ else {}
        for k, t in open_.items():
            t |= {"below": below[f"b{k}"], "after": below[f"a{k}"]}
        missed = _narrow(x, open_, found, todo)
        todo, slack = missed, slack * 16
    return spark.createDataFrame([(cols[i], q, v) for (i, q), v in sorted(found.items())], "column string, q double, value double")


def _narrow(x: DataFrame, open_: dict, found: dict, todo: list) -> list:
    """Resolve the positions of ``open_`` into ``found``; returns those that their bracket missed."""
    import math

    missed = []

    def settle(k: int, t: dict, groups: list) -> bool:
        """``groups``: (smallest, largest, count) of the interval's values, in order. True when both neighbours of the position are known."""
        lo, hi = math.floor(t["pos"]), math.ceil(t["pos"])
        at, value = t["below"], {}
        for j, (least, most, n) in enumerate(groups):
            for r in (lo, hi):
                if at <= r < at + n:
                    if least == most:
                        value[r] = least
                    elif r == at:
                        value[r] = least
                    elif r == at + n - 1:
                        value[r] = most
                    else:
                        t |= {"next": (least, most, n, at, groups[j + 1][0] if j + 1 < len(groups) else t["after"])}
            at += n
        if hi == at and t["after"] is not None:
            value[hi] = t["after"]
        if lo in value and hi in value:
            found[todo[k]] = value[lo] if value[lo] == value[hi] else value[lo] + (t["pos"] - lo) * (value[hi] - value[lo])
            return True
        return False

    while open_:
        exact = sum(t["rows"] for t in open_.values()) <= GATHERED
        cells = []
        for k, t in open_.items():
            v = F.col(t["x"])
            if exact:
                cell = F.lit(0)  # the values themselves are counted
            elif not (math.isfinite(t["lo"]) and math.isfinite(t["hi"])):
                cell = F.when(v == float("-inf"), 0).when(v == float("inf"), 2).otherwise(1)
            elif t["hi"] / 2 == t["lo"] / 2:
                cell = F.when(v <= F.lit(t["lo"]), 0).otherwise(1)
            else:  # halves, as the difference of two doubles may overflow
                share = (v / 2 - F.lit(t["lo"] / 2)) / F.lit(t["hi"] / 2 - t["lo"] / 2)
                cell = F.least(F.floor(share * BINS), F.lit(BINS - 1))
            inside = v.isNotNull() & (v >= F.lit(t["lo"])) & (v <= F.lit(t["hi"]))
            cells.append(F.when(inside, F.struct(F.lit(k).alias("k"), cell.cast("int").alias("c"), v.alias("v"))))
        band = x.select(F.explode(F.array_compact(F.array(*cells))).alias("s"))
        by = ["s.k", "s.v"] if exact else ["s.k", "s.c"]
        counted = band.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("s.v").alias("least"), F.max("s.v").alias("most")).collect()  # bounded: positions x BINS or GATHERED
        groups: dict = {}
        for r in counted:
            groups.setdefault(r["k"], []).append((r["least"] + 0.0, r["most"] + 0.0, r["n"]))
        for k, t in list(open_.items()):
            t.pop("next", None)
            if settle(k, t, sorted(groups.get(k, []))):
                del open_[k]
            elif "next" in t:
                least, most, n, at, after = t.pop("next")
                t |= {"lo": least, "hi": most, "rows": n, "below": at, "after": after}
            else:
                missed.append(todo[k])
                del open_[k]
    return missed


def ranged_counts(vc: DataFrame, partitions: int) -> DataFrame:
    """Distinct-value counts ``(column, value, n)`` range-partitioned by (column, value), with the
    partition id ``_pid``, checkpointed (shared by quantiles and modes)."""
    return reliable(vc.repartitionByRange(partitions, F.col("column"), F.col("value"))
                    .withColumn("_pid", F.spark_partition_id()))


def quantiles_of_ranged(ranged: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Selection of linear-interpolation quantiles from :func:`ranged_counts` output."""
    import math

    spark = ranged.sparkSession
    parts = ranged.groupBy("_pid", "column").agg(F.sum("n").alias("t")).collect()  # <= partitions + columns rows
    by_col: dict[str, list[tuple[int, int]]] = {}
    for r in parts:
        by_col.setdefault(r["column"], []).append((r["_pid"], r["t"]))
    wanted, offsets, targets = set(), {}, []
    for c, lst in by_col.items():
        lst.sort()
        total = sum(t for _, t in lst)
        acc, spans = 0, []
        for pid, t in lst:
            offsets[(pid, c)] = acc
            spans.append((acc, acc + t, pid))
            acc += t
        for q in probs:
            pos = float(q) * (total - 1)
            for side in (math.floor(pos), math.ceil(pos)):
                pid = next(p for lo, hi, p in spans if lo <= side < hi)
                wanted.add((pid, c))
                targets.append((c, float(q), int(side), pos - math.floor(pos)))
    if not targets:
        return spark.createDataFrame([], "column string, q double, value double")
    keys = F.array(*[F.lit(f"{p}|{c}") for p, c in sorted(wanted)])
    key = F.concat_ws("|", F.col("_pid").cast("string"), F.col("column"))
    off = F.create_map(*[x for (p, c), o in offsets.items() if (p, c) in wanted for x in (F.lit(f"{p}|{c}"), F.lit(o))])
    w = Window.partitionBy("_pid", "column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    local = (ranged.where(F.array_contains(keys, key))
             .withColumn("_end", F.sum("n").over(w) + off[key])
             .withColumn("_start", F.col("_end") - F.col("n")))
    tq = spark.createDataFrame(targets, "column string, q double, pos long, frac double")  # columns x probabilities x 2
    hit = (local.join(F.broadcast(tq), (local["column"] == tq["column"]) & (local["_start"] <= tq["pos"])
                      & (tq["pos"] < local["_end"]))
           .select(tq["column"], "q", "pos", "frac", F.col("value")))
    return (hit.groupBy("column", "q").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.first("frac").alias("frac"))
            .select("column", "q", (F.col("lo") + F.col("frac") * (F.col("hi") - F.col("lo"))).alias("value")))


def modes(counts: DataFrame) -> DataFrame:
    """``(column, mode)``: most frequent value per column, smallest value on ties."""
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v"))).alias("m"))
    return best.select("column", F.col("m.v").alias("mode"))


def fused_single_row(df: DataFrame, exprs: dict[str, Column], batch: int = 100) -> dict:
    """Evaluate many scalar aggregates over ``df`` in batches of ``batch`` expressions.

    Returns a dict of name -> value (O(number of expressions) on the driver).
    """
    out: dict = {}
    items = list(exprs.items())
    for i in range(0, len(items), batch):
        part = items[i:i + batch]
        row = df.agg(*[e.alias(n) for n, e in part]).collect()[0]
        out.update(row.asDict())
    return out

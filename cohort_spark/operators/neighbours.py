"""Exact nearest donors for KNN filling, found in donor lists.

A donor stands in one list per coordinate that it has. A list is sorted on its coordinate and cut into blocks of some ``DONORS`` rows (a
block of too many equal values is dealt into parts). For a recipient a donor counts in one list alone: that of the first
coordinate, in a common order, which both have; so whatever presence masks there are, the lists of a recipient's own coordinates hold every
comparable donor once. Coordinates of few values come last in that order: a list's recipients see its donors from its coordinate on,
and of donors that agree there (and in their mask) only the first ``k`` in the order of values can be taken, so such lists are short.

Each recipient is first compared with one block, the one that holds its value in a list that should have donors enough. The ``k`` donors found
limit the distance, and with it how far from the recipient's value the other lists need to be searched: mostly one block
each. So a recipient is sent once per coordinate and not once per block and target, and what is shuffled grows with the rows.

Within a block, the recipients of one presence mask see the donors in disjoint lists again, each sorted on the first coordinate, by spread,
that its donors share with them. The neighbours in these lists limit the ``k``-th distance, and only the donors in the
limit's window of each list are compared, so that a recipient costs a few searches instead of a pass over the donors.

Recipients and donors are joined by equality of block in groups of bounded size, and each task returns at most ``k`` donors per recipient,
target and block. Only the table of lists (cuts, at most ``max_cells`` and one per coordinate, and the ``KINDS`` commonest masks) is broadcast.

``Cells`` and ``build_cells``, a metric index by pivots, are not used by this search.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_spark.operators.ordered import fused_single_row, global_rank, reliable

MAX_CELLS = 16_384
DONORS, RECIPIENTS = 65_536, 65_536  # of one comparison task, at most
TASKS, KINDS = 48, 4096  # blocks of recipients in small inputs; presence masks whose donors are counted to choose the first list
CHUNK = 2_000_000  # numbers in one matrix of a task


def _names(d: int) -> list[str]:
    return [f"d{i}" for i in range(d)]


class Cells:
    """The cell table: bounds of the distance to a cell's donors."""

    def __init__(self, low, high, have, rows, pivot, radius):
        self.low, self.high, self.have = low, high, have  # have: donors with the coordinate, counted with repetition
        self.rows, self.pivot, self.radius = rows, pivot, radius
        self.any = have > 0
        self.all = np.zeros_like(self.any)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(lower bound, distance to the pivot)`` of each row of ``x`` to each cell; infinite: no coordinate in common."""
        m, d = x.shape
        given = ~np.isnan(x)
        gap, to_pivot = np.zeros((m, len(self.rows))), np.zeros((m, len(self.rows)))
        for i in range(d):
            r = np.flatnonzero(given[:, i])
            c = np.flatnonzero(self.all[:, i])
            if len(r) and len(c):
                v = x[r, i][:, None]
                box = np.maximum(np.maximum(self.low[c, i] - v, v - self.high[c, i]), 0.0)
                gap[np.ix_(r, c)] += box * box
                off = v - self.pivot[c, i]
                to_pivot[np.ix_(r, c)] += off * off
        to_pivot = np.sqrt(to_pivot)
        ball = np.where(np.isfinite(to_pivot), to_pivot - self.radius, 0.0)
        shared = given.astype(np.float64) @ self.any.T.astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            low = np.sqrt(d / shared) * np.maximum(np.sqrt(gap), np.maximum(ball, 0.0))
        return np.where(shared > 0, low, np.inf), np.where(np.isfinite(to_pivot), to_pivot, 0.0)

    def first(self, low: np.ndarray, near: np.ndarray, target: int, k: int) -> np.ndarray:
        """The cells nearest to a recipient that hold ``k`` donors with the target."""
        can = np.flatnonzero((self.have[:, target] > 0) & np.isfinite(low))
        order = can[np.lexsort((near[can], low[can]))]
        enough = np.searchsorted(np.cumsum(self.have[order, target]), k) + 1
        return order[:enough]


def build_cells(donors: DataFrame, d: int, max_cells: int) -> tuple[DataFrame, Cells | None]:
    """``donors`` (columns ``d0`` …, ``cnt``) with their cell, and the cell table."""
    import pandas as pd

    names = _names(d)
    n = donors.count()
    if not n:
        return donors.withColumn("cell", F.lit(0)), None
    size = fused_single_row(donors, {**{f"m{i}": F.avg(c) for i, c in enumerate(names)}, **{f"s{i}": F.stddev_pop(c) for i, c in enumerate(names)}})
    mean = np.array([size[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([size[f"s{i}"] or 1.0 for i in range(d)])
    pick = max(1, min(max_cells, ceil(sqrt(n))))
    pivots = donors.select(*names).orderBy(F.xxhash64(*names), *names).limit(pick).toPandas().to_numpy(dtype="float64")
    shared = donors.sparkSession.sparkContext.broadcast((pivots, mean, scale))

    def assign(batches):
        p, mu, sd = shared.value
        z = np.nan_to_num((p - mu) / sd)
        has = (~np.isnan(p)).astype(np.float64)
        for pdf in batches:
            x = pdf[names].to_numpy(dtype="float64")
            cell, ball = np.zeros(len(x), np.int64), np.zeros(len(x))
            step = max(1, CHUNK // len(p))
            for a in range(0, len(x), step):
                y = x[a:a + step]
                given = (~np.isnan(y)).astype(np.float64)
                w = np.nan_to_num((y - mu) / sd)
                # squared distance on shared coordinates, and 2 (a standardised square difference's mean) for each coordinate that only one has
                far = (w * w) @ has.T - 2 * w @ z.T + given @ (z * z).T + 2 * (given @ (1 - has).T + (1 - given) @ has.T)
                cell[a:a + step] = far.argmin(axis=1)
                off = y - p[cell[a:a + step]]
                ball[a:a + step] = np.sqrt(np.nansum(off * off, axis=1))
            yield pd.DataFrame({**{c: pdf[c] for c in names}, "cnt": pdf["cnt"], "cell": cell, "ball": ball})

    schema = ", ".join([*(f"{c} double" for c in names), "cnt long, cell long, ball double"])
    dealt = reliable(donors.select(*names, "cnt").mapInPandas(assign, schema))
    of = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("ball").alias("radius"), *[
        e for c in names for e in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"), F.coalesce(F.sum(F.when(F.col(c).isNotNull(), F.col("cnt"))), F.lit(0)).alias(f"n_{c}"),
                                   F.count(c).alias(f"r_{c}"))]).toPandas().sort_values("cell")
    where = of["cell"].to_numpy()
    table = lambda p: np.stack([of[f"{p}_{c}"].to_numpy(dtype="float64") for c in names], axis=1)
    cells = Cells(table("lo"), table("hi"), table("n"), of["rows"].to_numpy(), pivots[where], of["radius"].to_numpy(dtype="float64"))
    cells.all = table("r") == cells.rows[:, None]
    place = donors.sparkSession.createDataFrame([(int(c), i, ceil(r / DONORS)) for i, (c, r) in enumerate(zip(where, cells.rows))], "cell long, at long, nb long")
    dealt = dealt.join(F.broadcast(place), "cell").select(*names, "cnt", F.col("at").alias("cell"), F.pmod(F.xxhash64(*names), "nb").alias("db"))  # at most max_cells rows
    return dealt, cells


def _windows(x, given, can, y, has, spread, sorted_on, d: int, k: int, cap):
    """Candidates of recipients that share one presence mask and one target: ``(limit, [(donors in the order of a coordinate, from, to)])``.

    The donors that ``can`` be used (those with the target) are listed under the first coordinate, widest spread first, that they share with the
    recipients, and sorted on it (``sorted_on(c)``: all donors in the order of ``c``).
    The ``k`` donors next to a recipient in each list limit its ``k``-th distance; whatever is as near lies in the limit's window of its list.
    """
    shared = sorted(np.flatnonzero(given).tolist(), key=lambda c: -spread[c])
    rest, lists = can.copy(), []
    for n, c in enumerate(shared):
        at = sorted_on(c)
        at = at[rest[at]]
        rest[at] = False
        if len(at):
            lists.append((c, len(shared) - n, at, y[at, c]))
    limit = np.full(len(x), np.inf)
    step = max(1, CHUNK // (2 * k * (d + 1) * max(1, len(lists))))
    for a in range(0, len(x), step):
        part = x[a:a + step]
        near = [np.full((len(part), k), np.inf)]
        for c, _, at, v in lists:
            beside = np.searchsorted(v, part[:, c])[:, None] + np.arange(-k, k)
            there = (beside >= 0) & (beside < len(v))
            r, j = np.nonzero(there)
            far = np.full(there.shape, np.inf)
            far[r, j] = _distances(part, r, y, has, at[beside[r, j]], shared, d)[0]
            near.append(far)
        limit[a:a + step] = np.partition(np.nan_to_num(np.concatenate(near, axis=1), nan=np.inf, posinf=np.inf), k - 1, axis=1)[:, k - 1]
    limit = np.minimum(limit, cap) * (1 + 1e-9)
    out = []
    for c, m, at, v in lists:  # a donor of the list shares at most m coordinates
        wide = limit * sqrt(m / d) * (1 + 1e-9) + 1e-150
        with np.errstate(invalid="ignore"):
            low, high = np.searchsorted(v, x[:, c] - wide, "left"), np.searchsorted(v, x[:, c] + wide, "right")
        out.append((at, np.where(np.isinf(limit), 0, low), np.where(np.isinf(limit), len(v), high)))
    return limit, out


def _distances(x, r, y, has, at, shared, d: int):
    """Distance and number of shared coordinates of recipients ``x[r]`` and donors ``y[at]``."""
    total, common = np.zeros(len(r)), np.zeros(len(r), np.int32)
    with np.errstate(invalid="ignore", over="ignore"):
        for i in sorted(shared):
            off, both = x[r, i] - y[at, i], has[at, i]
            total += np.where(both, off * off, 0.0)
            common += both
        return np.sqrt(float(d) / common * total), common


def _nearest(d: int, k: int, before: Sequence[int] = (), lead: int | None = None):
    """Per recipient and target, the first ``k`` donors of a donor block by distance, more shared coordinates, then values.

    Optional columns: ``rank`` (a donor's place in the order of values; found here without it) and ``least`` (donors at the distance ``cap``
    count from so many shared coordinates on). With ``lead`` only the donors that share it and none of the coordinates ``before`` count.
    """
    import pandas as pd

    names = _names(d)

    def run(left, right):
        empty = pd.DataFrame({"rid": pd.Series(dtype="int64"), "target": pd.Series(dtype="int32"), "dist": pd.Series(dtype="float64"), "common": pd.Series(dtype="int32"),
                              "rank": pd.Series(dtype="int64"), "cnt": pd.Series(dtype="int64"), "y": pd.Series(dtype="float64")})
        if not len(left) or not len(right):
            return empty
        y, cnt = right[names].to_numpy(dtype="float64"), right["cnt"].to_numpy()
        has = ~np.isnan(y)
        if "rank" in right.columns:
            rank = right["rank"].to_numpy()
        else:
            keys = np.stack([k_ for i in range(d) for k_ in ((~has[:, i]).astype(np.float64), np.where(has[:, i], y[:, i], 0.0))], axis=1)
            rank = np.empty(len(y), np.int64)
            rank[np.lexsort(keys.T[::-1])] = np.arange(len(y))  # donors in the order of their values, missing ones last
        least = left["least"].to_numpy() if "least" in left.columns else np.zeros(len(left), np.int32)
        places: dict[int, np.ndarray] = {}

        def sorted_on(c):
            if c not in places:
                at = np.flatnonzero(has[:, c])
                places[c] = at[np.argsort(y[at, c], kind="stable")]
            return places[c]

        with np.errstate(invalid="ignore", over="ignore"):
            spread = np.nan_to_num(np.array([y[has[:, i], i].std() if has[:, i].any() else 0.0 for i in range(d)]), posinf=0.0)
        x, targets, rid, cap = left[names].to_numpy(dtype="float64"), left["target"].to_numpy(), left["rid"].to_numpy(), left["cap"].to_numpy(dtype="float64")
        kinds, kind = np.unique(np.column_stack([~np.isnan(x), targets]), axis=0, return_inverse=True)
        order = np.argsort(kind.ravel(), kind="stable")
        ends = np.searchsorted(kind.ravel()[order], np.arange(len(kinds) + 1))
        out = []
        for g, row in enumerate(kinds):
            of, given, t = order[ends[g]:ends[g + 1]], row[:d].astype(bool), int(row[d])
            can = has[:, t]
            if lead is not None:
                met = [c for c in before if given[c]]
                can = can & has[:, lead] & ~has[:, met].any(axis=1)
                given = given.copy()
                given[met] = False  # these donors lack them
            shared = np.flatnonzero(given)
            limit, lists = _windows(x[of], given, can, y, has, spread, sorted_on, d, k, cap[of])
            if not lists:
                continue
            many = np.cumsum(sum(high - low for _, low, high in lists))
            a = 0
            while a < len(of):  # candidates of one round are at most CHUNK numbers, or those of one recipient
                b = max(a + 1, int(np.searchsorted(many, (many[a - 1] if a else 0) + CHUNK // (d + 1), "right")))
                r, at = [], []
                for donors, low, high in lists:
                    n = (high - low)[a:b]
                    own = np.repeat(np.arange(a, b), n)
                    r.append(own)
                    at.append(donors[np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + low[own]])
                r, at = np.concatenate(r), np.concatenate(at)
                dist, common = _distances(x[of], r, y, has, at, shared, d)
                keep = ~(dist > limit[r]) & ~((dist == cap[of[r]]) & (common < least[of[r]]))
                r, at, dist, common = r[keep], at[keep], dist[keep], common[keep]
                by = np.lexsort((rank[at], -common, dist, r))
                by = by[np.arange(len(by)) - np.searchsorted(r[by], r[by]) < k]
                r, at = r[by], at[by]
                out.append(pd.DataFrame({"rid": rid[of[r]], "target": np.full(len(r), t, np.int32), "dist": dist[by], "common": common[by],
                                         "rank": rank[at], "cnt": cnt[at], "y": y[at, t]}))
                a = b
        out = [o for o in out if len(o)]
        return pd.concat(out, ignore_index=True) if out else empty

    return run


class Lists:
    """The table of donor lists: the donors that have a coordinate, cut into blocks along it.

    A donor counts for a recipient in one list alone: that of the first coordinate, in ``order``, which both have.
    """

    def __init__(self, order: list[int], cuts: dict[int, np.ndarray], masks: np.ndarray, counts: np.ndarray):
        self.order, self.cuts, self.masks, self.counts = order, cuts, masks, counts
        self.leads = [c for c in order if c in cuts]
        self.start, at = {}, 0
        for c in self.leads:
            self.start[c] = at
            at += len(cuts[c]) + 1
        self.parts = np.ones(at, np.int64)  # of a block that holds too many equal values

    def before(self, lead: int) -> list[int]:
        return self.order[:self.order.index(lead)]

    def block(self, lead: int, v: np.ndarray) -> np.ndarray:
        return self.start[lead] + np.searchsorted(self.cuts[lead], v, "right")

    def first(self, given: np.ndarray, targets: list[int], k: int) -> int | None:
        """The list of a presence mask that is searched first: the last in order whose blocks should hold donors enough, else the richest."""
        best, most, rest = None, -1.0, np.ones(len(self.masks), bool)
        for c in self.leads:
            if given[c]:
                here = rest & self.masks[:, c]
                rest &= ~self.masks[:, c]
                n = min(float(self.counts[here & self.masks[:, t]].sum()) for t in targets) / (len(self.cuts[c]) + 1)
                if n >= 4 * k or best is None or most < 4 * k and n > most:
                    best, most = c, n
        return best


def build_lists(donors: DataFrame, d: int, k: int, max_blocks: int) -> tuple[DataFrame, Lists]:
    """``donors`` (``d0`` …, ``cnt``) once per coordinate that they have (``lead``), with their ``rank``, ``block`` and its ``part``, and the
    table of lists. Of donors that no recipient of a list can tell apart but by rank the first ``k`` stay."""
    names = _names(d)
    spark = donors.sparkSession
    kinds = fused_single_row(donors, {f"n{i}": F.approx_count_distinct(c) for i, c in enumerate(names)})
    order = sorted(range(d), key=lambda i: (-kinds[f"n{i}"], i))
    ranked = global_rank(donors, [F.col(c).asc_nulls_last() for c in names], "rank").select(*names, "cnt", "rank")
    mask = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in names])
    seen = ranked.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "mask").limit(KINDS).collect()
    masks, counts = np.array([[b == "1" for b in r["mask"]] for r in seen], bool).reshape(len(seen), d), np.array([r["n"] for r in seen], np.int64)
    each = ranked.withColumn("lead", F.explode(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(i)) for i, c in enumerate(names)]))))
    place = F.get(F.lit([order.index(i) for i in range(d)]), F.col("lead"))
    told = [F.when(place <= order.index(i), F.col(c)) for i, c in enumerate(names)]
    w = Window.partitionBy("lead", mask, *told).orderBy("rank")
    few = each.where(place > 0).withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k).drop("nth")
    each = reliable(each.where(place == 0).unionByName(few))  # all coordinates of the first list tell donors apart
    rows = {r["lead"]: r["n"] for r in each.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = max(DONORS, ceil(sum(rows.values()) / max_blocks))
    blocks = {c: ceil(n / size) for c, n in rows.items()}
    at = {f"q{c}": F.percentile_approx(F.when(F.col("lead") == c, F.col(names[c])), [i / n for i in range(1, n)], 100 * n) for c, n in blocks.items() if n > 1}
    cut = fused_single_row(each, at) if at else {}
    lists = Lists(order, {c: np.unique(np.array(cut.get(f"q{c}") or [], np.float64)) for c in blocks}, masks, counts)
    shared = spark.sparkContext.broadcast(lists)

    def assign(batches):
        table = shared.value
        for pdf in batches:
            lead, block = pdf["lead"].to_numpy(), np.zeros(len(pdf), np.int64)
            for c in np.unique(lead):
                block[lead == c] = table.block(int(c), pdf[names[c]].to_numpy(dtype="float64")[lead == c])
            yield pdf.assign(block=block)

    dealt = each.mapInPandas(assign, ", ".join(f"{c} double" for c in names) + ", cnt long, rank long, lead int, block long")
    for r in dealt.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect():  # at most max_blocks rows and one a coordinate
        lists.parts[r["block"]] = ceil(r["n"] / size)
    parts = F.broadcast(spark.createDataFrame([(i, int(p)) for i, p in enumerate(lists.parts)], "block long, parts long"))
    return dealt.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("rank"), "parts")).drop("parts"), lists


FOUND = {"target": "int", "dist": "double", "common": "int", "rank": "long", "cnt": "long", "y": "double"}


def _search(d: int, k: int, targets: Sequence[int], table, packed: bool):
    """``_nearest`` of the recipients of a block for all their missing targets; ``packed``: one row per recipient, with the limits that follow."""
    import pandas as pd

    names = _names(d)

    def run(left, right):
        left = left.reset_index(drop=True)
        x = left[names].to_numpy(dtype="float64")
        of, which = np.nonzero(np.isnan(x[:, targets]))
        t = np.asarray(targets)[which]
        cap, least = left[[f"cap{i}" for i in range(d)]].to_numpy(dtype="float64"), left[[f"least{i}" for i in range(d)]].to_numpy()
        ask = pd.DataFrame({"rid": of, "target": t.astype(np.int32), "cap": cap[of, t], "least": least[of, t], **{n: x[of, i] for i, n in enumerate(names)}})
        lead = int(left["lead"].iloc[0]) if len(left) else 0
        got = _nearest(d, k, table.value.before(lead), lead)(ask, right)
        if not packed:
            return got.assign(rid=left["rid"].to_numpy()[got["rid"].to_numpy()])
        got = got.sort_values(["rid", "target"], kind="stable", ignore_index=True)
        i, t, n = got["rid"].to_numpy(), got["target"].to_numpy(), got["cnt"].to_numpy()
        if len(got):
            first = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (t[1:] != t[:-1])])
            sums = np.cumsum(np.minimum(n, k))
            sums -= np.repeat(sums[first] - np.minimum(n, k)[first], np.diff(np.r_[first, len(got)]))
            full = np.flatnonzero(sums >= k)
            full = full[::-1]  # the first row of a target that completes its k donors is set last
            cap[i[full], t[full]], least[i[full], t[full]] = np.nan_to_num(got["dist"].to_numpy()[full], nan=np.inf, posinf=np.inf), got["common"].to_numpy()[full]
        ends = np.searchsorted(i, np.arange(len(left) + 1))
        return left.drop(columns=["lead"]).assign(
            **{f"cap{c}": cap[:, c] for c in range(d)}, **{f"least{c}": least[:, c] for c in range(d)},
            **{c: [v[a:b] for a, b in zip(ends, ends[1:])] for c in FOUND for v in [got[c].to_numpy()]})

    return run


def _compare(ask: DataFrame, dealt: DataFrame, d: int, k: int, targets: Sequence[int], table, packed: bool) -> DataFrame:
    """``ask`` rows (rid, lead, block, part, the recipient's values and limits) against the donors of their part of a block."""
    names = _names(d)
    load = ask.groupBy("block", "part").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each part of a block
    size = max(1, min(RECIPIENTS, max(RECIPIENTS // 32, ceil(sum(r["n"] for r in load) / TASKS))))
    parts = F.broadcast(ask.sparkSession.createDataFrame([(r["block"], r["part"], ceil(r["n"] / size)) for r in load], "block long, part long, nr long"))
    by = ["block", "part", "rb"]
    left = ask.join(parts, ["block", "part"]).withColumn("rb", F.pmod(F.xxhash64("rid"), "nr")).drop("nr")
    right = dealt.drop("lead").join(parts, ["block", "part"]).withColumn("rb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nr") - 1))).drop("nr")
    found = ", ".join(f"{c} array<{t}>" if packed else f"{c} {t}" for c, t in FOUND.items())
    limits = ", ".join(f"{c} double, cap{i} double, least{i} int" for i, c in enumerate(names))
    schema = f"rid long, block long, part long, {limits}, {found}" if packed else f"rid long, {found}"
    run = _search(d, k, targets, table, packed)

    def named(left, right):  # by name and order of the schema
        out = run(left, right)
        return out[["rid", "block", "part", *[x for i, c in enumerate(names) for x in (c, f"cap{i}", f"least{i}")], *FOUND] if packed else ["rid", *FOUND]]

    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(named, schema)


def nearest_means(recipients: DataFrame, donors: DataFrame, d: int, k: int, targets: Sequence[int], max_cells: int = MAX_CELLS) -> DataFrame | None:
    """``(rid, target, imp)``: for every missing target coordinate of a recipient, the mean of its first ``k`` donors.

    ``recipients``: ``rid`` and ``d0`` … (null: missing); ``donors``: ``d0`` … and ``cnt``. A recipient without a comparable donor has no
    row. None without donors.
    """
    import pandas as pd

    names = _names(d)
    if donors.isEmpty():
        return None
    dealt, lists = build_lists(donors, d, k, max_cells)
    table = recipients.sparkSession.sparkContext.broadcast(lists)
    wanted = sorted(targets)

    def rows(pdf, x, of, lead, block, part, cap, least):
        return pd.DataFrame({"rid": pdf["rid"].to_numpy()[of], "lead": lead.astype(np.int32), "block": block, "part": part, **{n: x[of, i] for i, n in enumerate(names)},
                             **{f"cap{i}": cap[of, i] for i in range(d)}, **{f"least{i}": least[of, i] for i in range(d)}})

    def begin(batches):
        """Each recipient to the block of its first list that holds its value."""
        c, known = table.value, {}
        for pdf in batches:
            x = pdf[names].to_numpy(dtype="float64")
            kinds, kind = np.unique(~np.isnan(x), axis=0, return_inverse=True)
            lead = np.full(len(x), -1)
            for g, given in enumerate(kinds):
                missing = [t for t in wanted if not given[t]]
                if missing:
                    if given.tobytes() not in known:
                        known[given.tobytes()] = c.first(given, missing, k)
                    lead[kind.ravel() == g] = -1 if known[given.tobytes()] is None else known[given.tobytes()]
            of = np.flatnonzero(lead >= 0)
            block = np.zeros(len(of), np.int64)
            for a in np.unique(lead[of]):
                block[lead[of] == a] = c.block(int(a), x[of[lead[of] == a], a])
            part = pdf["rid"].to_numpy()[of] % c.parts[block]
            yield rows(pdf, x, of, lead[of], block, part, np.full((len(x), d), np.inf), np.zeros((len(x), d), np.int32))

    def go_on(batches):
        """Each recipient to the other blocks that its limits reach."""
        c = table.value
        for whole in batches:
            for a in range(0, len(whole), step := max(1, CHUNK // (4 * len(c.parts)))):
                pdf = whole.iloc[a:a + step]
                x = pdf[names].to_numpy(dtype="float64")
                cap, least = pdf[[f"cap{i}" for i in range(d)]].to_numpy(dtype="float64"), pdf[[f"least{i}" for i in range(d)]].to_numpy()
                far = np.where(np.isnan(x), cap, -1.0)[:, wanted].max(axis=1)
                for lead in c.leads:
                    of = np.flatnonzero(~np.isnan(x[:, lead]))
                    v, m = x[of, lead], (~np.isnan(x[of]))[:, c.order[c.order.index(lead):]].sum(axis=1)
                    with np.errstate(invalid="ignore", over="ignore"):
                        wide = far[of] * np.sqrt(m / d) * (1 + 1e-9) + 1e-150
                        open_ = ~np.isfinite(wide) | ~np.isfinite(v)
                        low, high = (np.where(open_, e, c.block(lead, np.where(open_, 0.0, z))) for e, z in
                                     ((c.start[lead], v - wide), (c.start[lead] + len(c.cuts[lead]), v + wide)))
                    n = high - low + 1
                    own = np.repeat(np.arange(len(of)), n)
                    block = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + low[own]
                    n = c.parts[block]
                    part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    own, block = of[np.repeat(own, n)], np.repeat(block, n)
                    new = (block != pdf["block"].to_numpy()[own]) | (part != pdf["part"].to_numpy()[own])
                    yield rows(pdf, x, own[new], np.full(new.sum(), lead), block[new], part[new], cap, least)

    schema = "rid long, lead int, block long, part long, " + ", ".join([*(f"{c} double" for c in names), *(f"cap{i} double" for i in range(d)), *(f"least{i} int" for i in range(d))])
    first = reliable(_compare(recipients.select("rid", *names).mapInPandas(begin, schema), dealt, d, k, wanted, table, True))
    again = first.drop(*FOUND).mapInPandas(go_on, schema)
    both = first.select("rid", F.explode(F.arrays_zip(*FOUND)).alias("f")).select("rid", *[F.col(f"f.{c}") for c in FOUND])
    both = both.unionByName(_compare(again, dealt, d, k, wanted, table, False))
    w = Window.partitionBy("rid", "target").orderBy("dist", F.col("common").desc(), "rank")
    before = F.coalesce(F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    both = both.withColumn("pre", before).where(F.col("pre") < k)
    take = F.least(F.col("cnt"), F.lit(k) - F.col("pre"))
    return both.groupBy("rid", "target").agg((F.sum(take * F.col("y")) / F.sum(take)).alias("imp"))

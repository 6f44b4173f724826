"""Operator 2, mixing sources to target weights by a minimum-cost flow.

Documents may belong to several sources. They are aggregated by membership pattern (the set of sources they belong to),
and a flow routes the patterns' words to the sources' quotas: a pattern offers its words once at the lowest cost, and once
more at each higher repetition at a convexly rising cost, so nothing is repeated while unused words remain. Patterns that
share no source are independent problems, solved in parallel. Each pattern's flow is then turned into documents: all of
them as often as the flow covers the pattern in full, and for the rest those that come first in a seeded hash order.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.llm.common import checked_broadcast, pick, stage
from cohort_spark.llm.components import connected_components
from cohort_spark.operators.ordered import global_rank

BUCKET_BITS = 12  # hash ranges per pattern (4,096); only the range that holds the cut is ordered exactly


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources in code point order (null last) weigh ``weights`` in turn and share ``share`` of all words by weight; a target
    stops at ``cap`` times its source's size and the excess is reshared by weight until none is above. Only totals reach the
    driver; each round caps at least one more source, and all that stay below have a target of level times weight.
    """
    ranked = global_rank(sizes.select(F.col("source").isNull().alias("last"), F.encode("source", "utf-8").alias("bytes"), "source", "source_size"),
                         [F.col("last"), F.col("bytes")], "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", w.alias("w")), "sources")
    level, limit = 0.0, F.col("source_size") * cap
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    while True:
        above = F.col("w") * level > limit
        s = ranked.agg(F.sum(F.when(above, limit)).alias("capped"), F.sum(F.when(~above, F.col("w"))).alias("open")).first()
        new = (share * total - (s["capped"] or 0.0)) / s["open"] if s["open"] else level
        if new <= level:
            break
        level = new
    return ranked.select("source", "source_size", F.least(F.col("w") * level, limit).cast("double").alias("target"))


def cheapest_flow(supply: dict[int, int], edges: list[tuple[int, int]], demand: dict[int, int], repeats: int) -> dict[tuple[int, int], int]:
    """Words that each source takes of each pattern: ``{(pattern, source): words}``.

    Successive cheapest paths on pattern and source nodes. The k-th use of a pattern's words costs ``2k - 1`` a word, so the total
    is convex in the repetitions; the capacities are the patterns' words per use and the sources' quotas.
    """
    arcs: list[list[int]] = []  # to, capacity, cost; the reverse of arc i is i ^ 1
    out: dict[object, list[int]] = {}
    nodes: dict[object, int] = {}

    def node(x):
        return nodes.setdefault(x, len(nodes))

    def arc(a, b, capacity, cost):
        for u, v, c, d in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out.setdefault(u, []).append(len(arcs))
            arcs.append([v, c, d])

    start, end = node("start"), node("end")
    for p, words in sorted(supply.items()):
        for k in range(1, repeats + 1):
            arc(start, node(("p", p)), words, 2 * k - 1)
    middle = {}
    for p, s in sorted(edges):
        middle[p, s] = len(arcs)
        arc(node(("p", p)), node(("s", s)), repeats * supply[p], 0)
    for s, words in sorted(demand.items()):
        arc(node(("s", s)), end, words, 0)
    potential = [0] * len(nodes)
    while True:
        far = [None] * len(nodes)
        via: list[int | None] = [None] * len(nodes)
        far[start], heap = 0, [(0, start)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for i in out.get(u, []):
                v, capacity, cost = arcs[i]
                if capacity > 0:
                    nd = d + cost + potential[u] - potential[v]
                    if far[v] is None or nd < far[v]:
                        far[v], via[v] = nd, i
                        heapq.heappush(heap, (nd, v))
        if far[end] is None:
            break
        for v, d in enumerate(far):
            potential[v] += d if d is not None else far[end]
        push, v = None, end
        while v != start:
            i = via[v]
            push = arcs[i][1] if push is None else min(push, arcs[i][1])
            v = arcs[i ^ 1][0]
        v = end
        while v != start:
            i = via[v]
            arcs[i][1] -= push
            arcs[i ^ 1][1] += push
            v = arcs[i ^ 1][0]
    return {k: arcs[i ^ 1][1] for k, i in middle.items()}


def _solve(repeats: int):
    def run(pdf):
        import pandas as pd

        supply = dict(zip(pdf["pattern"].tolist(), pdf["words"].tolist()))
        demand = {int(s): int(round(t)) for s, t in zip(pdf["sid"], pdf["target"])}
        flow = cheapest_flow(supply, list(zip(pdf["pattern"].tolist(), pdf["sid"].tolist())), demand, repeats)
        total: dict[int, int] = {}
        for (p, _), x in flow.items():
            total[p] = total.get(p, 0) + x
        return pd.DataFrame({"pattern": pd.Series(list(total), dtype="int64"), "flow": pd.Series(list(total.values()), dtype="int64")})
    return run


def route_words(patterns: DataFrame, targets: DataFrame, repeats: int) -> DataFrame:
    """``(pattern, flow)``: words that the mix takes of each pattern, repeats counted.

    ``patterns``: ``(pattern, words, source)``, one row per pattern and source; ``targets``: ``(source, sid, target)``. Patterns linked by
    common sources form one flow problem of aggregated rows; the problems are solved in parallel.
    """
    rows = stage(patterns.join(targets, patterns["source"].eqNullSafe(targets["source"])).select("pattern", "words", "sid", "target"), "mix-routes")
    shared = rows.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if shared:
        odd = rows.select((F.col("pattern") * 2 + 1).alias("a"), (F.col("sid") * 2).alias("b"))
        comp = connected_components(odd)
        rows = rows.join(comp, F.col("sid") * 2 == F.col("node")).drop("node")
    else:
        rows = rows.withColumn("root", F.col("sid"))
    return rows.groupBy("root").applyInPandas(_solve(repeats), "pattern long, flow long")


def choose_documents(rows: DataFrame, plan: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """``wide`` (default ``rows``; both have pattern, h, size) with ``uses``, how often the mix takes each row, per ``plan``
    (pattern, words, flow).

    With ``full = flow div words`` uses of every document, the rest goes to the documents that come first by ``h`` (a seeded
    hash) and fit into what is left: one that does not is passed over, and the order goes on behind it. So less is left than
    the smallest document passed over, which is taken too if that comes nearer. Rows with equal ``h`` in a pattern are taken together. Each round finds how far the order goes until
    the next document that does not fit: sums per hash range are gathered, and only the one range that holds that
    document is ordered. A round takes at least one document and leaves less than the size of the one that stopped it, so there are few. ``wide``
    meets only tables of one row per pattern.
    """
    plan = stage(plan.where("words > 0").select("pattern", F.expr("flow div words").alias("full"), F.expr("flow % words").alias("rest")), "mix-plan")
    n = plan.count()
    bucket = F.shiftrightunsigned("h", 64 - BUCKET_BITS)
    keys = stage(rows.where("size > 0").groupBy("pattern", bucket.alias("bucket"), "h").agg(F.sum("size").alias("total"), F.max("size").alias("size")), "mix-keys")
    left = plan.where("rest > 0").select(F.col("pattern").alias("p"), F.col("rest").alias("gap"), F.lit(-1).cast("long").alias("b0"), F.lit(0).cast("long").alias("h0"))
    rounds = None
    while True:
        left = stage(left, "mix-left")
        if left.isEmpty():
            break
        behind = (F.col("bucket") > F.col("b0")) | ((F.col("bucket") == F.col("b0")) & (F.col("h") > F.col("h0")))
        open_ = keys.join(checked_broadcast(left, n), (F.col("pattern") == F.col("p")) & behind & (F.col("size") <= F.col("gap")))
        sums = open_.groupBy("p", "gap", "b0", "h0", "bucket").agg(F.sum("total").alias("words"))
        by = Window.partitionBy("p").orderBy("bucket")  # at most 2**BUCKET_BITS rows a pattern
        sums = sums.withColumn("upto", F.sum("words").over(by))
        stop = sums.groupBy("p", "gap", "b0", "h0").agg(F.min(F.when(F.col("upto") > F.col("gap"), F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")))).alias("at"),
                                                        F.max("upto").alias("all"))
        stop = stage(stop.select("p", "gap", "b0", "h0", F.col("at.bucket").alias("b1"), F.col("at.before").alias("before"), "all"), "mix-stops")
        edge = open_.select("p", "bucket", "h", "total").join(checked_broadcast(stop.where("b1 is not null").select(F.col("p").alias("q"), "b1", "before", F.col("gap").alias("g")), n),
                                                              (F.col("p") == F.col("q")) & (F.col("bucket") == F.col("b1")))
        edge = edge.withColumn("upto", F.sum("total").over(Window.partitionBy("p").orderBy("h")) + F.col("before"))
        first_out = edge.groupBy("p").agg(F.min(F.when(F.col("upto") > F.col("g"), F.struct("h", (F.col("upto") - F.col("total")).alias("got")))).alias("x"))
        # to the end of the order, or up to (not with) the document at (b1, h1)
        done = stage(stop.join(first_out, "p", "left").select("p", "gap", "b0", "h0", "b1", F.col("x.h").alias("h1"), F.coalesce("x.got", "all").alias("got")), "mix-round")
        end = done.where("b1 is null and gap > got").select("p", (F.col("gap") - F.col("got")).alias("short"))
        ends = end if rounds is None else ends.unionAll(end)
        part = done.select("p", F.struct("gap", "b0", "h0", "b1", "h1").alias("r"))
        rounds = part if rounds is None else rounds.unionAll(part)
        left = done.where("b1 is not null and gap > got").select("p", (F.col("gap") - F.col("got")).alias("gap"), F.col("b1").alias("b0"), F.col("h1").alias("h0"))
    steps = plan.select(F.col("pattern").alias("p"), "full")
    steps = steps.withColumn("steps", F.array().cast("array<struct<gap:long,b0:long,h0:long,b1:long,h1:long>>")) if rounds is None else (
        steps.join(rounds.groupBy("p").agg(F.collect_list("r").alias("steps")), "p", "left"))  # a few rounds a pattern
    steps = stage(steps, "mix-steps")
    here = lambda r: ((bucket > r["b0"]) | ((bucket == r["b0"]) & (F.col("h") > r["h0"]))) & (
        r["b1"].isNull() | (bucket < r["b1"]) | ((bucket == r["b1"]) & (F.col("h") < r["h1"])))
    taken = F.coalesce(F.exists("steps", lambda r: here(r) & (F.col("size") <= r["gap"])), F.lit(False))
    if rounds is not None:
        open_ = steps.join(stage(ends, "mix-ends").select(F.col("p").alias("q"), "short"), F.col("p") == F.col("q")).drop("q")
        near = (keys.drop("bucket").join(checked_broadcast(open_, n), (F.col("pattern") == F.col("p")) & (F.col("total") < 2 * F.col("short"))).where(~taken)
                .groupBy("p").agg(F.min(F.struct("total", "h")).alias("near")))
        steps = steps.join(near.select(F.col("p").alias("q"), F.col("near.h").alias("over")), F.col("p") == F.col("q"), "left").drop("q")
    else:
        steps = steps.withColumn("over", F.lit(None).cast("long"))
    steps = checked_broadcast(stage(steps, "mix-taken"), n)
    taken = taken | F.coalesce(F.col("h") == F.col("over"), F.lit(False))
    uses = F.coalesce("full", F.lit(0)) + taken.cast("int")
    return ((rows if wide is None else wide).join(steps, F.col("pattern") == F.col("p"), "left")
            .withColumn("uses", F.when(F.col("size") > 0, uses).otherwise(0).cast("int")).drop("p", "full", "steps", "over"))


class _Mix:
    """The plan of a mix: ``rows`` (id, sources, size, h, pattern, source_size, target), ``lookup`` and ``plan``."""

    def __init__(self, docs, id_col, text_col, source_col, weights, share, repeats, seed):
        self.args = (id_col, text_col, source_col, seed)
        base = stage(self.keyed(docs).select(qcol(id_col).alias("id"), "sources", "size", "h"), "mix-documents")
        by_pattern = stage(base.groupBy("sources").agg(F.sum("size").alias("words")).withColumn("pattern", F.monotonically_increasing_id()), "mix-patterns")
        each = by_pattern.select("pattern", "words", F.explode("sources").alias("source"))
        targets = source_targets(each.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, float(repeats))
        targets = stage(targets.withColumn("sid", F.monotonically_increasing_id()), "mix-targets")
        flow = route_words(each, targets.select("source", "sid", "target"), repeats)
        self.plan = by_pattern.join(flow, "pattern").select("pattern", "words", "flow")
        first = by_pattern.select("pattern", F.col("sources").alias("s"), F.get("sources", F.lit(0)).alias("source"))
        lookup = first.join(targets, first["source"].eqNullSafe(targets["source"]), "left").select("pattern", "s", "source_size", "target")
        self.lookup = checked_broadcast(stage(lookup, "mix-lookup"))
        self.rows = self.with_pattern(base)

    def keyed(self, docs: DataFrame) -> DataFrame:
        id_col, text_col, source_col, seed = self.args
        one = F.array(qcol(source_col))
        if dict(docs.dtypes)[source_col].startswith("array"):
            one = F.coalesce(F.array_sort(F.array_distinct(qcol(source_col))), F.array().cast(dict(docs.dtypes)[source_col]))
        return docs.withColumns({"sources": one, "size": word_count(qcol(text_col)), "h": F.xxhash64(F.lit(seed), qcol(id_col), qcol(text_col))})

    def with_pattern(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.lookup, F.col("sources").eqNullSafe(F.col("s"))).drop("s")


def source_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: Sequence[float] = (3, 1, 2), share: float = 1.5, repeats: int = 2, seed: int = 2) -> DataFrame:
    """One row per document: ``(id, size, source_size, target, taken)``.

    ``size``: number of ``[^\\x20\\x09-\\x0D]+`` in the text (null or empty: 0). ``source_col`` is one source (null is a source) or an
    array of sources (a document of several sources counts in each one's size and may serve any of them; ``source_size`` and
    ``target`` are then those of its first source in order; without any, null, and nothing is taken). Targets: see
    ``source_targets``. ``taken``: words that the mix takes of the document, its size times 0 to ``repeats``. The seeded order
    hashes id and text, so reruns agree; rows that repeat both are taken together. Null ids are documents like others. Empty
    table: empty result. Columns besides the three named are ignored.
    """
    names = {"id": id_col, "text": text_col, "source": source_col}
    mix = _Mix(pick(docs, **names), "id", "text", "source", weights, share, repeats, seed)
    return choose_documents(mix.rows, mix.plan).select(F.col("id").alias(id_col), "size", "source_size", "target",
                                                       (F.col("uses") * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: Sequence[float] = (3, 1, 2), share: float = 1.5, repeats: int = 2, seed: int = 2) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as ``source_mix`` takes it. Texts aren't shuffled."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    src = docs.select(*[qcol(c).alias(a) for c, a in names.items()])
    mix = _Mix(src, names[id_col], names[text_col], names[source_col], weights, share, repeats, seed)
    chosen = choose_documents(mix.rows, mix.plan, mix.with_pattern(mix.keyed(src)))
    return (chosen.where("uses > 0").withColumn("use", F.explode(F.sequence(F.lit(1), F.col("uses"))))
            .select(*[F.col(a).alias(c) for c, a in names.items()]))

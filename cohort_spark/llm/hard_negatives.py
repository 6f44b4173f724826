"""Operator 12, hard-negative mining by coordinate pruning of inner-product searches (the LEMP scheme).

Candidates stand in length buckets: vectors of one label whose lengths differ by a factor of 0.9 at most, cut into blocks
of bounded size. A block holds, per coordinate, its unit vectors' values in sorted order. A query that asks for scores of
``low`` or more needs a cosine of at least ``low / (|query| * longest)`` in a block; on each of its focus coordinates (its
largest ones) that cosine leaves a range of feasible values, the sorted lists give the rows in each range, and only rows
in all ranges are scored exactly. Blocks too short for every query of a query block are never shipped.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_spark.llm.common import checked_broadcast, pick, stage

BLOCK, QUERIES = 8192, 1024  # candidates and queries of a comparison task
FOCUS = 6  # focus coordinates of a query
RATIO = 0.9  # shortest over longest vector of a bucket
LONG = 2**63 - 1
EXACT = 2.0**53  # below this, sums of products of integers in double precision are exact


def _read(scale: float):
    """``floor(scale * x)`` of each usable vector in the narrowest of two integer widths, and its length."""
    def run(batches):
        for b in batches:
            v = b.column("v")
            n = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            fine = np.concatenate([[0], np.cumsum(np.isfinite(flat))])
            ends = np.cumsum(n)
            ok = (fine[ends] - fine[ends - n] == n) & v.is_valid().to_numpy(zero_copy_only=False) & b.column("label").is_valid().to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", over="ignore"):
                q = np.floor(scale * flat)
            raw, norm = [None] * len(n), [0.0] * len(n)
            for i in np.flatnonzero(ok):
                x = q[ends[i] - n[i]:ends[i]]
                norm[i] = float(np.sqrt((x * x).sum())) if len(x) and np.abs(x).max() < 1e150 else float("inf") if len(x) else 0.0
                narrow = not len(x) or np.abs(x).max() < 2**15
                raw[i] = (x.astype(np.int16) if narrow else _saturated(x)).tobytes()
            at = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(at), b.column("label").take(at), pa.array(n[at], pa.int32()), pa.array([raw[i] for i in at], pa.binary()),
                 pa.array([norm[i] for i in at], pa.float64())], names=["id", "label", "dim", "raw", "norm"])
    return run


def _saturated(x: np.ndarray) -> np.ndarray:
    return np.array([max(-LONG, min(LONG, int(c))) if np.isfinite(c) else LONG if c > 0 else -LONG for c in x], np.int64)


def _matrix(raw: list[bytes], dim: int) -> np.ndarray:
    """The integer vectors as rows."""
    return np.stack([np.frombuffer(r, np.int16 if len(r) == 2 * dim else np.int64) for r in raw]).astype(np.int64)


class Bucket:
    """One block of candidates of about equal length, with sorted coordinate lists."""

    def __init__(self, vectors: np.ndarray):
        self.whole = vectors
        self.real = vectors.astype(np.float64)
        self.norms = np.sqrt((self.real * self.real).sum(axis=1))
        self.longest = float(self.norms.max(initial=0.0))
        self.unit = self.real / np.where(self.norms > 0, self.norms, 1.0)[:, None]
        self.most = float(np.abs(self.real).max(initial=0.0))
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def feasible(self, query: np.ndarray, low: int) -> np.ndarray:
        """Positions that may score ``low`` or more with ``query``: a superset."""
        n = len(self.real)
        length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        if low <= 0 or not np.isfinite(length * self.longest):
            return np.arange(n)
        if length * self.longest * (1 + 1e-9) < low:
            return np.zeros(0, np.int64)
        wide = np.arccos(min(1.0, low / (length * self.longest))) + 1e-6
        q = query / length
        focus = np.argsort(-np.abs(q), kind="stable")[:FOCUS]
        slices = []
        for f in focus:
            mid = np.arccos(np.clip(q[f], -1, 1))
            lo, hi = np.cos(min(np.pi, mid + wide)) - 1e-9, np.cos(max(0.0, mid - wide)) + 1e-9
            order, values = self._list(int(f))
            slices.append((order[np.searchsorted(values, lo, "left"):np.searchsorted(values, hi, "right")], f, lo, hi))
        slices.sort(key=lambda x: len(x[0]))
        rows = slices[0][0]
        for _, f, lo, hi in slices[1:]:
            x = self.unit[rows, f]
            rows = rows[(x >= lo) & (x <= hi)]
        return rows[self.norms[rows] * length * (1 + 1e-9) >= low]

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products with the rows (beyond a long: saturated)."""
        real = query.astype(np.float64)
        if self.most * float(np.abs(real).max(initial=0.0)) * max(1, len(query)) < EXACT:
            return (self.real[rows] @ real).astype(np.int64)
        exact = [sum(int(a) * int(b) for a, b in zip(query, v)) for v in self.whole[rows]]
        return np.array([max(-LONG, min(LONG, s)) for s in exact], np.int64)


def _first(scores: np.ndarray, rows: np.ndarray, k: int, nul: list, ids: list) -> list[int]:
    """Positions in ``rows`` of the first ``k``: highest score, then smallest id, null ids last."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        near = np.arange(len(scores))
    return sorted(near.tolist(), key=lambda i: (-int(scores[i]), nul[rows[i]], ids[rows[i]]))[:k]


HITS = "qid long, p long, nul boolean, id {id}, score long, same boolean"


def _hits(rows: list[tuple], id_type: pa.DataType) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * 6
    types = [pa.int64(), pa.int64(), pa.bool_(), id_type, pa.int64(), pa.bool_()]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["qid", "p", "nul", "id", "score", "same"])


def _block(right: pa.Table):
    dim = right.column("dim")[0].as_py()
    raw = right.column("raw").to_pylist()
    return dim, raw, Bucket(_matrix(raw, dim)), right.column("nul").to_pylist(), right.column("id").to_pylist()


def _best(k: int):
    """The first ``k`` rows of a block for every query of a query block, none below the query's ``low``."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, kind = [], right.schema.field("id").type
        if left.num_rows and right.num_rows:
            dim, raw, bucket, nul, ids = _block(right)
            own = left.column("raw").to_pylist()
            for qid, q, mine, low in zip(left.column("qid").to_pylist(), _matrix(own, dim), own, left.column("low").to_pylist()):
                rows = bucket.feasible(q, low)
                s = bucket.scores(q, rows)
                rows, s = rows[s >= low], s[s >= low]
                out += [(qid, 0, nul[rows[i]], ids[rows[i]], int(s[i]), raw[rows[i]] == mine) for i in _first(s, rows, k, nul, ids)]
        return _hits(out, kind)
    return run


def _near(k: int, margin: int):
    """The first ``k`` rows of a block in the window under each positive score ``p`` of a query."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, kind = [], right.schema.field("id").type
        if left.num_rows and right.num_rows:
            dim, _, bucket, nul, ids = _block(right)
            for qid, q, ps, low in zip(left.column("qid").to_pylist(), _matrix(left.column("raw").to_pylist(), dim), left.column("ps").to_pylist(), left.column("low").to_pylist()):
                rows = bucket.feasible(q, low)
                s = bucket.scores(q, rows)
                for p in ps:
                    least = -((-margin * p) // 100)
                    at = np.flatnonzero((s >= least) & (s <= p))
                    out += [(qid, p, nul[rows[at[i]]], ids[rows[at[i]]], int(s[at[i]]), False) for i in _first(s[at], rows[at], k, nul, ids)]
        return _hits(out, kind)
    return run


def _seed(k: int):
    """Lower bound of each query's ``k``-th best score: the ``k``-th best among the queries of its block."""
    def run(t: pa.Table) -> pa.Table:
        dim = t.column("dim")[0].as_py()
        m = _matrix(t.column("raw").to_pylist(), dim)
        bucket, every = Bucket(m), np.arange(len(m))
        low = [int(np.partition(bucket.scores(q, every), -k)[-k]) if len(m) >= k else -LONG for q in m]
        return pa.table([t.column("qid"), pa.array(low, pa.int64())], names=["qid", "low"])
    return run


def _search(queries: DataFrame, cands: DataFrame, blocks: DataFrame, same_label: bool, fn, hits: str, name: str) -> DataFrame:
    """``fn`` on every pair of a query block and a candidate block that can hold an answer; ``queries`` has ``need``, the
    length that a candidate must have."""
    q = queries.select(F.struct("label", "dim", "qb").alias("qkey"), "qid", "raw", "low", "need", *[c for c in ("ps",) if c in queries.columns])
    heads = q.groupBy("qkey").agg(F.min("need").alias("need"))
    label = F.col("qkey.label") == F.col("ckey.label")
    pairs = stage(heads.join(blocks, (F.col("qkey.dim") == F.col("ckey.dim")) & (label if same_label else ~label) & (F.col("longest") >= F.col("need")))
                  .select("qkey", "ckey", "longest").withColumn("pair", F.monotonically_increasing_id()), name + "-pairs")
    n = pairs.count()
    left = q.join(checked_broadcast(pairs.select("qkey", "pair", "longest"), n), "qkey").where("longest >= need").drop("qkey", "longest", "need")
    right = cands.join(checked_broadcast(pairs.select("ckey", F.col("pair").alias("met")), n), "ckey").select("met", "dim", "raw", "nul", "id")
    return left.groupBy("pair").cogroup(right.groupBy("met")).applyInArrow(fn, hits)


def hard_negatives(vecs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   is_anchor: Callable[[Column], Column] = lambda i: i % 100 == 0, scale: float = 256.0, positives: int = 5,
                   negatives: int = 5, margin: int = 80) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``, ``rank`` from 1.

    Components become ``floor(scale * x)``; a score is the integer inner product with the anchor, higher first, ties by
    smaller id (null ids last). An anchor's positives are its first ``positives`` other rows of the same label; for each,
    the first ``negatives`` rows of another label with ``margin * positive_score <= 100 * negative_score <= 100 *
    positive_score`` are returned (so none for a negative positive_score). Rows with a null label, a null vector or a null or
    non-finite component take no part; vectors are compared within their dimension only. Rows that repeat id, label and
    vector are one row; an id with several vectors is as many rows, and an anchor may be a positive of its other vector.
    Null ids are no anchors but may be returned. Components and scores beyond a long saturate. Empty table: empty result.
    Columns besides the three named are ignored.

    Of rows with equal label and vector only the first ``positives + 1`` ids can ever be returned, so a hot vector is cut to
    those in the tasks that read it, and equal anchors are searched once. Work is dealt in pairs of bounded blocks; a task
    returns a query's first rows of its block, and these are reduced map-side. Staged tables hold every input row once.
    """
    src = pick(vecs, id=id_col, v=vec_col, label=label_col)
    kinds = dict(src.dtypes)
    rows = stage(src.mapInArrow(_read(scale), f"id {kinds['id']}, label {kinds['label']}, dim int, raw binary, norm double")
                 .groupBy("id", "label", "dim", "raw").agg(F.first("norm").alias("norm")), "negatives-rows")
    most = max(positives + 1, negatives)
    order = Window.partitionBy("label", "dim", "raw").orderBy(F.col("id").asc_nulls_last())
    kept = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).drop("r")
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / F.lit(-np.log(RATIO)))).otherwise(F.lit(-1)).cast("long")
    kept = stage(kept.withColumn("bucket", F.coalesce(bucket, F.lit(-1))), "negatives-candidates")
    blocks = stage(kept.groupBy("label", "dim", "bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("nb"), F.max("norm").alias("longest")), "negatives-buckets")
    nul = F.col("id").isNull()
    spare = {"string": F.lit(""), "binary": F.lit(b"")}.get(kinds["id"], F.lit(0)).cast(kinds["id"])
    cands = (kept.join(checked_broadcast(blocks), ["label", "dim", "bucket"])
             .select(F.struct("label", "dim", "bucket", F.pmod(F.xxhash64("id", "raw"), "nb").alias("block")).alias("ckey"),
                     "dim", "raw", nul.alias("nul"), F.coalesce("id", spare).alias("id")))
    blocks = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("block"), "*").select(
        F.struct("label", "dim", "bucket", "block").alias("ckey"), "longest")

    anchors = rows.where(is_anchor(F.col("id"))).withColumnRenamed("id", "anchor_id")
    asked = stage(anchors.groupBy("label", "dim", "raw").agg(F.first("norm").alias("norm")).withColumn("qid", F.monotonically_increasing_id()), "negatives-queries")
    heads = stage(asked.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("nq")), "negatives-query-labels")
    asked = asked.join(checked_broadcast(heads), ["label", "dim"]).withColumn("qb", F.pmod(F.xxhash64("qid"), "nq")).drop("nq")
    anchors = stage(anchors.join(asked.select("label", "dim", "raw", "qid"), ["label", "dim", "raw"]).select("anchor_id", "qid"), "negatives-anchors")

    length = F.when(F.col("low") > 0, F.col("low") / F.col("norm") * (1 - 1e-9)).otherwise(F.lit(-1.0))
    lows = asked.select("qid", "dim", "raw", "label", "qb").groupBy("label", "dim", "qb").applyInArrow(_seed(positives + 1), "qid long, low long")
    queries = stage(asked.join(lows, "qid").withColumn("need", length), "negatives-seeded")
    hits = HITS.format(id=kinds["id"])
    found = _search(queries, cands, blocks, True, _best(positives + 1), hits, "positives")
    lists = _lists(found, ["qid"], positives + 1)
    itself = F.filter("hits", lambda x: ~(x["same"] & ~x["nul"] & (x["id"] == F.col("anchor_id"))))
    pos = stage(anchors.join(lists, "qid").select("anchor_id", "qid", F.explode(F.slice(itself, 1, positives)).alias("h"))
                .select("anchor_id", "qid", F.when(~F.col("h.nul"), F.col("h.id")).alias("positive_id"), (-F.col("h.minus")).alias("positive_score")), "positives")

    windows = pos.where("positive_score >= 0").groupBy("qid").agg(F.collect_set("positive_score").alias("ps"))
    lowest = F.array_min("ps")
    least = (F.ceil(lowest.cast("decimal(38,0)") * margin / 100)).cast("long")
    queries = stage(asked.join(windows, "qid").withColumn("low", least).withColumn("need", length), "negatives-windows")
    near = _lists(_search(queries, cands, blocks, False, _near(negatives, margin), hits, "negatives"), ["qid", "p"], negatives)
    return (pos.join(near.withColumnRenamed("p", "positive_score"), ["qid", "positive_score"])
            .select("anchor_id", "positive_id", F.posexplode("hits").alias("at", "h"), "positive_score")
            .select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.when(~F.col("h.nul"), F.col("h.id")).alias("negative_id"),
                    "positive_score", (-F.col("h.minus")).alias("negative_score")))


def _lists(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` hits per key as one sorted array; tasks cut to ``k`` before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "nul", "id")
    first = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    return first.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "nul", "id", "same"))).alias("hits"))

"""Operator 3, embedding near-dedup by collision counting over sorted one-dimensional projections.

Two unit vectors at distance r differ by at most r in all on orthonormal directions, so on fewer than ``r**2 / w**2`` of
them by more than ``w``. Each side of a comparison is sorted on every projection; a vector opens a window of half-width
``w`` around its own value in each, and a pair collides as often as one lies in the other's window. Every pair within r
reaches ``min_hits`` collisions, and pairs that do are verified with the exact cosine: no link is lost.

Every pair of a label is judged, in blocks of bounded size, whatever the label's size: whether a pair is linked
depends on its two vectors alone.
"""

from __future__ import annotations

import hashlib
from math import ceil, comb, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.common import checked_broadcast, join_parts, pick, stage
from cohort_spark.llm.components import connected_components

CHUNK = 64  # vectors of the left side that are compared at once
NUMBERS = 4_000_000  # components of candidate pairs that are verified at once


def window_plan(cosine: float, projections: int, recall: float) -> tuple[float, int]:
    """Window half-width (two standard deviations at the threshold) and the collision count calibrated for Gaussian
    directions. Not used by :func:`embedding_dedup`, whose plan loses no pair (:func:`collision_plan`)."""
    half = 2 * sqrt(2 - 2 * cosine)
    p = erf(2 / sqrt(2))

    def tail(k):
        return sum(comb(projections, i) * p**i * (1 - p)**(projections - i) for i in range(k, projections + 1))

    return half, max(k for k in range(1, projections + 1) if k == 1 or tail(k) >= recall)


def collision_plan(cosine: float, directions: int) -> tuple[float, float, int]:
    """Distance at the threshold, window half-width and collisions that every pair at the threshold reaches on
    orthonormal directions, with room for rounding: one miss is allowed, as more windows would have to be wider."""
    misses = min(1, directions - 1)
    reach = sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-9) + 1e-7
    return reach, reach / sqrt(misses + 1) * (1 + 1e-9), directions - misses


def table_plan(n: int, cosine: float, recall: float, cell: int) -> tuple[int, int]:
    """Leading projections and tables for a label of ``n`` vectors: a cell of width 1 holds at most ~0.4 of a
    standard normal and keeps a threshold pair together with probability ``1 - E|difference|``. Not used by
    :func:`embedding_dedup`: tables that depend on ``n`` would make a pair's link depend on the other rows."""
    lead = max(0, ceil(log(max(n, 1) / cell) / log(1 / 0.4))) if n > cell else 0
    meet = (1 - sqrt(2 - 2 * cosine) * sqrt(2 / np.pi)) ** lead
    return lead, 1 if lead == 0 else ceil(log(1 - recall) / log(1 - meet))


def _clean(v) -> np.ndarray | None:
    if v is None or not len(v) or any(x is None for x in v):
        return None
    x = np.asarray(v, np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    return x + 0.0  # -0.0 and 0.0 are one value


def _read(batches):
    """Digest and bytes of each usable vector (null, zero or non-finite ones: none)."""
    for b in batches:
        digests, dims, raw = [], [], []
        for v, label in zip(b.column("v"), b.column("label")):
            x = _clean(v.as_py()) if label.is_valid else None
            raw.append(None if x is None else x.tobytes())
            dims.append(0 if x is None else len(x))
            digests.append(None if x is None else hashlib.blake2b(raw[-1], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(dims, pa.int32()),
                                          pa.array(digests, pa.binary()), pa.array(raw, pa.binary())],
                                         names=["id", "label", "dim", "digest", "raw"])


def _directions(seed: int, dim: int, first: int, n: int) -> np.ndarray:
    """Gaussian directions number ``first`` to ``first + n - 1`` of dimension ``dim``, the same in every task."""
    return np.stack([np.random.default_rng([seed, dim, first + i]).standard_normal(dim) for i in range(n)], 1)


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(r, np.float64) for r in raw])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _windows(values: np.ndarray, others: np.ndarray, half: float):
    """On one projection: the place of each of ``others`` in sorted order, and of each of ``values`` its window's first place and length."""
    order = np.argsort(others, kind="stable")
    kind = np.uint16 if len(others) < 2**16 else np.uint32
    place = np.empty(len(others), kind)
    place[order] = np.arange(len(others), dtype=kind)
    ranked = others[order]
    first = np.searchsorted(ranked, values - half, "left")
    return place, first.astype(kind), (np.searchsorted(ranked, values + half, "right") - first).astype(kind)


def _linked(u: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float, projections: int, seed: int):
    """The linked pairs of rows ``left`` and ``right`` of ``u`` (each once if both are the same), in bounded pieces."""
    own = left is right
    basis = np.linalg.qr(_directions(seed, u.shape[1], 0, min(projections, u.shape[1])))[0]
    reach, half, min_hits = collision_plan(cosine, basis.shape[1])
    p = u @ basis
    right = right[np.argsort(p[right, 0], kind="stable")]
    left = right if own else left[np.argsort(p[left, 0], kind="stable")]
    windows = [_windows(x, y, half) for x, y in zip(p[left].T, p[right].T)]
    line, step = p[right, 0], max(1, NUMBERS // u.shape[1])
    for at in range(0, len(left), CHUNK):
        some = left[at:at + CHUNK]
        low = int(np.searchsorted(line, p[some[0], 0] - reach, "left"))  # beyond reach on one direction: no link
        high = int(np.searchsorted(line, p[some[-1], 0] + reach, "right"))
        if own:
            low = max(low, at)
        hits = np.zeros((len(some), high - low), np.uint8 if projections < 256 else np.uint16)
        for place, first, length in windows:  # before the window's first place, the unsigned difference is beyond its length
            hits += (place[None, low:high] - first[at:at + CHUNK, None]) < length[at:at + CHUNK, None]
        x, y = np.nonzero(hits >= min_hits)
        y += low
        if own:
            x, y = x[y > x + at], y[y > x + at]
        for i in range(0, len(x), step):
            a, b = some[x[i:i + step]], right[y[i:i + step]]
            ok = np.einsum("ij,ij->i", u[a], u[b]) >= cosine
            yield a[ok], b[ok]


def _compare(cosine: float, projections: int, seed: int):
    def run(key, pdf):
        import pandas as pd

        _, _, i, j = key
        pdf = pdf.sort_values("cid", ignore_index=True)
        blk = pdf["block"].to_numpy()
        left = np.flatnonzero(blk == i)
        right = left if i == j else np.flatnonzero(blk == j)
        counts, edges = np.zeros((0, 2), np.int64), np.zeros((0, 2), np.int64)
        if len(left) and len(right):
            cid, copies = pdf["cid"].to_numpy(), pdf["copies"].to_numpy()
            links, part = np.zeros(len(pdf)), np.arange(len(pdf))
            for a, b in _linked(_unit(list(pdf["raw"])), left, right, cosine, projections, seed):
                links += np.bincount(a, copies[b], len(pdf)) + np.bincount(b, copies[a], len(pdf))
                part = join_parts(part, a, b)
            some = np.flatnonzero(links)
            counts = np.stack([cid[some], links[some].astype(np.int64)], 1)
            some = np.flatnonzero(part != np.arange(len(pdf)))
            edges = np.stack([cid[some], cid[part[some]]], 1)
        return pd.DataFrame({"a": np.concatenate([counts[:, 0], edges[:, 0]]),
                             "b": pd.array([None] * len(counts) + edges[:, 1].tolist(), "Int64"),
                             "n": np.concatenate([counts[:, 1], np.zeros(len(edges), np.int64)])})
    return run


def embedding_dedup(vecs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = 0.98, projections: int = 16, recall: float = 0.995, cell: int = 4096,
                    seed: int = 3) -> DataFrame:
    """One row per vector: ``(id, n_links, component_id, kept)``.

    Vectors of one label (and one dimension) are linked when their cosine, in double precision, is at least
    ``cosine``. ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id
    reachable, ``kept`` is ``id = component_id``. Null, empty or zero vectors, vectors with a null or non-finite
    component, and vectors without a label link with nothing. Null ids are judged like others but can't be the
    smallest id. Rows that repeat an id each count as a vector. Empty table: empty result. Columns besides the
    three named are ignored.

    Equal vectors are one class, counted map-side. All classes of a label are compared, in blocks of about ``cell``,
    every block pair its own task; a task returns each vector's link count and a spanning forest, so neither a label
    nor its pairs are ever gathered or emitted. The work grows with the square of a label's distinct vectors, by a few
    comparisons of two-byte places a pair. Every link is found, so any ``recall`` is met.
    """
    src = pick(vecs, id=id_col, v=vec_col, label=label_col)
    rows = stage(src.mapInArrow(_read, f"id long, label {dict(src.dtypes)['label']}, dim int, digest binary, raw binary"),
                 "vectors")
    cls = stage(rows.where("digest is not null").groupBy("label", "dim", "digest")
                .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw"))
                .withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    sizes = stage(cls.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size")), "vector-labels")
    blocks = sizes.where("size > 1").select("label", "dim", F.ceil(F.col("size") / cell).alias("nb"))
    placed = (cls.select("cid", "label", "dim", "copies", "raw").join(checked_broadcast(blocks, sizes.count()), ["label", "dim"])
              .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("nb")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
              .select("cid", "label", "dim", "copies", "raw", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    found = stage(placed.groupBy("label", "dim", "i", "j")
                  .applyInPandas(_compare(cosine, projections, seed), "a long, b long, n long"), "vector-links")
    comp = connected_components(found.where("b is not null").select("a", "b"))
    links = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("more"))
    merged = (cls.select("cid", "label", "dim", "digest", "rep", "copies").join(links, "cid", "left")
              .join(comp, F.col("cid") == F.col("node"), "left")
              .withColumn("root", F.coalesce("root", "cid")))
    lowest = merged.groupBy("root").agg(F.min("rep").alias("component"))
    merged = merged.join(lowest, "root").select("label", "dim", "digest", "component", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    out = rows.select("id", "label", "dim", "digest").join(merged, ["label", "dim", "digest"], "left")
    component = F.when(F.col("digest").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))

"""Helpers shared by the operators: staged tables, size-checked joins, word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.session import scratch_path

BROADCAST_ROWS = 200_000  # a side is broadcast only when its counted rows are at most this many (narrow rows)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back: later steps
    start from committed files, so a lost executor costs no recomputation of what came before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its row count is at most ``limit``, else ``df`` itself, which
    Spark then joins by shuffle (splitting skewed partitions). ``df`` should be staged."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def sorted_join(df: DataFrame) -> DataFrame:
    """``df`` with the hint that its next join is a sort-merge join. For joins with exploded rows: Spark takes an exploded
    table for as large as its source and would gather it at the driver to broadcast it. Skewed partitions are still split."""
    return df.hint("merge")


def pick(df: DataFrame, **cols: str):
    """Only the named columns under internal names, so that further columns cannot clash."""
    return df.select(*[qcol(c).alias(a) for a, c in cols.items()])


def by_batch(fn: Callable[[dict], Iterator[pa.RecordBatch]]):
    """Adapter for ``mapInArrow`` over a per-batch generator."""
    def run(batches):
        for b in batches:
            yield from fn(b)
    return run


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Edges ``(node, smallest node of its part)`` that join exactly what the boolean matrix
    ``linked[left, right]`` joins; at most one edge per node, however dense the matrix."""
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return np.zeros((0, 2), np.int64)
    m, top = linked[np.ix_(rows, cols)], np.iinfo(np.int64).max
    a, b = left[rows].astype(np.int64), right[cols].astype(np.int64)
    low_a, low_b = a.copy(), b.copy()
    while True:
        next_a = np.minimum(low_a, np.where(m, low_b[None, :], top).min(axis=1))
        next_b = np.minimum(low_b, np.where(m, next_a[:, None], top).min(axis=0))
        if (next_a == low_a).all() and (next_b == low_b).all():
            break
        low_a, low_b = next_a, next_b
    out = np.concatenate([np.stack([a, low_a], 1), np.stack([b, low_b], 1)])
    return np.unique(out[out[:, 0] != out[:, 1]], axis=0)


def join_parts(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``part`` (each node's smallest known node) after the edges ``(a, b)``; the time follows the number of edges."""
    while len(a):
        x, y = part[a], part[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(part, np.maximum(x, y), np.minimum(x, y))
        while (part[part] != part).any():
            part = part[part]
    return part


MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX2
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of byte words, with a bounded cache of the words seen."""

    def __init__(self, limit: int = 500_000):
        import xxhash

        self._one, self._limit, self._seen = xxhash.xxh64_intdigest, limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        seen, one = self._seen, self._one
        if len(seen) > self._limit:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = one(w)
        return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


WINDOW_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (a whole shorter sequence counts as one run;
    no words: none)."""
    k = len(word_hashes)
    if k == 0:
        return word_hashes
    width = min(n, k)
    h = np.zeros(k - width + 1, np.uint64)
    for i in range(width):
        h = h * WINDOW_FACTOR + word_hashes[i:k - width + 1 + i]
    return mix64(h + np.uint64(width))

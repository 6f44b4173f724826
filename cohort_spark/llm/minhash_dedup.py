"""Operator 9, MinHash near-dedup by tensored banding.

A usual banding scheme of L tables with k minhashes each computes L*k minhashes. Here two small
collections of ``halves`` half-keys (``rows`` minhashes each) are drawn and every pair (first half i,
second half j) forms the key of one table: ``halves**2`` tables of ``2*rows`` minhashes from only
``2*halves*rows`` minhashes (64 tables from 48 hash functions instead of 384). Two sets of similarity
s share a table with probability (1 - (1 - s**rows)**halves)**2: 0.999 at 0.85 with the defaults.
Candidates are confirmed on full shingle sets; links are decided by exact set sizes, never by the sketch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.common import WordHasher, checked_broadcast, forest, mix64, pick, sorted_join, stage, window_hashes
from cohort_spark.llm.components import connected_components

BLOCK = 512  # documents per side of a block comparison
HASH_CHUNK = 8192  # shingles hashed at once, bounds memory for very long texts
SLICE = 512  # documents whose sketches or sets a task holds before it sends them on
CACHED_WORDS = 100_000
WANTED_ROWS = 500_000  # rows (two ids and a digest) that are broadcast to leave the texts where they are


def _slices(batches):
    for b in batches:
        for i in range(0, b.num_rows, SLICE):
            yield b.slice(i, SLICE)


def _shingles(text: bytes | None, hasher: WordHasher, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; bytes.lower and bytes.split touch ASCII only."""
    return np.unique(window_hashes(hasher(text.lower().split()), n)) if text else np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _half_keys(s: np.ndarray, mult: np.ndarray, add: np.ndarray, rows: int) -> np.ndarray:
    low = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), HASH_CHUNK):
        np.minimum(low, (mult[:, None] * s[None, i:i + HASH_CHUNK] + add[:, None]).min(axis=1), out=low)
    h = np.zeros(len(mult) // rows, np.uint64)
    for part in low.reshape(-1, rows).T:
        h = mix64(h + part)
    return h.view(np.int64)


def _sketch(n: int, halves: int, rows: int, seed: int):
    rng = np.random.default_rng(seed)
    mult = rng.integers(0, 2**63, 2 * halves * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, 2 * halves * rows, dtype=np.uint64)

    def run(batches):
        hasher = WordHasher(CACHED_WORDS)
        for b in _slices(batches):
            sizes, digests, keys = [], [], []
            for text in b.column("text"):
                s = _shingles(text.as_py(), hasher, n)
                sizes.append(len(s))
                digests.append(_digest(s) if len(s) else None)
                keys.append(_half_keys(s, mult, add, rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "digest", "halves"])
    return run


def _sets(n: int):
    """The full shingle sets of the wanted documents (rows whose digest is another text's are skipped)."""
    def run(batches):
        hasher = WordHasher(CACHED_WORDS)
        for b in _slices(batches):
            cids, sets = [], []
            for text, digest, cid in zip(b.column("text"), b.column("digest"), b.column("cid")):
                s = _shingles(text.as_py(), hasher, n)
                if len(s) and _digest(s) == digest.as_py():
                    cids.append(cid.as_py())
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["cid", "shingles"])
    return run


def _similar(sa: str, sb: str, percent: int):
    inter = F.size(F.array_intersect(sa, sb)).cast("long")
    return F.lit(100) * inter >= F.lit(percent) * (F.size(sa) + F.size(sb) - inter)


def _block_links(percent: int):
    """Exact similarities of two blocks by products of shingle incidence matrices; gives only edges that
    join parts not yet joined in this block pair (a spanning forest)."""
    def run(key, pdf):
        import pandas as pd

        _, i, j = key
        pdf = pdf.sort_values("cid", ignore_index=True)
        cid, comp, blk = pdf["cid"].to_numpy(), pdf["comp"].to_numpy(), pdf["block"].to_numpy()
        out = np.zeros((0, 2), np.int64)
        left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        if len(left) and len(right) and len(np.unique(comp)) > 1:
            sets = [np.asarray(x) for x in pdf["shingles"]]
            sizes = np.array([len(x) for x in sets], np.int64)
            values, counts = np.unique(np.concatenate(sets), return_counts=True)
            values = values[counts > 1]  # a shingle of one document adds to no intersection
            cols = [np.searchsorted(values, x[np.isin(x, values, assume_unique=True)]) for x in sets]
            inter = np.zeros((len(left), len(right)), np.float32)
            for c in range(0, len(values), 4096):
                a, b = (np.zeros((len(side), min(4096, len(values) - c)), np.float32) for side in (left, right))
                for m, side in ((a, left), (b, right)):
                    for r, k in enumerate(side):
                        w = cols[k]
                        m[r, w[(w >= c) & (w < c + 4096)] - c] = 1
                inter += a @ b.T
            inter = inter.astype(np.int64)
            union = sizes[left][:, None] + sizes[right][None, :] - inter
            ok = (100 * inter >= percent * union) & (comp[left][:, None] != comp[right][None, :])
            out = forest(ok, cid[left], cid[right])
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    return run


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 85,
                  halves: int = 8, rows: int = 3, seed: int = 9) -> DataFrame:
    """One row per document: ``(id, n_shingles, component_id, kept)``.

    Documents are linked when ``100 * |A and B| >= percent * |A or B|`` on their sets of ``n``-word shingles
    (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``; fewer words: the whole sequence is the one shingle).
    ``component_id`` is the smallest id reachable by links, ``kept`` is ``id = component_id``.

    1. Sketch each text, write ids, set sizes, set digests and half-keys (no sets).
    2. Equal sets are one class (aggregated map-side), so exact copies of any number cost one class.
    3. All pairs of half-keys form table keys; buckets with one class vanish.
    4. Each class is compared on full sets with its three likeliest bucket heads (linear in the classes).
    5. Buckets that still hold several components are clustered, and within each cluster blocks of at
       most ~512 classes are compared with each other by exact set sizes, each block pair its own task,
       which gives a spanning forest of links. So no bucket or cluster is ever gathered whole, and no
       pairs within a group are emitted.
    6. Components of all links; exact copies take their class's component.

    Null or empty text, or no words: size 0, linked with nothing. Null id: judged like the others, but can't
    be the smallest id; ``component_id`` is null if no id is reachable, and ``kept`` is true only then. Rows
    that repeat an id each give a row. Columns besides the two named are ignored. Empty table: empty result.
    """
    src = pick(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("binary"))
    sk = stage(src.mapInArrow(_sketch(n, halves, rows, seed), "id long, n long, digest binary, halves array<long>"),
               "minhash")
    cls = stage(sk.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.first("halves").alias("halves"))
                .withColumn("cid", F.monotonically_increasing_id()), "minhash-classes")

    pairs = F.expr(f"transform(sequence(0, {halves * halves - 1}), t -> xxhash64(t, halves[int(t / {halves})], "
                   f"halves[{halves} + t % {halves}]))")
    tables = cls.where("rep is not null").select("cid", F.explode(pairs).alias("key"))
    heads = tables.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("cid").alias("head")).where("c > 1")
    members = stage(tables.join(sorted_join(heads.select("key", "head")), "key"), "minhash-buckets")

    wanted = stage(members.select("cid").distinct().join(cls.select("cid", "rep", "digest"), "cid"), "minhash-wanted")
    sets = stage(src.join(checked_broadcast(wanted, limit=WANTED_ROWS), F.col("id") == F.col("rep"))
                 .select("cid", "digest", "text").mapInArrow(_sets(n), "cid long, shingles array<long>")
                 .dropDuplicates(["cid"]), "minhash-sets")

    def best(k):
        votes = members.where("cid <> head").groupBy("cid", "head").agg(F.count(F.lit(1)).alias("c"))
        ranked = votes.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct(-F.col("c"), "head"))).alias("h"))
        return ranked.select("cid", F.explode(F.slice("h", 1, k)).alias("h")).select("cid", F.col("h.head").alias("head"))

    a = sets.select(F.col("cid").alias("head"), F.col("shingles").alias("sa"))
    first = stage(best(3).join(sorted_join(a), "head").join(sorted_join(sets), "cid").where(_similar("sa", "shingles", percent))
                  .select(F.col("cid").alias("a"), F.col("head").alias("b")), "minhash-links")
    comp = connected_components(first)
    labelled = members.join(comp, F.col("cid") == F.col("node"), "left").select(
        "key", "cid", "head", F.coalesce("root", "cid").alias("comp"))
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    open_ = stage(labelled.join(mixed.select("key"), "key", "left_semi"), "minhash-open")
    clusters = connected_components(open_.select(F.col("cid").alias("a"), F.col("head").alias("b")))
    clusters = stage(clusters.select(F.col("node").alias("cid"), F.col("root").alias("cluster")), "minhash-clusters")
    blocks = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("nb"))
    placed = (clusters.join(blocks, "cluster").join(open_.groupBy("cid").agg(F.min("comp").alias("comp")), "cid")
              .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("nb")))
              .select("cid", "comp", "cluster", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("other"))
              .select("cid", "comp", "cluster", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    rest = (placed.join(sorted_join(sets), "cid").groupBy("cluster", "i", "j")
            .applyInPandas(_block_links(percent), "a long, b long"))
    links = connected_components(first.unionAll(rest))
    reps = cls.join(links, F.col("cid") == F.col("node"), "left").select("digest", "rep", F.coalesce("root", "cid").alias("root"))
    lowest = reps.groupBy("root").agg(F.min("rep").alias("component_id"))
    out = sk.select("id", "n", "digest").join(reps.join(lowest, "root").select("digest", "component_id"), "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))

"""Operator 4, byte-level BPE by a global shuffle of distinct words.

Texts are split into pre-tokens. The distinct pre-tokens of each block of texts are shuffled by word (in rows that hold a
block's words of one hash bucket); where equal words of all blocks meet they are encoded once, and the ids go back to
their blocks, in which every text is reassembled by the positions of its words. A word therefore crosses the network once
per block instead of once per occurrence, so no word is hot. Decoding joins the ids with the token-byte table, which has one
row per token.

The rank file is a parameter; it is read on the driver and broadcast (one entry per token of the vocabulary). Inputs must be
stable tables (files, checkpoints): the blocks are formed twice, once for the words and once for the positions, and are
keyed by their content, so that a mismatch would raise an error instead of giving wrong ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_spark.llm.common import pick

BLOCK_CHARS = 12_000_000  # a block ends once its texts have so many characters; it holds at least one text
CHUNK = 200_000  # words of a text that are reassembled at once


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def bpe(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: adjacent parts with the lowest rank merge first, the leftmost among equals."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n > 100:
        return _bpe_long(word, ranks)
    none = len(ranks) + 1
    parts = [word[i:i + 1] for i in range(n)]
    pairs = [ranks.get(word[i:i + 2], none) for i in range(n - 1)]
    while pairs and (best := min(pairs)) != none:
        i = pairs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _bpe_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long words in O(n log n): a heap of pairs over a linked list of parts."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n

    def pair(i):
        j = after[i]
        return ranks.get(word[i:end[j]]) if j < n else None

    heap = [(r, i, end[after[i]]) for i in range(n - 1) if (r := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop or pair(i) != r:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, end[j], after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and (p := pair(k)) is not None:
                heapq.heappush(heap, (p, k, end[after[k]]))
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


WHITE_AT_SPACE = re.compile(r"\s |[ ]\s|^ | $")  # where a space is next to white space, or ends the text
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def segments(s: str) -> list[str]:
    """The text cut at its single spaces between non-space characters. No pre-token runs across such a place, and each
    begins with the space, so a segment's pre-tokens don't depend on its neighbours and need to be found once per block."""
    return LONE_SPACE.split(s) if WHITE_AT_SPACE.search(s) else s.split(" ")


class _Block:
    """Distinct segments (first ones of texts, and others, which follow a space) and a digest of the content as key;
    with ``places``, also the ids and the segment numbers of each text."""

    def __init__(self, places: bool):
        self.size, self._digest, self.texts, self.ids = 0, hashlib.blake2b(digest_size=8), [], []
        count = itertools.count()
        self.first: dict = defaultdict(count.__next__) if places else {}
        self.after: dict = defaultdict(count.__next__) if places else {}
        self._places = places

    def add(self, i, s: str) -> None:
        self._digest.update(repr((i.as_py(), len(s))).encode())
        self._digest.update(s.encode("utf-8", "surrogatepass"))
        parts = segments(s)
        if self._places:
            self.ids.append(i)
            where = np.empty(len(parts), np.int32)
            where[0] = self.first[parts[0]]
            where[1:] = np.fromiter(map(self.after.__getitem__, parts[1:]), np.int32, len(parts) - 1)
            self.texts.append(where)
        else:
            self.first[parts[0]] = 0
            self.after.update(dict.fromkeys(parts[1:], 0))
        self.size += max(1, len(s))

    def key(self) -> int:
        return int.from_bytes(self._digest.digest(), "little", signed=True)

    def words(self, split) -> dict[str, int]:
        """The distinct pre-tokens; with ``places``, also ``flat`` and ``start``: word numbers of each segment."""
        number: dict = defaultdict(itertools.count().__next__)
        if not self._places:
            for p in self.first:
                for w in split(p):
                    number[w]
            for p in self.after:
                for w in split(" " + p):
                    number[w]
            return number
        found: list = [None] * (len(self.first) + len(self.after))
        for p, k in self.first.items():
            found[k] = [number[w] for w in split(p)]
        for p, k in self.after.items():
            found[k] = [number[w] for w in split(" " + p)]
        self.start = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
        self.flat = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(self.start[-1]))
        return number


def _blocks(batches, pattern: str, places: bool):
    import regex

    split, block = regex.compile(pattern).findall, _Block(places)
    for b in batches:
        for i, text in zip(b.column("id"), b.column("text")):
            block.add(i, text.as_py() or "")
            if block.size >= BLOCK_CHARS:
                yield block, block.words(split)
                block = _Block(places)
    if block.size:
        yield block, block.words(split)


def _by_bucket(words, buckets: int) -> list[list[bytes]]:
    """The words of a block by hash bucket, sorted: the same order wherever it is formed."""
    out: list[list[bytes]] = [[] for _ in range(buckets)]
    for w in words:
        raw = w.encode("utf-8", "surrogatepass")
        out[zlib.crc32(raw) % buckets].append(raw)
    for x in out:
        x.sort()
    return out


def _pack(x: np.ndarray) -> bytes:
    """Numbers as four byte planes, compressed (high planes are mostly zero)."""
    return pa.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def _unpack(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(raw, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _words_out(pattern: str, buckets: int):
    """A row per block and hash bucket with its words (lengths, bytes)."""
    def run(batches):
        for block, words in _blocks(batches, pattern, False):
            rows = [(k, x) for k, x in enumerate(_by_bucket(words, buckets)) if x]
            raw = [b"".join(x) for _, x in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.key()] * len(rows), pa.int64()), pa.array([k for k, _ in rows], pa.int32()), pa.array([len(x) for _, x in rows], pa.int64()),
                 pa.array([_pack(np.array([len(w) for w in x])) for _, x in rows], pa.binary()), pa.array([len(r) for r in raw], pa.int64()),
                 pa.array([pa.compress(r, codec="zstd", asbytes=True) for r in raw], pa.binary())], names=["block", "bucket", "n", "sizes", "n_bytes", "raw"])
    return run


def _texts_out(pattern: str, buckets: int):
    """Per text the numbers of its words (by falling frequency in the block, which packs well), and per block, as a row with
    ``n = -1 - number of words``, the place of each number among the words as ``_words_out`` orders them."""
    def run(batches):
        for block, number in _blocks(batches, pattern, True):
            uses = np.bincount(np.concatenate(block.texts), minlength=len(block.start) - 1)
            counts = np.bincount(block.flat, np.repeat(uses, np.diff(block.start)), minlength=len(number)) if len(number) else np.zeros(0)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(number), np.int64)
            rank[order] = np.arange(len(number))
            ordered = [w for x in _by_bucket(number, buckets) for w in x]
            place = {w: k for k, w in enumerate(ordered)}
            names = np.fromiter((place[w.encode("utf-8", "surrogatepass")] for w in number), np.int64, len(number))  # by number
            kind, key = block.ids[0].type, block.key()
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([None], kind), pa.array([-1 - len(number)], pa.int64()),
                                              pa.array([_pack(names[order])], pa.binary())], names=["block", "id", "n", "places"])
            for at in range(0, len(block.ids), 2_000):
                part = [rank[_gather(block.flat, block.start, t)] for t in block.texts[at:at + 2_000]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(part), pa.int64()), pa.array([i.as_py() for i in block.ids[at:at + 2_000]], kind),
                     pa.array([len(t) for t in part], pa.int64()), pa.array([_pack(t) for t in part], pa.binary())],
                    names=["block", "id", "n", "places"])
    return run


def _encode_buckets(ranks):
    """Ids of the words of each row. Rows of a bucket arrive together; a distinct word is encoded once."""
    def run(batches):
        table, known, now = ranks.value, {}, None
        for b in batches:
            sizes, packed, ids_n = [], [], []
            for bucket, n, lengths, n_bytes, raw in zip(*(b.column(c).to_pylist() for c in ("bucket", "n", "sizes", "n_bytes", "raw"))):
                if bucket != now:
                    known, now = {}, bucket
                data, at, flat, counts = pa.decompress(raw, n_bytes, codec="zstd", asbytes=True), 0, [], []
                for k in _unpack(lengths, n).tolist():
                    w = data[at:at + k]
                    at += k
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = bpe(w, table)
                    flat += ids
                    counts.append(len(ids))
                sizes.append(_pack(np.array(counts)))
                packed.append(_pack(np.array(flat)))
                ids_n.append(len(flat))
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("bucket"), b.column("n"), pa.array(sizes, pa.binary()),
                                              pa.array(ids_n, pa.int64()), pa.array(packed, pa.binary())], names=["block", "bucket", "n", "sizes", "n_ids", "ids"])
    return run


def _gather(flat: np.ndarray, start: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start[i]:start[i + 1]]`` for each i of ``which``, one after the other."""
    size = start[which + 1] - start[which]
    total = np.cumsum(size)
    return flat[np.repeat(start[which] - (total - size), size) + np.arange(total[-1] if len(total) else 0)]


def _pieces(parts: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray]:
    width = np.dtype(dtype).itemsize
    return (np.frombuffer(b"".join(parts), dtype), np.concatenate([[0], np.cumsum([len(p) // width for p in parts], dtype=np.int64)]))


def _reassemble(tokens, digests: bool):
    """Texts of a block from its words' ids; with ``digests`` only hashes of the ids and of the decoded bytes."""
    def run(key, texts, words):
        import pandas as pd

        words = words.drop_duplicates("bucket").sort_values("bucket")  # equal blocks send equal rows
        order = texts[texts["n"] < 0]
        texts = texts[texts["n"] >= 0]
        n_words = -1 - int(order["n"].iloc[0])
        if int(words["n"].sum()) != n_words:
            raise RuntimeError(f"block {key[0]} was formed differently for words and positions: the input is not a stable table")
        flat = np.concatenate([_unpack(r, n) for r, n in zip(words["ids"], words["n_ids"])] or [np.zeros(0, np.int64)]).astype("<u4")
        start = np.concatenate([[0], *[_unpack(r, n) for r, n in zip(words["sizes"], words["n"])]]).cumsum()
        names = _unpack(order["places"].iloc[0], n_words) if n_words else np.zeros(0, np.int64)
        if digests:
            token_bytes, token_start = tokens.value
        rows = []
        for i, n, raw in zip(texts["id"], texts["n"], texts["places"]):
            places = names[_unpack(raw, n)]
            count, a, b, ids = 0, hashlib.sha256(), hashlib.sha256(), []
            for at in range(0, n, CHUNK):
                part = _gather(flat, start, places[at:at + CHUNK])
                count += len(part)
                if digests:
                    a.update(part.tobytes())
                    b.update(_gather(token_bytes, token_start, part.astype(np.int64)).tobytes())
                else:
                    ids.append(part)
            rows.append((i, count, a.hexdigest(), b.hexdigest()) if digests else
                        (i, count, np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)))
        return pd.DataFrame(rows, columns=["id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["id", "n_tokens", "ids"])
    return run


def _token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    parts = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        parts[i] = token
    return _pieces(parts, "u1")


def bpe_encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per document: ``(id, n_tokens, ids array<long>)``, or with ``digests`` ``(id, n_tokens, ids_sha256,
    decoded_sha256)``: SHA-256 of the ids as little-endian unsigned 32-bit integers and of the bytes that they decode to.

    Each match of ``pattern`` in the whole text is encoded by itself, as the tiktoken library would, without special tokens.
    No match may run from a non-space character over a space (true of the customary patterns).
    Null or empty text: no ids. Repeated rows give repeated rows; null ids stay. Columns besides the two named are ignored.
    Empty table: empty result. A very long text is one block and is reassembled in chunks.
    """
    sc = docs.sparkSession.sparkContext
    table = read_ranks(rank_path)
    ranks, tokens = sc.broadcast(table), sc.broadcast(_token_table(table)) if digests else None
    src = pick(docs, id=id_col, text=text_col)
    kind = dict(src.dtypes)["id"]
    buckets = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    words = (src.mapInArrow(_words_out(pattern, buckets), "block long, bucket int, n long, sizes binary, n_bytes long, raw binary")
             .repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_encode_buckets(ranks), "block long, bucket int, n long, sizes binary, n_ids long, ids binary"))
    texts = src.mapInArrow(_texts_out(pattern, buckets), f"block long, id {kind}, n long, places binary")
    out = texts.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(
        _reassemble(tokens, digests), f"id {kind}, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<long>"))
    return out.withColumnRenamed("id", id_col)


def bpe_decode(spark: SparkSession, rows: DataFrame, rank_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, bytes)`` of rows of ids: ids and their positions are joined with the token-byte table and put together by
    position (in chunks, so that a long sequence is no single large group while it is joined). Rows without ids, or with
    null ids, give empty bytes; ids outside the table raise an error. Repeated rows give repeated rows."""
    table = spark.createDataFrame(sorted((i, bytearray(t)) for t, i in read_ranks(rank_path).items()), "token int, bytes binary")
    src = pick(rows, id=id_col, ids=ids_col).withColumn("uid", F.monotonically_increasing_id())
    each = src.select("uid", "id", F.posexplode_outer("ids").alias("pos", "token"))
    joined = each.join(F.broadcast(table), "token", "left").withColumn(  # one row per token of the vocabulary
        "bytes", F.when(F.col("token").isNotNull() & F.col("bytes").isNull(), F.raise_error(F.lit("id outside the token table")).cast("binary")).otherwise(F.col("bytes")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.hex("bytes").alias("h")))), lambda x: x["h"]), "")
    return joined.groupBy("uid", "id").agg(F.unhex(text).alias("bytes")).select(F.col("id").alias(id_col), F.coalesce("bytes", F.lit(b"")).alias("bytes"))

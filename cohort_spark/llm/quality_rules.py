"""Operator 7, quality rules: per-document counts, and lines that many documents of one host share.

Each line is normalised (A-Z lower-cased; digits, ASCII marks and white space dropped) and hashed; per host the
documents that hold it are counted. Lines above the limit are boilerplate and are removed; a document that they
deplete is rejected. Copies must not make each other's text boilerplate, so documents are counted by content: by a hash of
the whole text, which exact copies share and different documents don't, however many lines they have in common.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.llm.common import WordHasher, mix64, pick, stage, window_hashes

SPACES = (" ", "\t", "\n", "\v", "\f", "\r")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")
SYMBOLS = "#*$%&|<>"
#: Bytes dropped from a normalised line: controls, white space, digits and ASCII marks.
DROPPED = bytes(b for b in range(128) if not chr(b).isalpha())


def repeated_words(hashes: np.ndarray, n: int = 5) -> int:
    """Words covered by an ``n``-word window that occurs at least twice, the first occurrence included."""
    if len(hashes) < n:
        return 0
    windows = window_hashes(hashes, n)
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[where] > 1)
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[starts] += 1
    np.subtract.at(edge, starts + n, 1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def line_key(line: bytes, hasher) -> int:
    """Hash of a normalised line (signed); 0 for a line without letters."""
    kept = line.lower().translate(None, DROPPED)
    return int(hasher(kept)) - 2**63 if kept else 0


def _host_line(host: str | None, line: int, hasher) -> int:
    """Key of a line within a host."""
    h = hasher(("\x01" + host).encode("utf-8", "surrogatepass") if host is not None else b"\x00")
    return int(mix64(np.array([h], np.uint64) ^ np.array([line], np.int64).view(np.uint64)).view(np.int64)[0])


def _lines(batches):
    """(host line key, host key, content) of every line with letters, and one row per document for its host's total."""
    import xxhash

    one, hosts = xxhash.xxh64_intdigest, {}
    for b in batches:
        rows = set()
        for text, host in zip(b.column("text"), b.column("host")):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if not raw.strip():
                continue
            h = host.as_py()
            if h not in hosts:
                hosts[h] = _host_line(h, 0, one)
            content = one(raw) - 2**63
            rows.add((hosts[h], hosts[h], content))
            keys = {line_key(x, one) for x in raw.split(b"\n")} - {0}
            mixed = mix64(np.array(list(keys), np.int64).view(np.uint64) ^ np.array([hosts[h]], np.int64).view(np.uint64)).view(np.int64)
            rows.update((k, hosts[h], content) for k in mixed.tolist())
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["line", "host", "content"])


def _judge(common, min_words: int, max_repeat_percent: int, min_left: float, texts: bool):
    """Counts and verdict of each text; with ``texts``, only kept rows, their boilerplate lines removed."""
    def run(batches):
        import xxhash

        hasher, one, hosts, known = WordHasher(), xxhash.xxh64_intdigest, {}, set(common.value.tolist()) if common else None
        for b in batches:
            counts, out = {k: [] for k in COUNTS}, []
            drops = None if known is not None else b.column("drop")
            for r, (text, host) in enumerate(zip(b.column("text"), b.column("host"))):
                s = text.as_py() or ""
                raw = s.encode("utf-8", "surrogatepass")
                words, h = raw.split(), host.as_py()
                if h not in hosts:
                    hosts[h] = np.uint64(_host_line(h, 0, one) % 2**64)
                listed = known if known is not None else set(drops[r].as_py() or ())
                lines, seen, dups, gone, left = raw.split(b"\n"), set(), 0, 0, []
                keys = np.array([line_key(x, one) for x in lines], np.int64)
                mixed = mix64(keys.view(np.uint64) ^ hosts[h]).view(np.int64).tolist()
                for line, key, m in zip(lines, keys.tolist(), mixed):
                    size = len(line.split())
                    if size:
                        dups += line in seen
                        seen.add(line)
                    if key and m in listed:
                        gone += size
                    elif texts:
                        left.append(line)
                repeat, n = repeated_words(hasher(words)), len(words)
                failed = n < min_words or 100 * repeat > max_repeat_percent * n
                kept = not failed and not (gone and (n - gone < min_words or n - gone < min_left * n))
                chars = len(s) - sum(map(s.count, SPACES))
                for k, v in zip(COUNTS, (n, chars, sum(map(s.count, SYMBOLS)), dups, repeat, gone, failed, kept)):
                    counts[k].append(v)
                if texts:
                    out.append(b"\n".join(left).decode("utf-8", "surrogatepass") if gone else text.as_py())
            if texts:
                mask = pa.array(counts["kept"], pa.bool_())
                cols = [pa.array(out, pa.string()) if n == "text" else b.column(n) for n in b.schema.names if n != "drop"]
                yield pa.RecordBatch.from_arrays(cols, names=[n for n in b.schema.names if n != "drop"]).filter(mask)
            else:
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), *[pa.array(v, pa.bool_() if k in ("base_failed", "kept") else pa.int64()) for k, v in counts.items()]],
                    names=["id", *COUNTS])
    return run


def common_lines(src: DataFrame, min_docs: int, host_share: float) -> DataFrame:
    """Keys of the boilerplate lines (one column, ``line``) of a table with ``text`` and ``host``."""
    rows = src.select("text", "host").mapInArrow(_lines, "line long, host long, content long").distinct()
    counts = stage(rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > min_docs) | (F.col("host") == F.col("line"))),
                   "line-counts")
    totals = counts.where("host = line").select(F.col("host").alias("h"), F.col("n").alias("of"))
    return stage(counts.where("host <> line").join(totals, F.col("host") == F.col("h"))
                 .where((F.col("n") > min_docs) & (F.col("n") > F.lit(host_share) * F.col("of"))).select("line"), "common-lines")


def _with_lines(src: DataFrame, common: DataFrame, limit: int):
    """The boilerplate keys as a broadcast array where their counted number is at most ``limit``; else null and the
    table with a ``drop`` column, the keys of each row's own boilerplate lines, found by a join."""
    n = common.count()
    if n <= limit:
        keys = np.array([r["line"] for r in common.collect()], np.int64)
        return src.sparkSession.sparkContext.broadcast(keys), src
    src = stage(src.withColumn("uid", F.monotonically_increasing_id()), "quality-rows")

    def keyed(batches):
        import xxhash

        for b in batches:
            uid, out = [], []
            for u, text, host in zip(b.column("uid"), b.column("text"), b.column("host")):
                h = _host_line(host.as_py(), 0, xxhash.xxh64_intdigest)
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                keys = {line_key(x, xxhash.xxh64_intdigest) for x in raw.split(b"\n")} - {0}
                mixed = mix64(np.array(list(keys), np.int64).view(np.uint64) ^ np.array([h], np.int64).view(np.uint64)).view(np.int64)
                uid += [u.as_py()] * len(mixed)
                out += mixed.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(out, pa.int64())], names=["uid", "line"])

    own = (src.select("uid", "text", "host").mapInArrow(keyed, "uid long, line long").join(common, "line", "left_semi")
           .groupBy("uid").agg(F.collect_set("line").alias("drop")))
    return None, src.join(own, "uid", "left").drop("uid")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_docs: int = 30, host_share: float = 0.1, min_words: int = 10, max_repeat_percent: int = 20,
                  min_left: float = 0.3, broadcast_lines: int = 1_000_000) -> DataFrame:
    """One row per document: ``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
    base_failed, kept)``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A line is boilerplate if, within its host, more than ``min_docs`` documents and more
    than ``host_share`` of the host's documents hold it, documents being counted by content (see the module text). A document
    is depleted if less than ``min_left`` of its words, or fewer than ``min_words``, are left without those lines. Rejected
    are depleted documents and those that fail the base rules (fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` percent of the words in repeated 5-word windows). Null or empty text: no words, fails. A null host
    is a host. Repeated rows are judged each. Empty table: empty result. Columns besides the three named are ignored.

    One pass counts lines (a hot line or host is never gathered: distinct rows are formed map-side, then counted), one pass
    judges. A host has at most ``lines per document / host_share`` boilerplate lines; up to ``broadcast_lines`` of them are
    broadcast, more are joined.
    """
    src = pick(docs, id=id_col, text=text_col, host=host_col).withColumn("host", F.col("host").cast("string"))
    common, rows = _with_lines(src, common_lines(src, min_docs, host_share), broadcast_lines)
    out = rows.mapInArrow(_judge(common, min_words, max_repeat_percent, min_left, False),
                          f"id {dict(src.dtypes)['id']}, " + ", ".join(f"{k} {'boolean' if k in ('base_failed', 'kept') else 'long'}" for k in COUNTS))
    return out.withColumnRenamed("id", id_col)


def apply_quality_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_docs: int = 30,
                        host_share: float = 0.1, min_words: int = 10, max_repeat_percent: int = 20, min_left: float = 0.3,
                        broadcast_lines: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns, without their boilerplate lines."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    src = docs.select(*[qcol(c).alias("text" if c == text_col else a) for c, a in names.items()],
                      qcol(host_col).cast("string").alias("host"))
    common, rows = _with_lines(src, common_lines(src, min_docs, host_share), broadcast_lines)
    out = rows.mapInArrow(_judge(common, min_words, max_repeat_percent, min_left, True),
                          ", ".join(f"{c} {t}" for c, t in src.dtypes))
    return out.select(*[F.col("text" if c == text_col else a).alias(c) for c, a in names.items()])

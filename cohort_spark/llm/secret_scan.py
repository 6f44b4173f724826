"""Operator 5, secret scans: fixed patterns, and formats inferred from the credentials that they find.

The matched credentials are labelled examples of their kinds. From a bounded sample of each kind a prefix tree is
built over symbols (the first characters as they are, later ones by character class), and statistically compatible
states are merged (state merging with Hoeffding bounds, the ALERGIA scheme) into a probabilistic automaton; another is
inferred from ordinary long tokens. Every other candidate token of every text is then scored by the likelihood of its
format under the credential automata against the ordinary one, and those above a calibrated cut are added as spans.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.llm.common import pick, stage

#: The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "inferred")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
                    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # AKIA[A-Z0-9]+ of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{10,}")  # candidates; a hex match always lies in one
SHORT = 16  # shorter candidates need a digit and letters: words and numbers of that length are everywhere

LITERAL = 4  # characters of a credential that are kept as they are
TRAIN_SYMBOLS = 64  # symbols of a training credential that enter the prefix tree


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """Spans of the fixed patterns (by start, then kind), and the candidate tokens that overlap none."""
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    tokens = [m.span() for m in TOKEN.finditer(text) if m.end() - m.start() >= SHORT or shape(m[0]) == (True, True)]
    for s, e in tokens:
        if e - s >= 24:
            spans += [("hex", *m.span()) for m in HEX.finditer(text, s, e)]
    spans.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    free = [(s, e) for s, e in tokens if all(e <= a or s >= b for _, a, b in spans)] if spans else tokens
    return spans, free


def secret_part(kind: str, text: str) -> str:
    """The credential itself: the assigned value, or the whole match."""
    return ASSIGN.match(text)[2] if kind == "assign" else text


def symbols(token: str) -> list[str]:
    """The first characters literally, then classes: digit, a-f, other lower case, upper case, marks as they are."""
    out = list(token[:LITERAL])
    for c in token[LITERAL:]:
        out.append("09" if c.isdigit() else "af" if "a" <= c <= "f" else "az" if c.islower() else "AZ" if c.isupper() else "=" + c)
    return out


def shape(token: str) -> tuple[bool, bool]:
    """Whether a token has digits, and letters: numbers, words and mixed tokens are ordinary in different ways."""
    return any(c.isdigit() for c in token), any(c.isalpha() for c in token)


CLASS_SIZE = {"09": 10, "af": 6, "az": 20, "AZ": 26}


class Automaton:
    """A probabilistic automaton inferred from strings by merging prefix-tree states."""

    def __init__(self, strings: list[list[str]], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.n, self.end = [0], [0]
        for s in strings:
            q = 0
            self.n[0] += 1
            for c in s:
                if c not in self.next[q]:
                    self.next[q][c] = len(self.n)
                    self.next.append({})
                    self.count.append({})
                    self.n.append(0)
                    self.end.append(0)
                self.count[q][c] = self.count[q].get(c, 0) + 1
                q = self.next[q][c]
                self.n[q] += 1
            self.end[q] += 1
        self._bound = sqrt(0.5 * log(2 / alpha))
        self._merge_states()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self._bound * (1 / sqrt(n1) + 1 / sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo, seen = [(a, b)], set()
        while todo:
            p, q = todo.pop()
            if (p, q) in seen or not self.n[p] or not self.n[q]:
                continue
            seen.add((p, q))
            if self._differ(self.end[p], self.n[p], self.end[q], self.n[q]):
                return False
            for c in self.count[p].keys() | self.count[q].keys():
                if self._differ(self.count[p].get(c, 0), self.n[p], self.count[q].get(c, 0), self.n[q]):
                    return False
                if c in self.next[p] and c in self.next[q]:
                    todo.append((self.next[p][c], self.next[q][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree under ``b`` to the automaton at ``a``."""
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            self.n[p] += self.n[q]
            self.end[p] += self.end[q]
            for c, t in self.next[q].items():
                self.count[p][c] = self.count[p].get(c, 0) + self.count[q][c]
                if c in self.next[p]:
                    todo.append((self.next[p][c], t))
                else:
                    self.next[p][c] = t

    def _merge_states(self) -> None:
        red, blue = [0], deque((0, c) for c in sorted(self.next[0]))
        kept = {0}
        while blue:
            p, c = blue.popleft()
            q = self.next[p][c]
            if q in kept:
                continue
            for r in red:
                if self._compatible(r, q):
                    self.next[p][c] = r
                    known = set(self.next[r])
                    self._fold(r, q)
                    blue.extend((r, x) for x in sorted(set(self.next[r]) - known))
                    break
            else:
                red.append(q)
                kept.add(q)
                blue.extend((q, x) for x in sorted(self.next[q]))
        self.states = len(red)

    def score(self, s: list[str], alphabet: int = 96) -> float:
        """Mean log-likelihood per character; unseen symbols get a smoothed share and leave the state unchanged."""
        q, total = 0, 0.0
        for c in s:
            total += log((self.count[q].get(c, 0) + 1 / alphabet) / (self.n[q] + 1)) - log(CLASS_SIZE.get(c, 1))
            q = self.next[q].get(c, q)
        return total / max(1, len(s))


class Formats:
    """The inferred formats and the cut: what ``ratio`` gives to a tenth of the labelled credentials at most, raised
    until at most one ordinary token in a hundred reaches it.

    The sample of other tokens may hold many bare credentials. Those that fit a credential format as well as all but one in
    a hundred of its own examples do are neither taught as ordinary nor counted for the cut, so the cut does not rise with their number."""

    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str], min_ratio: float = 0.2):
        train = {k: [symbols(v)[:TRAIN_SYMBOLS] for v in vs] for k, vs in labelled.items() if vs}
        self.kinds = {k: Automaton(v) for k, v in train.items()}
        fits, held = {}, []
        for k, v in train.items():  # scored by automata of the other half, as tokens that were never taught are
            halves = v[::2], v[1::2]
            own = [(a.score(s), s) for a, other in zip(map(Automaton, halves), halves[::-1]) for s in other] if len(v) > 1 else [(self.kinds[k].score(v[0]), v[0])]
            fits[k] = sorted(x for x, _ in own)[len(own) // 100]
            held += [x for x in own if len(x[1]) >= 10]
        ordinary = [v for v in ordinary if not any(self.kinds[k].score(symbols(v)) >= fits[k] for k in fits) or shape(v) != (True, True)]
        shapes: dict[tuple[bool, bool], list[str]] = {}
        for v in ordinary:
            shapes.setdefault(shape(v), []).append(v)
        self.ordinary = [Automaton([symbols(v)[:TRAIN_SYMBOLS] for v in vs]) for _, vs in sorted(shapes.items())] or [Automaton([])]
        good = sorted(x - max(a.score(s) for a in self.ordinary) for x, s in held)
        bad = sorted(self.ratio(v) for v in ordinary)
        self.cut = max([min_ratio, *good[len(good) // 10:][:1], *bad[len(bad) * 99 // 100:][:1]])

    def ratio(self, token: str) -> float:
        if not self.kinds:
            return float("-inf")
        s = symbols(token)
        return max(a.score(s) for a in self.kinds.values()) - max(a.score(s) for a in self.ordinary)

    def is_secret(self, token: str) -> bool:
        return bool(self.kinds) and self.ratio(token) > self.cut


def _find(batches):
    """Base spans and candidate tokens of each text, with the strings at them."""
    for b in batches:
        base, free = [], []
        for text in b.column("text"):
            s = text.as_py() or ""
            spans, tokens = base_spans(s)
            base.append([{"kind": k, "s": i, "e": j, "v": secret_part(k, s[i:j])} for k, i, j in spans])
            free.append([{"s": i, "e": j, "v": s[i:j]} for i, j in tokens])
        point = [pa.field("s", pa.int64()), pa.field("e", pa.int64()), pa.field("v", pa.string())]
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(base, pa.list_(pa.struct([pa.field("kind", pa.string()), *point]))), pa.array(free, pa.list_(pa.struct(point)))],
            names=["id", "base", "free"])


SPANS = "array<struct<kind:string,s:long,e:long,v:string>>"
TOKENS = "array<struct<s:long,e:long,v:string>>"


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = pick(docs, id=id_col, text=text_col)
    return stage(src.mapInArrow(_find, f"id {dict(src.dtypes)['id']}, base {SPANS}, free {TOKENS}"), "secrets")


def learn_formats(found: DataFrame, per_kind: int = 400) -> Formats:
    """Formats from at most ``per_kind`` distinct credentials of each kind and as many ordinary tokens: those whose
    hashes are smallest, so the sample depends neither on order nor on partitions."""
    def sample(df: DataFrame) -> list[str]:
        return sorted(r["v"] for r in df.distinct().orderBy(F.xxhash64("v"), "v").limit(per_kind).collect())

    creds = found.select(F.explode("base").alias("b")).select("b.kind", F.substring("b.v", 1, 4096).alias("v"))
    return Formats({k: sample(creds.where(F.col("kind") == k).select("v")) for k in KINDS[:3]},
                   sample(found.select(F.explode("free").alias("f")).select(F.substring("f.v", 1, 4096).alias("v"))))


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_kind: int = 400) -> DataFrame:
    """One row per document: ``(id, n_assign, n_access, n_hex, base_sha256, spans, n_inferred)``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind as in ``KINDS``, comma-joined; the
    base ones are leftmost and non-overlapping per kind, whole matches; ``base_sha256`` is of the base spans alone.
    ``inferred`` spans are further tokens whose format is that of a credential; they overlap no base span. Null or empty
    text: no spans. Without any labelled credential nothing is inferred. Rows may repeat; null ids stay. Columns besides the
    two named are ignored. Each text is scanned once; formats are learnt from a bounded sample (``per_kind``), candidates
    come from all texts.
    """
    found = _found(docs, id_col, text_col)
    formats = docs.sparkSession.sparkContext.broadcast(learn_formats(found, per_kind))

    def judge(batches):
        f, known = formats.value, {}
        for b in batches:
            rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_inferred")}
            for base, free in zip(b.column("base").to_pylist(), b.column("free").to_pylist()):
                spans = [(x["kind"], x["s"], x["e"]) for x in base]
                more = [("inferred", x["s"], x["e"]) for x in free if _secret(f, known, x["v"])]
                for k in KINDS[:3]:
                    rows["n_" + k].append(sum(x[0] == k for x in spans))
                rows["base_sha256"].append(hashlib.sha256(_join(spans).encode()).hexdigest())
                rows["spans"].append(_join(spans + more))
                rows["n_inferred"].append(len(more))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *[pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in rows.items()]],
                names=["id", *rows])

    return (found.mapInArrow(judge, f"id {dict(found.dtypes)['id']}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_inferred long")
            .withColumnRenamed("id", id_col))


def _secret(formats: Formats, known: dict, token: str) -> bool:
    if len(known) > 100_000:
        known.clear()
    if token not in known:
        known[token] = formats.is_secret(token)
    return known[token]


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", per_kind: int = 400) -> DataFrame:
    """All rows and columns of ``docs``, every span that ``secret_scan`` finds (overlapping ones as one) replaced by ``mark``;
    a text without one stays as it is, null stays null. The texts are scanned twice and never shuffled."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    src = docs.select(*[qcol(c).alias("text" if c == text_col else a) for c, a in names.items()])
    formats = docs.sparkSession.sparkContext.broadcast(learn_formats(_found(src.select(F.lit(0).alias("id"), "text"), "id", "text"), per_kind))

    def hide(batches):
        f, known = formats.value, {}
        for b in batches:
            out = []
            for text in b.column("text"):
                s = text.as_py()
                spans, free = base_spans(s or "")
                cuts = sorted([x[1:] for x in spans] + [x for x in free if _secret(f, known, s[x[0]:x[1]])])
                parts, at = [], 0
                for i, j in cuts:
                    if i >= at:
                        parts += [s[at:i], mark]
                    at = max(at, j)
                out.append("".join(parts) + s[at:] if cuts else s)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == "text" else b.column(n) for n in b.schema.names], names=b.schema.names)

    out = src.mapInArrow(hide, ", ".join(f"{c} {t}" for c, t in src.dtypes))
    return out.select(*[F.col("text" if c == text_col else a).alias(c) for c, a in names.items()])

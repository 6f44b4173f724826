"""Operator 13, personal data by a semi-Markov conditional random field.

Fixed patterns give the base spans. They also label examples: windows of text around base spans, the same with the span
rewritten in common disguises (``name (at) host (dot) org``, a phone number without its plus, a card number with dots, a
defanged address), and windows that hold nothing: numbers found elsewhere in the texts, broken spans (a wrong check
digit, an octet over 255, a number cut short), dates, times, amounts and versions. On these a semi-Markov conditional random
field is trained by gradient ascent on the conditional likelihood: a text is split into single outside tokens and
segments of a type, and a segment's score is the sum of weights of features of the whole span (digits, their grouping,
separators, check digit, octets, marks for at and dot, neighbours). Elsewhere the Viterbi split, over segments of at most
``MAX_TOKENS`` tokens, chooses boundaries and types jointly. A segment needs an at mark, seven digits or four groups of digits, so
text far from those is outside without being scored.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.llm.common import pick, stage

#: The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")

MAX_TOKENS, MAX_CHARS = 24, 100  # of a segment
TOKEN = re.compile(r"[^\W_]+|.", re.DOTALL)
AT = re.compile(r"@|[\[({<]\s{0,3}at\s{0,3}[\])}>]|(?<=\s)at(?=\s)", re.IGNORECASE)
DOT = re.compile(r"(?<=[^\W_])\.(?=[^\W_])|[\[({<]\s{0,3}dot\s{0,3}[\])}>]|(?<=\s)dot(?=\s)", re.IGNORECASE)
SEED = re.compile(r"[0-9](?:[^0-9\w\n]{0,4}[0-9]){6,}+|(?<![0-9])[0-9]{1,3}(?:[^0-9\w\n]{1,5}[0-9]{1,3}){3}(?![0-9])|@|[\[({<]\s{0,3}[aA][tT]\s{0,3}[\])}>]|(?<=\s)[aA][tT](?=\s[^\n]{1,60}\s[dD][oO][tT]\s)")
AROUND = 64  # characters kept on either side of a seed


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octet(digits: str) -> bool:
    d = digits.lstrip("0")
    return len(d) < 3 or len(d) == 3 and int(d) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by kind, then start: leftmost and non-overlapping per kind; failing matches are dropped."""
    out, free = [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            from_ = max(free, text.rfind("@", free, m.start()) + 1)
            start = from_ + len(text[from_:m.start()].rstrip(LOCAL))
            if start < m.start():
                out.append(("email", start, m.end()))
                free = m.end()
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(octet(d) for d in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15]
    return out


# ---- candidate segments and features of whole spans

def _class(c: str) -> str:
    return "start" if not c else "space" if c.isspace() else "09" if c.isdigit() else "az" if c.isalpha() else c if c in "+-./@#=:_,;()" else "mark"


def _gaps(seg: str) -> int:
    """Neighbouring words with nothing but blanks between them, marks for at and dot apart."""
    words = re.sub(r"(?<=\s)(?:at|dot)(?=\s)", "/", seg, flags=re.IGNORECASE)
    return len(re.findall(r"[^\W_]\s+(?=[^\W_])", words))


def features(text: str, s: int, e: int) -> tuple[str, ...]:
    """One value for each property of the span ``text[s:e]``; the position in the tuple is part of the feature."""
    seg = text[s:e]
    groups = DIGITS.findall(seg)
    n = sum(map(len, groups))
    at = AT.search(text, s, e)
    dot = DOT.search(text, at.end() if at else s, e)
    marks = sorted({_class(c) for c in seg if not c.isalnum()})
    letters = sum(any(c.isalpha() for c in t) for t in TOKEN.findall(seg))
    check = "" if at or not 13 <= n <= 19 else "good" if luhn("".join(groups)) else "bad"
    octets = "" if at or len(groups) != 4 else "good" if all(octet(g) for g in groups) else "bad"
    sign = "@" if at and at[0] == "@" else "word" if at else ""
    size = "" if at else "four" if octets == "good" else str(min(n, 20))  # octets vary in length, so their lengths say nothing
    shape = "" if at else "four" if octets == "good" else "-".join(str(len(g)) for g in groups) if len(groups) <= 6 and n <= 20 else "long"
    last = re.search(r"[^\W_]+$", seg)
    return ("", size, shape, " ".join(marks), _class(seg[0]), _class(seg[-1]), sign,
            ("." if dot[0] == "." else "word") if dot else "", str(min(letters, 6)), check, octets, _class(text[s - 1:s]), _class(text[e:e + 1]),
            "twice" if re.search(r"\W\W", seg) else "", str(min(3, _gaps(seg))) if at else "", "dot" if DOT.match(text[e:e + 8].lstrip()) and text[e + 1:].strip(" .") else "", f"{size} {check} {octets} {sign} {dot is not None}",
            str(min(5, len(last[0]))) if at and last else "")


def candidates(text: str, fixed: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Number of tokens, and the segments ``(first token, token after, start, end)`` that may be entities and do not overlap ``fixed``."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    n = len(spans)
    taken = np.zeros(len(text) + 1, np.int64)
    for a, b in fixed:
        taken[a:b] = 1
    kinds = ["d" if t.isascii() and t.isdigit() else "w" if t[0].isalnum() else "n" if t == "\n" else "p" for t in (text[a:b] for a, b in spans)]
    ats = {m.start() for m in AT.finditer(text)}
    out = []
    for i, (s, _) in enumerate(spans):
        if taken[s] or kinds[i] == "n" or kinds[i] == "p" and text[s] not in "+(":
            continue
        digits = groups = 0
        word = at = False
        for j in range(i, min(n, i + MAX_TOKENS)):
            a, b = spans[j]
            k = kinds[j]
            if k == "n" or b - s > MAX_CHARS or taken[a]:
                break
            at = at or a in ats and j > i
            word = word or k == "w"
            if k == "d":
                digits, groups = digits + b - a, groups + 1
            if word and not at and (kinds[i] == "p" or j - i > 12):
                break
            if k in "dw" and (at and a not in ats or not word and (digits >= 7 or groups == 4)):
                out.append((i, j + 1, s, b))
    return n, out


# ---- the model

class SemiCRF:
    """Weights per (feature, kind), trained on windows ``(text, gold spans)``."""

    def __init__(self, windows: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = 12, rate: float = 0.4, decay: float = 1e-4, seed: int = 13):
        self.ids: dict[tuple[int, str], int] = {}
        data = [w for w in (self._prepare(t, g) for t, g in windows) if w is not None]
        self.weights = np.zeros((len(self.ids) + 1, len(KINDS)))
        past = np.full_like(self.weights, 1e-6)
        rnd = random.Random(seed)
        for _ in range(epochs):
            rnd.shuffle(data)
            for n, segs, feats, gold in data:
                grad = np.zeros_like(self.weights)
                expected = self._expected(n, segs, feats)
                for k in range(feats.shape[1]):
                    np.add.at(grad, feats[:, k], gold - expected)
                grad -= decay * self.weights
                past += grad * grad
                self.weights += rate * grad / np.sqrt(past)
        self.weights[0] = 0
        self.trained = bool(data)

    def _prepare(self, text, gold):
        n, segs = candidates(text, [])
        where = {(s, e): x for x, (_, _, s, e) in enumerate(segs)}
        if not segs or any((s, e) not in where for _, s, e in gold):
            return None
        feats = np.array([[self.ids.setdefault((k, v), len(self.ids) + 1) for k, v in enumerate(features(text, s, e))] for _, _, s, e in segs])
        target = np.zeros((len(segs), len(KINDS)))
        for kind, s, e in gold:
            target[where[s, e], KINDS.index(kind)] = 1
        return n, segs, feats, target

    def _scores(self, feats: np.ndarray) -> np.ndarray:
        return self.weights[feats].sum(axis=1)

    def _expected(self, n, segs, feats) -> np.ndarray:
        """Probability of each segment and kind under the model (forward and backward sums over all splits, in logarithms)."""
        scores = self._scores(feats)
        total = np.logaddexp.reduce(scores, axis=1)
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        starts: list[list[int]] = [[] for _ in range(n + 1)]
        for x, (i, j, _, _) in enumerate(segs):
            ends[j].append(x)
            starts[i].append(x)
        fore, back = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            fore[j] = fore[j - 1]
            for x in ends[j]:
                fore[j] = np.logaddexp(fore[j], fore[segs[x][0]] + total[x])
        for i in range(n - 1, -1, -1):
            back[i] = back[i + 1]
            for x in starts[i]:
                back[i] = np.logaddexp(back[i], back[segs[x][1]] + total[x])
        around = np.array([fore[i] + back[j] for i, j, _, _ in segs]) - fore[n]
        return np.exp(scores + around[:, None])

    def decode(self, text: str, fixed: list[tuple[int, int]], margin: float = 1.0) -> list[tuple[str, int, int]]:
        """The best split's segments that don't overlap ``fixed``; each must beat outside tokens by ``margin``."""
        n, segs = candidates(text, fixed)
        if not segs or not self.trained:
            return []
        feats = np.array([[self.ids.get((k, v), 0) for k, v in enumerate(features(text, s, e))] for _, _, s, e in segs])
        scores = self._scores(feats) - margin
        kind, best = scores.argmax(axis=1), scores.max(axis=1)
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        for x in np.flatnonzero(best > 0):
            ends[segs[x][1]].append(int(x))
        top, via = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            top[j] = top[j - 1]
            for x in ends[j]:
                if top[segs[x][0]] + best[x] > top[j]:
                    top[j], via[j] = top[segs[x][0]] + best[x], x
        out, j = [], n
        while j > 0:
            if via[j] < 0:
                j -= 1
            else:
                i, _, s, e = segs[via[j]]
                out.append((KINDS[kind[via[j]]], s, e))
                j = i
        return out[::-1]


# ---- examples

def disguises(kind: str, span: str) -> list[str]:
    """Ways in which people write such a span so that the fixed pattern misses it."""
    if kind == "email":
        local, host = span.rsplit("@", 1)
        word = host.replace(".", " dot ")
        return [f"{local} at {word}", f"{local} (at) {host.replace('.', ' (dot) ')}", f"{local}[at]{host.replace('.', '[dot]')}", f"{local} [at] {host}", f"{local} @ {host}", f"{local}(at){host}"]
    groups = DIGITS.findall(span)
    if kind == "ip":
        return ["[.]".join(groups), " . ".join(groups), "(.)".join(groups)]
    if kind == "card":
        d = "".join(groups)
        quads = [d[i:i + 4] for i in range(0, len(d), 4)]
        return [".".join(quads), "/".join(quads), "  ".join(quads), " - ".join(quads)]
    rest = "".join(groups[1:]) if len(groups) > 1 else groups[0][1:]
    if len(rest) < 8:
        return []
    a, b, c = rest[:3], rest[3:-4], rest[-4:]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}", f"00{groups[0]} {a} {b} {c}"]


def spoiled(kind: str, span: str) -> list[str]:
    """Similar spans that are no personal data of the kind."""
    groups = DIGITS.findall(span)
    if kind == "email":
        local, host = span.rsplit("@", 1)
        return [f"{local} at {host.split('.')[0]}", f"@{host.split('.')[0]}", f"to {local} at {host.split('.')[0]}. The"]
    if kind == "ip":
        return [".".join(groups[:3]), ".".join([str(int(groups[0][-3:]) + 300), *groups[1:]]), "-".join(groups[:3])]
    if kind == "card":
        d = "".join(groups)
        return [d[:-1] + str((int(d[-1]) + k) % 10) for k in (1, 5)] + [d[:11], "/".join([d[:4], d[4:8], d[8:12], d[12:-1] + str((int(d[-1]) + 3) % 10)])]
    return ["-".join(groups[-2:]), "".join(groups[-2:]), groups[-1] + "," + "000"]


def ordinary(rnd: random.Random) -> list[str]:
    """Numbers of everyday texts that hold no personal data."""
    y, m, d = rnd.randrange(1900, 2040), rnd.randrange(1, 13), rnd.randrange(1, 29)
    h, mi, s = rnd.randrange(24), rnd.randrange(60), rnd.randrange(60)
    a, b, c = rnd.randrange(1, 999), rnd.randrange(1000), rnd.randrange(1000)
    return [f"{y}-{m:02}-{d:02}", f"{y}-{m:02}-{d:02} {h:02}:{mi:02}:{s:02}", f"{d:02}.{m:02}.{y}", f"{d:02}/{m:02}/{y} {h:02}:{mi:02}", f"{a},{b:03},{c:03}", f"{a}.{b}.{c}",
            f"{a}.{b:03}.{c:03},{mi:02}", f"{y}-{y + 3}", f"{a} {b} {c} {h} {mi}", f"{a}, {b}, {c}, {h}", f"3.{mi}{a}{b}{c}", f"978-{a % 10}-{b:03}-{c:03}{mi:02}-{s % 10}", str(rnd.randrange(10**6, 10**12)),
            f"{y}{m:02}{d:02}{h:02}{mi:02}{s:02}", f"{a}x{b}x{c}", f"v{h}.{mi}.{s}"]


def training_windows(examples: list[tuple[str, str, int, int]], empty: list[str], seed: int = 13) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Windows with gold spans from ``(kind, text, start, end)`` examples and from texts without personal data."""
    rnd, out = random.Random(seed), []
    for kind, text, s, e in examples:
        left, span, right = text[:s], text[s:e], text[e:]
        if any(k != kind or (a, b) != (s, e) for k, a, b in base_spans(text)):
            continue  # neighbours would need labels of their own
        ways = disguises(kind, span)
        for way in [span, *rnd.sample(ways, min(3, len(ways)))]:
            out.append((left + way + right, [(kind, s, s + len(way))]))
        out += [(left + way + right, []) for way in [*spoiled(kind, span), *rnd.sample(ordinary(rnd), 3)]]
    return out + [(t, []) for t in empty if not base_spans(t)]


def windows(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Stretches of text around seeds outside base spans: the only places that may hold further segments."""
    base = sorted((s, e) for _, s, e in spans)
    out: list[list[int]] = []
    k = 0
    for m in SEED.finditer(text):
        while k < len(base) and base[k][1] <= m.start():
            k += 1
        if k < len(base) and base[k][0] <= m.start() and m.end() <= base[k][1]:
            continue
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        while a > 0 and text[a - 1].isalnum() and text[a].isalnum() and m.start() - a < 2 * AROUND:
            a -= 1
        while b < len(text) and text[b - 1].isalnum() and text[b].isalnum() and b - m.end() < 2 * AROUND:
            b += 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


SPAN = pa.struct([pa.field("kind", pa.string()), pa.field("s", pa.int64()), pa.field("e", pa.int64())])
PLACE = pa.struct([pa.field("at", pa.int64()), pa.field("text", pa.string())])
EXAMPLE = pa.struct([pa.field("kind", pa.string()), pa.field("text", pa.string()), pa.field("s", pa.int64()), pa.field("e", pa.int64())])
FOUND = "base array<struct<kind:string,s:long,e:long>>, places array<struct<at:long,text:string>>, examples array<struct<kind:string,text:string,s:long,e:long>>"


def _find(batches):
    """Base spans, the places to decode, and one example of each kind, of each text."""
    for b in batches:
        base, places, examples = [], [], []
        for text in b.column("text"):
            t = text.as_py() or ""
            spans = base_spans(t)
            base.append([{"kind": k, "s": s, "e": e} for k, s, e in spans])
            places.append([{"at": x, "text": t[x:y]} for x, y in windows(t, spans)])
            first = {k: (s, e) for k, s, e in reversed(spans) if e - s <= MAX_CHARS}
            examples.append([{"kind": k, "text": t[max(0, s - 24):e + 24], "s": min(s, 24), "e": min(s, 24) + e - s} for k, (s, e) in first.items()])
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(base, pa.list_(SPAN)), pa.array(places, pa.list_(PLACE)), pa.array(examples, pa.list_(EXAMPLE))],
                                         names=["id", "base", "places", "examples"])


def learn(found: DataFrame, per_kind: int = 60) -> SemiCRF:
    """The field trained on at most ``per_kind`` distinct examples of each kind and four times as many places without one, those of smallest
    hash, so that the sample depends neither on order nor on partitions."""
    ex = found.select(F.explode("examples").alias("x")).select("x.*")
    picked = []
    for kind in KINDS:
        rows = ex.where(F.col("kind") == kind).distinct().orderBy(F.xxhash64("text", "s"), "text", "s").limit(per_kind).collect()
        picked += [(r["kind"], r["text"], r["s"], r["e"]) for r in rows]
    near = found.where("size(base) = 0").select(F.explode("places").alias("p")).select(F.substring("p.text", 1, 256).alias("t"))
    empty = [r["t"] for r in near.distinct().orderBy(F.xxhash64("t"), "t").limit(4 * per_kind).collect()]
    return SemiCRF(training_windows(picked, empty))


def _added(model: SemiCRF, known: dict, base: list[tuple[str, int, int]], at: int, text: str) -> list[tuple[str, int, int]]:
    fixed = tuple((max(0, s - at), min(len(text), e - at)) for _, s, e in base if s < at + len(text) and e > at)
    key = (text, fixed)
    if key not in known:
        if len(known) > 50_000:
            known.clear()
        known[key] = model.decode(text, list(fixed))
    return [(k, s + at, e + at) for k, s, e in known[key]]


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), *x[1:])))


def _model(docs: DataFrame, id_col: str, text_col: str, per_kind: int):
    src = pick(docs, id=id_col, text=text_col)
    found = stage(src.mapInArrow(_find, f"id {dict(src.dtypes)['id']}, {FOUND}"), "personal")
    return found, docs.sparkSession.sparkContext.broadcast(learn(found, per_kind))


def pii_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_kind: int = 60) -> DataFrame:
    """One row per document: ``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)``.

    Spans are ``kind:start:end`` in code points, end exclusive, by kind as in ``KINDS``, then start, comma-joined. The counts and
    ``base_sha256`` are of the base spans alone; ``n_added`` further spans come from the field and overlap no base span.
    Null or empty text: no spans. Without base spans anywhere there are no examples, and nothing is added. Repeated rows are
    each scanned, null ids stay, other columns are ignored. Whole texts are scanned once; the field is trained on a bounded sample
    (``per_kind``) and decodes every place of every text that may hold a segment.
    """
    found, model = _model(docs, id_col, text_col, per_kind)

    def judge(batches):
        m, known = model.value, {}
        for b in batches:
            rows = {k: [] for k in (*("n_" + k for k in KINDS), "base_sha256", "spans", "n_added")}
            for base, places in zip(b.column("base").to_pylist(), b.column("places").to_pylist()):
                spans = [(x["kind"], x["s"], x["e"]) for x in base]
                more = [x for p in places for x in _added(m, known, spans, p["at"], p["text"])]
                for k in KINDS:
                    rows["n_" + k].append(sum(x[0] == k for x in spans))
                rows["base_sha256"].append(hashlib.sha256(_join(spans).encode()).hexdigest())
                rows["spans"].append(_join(spans + more))
                rows["n_added"].append(len(more))
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in rows.items()]],
                                             names=["id", *rows])

    out = f"id {dict(found.dtypes)['id']}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return found.select("id", "base", "places").mapInArrow(judge, out).withColumnRenamed("id", id_col)


def redact_pii(docs: DataFrame, text_col: str = "text", per_kind: int = 60) -> DataFrame:
    """All rows and columns of ``docs``, every span that ``pii_scan`` finds replaced by its kind (``[EMAIL]``; overlapping spans as one, named by the
    first). Texts without one stay as they are, null stays null."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    src = docs.select(*[qcol(c).alias("text" if c == text_col else a) for c, a in names.items()])
    _, model = _model(src.select(F.lit(0).alias("id"), "text"), "id", "text", per_kind)

    def hide(batches):
        m, known = model.value, {}
        for b in batches:
            out = []
            for text in b.column("text"):
                t = text.as_py()
                spans = base_spans(t or "")
                spans += [x for a, z in windows(t or "", spans) for x in _added(m, known, spans, a, t[a:z])]
                parts, at = [], 0
                for kind, s, e in sorted(spans, key=lambda x: x[1:]):
                    if s >= at:
                        parts += [t[at:s], f"[{kind.upper()}]"]
                    at = max(at, e)
                out.append("".join(parts) + t[at:] if spans else t)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == "text" else b.column(n) for n in b.schema.names], names=b.schema.names)

    out = src.mapInArrow(hide, ", ".join(f"{c} {t}" for c, t in src.dtypes))
    return out.select(*[F.col("text" if c == text_col else a).alias(c) for c, a in names.items()])

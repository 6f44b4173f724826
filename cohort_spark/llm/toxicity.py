"""Operator 8, toxicity: noisy-channel deobfuscation, then a score of the restored words.

Disguised words (leetspeak, spaced-out letters, stretched letters) are read as a noisy channel's output: every observed
character may stand for some intended letters, a repetition or a separator may stand for nothing, each at a cost, and a
Viterbi search finds the likeliest intended word under a character trigram model counted over all texts. The restored
words are then weighed with a lexicon of words and word beginnings learnt from labelled documents, and a logistic
function of a document's evidence gives its score.
"""

from __future__ import annotations

import re
from collections import Counter
from math import exp, log, log1p, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.common import pick, stage

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100))
SYMBOLS = 64  # 0: anything that is no letter; 1..: LETTERS; 63: other letters
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
#: Letters that a character may stand for in leetspeak.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
SWAP, DROP, SPACE, BREAK = 1.0, 0.7, 0.2, 0.2  # channel costs: a stand-in, a dropped repetition, a dropped separator, one that ends a word

WORD = re.compile(r"[^\W\d_]+")
SPACED = re.compile(r"(?<!\S)[^\W_](?: [^\W_]){2,}(?!\S)")  # single characters between spaces
MAYBE_SPACED = re.compile(r" \S \S(?:\s|\Z)")  # found wherever SPACED finds something
DOTTED = re.compile(r"(?<![^\W_])[^\W_](?:[.*_-][^\W_]){2,}(?![^\W_])")  # within a token
LEET_RUN = re.compile(r"(?:[^\W_]|[@$!|+(])+")
TRAILING = re.compile(r"(?:([@$!|+(])\1+|[!|+(])$")  # punctuation rather than stand-ins
STRETCHED = re.compile(r"([^\W\d_])\1\1")


def trigram_counts(batches):
    """Counts of character trigrams of whole texts (lower-cased, folded to 64 symbols), one emission per task."""
    table = np.zeros(0x10000, np.int32)
    for c in range(0x10000):
        if chr(c).isalpha():
            table[c] = CODE.get(chr(c), SYMBOLS - 1)
    total = np.zeros(SYMBOLS ** 3, np.int64)
    for b in batches:
        for text in b.column("text"):
            s = " " + (text.as_py() or "").lower() + " "
            for at in range(0, len(s), 1_000_000):  # bounds memory; neighbours overlap by two characters
                c = np.frombuffer(s[max(0, at - 2):at + 1_000_000].encode("utf-32-le", "surrogatepass"), np.uint32)
                k = table[np.minimum(c, 0xFFFF)]
                total += np.bincount(k[:-2] * SYMBOLS**2 + k[1:-1] * SYMBOLS + k[2:], minlength=SYMBOLS**3) if len(k) > 2 else 0
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["gram", "n"])


class Restorer:
    """Viterbi decoding of disguised words under the trigram model; keeps a bounded memory of words seen."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        uni = (c.sum((0, 1)) + 1) / (c.sum() + SYMBOLS)
        bi = (c.sum(0) + 5 * uni) / (c.sum((0, 2))[:, None] + 5)
        tri = (c + 5 * bi[None]) / (c.sum(2)[:, :, None] + 5)
        self._cost = -np.log(tri)
        self._seen: dict[str, str] = {}

    def __call__(self, token: str) -> str:
        if len(self._seen) > 200_000:
            self._seen.clear()
        if token not in self._seen:
            self._seen[token] = self._decode(token)
        return self._seen[token]

    def _decode(self, token: str) -> str:
        cost, paths, before = self._cost, {(0, 0): (0.0, None)}, ""  # a path is its last letter and the path before
        for ch in token:
            choices: list[tuple[str, float]] = []
            if ch.isalpha():
                choices.append((ch, 0.0))
            choices += [(x, SWAP) for x in LEET.get(ch, "")]
            if ch == before:
                choices.append(("", DROP))
            if not choices or ch in " .*_-":
                choices += [("", SPACE), (" ", BREAK)]
            step: dict[tuple[int, int], tuple] = {}
            for (p, q), (total, path) in paths.items():
                for letter, extra in choices:
                    if not letter:
                        key, value = (p, q), total + extra
                    elif letter == " ":
                        if not q:
                            continue
                        key, value = (q, 0), total + extra + cost[p, q, 0]
                    else:
                        k = CODE.get(letter, SYMBOLS - 1)
                        key, value = (q, k), total + extra + cost[p, q, k]
                    if key not in step or value < step[key][0]:
                        step[key] = (value, (letter, path) if letter else path)
            paths, before = step, ch
        _, path = min(((total + (cost[p, q, 0] if q else 0.0), path) for (p, q), (total, path) in paths.items()), key=lambda x: x[0])
        out = []
        while path is not None:
            letter, path = path
            out.append(letter)
        return "".join(reversed(out))


def _disguised(run: str) -> bool:
    """Whether a run may be a word with stand-ins: with letters and stand-ins, and not mostly digits."""
    letters, marks = sum(map(str.isalpha, run)), sum(c in LEET for c in run)
    return letters >= 2 and marks > 0 and 5 * sum(map(str.isdigit, run)) <= 3 * len(run)


def token_words(token: str, restore: Restorer) -> list[str]:
    """The words of a lower-cased token without white space, with the restored forms of disguised ones."""
    words = WORD.findall(token)
    if not token.isalpha() and len(token) > 2:
        words += [x for m in DOTTED.finditer(token) for x in WORD.findall(restore(m[0]))]
        for m in LEET_RUN.finditer(token):
            run = TRAILING.sub("", m[0])
            if _disguised(run):
                words += WORD.findall(restore(run))
    if STRETCHED.search(token):
        words += [x for w in WORD.findall(token) if STRETCHED.search(w) for x in WORD.findall(restore(w))]
    return words


def spaced_words(low: str, restore: Restorer) -> list[str]:
    """Restored forms of spaced-out words of a lower-cased text."""
    if not MAYBE_SPACED.search(low):
        return []
    return [w for m in SPACED.finditer(low) for w in WORD.findall(restore(m[0]))]


def restored_words(text: str, restore: Restorer) -> set[str]:
    """The distinct words of a text, lower-cased, with the restored forms of its disguised ones."""
    low = text.lower()
    out = set(spaced_words(low, restore))
    for token in set(low.split()):
        out.update(token_words(token, restore))
    return out


def features(word: str) -> list[str]:
    """The word, and its beginnings (stems carry over to unseen endings)."""
    return [word + "$", *[word[:k] for k in (4, 5, 6) if len(word) > k]]


def lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int, min_docs: int, min_weight: float) -> dict[str, float]:
    """Weights of features: the lower confidence bound (two standard errors) of the log-odds ratio."""
    out = {}
    for f, a, b in counts:
        if a < min_docs:
            continue
        x, y = a + 0.5, b + 0.5
        w = log(x / (toxic - a + 0.5)) - log(y / (clean - b + 0.5)) - 2 * sqrt(1 / x + 1 / y)
        if w >= min_weight:
            out[f] = w
    return out


class Scorer:
    """Evidence of a document: the largest weight of its tokens, and the sum over its distinct tokens (logarithmic)."""

    def __init__(self, weights: dict[str, float], restore: Restorer):
        self.weights, self.restore, self._seen, self.beta = weights, restore, {}, np.zeros(3)

    def _weight(self, words: list[str]) -> float:
        return max([self.weights.get(f, 0.0) for w in words for f in features(w)], default=0.0)

    def evidence(self, text: str) -> tuple[float, float]:
        seen, low = self._seen, text.lower()
        if len(seen) > 500_000:
            seen.clear()
        tokens = set(low.split())
        for t in tokens.difference(seen):
            seen[t] = self._weight(token_words(t, self.restore))
        found = [v for v in map(seen.__getitem__, tokens) if v]
        found += [v for w in spaced_words(low, self.restore) if (v := self._weight([w]))]
        return max(found, default=0.0), log1p(sum(sorted(found)))

    def probability(self, e: tuple[float, float]) -> float:
        z = float(self.beta[0] + self.beta[1] * e[0] + self.beta[2] * e[1])
        return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Ridge logistic regression of weighted rows by Newton steps; slopes are kept non-negative (evidence never counts against)."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge * np.eye(len(beta)), x.T @ (weight * (y - p)) - ridge * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    beta[1:] = np.maximum(beta[1:], 0)
    return beta


def learn(docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int, min_docs: int, min_weight: float) -> Scorer:
    """A scorer: the trigram model over all of ``docs`` (id, text), lexicon and scale from a bounded sample of ``labels`` (id, toxic)."""
    spark = docs.sparkSession
    grams = docs.select("text").mapInArrow(trigram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(SYMBOLS ** 3, np.int64)
    for r in grams.collect():  # at most 64**3 rows
        counts[r["gram"]] = r["n"]
    restore = spark.sparkContext.broadcast(counts)

    marked = labels.where("id is not null and toxic is not null").groupBy("id").agg((F.max("toxic") > 0).alias("toxic"))
    order = [F.xxhash64(F.col("id").cast("string")), "id"]
    sample = stage(marked.where("toxic").orderBy(*order).limit(max_toxic).unionAll(marked.where("not toxic").orderBy(*order).limit(max_clean)), "toxic-sample")
    train = stage(docs.join(F.broadcast(sample), "id").select("toxic", "text"), "toxic-train")  # at most max_toxic + max_clean rows

    def count(batches):
        r = Restorer(restore.value)
        for b in batches:
            c = {True: Counter(), False: Counter()}
            for text, toxic in zip(b.column("text"), b.column("toxic")):
                c[toxic.as_py()].update({f for w in restored_words(text.as_py() or "", r) for f in features(w)})
            names = list(c[True] | c[False])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([c[True][n] for n in names], pa.int64()),
                                              pa.array([c[False][n] for n in names], pa.int64())], names=["f", "a", "b"])

    size = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    toxic, clean = size.get(True, 0), size.get(False, 0)
    odd = F.col("a") * (clean + 1) > F.col("b") * (toxic + 1) * float(np.exp(min_weight))  # far more common in toxic texts
    rows = (train.mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
            .where((F.col("a") >= min_docs) & odd).collect())  # bounded by the sample
    scorer = Scorer(lexicon([tuple(r) for r in rows], toxic, clean, min_docs, min_weight), Restorer(counts))
    weights = spark.sparkContext.broadcast(scorer.weights)

    def weigh(batches):
        s = Scorer(weights.value, Restorer(restore.value))
        for b in batches:
            e = [s.evidence(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array([x for x, _ in e], pa.float64()), pa.array([x for _, x in e], pa.float64())],
                                             names=["toxic", "top", "total"])

    seen = train.mapInArrow(weigh, "toxic boolean, top double, total double").toPandas()
    if toxic and clean:
        given = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # the bounds may thin one kind more than the other
        y = seen["toxic"].to_numpy().astype(bool)
        scorer.beta = _fit(seen[["top", "total"]].to_numpy(), y.astype(float), np.where(y, max(1.0, given[True] / max_toxic), max(1.0, given[False] / max_clean)))
    else:
        scorer.beta = np.array([log((toxic + 0.5) / (clean + 0.5)), 0.0, 0.0])
    scorer.counts = counts
    return scorer


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             cut: float = 0.7, max_toxic: int = 8_000, max_clean: int = 12_000, min_docs: int = 4, min_weight: float = 1.0) -> DataFrame:
    """One row per document: ``(id, held_out, score, predicted)``.

    Rows whose ``crc32(id as text) mod 3`` is 1 are held out: their labels are never read. Of the other labelled rows, the
    ``max_toxic`` toxic and ``max_clean`` clean ones with the smallest id hashes teach lexicon and scale (a label given twice
    counts as toxic if either is). The character model counts all texts. Only the text enters a score. Null or empty text:
    the score without evidence. Null id: scored, not held out. No usable labels of one kind: a constant score. Rows may
    repeat. Columns besides the named ones are ignored. Texts are read three times and never shuffled.
    """
    out_of = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(3)) == 1
    src = pick(docs, id=id_col, text=text_col)
    marks = pick(labels, id=id_col, toxic=label_col).where(~out_of)
    scorer = learn(src, marks, max_toxic, max_clean, min_docs, min_weight)
    model = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.counts, scorer.beta))

    def score(batches):
        weights, counts, beta = model.value
        s = Scorer(weights, Restorer(counts))
        s.beta = beta
        for b in batches:
            p = [s.probability(s.evidence(t.as_py() or "")) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(p, pa.float64())], names=["id", "score"])

    scored = src.mapInArrow(score, f"id {dict(src.dtypes)['id']}, score double")
    return scored.select(F.col("id").alias(id_col), F.coalesce(out_of, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))

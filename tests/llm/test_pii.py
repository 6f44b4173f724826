"""Operator 13: base spans against plain regular expressions, the field against all splits, disguises, clean texts, odd rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from cohort_spark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def luhn(d):
        odd = sum(int(c) for c in d[-1::-2])
        return (odd + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])) % 10 == 0
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_plain_patterns(docs):
    rnd = random.Random(4)
    made = ["".join(rnd.choice(rnd.choice(["a1@.", "0123456789. -", "+1()- .5", "a@.-_é\n"])) for _ in range(rnd.randrange(80))) for _ in range(20000)]
    made += ["@a.b@c.d", "x@a.b@c.d", "a@b@c.d.", "1.2.3.4.5.6.7.8", "999.1.2.3.4", "4111 1111-1111 1111", "0" * 25 + ".1.1.1", "+1 (017) 555-7713-", "é@é.é"]
    for t in made + [r["text"] or "" for r in docs.collect()]:
        assert pii.base_spans(t) == plain(t), t


def test_long_texts_take_linear_time():
    import time

    began = time.time()
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + " " * 300_000, "@" + "a" * 300_000, "1 " * 100_000, " at " * 50_000, "(" * 200_000):
        pii.windows(t, pii.base_spans(t))
    assert time.time() - began < 20


def examples(n):
    rnd, out = random.Random(n), []
    words = lambda: " ".join(rnd.choice(["the", "on", "we", "Haus", "était", "ring", "read", "it,", "box."]) for _ in range(4))
    for _ in range(n):
        card = "".join(str(rnd.randrange(10)) for _ in range(15))
        card += next(c for c in "0123456789" if pii.luhn(card + c))
        for kind, span in (("email", f"{rnd.choice(['an', 'bo.li', 'kim'])}.{rnd.randrange(99)}@mail{rnd.randrange(9)}.example.com"),
                           ("ip", ".".join(str(rnd.randrange(256)) for _ in range(4))), ("card", card),
                           ("phone", f"+1 ({rnd.randrange(1000):03}) 555-{rnd.randrange(10000):04}")):
            left = words() + " "
            out.append((kind, left + span + " " + words(), len(left), len(left) + len(span)))
    return out


@pytest.fixture(scope="module")
def model():
    return pii.SemiCRF(pii.training_windows(examples(60), ["in 2019 we sold 1 234 567 boxes", "the 2024-05-01 10:00:00 run"]))


def test_disguises_are_found_and_spoiled_spans_are_not(model):
    found, total, false, wrong = 0, 0, 0, 0
    for kind, text, s, e in examples(25)[4:]:
        for way in pii.disguises(kind, text[s:e]):
            t = text[:s] + way + text[e:]
            found += (kind, s, s + len(way)) in model.decode(t, [x[1:] for x in pii.base_spans(t)]) + pii.base_spans(t)
            total += 1
        for way in [*pii.spoiled(kind, text[s:e]), *pii.ordinary(random.Random(s))]:
            t = text[:s] + way + text[e:]
            wrong += bool(model.decode(t, [x[1:] for x in pii.base_spans(t)]))
            false += 1
    assert found / total > 0.93 and wrong / false < 0.02


def splits(n, segs, i=0):
    """All ways to split tokens ``i..n`` into single outside tokens and segments."""
    if i == n:
        yield ()
        return
    yield from splits(n, segs, i + 1)
    for x, (a, b, _, _) in enumerate(segs):
        if a == i:
            for rest in splits(n, segs, b):
                yield (x, *rest)


def test_field_equals_all_splits(model):
    for text in ("on +1 (017) 555-7713 or 80.1.2.3", "a.b at c dot d", "4000 1234 5678 9010 1.1.1.1"):
        n, segs = pii.candidates(text, [])
        feats = np.array([[model.ids.get((k, v), 0) for k, v in enumerate(pii.features(text, s, e))] for _, _, s, e in segs])
        scores = model._scores(feats)
        weight, best = np.zeros_like(scores), (0.0, ())
        total = 0.0
        for way in splits(n, segs):
            for kinds in itertools.product(range(4), repeat=len(way)):
                w = sum(scores[x, k] for x, k in zip(way, kinds))
                total += np.exp(w)
                for x, k in zip(way, kinds):
                    weight[x, k] += np.exp(w)
                best = max(best, (w - len(way), tuple((pii.KINDS[k], *segs[x][2:]) for x, k in zip(way, kinds))))
        assert np.allclose(weight / total, model._expected(n, segs, feats))
        assert tuple(model.decode(text, [])) == best[1]


def test_scan_and_redaction(spark, docs, odd_docs, no_docs):
    got = {r["doc_id"]: r for r in pii.pii_scan(docs).collect()}
    for r in docs.collect():
        base = plain(r["text"] or "")
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        g = got[r["doc_id"]]
        assert [g["n_" + k] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert g["base_sha256"] == hashlib.sha256(line.encode()).hexdigest() and set(line.split(",")) <= set(g["spans"].split(",")) | {""}
        spans = sorted((int(x.split(":")[1]), int(x.split(":")[2])) for x in g["spans"].split(",") if x)
        assert g["n_added"] == len(spans) - len(base)
    assert sum(g["n_added"] for g in got.values()) <= 3  # the given texts hide little
    assert pii.pii_scan(odd_docs).count() == odd_docs.count() and pii.pii_scan(no_docs).count() == 0
    hidden = pii.redact_pii(docs)
    assert hidden.columns == docs.columns and hidden.count() == docs.count()
    assert not any(plain(r["text"] or "") for r in hidden.collect())


def test_disguises_in_a_table(spark):
    texts = [t for _, t, _, _ in examples(40)]
    hidden = ["reach me at jo.li at mail3 dot example dot com today", "call (212) 555-0147 now", "host 10[.]20[.]30[.]40 is down", "nothing here at all, 12 boxes on 2024-01-02"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts + hidden)], "doc_id long, text string, id string, n int")
    got = {r["doc_id"]: r["spans"] for r in pii.pii_scan(df).collect()}
    n = len(texts)
    kinds = [got[n + i].split(":")[0] for i in range(4)]
    assert kinds[1:] == ["phone", "ip", ""] and kinds[0] == "email"
    assert not got[n + 3]

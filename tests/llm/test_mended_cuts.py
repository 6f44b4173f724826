"""Cases that earlier limits lost: long disguises, many credentials, one very long document in a mix."""

import random

import numpy as np
import pytest

from cohort_spark.llm import secret_scan as S
from cohort_spark.llm import toxicity as X
from cohort_spark.llm.source_mix import source_mix


@pytest.fixture(scope="module")
def restore():
    import pyarrow as pa

    words = "you are a stupid idiot the pathetic moron and clown with trash for brains who loses all time little stone island bottle".split()
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(words)] * 50)], names=["text"])
    counts = next(iter(X.trigram_counts([batch])))
    table = np.zeros(X.SYMBOLS ** 3, np.int64)
    table[counts["gram"].to_numpy()] = counts["n"].to_numpy()
    return X.Restorer(table)


def test_spaced_runs_of_any_length_and_place(restore):
    said = "you are a stupid idiot and a clown with trash for brains"
    assert {"stupid", "idiot", "clown", "brains"} <= X.restored_words(" ".join(said.replace(" ", "")), restore)
    assert "idiot" in X.restored_words("foo\ni d i o t\nbaz", restore) and "idiot" in X.restored_words("i d i o t", restore)
    assert {"you", "idiot"} <= X.restored_words("so y o u i d i o t there", restore)


def test_stretched_and_leet_runs_of_any_length(restore):
    assert "idiot" in X.token_words("idi" + "o" * 30 + "t", restore)
    assert "stupid" in X.token_words("$tup1" + "d" * 40, restore)
    assert X.token_words("a" * 20000, restore)  # linear


def test_edges_of_long_texts_are_counted():
    import pyarrow as pa

    def table(text):
        b = next(iter(X.trigram_counts([pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])])))
        return dict(zip(b["gram"].to_pylist(), b["n"].to_pylist()))

    whole, word = "ab " * 400_000 + "xyz", table("xyz")
    assert sum(table(whole).values()) == len(whole)
    assert all(g in table(whole) for g in word if g % X.SYMBOLS == 0)  # the end of the text is an edge


@pytest.mark.parametrize("share", [0.005, 0.05, 0.3])
def test_bare_keys_are_found_whatever_their_share(share):
    rnd = random.Random(7)
    key = lambda: "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))
    word = lambda: "".join(rnd.choice("aeiounrstlmd") for _ in range(rnd.randrange(16, 30)))
    plain = lambda: rnd.choice([word(), "-".join(word()[:6] for _ in range(3)), f"{rnd.randrange(10**15, 10**17)}", f"page-{rnd.randrange(99)}-of-{word()[:8]}-section"])
    labelled = {"assign": [key() for _ in range(200)], "hex": ["".join(rnd.choice("0123456789abcdef") for _ in range(40)) for _ in range(200)], "access": []}
    f = S.Formats(labelled, [key() if rnd.random() < share else plain() for _ in range(400)])
    found = np.mean([f.is_secret(key()) for _ in range(300)])
    print(found, f.cut)
    assert found >= 0.8
    assert np.mean([f.is_secret(plain()) for _ in range(300)]) <= 0.03


def test_short_candidates_need_digits_and_letters():
    _, free = S.base_spans("use hunter2Xy9Qz here, extraordinary 1234567890123 words")
    assert [("use hunter2Xy9Qz here, extraordinary 1234567890123 words")[a:b] for a, b in free] == ["hunter2Xy9Qz"]


@pytest.mark.parametrize("seed", range(6))
def test_a_mix_meets_its_target_beside_one_very_long_document(spark, seed):
    rows = [(i, "w " * 100, "a") for i in range(2000)] + [(2000, "w " * 150_000, "a")]
    out = source_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed=seed).collect()
    target = out[0].target
    assert target == 525_000 and abs(sum(r.taken for r in out) - target) < 100 and all(r.taken <= 2 * r.size for r in out)


def test_every_size_is_filled_to_the_smallest_document(spark):
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.choice([1, 3, 10, 40, 700, 5000]), rnd.choice("abc")) for i in range(600)]
    out = source_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = {i: s for i, _, s in rows}
    for s in "abc":
        mine = [r for r in out if by[r.doc_id] == s]
        full = mine[0].target // mine[0].source_size
        over = [r.size for r in mine if r.taken == full * r.size]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(1, min(over, default=0) / 2)

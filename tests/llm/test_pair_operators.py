"""Operators 3 and 9 and the components, against brute force."""

import random
import time

import numpy as np

from cohort_spark.llm.common import forest, join_parts
from cohort_spark.llm.components import connected_components
from cohort_spark.llm.embedding_dedup import _compare, _unit, embedding_dedup, table_plan, window_plan
from cohort_spark.llm.minhash_dedup import minhash_dedup


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(120)]
    edges += [(7, 7), (3, 2), (2, 3)]
    df = spark.createDataFrame(edges + [(None, 4)], "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    want = roots({x for e in edges for x in e if e[0] != e[1]}, edges)
    assert got == want and connected_components(df.limit(0)).count() == 0


def test_forest_joins_what_the_matrix_joins():
    rng = np.random.default_rng(4)
    for density in (0.01, 0.1, 0.9):
        m = rng.random((30, 40)) < density
        left, right = np.arange(30) * 2 + 1, np.arange(40) * 2
        edges = [(left[i], right[j]) for i, j in zip(*np.nonzero(m))]
        nodes = [*left, *right]
        assert roots(nodes, edges) == roots(nodes, [tuple(e) for e in forest(m, left, right)])
        assert len(forest(m, left, right)) <= 70


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def check_minhash(df, **options):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    sets = {i: shingles(t) for i, t in rows}
    ids = [i for i in sets if i is not None]
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and
             100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(ids, edges)
    for r in minhash_dedup(df, **options).collect():
        assert r.n_shingles == len(sets[r.doc_id])
        if r.doc_id is not None:
            assert (r.component_id, r.kept) == (want[r.doc_id], r.doc_id == want[r.doc_id])


def test_minhash_edges(odd_docs, no_docs):
    check_minhash(odd_docs.where("doc_id is not null or text like 'some%'"))
    assert minhash_dedup(no_docs).count() == 0


def test_minhash_groups(spark):
    """A large group of copies, a large group of near copies at all distances, chains, and unrelated texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(4))
    base = [word() for _ in range(120)]
    rows = [" ".join(base)] * 150
    for _ in range(150):  # edits of one word up to many
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = word()
        rows.append(" ".join(w))
    chain = [word() for _ in range(150)]
    for k in range(12):  # each links with its neighbours only
        rows.append(" ".join(chain))
        chain = [*chain[:k * 10], word(), *chain[k * 10 + 1:]]
    rows += [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(100)]
    rng.shuffle(rows)
    check_minhash(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))


def check_vectors(df):
    rows = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    good = [(i, lab, np.array(v, float)) for i, lab, v in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    edges = [(a[0], b[0]) for k, a in enumerate(good) for b in good[:k] if a[1] == b[1] and len(a[2]) == len(b[2]) and
             a[2] @ b[2] / np.sqrt(a[2] @ a[2]) / np.sqrt(b[2] @ b[2]) >= 0.98]
    want = roots([i for i, _, _ in rows], edges)
    out = {r.vec_id: r for r in embedding_dedup(df, cell=64).collect()}
    links = sum(r.n_links for r in out.values())
    right = sum(r.component_id == want[i] for i, r in out.items())
    assert all(r.kept == (r.component_id == i) for i, r in out.items())
    return links, 2 * len(edges), right / len(out)


def test_embedding_groups(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((400, 32))
    hot = base[0] / np.linalg.norm(base[0])
    vecs = [*base, *[base[1]] * 60]
    for k in range(200):  # a dense cluster at all distances around the limit
        d = rng.standard_normal(32)
        d -= d @ hot * hot
        vecs.append(hot + d / np.linalg.norm(d) * rng.uniform(0, 0.3))
    rows = [(i, [float(x) for x in v], int(i % 3 == 0)) for i, v in enumerate(vecs)]
    rows += [(10_000, None, 1), (10_001, [0.0] * 32, 1), (10_002, [float("nan")] * 32, 1), (10_003, [float("inf")] + [1.0] * 31, 1),
             (10_004, [None] + [1.0] * 31, 1), (10_005, [float(x) for x in base[0]], None), (10_006, [1.0, 2.0], 1), (10_007, [2.0, 4.0], 1), (10_008, [], 1)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, id string, cid int")
    got, want, right = check_vectors(df)
    assert want > 1000 and 0.97 * want <= got <= want and right > 0.98  # windowed candidates, exact verification
    assert embedding_dedup(df.limit(0)).count() == 0


def test_embedding_links_do_not_depend_on_other_rows(spark):
    rng = np.random.default_rng(8)
    few = []
    for v in rng.standard_normal((60, 16)):  # pairs just inside the limit
        d = rng.standard_normal(16)
        d -= d @ v / (v @ v) * v
        few += [v, v + d / np.linalg.norm(d) * np.linalg.norm(v) * 0.195]
    many = rng.standard_normal((1500, 16))
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate([*few, *many])]
    small, large = ({r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(spark.createDataFrame(x, "vec_id long, embedding array<double>, label int"), cell=128).collect()}
                    for x in (rows[:len(few)], rows))
    assert {i: large[i] for i in small} == small and sum(n for n, _ in small.values()) >= 100


def at_the_limit(rng, n, dim):
    """Pairs of unit vectors whose cosine is just within 0.98."""
    v = rng.standard_normal((n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    d = rng.standard_normal((n, dim))
    d -= (d * v).sum(axis=1, keepdims=True) * v
    w = (0.98 + 1e-9) * v + np.sqrt(1 - (0.98 + 1e-9) ** 2) * d / np.linalg.norm(d, axis=1, keepdims=True)
    return np.concatenate([v, w])


def test_embedding_links_at_the_limit_are_all_found(spark):
    for dim in (2, 40):
        x = at_the_limit(np.random.default_rng(dim), 1500 if dim > 2 else 20, dim)
        got = {r.vec_id: r.n_links for r in embedding_dedup(spark.createDataFrame([(i, [float(c) for c in v], 1) for i, v in enumerate(x)],
                                                                                   "vec_id long, embedding array<double>, label int"), cell=400).collect()}
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        want = (u @ u.T >= 0.98).sum(axis=1) - 1
        assert [got[i] for i in range(len(x))] == want.tolist() and want.min() >= 1


def test_embedding_block_takes_little_time():
    """A block of 4,096 vectors: 8 million pairs, most of which collide too seldom."""
    import pandas as pd

    x = at_the_limit(np.random.default_rng(9), 2048, 64)
    raw = [v.tobytes() for v in x]
    pdf = pd.DataFrame({"cid": np.arange(len(x)), "copies": 1, "raw": raw, "block": 0})
    start = time.thread_time()
    out = _compare(0.98, 16, 3)((1, 64, 0, 0), pdf)
    assert time.thread_time() - start < 2
    u = _unit(raw)
    assert out["n"].sum() == (u @ u.T >= 0.98).sum() - len(u) == 2 * 2048 and out["b"].notna().sum() == 2048


def test_parts_join_like_edges():
    rng = np.random.default_rng(5)
    part, edges = np.arange(300), rng.integers(0, 300, (220, 2))
    for a in range(0, 220, 30):
        part = join_parts(part, edges[a:a + 30, 0], edges[a:a + 30, 1])
    assert dict(enumerate(part.tolist())) == roots(range(300), edges.tolist())


def test_plans_keep_the_recall():
    half, hits = window_plan(0.98, 16, 0.995)
    assert 0.39 < half < 0.41 and 8 <= hits <= 14
    for n in (10, 10**5, 10**8):
        lead, tables = table_plan(n, 0.98, 0.995, 4096)
        meet = (1 - 0.2 * np.sqrt(2 / np.pi)) ** lead
        assert 1 - (1 - meet) ** tables >= 0.995 or lead == 0
        assert n * 0.4 ** lead <= 4096

"""Operator 11 against brute force: every edit sequence of short conversations, blocks, odd rows."""

import hashlib
import itertools
import random

from cohort_spark.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, pos int, block string, uid int, audit string"


def best_repair(rows):
    """Cheapest (cost, audit, lines) by trying all edits: rows are (role, text, must_go, truncated)."""
    def go(i, state):
        ends = {0: (0, "", ()), 3: (0, "", ())}
        if i == len(rows):
            ways = [ends[state]] if state in ends else []
        else:
            role, text, must_go, cut = rows[i]
            c, a, ls = memo(i + 1, state)
            ways = [(3 + c, "D" + a, ls)]
            turns = {0: "us", 1: "u", 2: "a", 3: "u"}[state]
            if not must_go:
                for r in turns:
                    nxt = {"s": 1, "u": 2, "a": 3}[r]
                    c, a, ls = memo(i + 1, nxt)
                    if role[:1] == r:
                        ways.append((cut + c, "K" + a, (f"{role}:{text}", *ls)))
                    if r != "s":
                        name = {"u": "user", "a": "assistant"}[r]
                        ways.append((2 + cut + c, "R" + a, (f"{name}:{text}", *ls)))
        return ways

    known = {}

    def memo(i, state):
        if (i, state) not in known:
            ways = {s: go(i, s) for s in range(4)}
            best = {s: min(w) if w else None for s, w in ways.items()}
            for _ in range(3):  # inserts move between states at one position
                for s in range(4):
                    nxt, name = (3, "assistant:") if s == 2 else (2, "user:")
                    if best[nxt]:
                        c, a, ls = best[nxt]
                        way = (2 + c, "I" + a, (name, *ls))
                        best[s] = min(filter(None, (best[s], way)))
            for s in range(4):
                known[i, s] = best[s]
        return known[i, state]
    return memo(0, 0)


def test_path_equals_all_edits():
    for roles in itertools.chain.from_iterable(itertools.product("suax", repeat=n) for n in range(6)):
        rnd = random.Random("".join(roles))
        rows = [(r, "t", rnd.random() < 0.2, rnd.random() < 0.3) for r in roles]
        codes = [cr.INITIAL.get(r, 0) + (8 if go else 4 if cut else 0) for r, _, go, cut in rows]
        tables = [cr.row_table(c) for c in codes]
        at, cost, audit = 0, 0, ""
        for t, s in zip(tables, cr.path_states(tables, 0, cr.FINISH, cr.Steps())):
            cost, audit, at = cost + t[at][s][0], audit + t[at][s][1], s
        want = best_repair(rows)
        assert (cost + 2 * len(cr.TAIL[at]), audit + cr.TAIL[at]) == want[:2], roles


def brute(rows):
    """The report and the hash for one conversation's rows ``(turn, role, text)`` in input order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    rows.sort(key=key)
    seen, judged, n = set(), [], {"b": 0, "d": 0, "t": 0}
    for _, role, text in rows:
        bare = text.rstrip(cr.SPACE)
        f = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        if f:
            n[f] += 1
        judged.append((role, text, f in ("b", "d") and f != "", f == "t"))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, lines = best_repair(judged)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["b"], n["d"], n["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, 1, "b", 2, "c") for r in rows], SCHEMA)
    report, turns = cr.repair_conversations(df)
    sha = {r["conv"]: r["digest"] for r in cr.turn_digests(turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: (*r[1:], sha.get(r["conv"], empty)) for r in report.collect()}


def some_rows(seed, convs, most):
    rnd = random.Random(seed)
    out = []
    for c in convs:
        for _ in range(rnd.randrange(1, most)):
            out.append((c, rnd.choice([None, *range(12)]), rnd.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
                        rnd.choice(["Yes.", "no", "", " \n", None, "Ünï!", "why? \t", "a long text " * 50 + "."])))
    return out


def expected(rows):
    convs: dict = {}
    for c, *r in rows:
        convs.setdefault(c, []).append(r)
    return {c: brute(r) for c, r in convs.items()}


def test_equals_brute_force(spark):
    rows = some_rows(1, [None, *range(40)], 14)
    assert repaired(spark, rows) == expected(rows)


def test_long_conversation_spans_blocks(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_BITS", 4)
    rnd = random.Random(5)
    rows = [(7, i, rnd.choice(["user", "assistant", "assistant", "system", "x"]), rnd.choice(["a.", "b", f"c{i}!", f"d{i}", ""])) for i in range(400)]
    rows += some_rows(2, [3, 5, 9, 11, None], 30)
    assert repaired(spark, rows) == expected(rows)


def test_damage_and_query_frame(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (None, None, None, None), (4, 9223372036854775807, "user", "a."), (4, -9223372036854775808, "user", "a.")]
    out = {r["conv_id"]: r for r in cr.damage_and_repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(out) == {1, None, 4}
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.damage_and_repair(none).count() == 0
    import zlib

    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    r = cr.damage_and_repair(spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")).collect()[0]
    assert tuple(r) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())

"""Operator 11, conversation structure repair by Hirschberg's divide and conquer over four states.

A repaired conversation's role initials are ``(s?(ua)+)?``. Before each turn it is in one of four states: nothing yet,
after the system turn, after a user turn, after an assistant turn. Each row moves between states by inserts and one of Keep,
Rerole or Delete. The cheapest edits are found in linear space: a forward vector (the cheapest cost of each state from the
start, and the order of the states' least audits) meets a backward vector (the cheapest cost to the end) in the middle;
the cheapest crossing with the least audit is fixed and both halves are solved alike. A left part's audit ends
with a letter that consumes a row, so no state's audit begins another's, and comparing left parts decides ties.

Rows are ordered by a range shuffle and cut into blocks, so a long conversation spans many tasks: each of its blocks first
gives the costs between all states, those of one conversation are solved like rows, and each block is then solved
between known states.
"""

from __future__ import annotations

import hashlib
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_spark.llm.common import pick, stage

#: The edits' costs and the white space that makes no text.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"

BLOCK_BITS = 13  # a block holds up to 2**13 rows
START, SYSTEM, USER, ASSISTANT = range(4)
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
TAIL = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}  # inserts that end a conversation
NEVER = 1 << 60


def _follows(state: int) -> int:
    """The state after the next turn that isn't a system turn."""
    return ASSISTANT if state == USER else USER


@cache
def row_table(code: int) -> list[list[tuple[int, str] | None]]:
    """``[state before][state after]`` of a row: the cheapest ``(cost, edits)``, least edits first; None: impossible.

    ``code`` is the role's initial as a state (0: another), plus 4 if truncated, or 8 if it must go.
    """
    role, must_go, extra = code % 4, code >= 8, TRUNCATED if code % 8 >= 4 else 0
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    for before in range(4):
        at, inserts = before, 0
        while inserts <= 2:
            options = [(at, DELETE, "D")]
            if not must_go:
                if role == SYSTEM and at == START or role in (USER, ASSISTANT) and role == _follows(at):
                    options.append((role, extra, "K"))
                options.append((_follows(at), REROLE + extra, "R"))
            for after, cost, edit in options:
                found = (cost + INSERT * inserts, "I" * inserts + edit)
                table[before][after] = min(filter(None, (table[before][after], found)))
            at, inserts = _follows(at), inserts + 1
    return table


class Steps:
    """Vector steps over tables, remembered per table and vector (costs relative to their minimum)."""

    def __init__(self):
        self.known: dict = {}

    def forward(self, table, costs: tuple, order: tuple) -> tuple[tuple, tuple, int]:
        """Costs and order of the states after ``table``, and the minimum that was taken off the costs."""
        key = (id(table), costs, order)
        if key not in self.known:
            best = []
            for after in range(4):
                ways = [(costs[b] + table[b][after][0], order[b], table[b][after][1]) for b in range(4) if costs[b] < NEVER and table[b][after]]
                best.append(min(ways) if ways else (NEVER, -1, ""))
            reached = sorted((w[1:], s) for s, w in enumerate(best) if w[0] < NEVER)
            rank = {s: i for i, (_, s) in enumerate(reached)}
            low = min(w[0] for w in best)
            self.known[key] = tuple(w[0] - low if w[0] < NEVER else NEVER for w in best), tuple(rank.get(s, -1) for s in range(4)), low, table
        return self.known[key][:3]

    def backward(self, table, costs: tuple) -> tuple[tuple, int]:
        key = (id(table), costs)
        if key not in self.known:
            best = [min((table[b][a][0] + costs[a] for a in range(4) if table[b][a] and costs[a] < NEVER), default=NEVER) for b in range(4)]
            low = min(best)
            self.known[key] = tuple(c - low if c < NEVER else NEVER for c in best), low, table
        return self.known[key][:2]


def _only(state: int) -> tuple:
    return tuple(0 if s == state else NEVER for s in range(4))


FINISH = tuple(INSERT * len(TAIL[s]) for s in range(4))


def path_states(tables: list, before: int, end: tuple, steps: Steps) -> list[int]:
    """The state after each table on the cheapest way from ``before`` to the end costs, the least audit among those."""
    out = [0] * len(tables)

    def solve(lo: int, hi: int, before: int, end: tuple) -> None:
        if hi - lo == 1:
            t = tables[lo][before]
            out[lo] = min((t[a][0] + end[a], t[a][1], a) for a in range(4) if t[a] and end[a] < NEVER)[2]
            return
        mid = (lo + hi) // 2
        costs, order = _only(before), _only(before)
        for i in range(lo, mid):
            costs, order, _ = steps.forward(tables[i], costs, order)
        rest = end
        for i in range(hi - 1, mid - 1, -1):
            rest, _ = steps.backward(tables[i], rest)
        crossing = min((costs[s] + rest[s], order[s], s) for s in range(4) if costs[s] < NEVER and rest[s] < NEVER)[2]
        solve(lo, mid, before, _only(crossing))
        solve(mid, hi, crossing, end)

    if tables:
        solve(0, len(tables), before, end)
    return out


def between_states(tables: list, steps: Steps) -> list[list[tuple[int, int] | None]]:
    """``[state before][state after]`` of a run of rows: the cheapest cost, and the place of its audit among those from the
    same state."""
    out = []
    for before in range(4):
        costs, order, total = _only(before), _only(before), 0
        for t in tables:
            costs, order, low = steps.forward(t, costs, order)
            total += low
        out.append([(total + costs[s], order[s]) if costs[s] < NEVER else None for s in range(4)])
    return out


def _runs(keys: list) -> list[tuple[int, int]]:
    """Maximal runs of equal neighbours."""
    cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def _summaries(t: pa.Table) -> pa.Table:
    """Per conversation of a block: counts, first and last role, and the costs between states where the conversation may
    go on in another block (elsewhere none)."""
    t = t.sort_by("pos")
    conv, code, fault = (t.column(c).to_pylist() for c in ("conv", "code", "fault"))
    steps, out = Steps(), []
    runs = _runs(conv)
    for k, (a, b) in enumerate(runs):
        edge = k in (0, len(runs) - 1)
        table = between_states([row_table(c) for c in code[a:b]], steps) if edge else []
        roles = [c % 4 for c in code[a:b]]
        out.append((conv[a], *(sum(f == x for f in fault[a:b]) for x in (1, 2, 3)), sum(not _legal(x, y) for x, y in zip(roles, roles[1:])), roles[0], roles[-1],
                    [c[0] if c else -1 for row in table for c in row], [c[1] if c else -1 for row in table for c in row]))
    cols = list(zip(*out))
    n, ints = len(out), pa.list_(pa.int64())
    return pa.table([pa.array(cols[0], t.schema.field("conv").type), pa.array([t.column("block")[0].as_py()] * n, pa.int64()),
                     *[pa.array(c, pa.int64()) for c in cols[1:7]], pa.array(cols[7], ints), pa.array(cols[8], ints)],
                    names=["conv", "block", "blank", "duplicate", "truncated", "illegal", "first", "last", "costs", "ranks"])


def _legal(x: int, y: int) -> bool:
    return (x, y) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def _joints(t: pa.Table) -> pa.Table:
    """States before and after each block of a conversation that spans several."""
    t = t.sort_by("block")
    tables = [[[(c, r) if c >= 0 else None for c, r in zip(costs[i:i + 4], ranks[i:i + 4])] for i in range(0, 16, 4)]
              for costs, ranks in zip(t.column("costs").to_pylist(), t.column("ranks").to_pylist())]
    after = path_states(tables, START, FINISH, Steps())
    return pa.table([t.column("conv"), t.column("block"), pa.array([START, *after[:-1]], pa.int64()), pa.array([*after[:-1], -1], pa.int64())],
                    names=["conv", "block", "before", "after"])


def _edits(t: pa.Table) -> pa.Table:
    """The edits of a block's rows in order, and the audit and cost of each of its conversations' parts."""
    t = t.sort_by("pos")
    conv, code, pos, uid, before, after = (t.column(c).to_pylist() for c in ("conv", "code", "pos", "uid", "before", "after"))
    steps, out = Steps(), []
    for a, b in _runs(conv):
        at = before[a]
        tables = [row_table(c) for c in code[a:b]]
        states = path_states(tables, at, FINISH if after[a] < 0 else _only(after[a]), steps)
        cost, audit = 0, []
        for i, state in enumerate(states, a):
            price, edits = tables[i - a][at][state]
            cost += price
            audit.append(edits)
            at = _write(out, conv[i], pos[i], 0, edits, at, state, uid[i])
        if after[a] < 0:
            audit.append(TAIL[at])
            cost += INSERT * len(TAIL[at])
            _write(out, conv[a], pos[b - 1], 4, TAIL[at], at, None, None)
        out.append((conv[a], pos[a], -1, None, None, None, "".join(audit), cost))
    cols = list(zip(*out))
    kinds = [t.schema.field("conv").type, pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=["conv", "pos", "sub", "edit", "new_role", "uid", "audit", "cost"])


def _write(out: list, conv, pos: int, sub: int, edits: str, at: int, state: int | None, uid) -> int:
    """Append the edits as rows; the state after them."""
    for e in edits:
        if e == "I" or e == "R":
            at = _follows(at)
        elif e == "K":
            at = state
        if e != "D":
            out.append((conv, pos, sub, e, ("user" if at == USER else "assistant") if e in "IR" else None, None if e == "I" else uid, None, None))
        sub += 1
    return at


def repair_conversations(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(report, turns)`` of conversations whose rows may be out of order, blank, repeated, cut short or of the wrong role.

    ``turns`` holds the repaired conversations: ``(conv, pos, sub, edit, role, text)``, in the order of ``pos, sub``; edits are K
    (kept), R (role changed to user or assistant) and I (inserted, empty text). ``report`` has a row per conversation with
    rows: ``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)``.

    Rows stand by turn, nulls first; rows of one turn by role, then by a hash of role and text. Null role or text reads as one
    space; a null conversation id is a conversation. A row's first fault counts: blank, duplicate (its role and text stand
    earlier), truncated (its last character but white space is none of ``.!?``). ``gaps`` is the last turn minus the first plus 1 minus
    the distinct turns (without turns 0; beyond a long null); ``illegal`` counts neighbours whose role initials are none of su, ua, au. ``audit``
    holds the cheapest edits' initials, ASCII-least among equals. Empty table: empty results. Other columns are ignored.

    Texts never enter Python: rows are judged by flags, one code a row is ordered and solved in blocks of bounded size, and the texts are
    joined to the edits by row number.
    """
    src = pick(convs, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    src = src.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    rows = stage(src.withColumn("uid", F.monotonically_increasing_id()), "turns")
    bare = F.rtrim("text", F.lit(SPACE))
    slim = rows.select("uid", "conv", "turn", "role", F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"), (bare == "").alias("blank"),
                       (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    firsts = slim.groupBy("conv", "digest").agg(F.min(F.struct("turn", "uid")).alias("f")).select(F.col("f.uid").alias("uid"), F.lit(1).alias("is_first"))
    fault = F.when(F.col("blank"), 1).when(F.col("is_first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    state = F.coalesce(*[F.when(F.substring("role", 1, 1) == c, s) for c, s in INITIAL.items()], F.lit(0))
    order = ["conv", "turn", "role", "digest", "uid"]
    ordered = (slim.join(firsts, "uid", "left").withColumn("fault", fault)
               .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
               .select("conv", "turn", "uid", "pos", F.shiftright("pos", BLOCK_BITS).alias("block"), "fault",
                       (state + F.when(F.col("fault").isin(1, 2), 8).when(F.col("fault") == 3, 4).otherwise(0)).alias("code")))
    ordered = stage(ordered, "turns-ordered")
    kind = dict(src.dtypes)["conv"]
    counts = "blank long, duplicate long, truncated long, illegal long"
    parts = stage(ordered.select("conv", "block", "pos", "code", "fault").groupBy("block")
                  .applyInArrow(_summaries, f"conv {kind}, block long, {counts}, first long, last long, costs array<long>, ranks array<long>"), "turn-blocks")
    several = parts.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv").alias("c"))
    joints = stage(parts.join(several, F.col("conv").eqNullSafe(F.col("c")), "left_semi").select("conv", "block", "costs", "ranks").groupBy("conv")
                   .applyInArrow(_joints, f"conv {kind}, block long, before long, after long"), "turn-joints")
    at = joints.select(F.col("conv").alias("c"), F.col("block").alias("b"), "before", "after")
    known = (ordered.select("conv", "block", "pos", "uid", "code").join(at, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left")
             .withColumns({"before": F.coalesce("before", F.lit(START).cast("long")), "after": F.coalesce("after", F.lit(-1).cast("long"))}).drop("c", "b"))
    edits = stage(known.groupBy("block").applyInArrow(
        _edits, f"conv {kind}, pos long, sub int, edit string, new_role string, uid long, audit string, cost long"), "turn-edits")

    turns = (edits.where("edit is not null").join(rows.select("uid", "role", "text"), "uid", "left")
             .select("conv", "pos", "sub", "edit", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    over = Window.partitionBy("conv").orderBy("block")
    pair = F.concat_ws(",", F.lag("last").over(over), F.col("first"))
    legal = pair.isin(*[f"{x},{y}" for x in range(4) for y in range(4) if _legal(x, y)])
    sums = (parts.withColumn("joint", F.when(F.lag("last").over(over).isNotNull() & ~legal, 1).otherwise(0))
            .groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + F.col("joint")).alias("illegal")))
    big = "decimal(38,0)"
    span = F.max("turn").cast(big) - F.min("turn").cast(big) + 1 - F.count("turn")
    gaps = (ordered.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv").agg(F.coalesce(span, F.lit(0)).try_cast("long").alias("gaps")))
    audits = (edits.where("audit is not null").groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("pos", "audit"))), lambda x: x["audit"])).alias("audit")))
    report = sums
    for more in (gaps, audits):
        more = more.withColumnRenamed("conv", "c")
        report = report.join(more, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    return report.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), turns


def _digests(batches):
    """SHA-256 of each conversation's lines, read in order; one line is held at a time."""
    now, h, kind, out = None, None, None, []
    for b in batches:
        kind = b.column("conv").type
        for conv, line in zip(b.column("conv"), b.column("line")):
            conv = conv.as_py()
            if h is None or conv != now:
                if h is not None:
                    out.append((now, h.hexdigest()))
                now, h = conv, hashlib.sha256(line.as_buffer())
            else:
                h.update(b"\n")
                h.update(line.as_buffer())
        if len(out) > 10_000:
            yield _digest_rows(out, kind)
            out = []
    if h is not None:
        yield _digest_rows([*out, (now, h.hexdigest())], kind)


def _digest_rows(out: list, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kind), pa.array([x[1] for x in out], pa.string())], names=["conv", "digest"])


def turn_digests(turns: DataFrame) -> DataFrame:
    """``(conv, digest)``: lowercase hex SHA-256 of ``role:text`` of a conversation's turns, newline-joined. A digest runs over its whole
    conversation in order, so one conversation is hashed by one task, line by line."""
    lines = turns.select("conv", "pos", "sub", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv").sortWithinPartitions("conv", "pos", "sub").mapInArrow(_digests, f"conv {dict(turns.dtypes)['conv']}, digest string")


def damage(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows damaged by ``crc32(conv:turn) % 20``: 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its
    role user. Nulls read as one space, also within the hashed text; ids and turns stay null."""
    src = pick(convs, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    blank = F.lit(" ")
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    kind = F.crc32(F.concat(F.coalesce(F.col("conv").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    out = (src.withColumn("kind", kind).where("kind <> 0")
           .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))))
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.when(F.col("kind") == 4, "user").otherwise(role).alias(role_col),
                      F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias(text_col))


def damage_and_repair(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The report of ``repair_conversations`` on the damaged rows with ``repaired_sha256``, for every conversation of ``convs``; those
    without rows after damage have zeros, an empty audit and the hash of the empty string."""
    report, turns = repair_conversations(damage(convs, conv_col, turn_col, role_col, text_col), conv_col, turn_col, role_col, text_col)
    out = pick(convs, id=conv_col).distinct()
    for more in (report.withColumnRenamed("conv", "c"), turn_digests(turns).select(F.col("conv").alias("d"), "digest")):
        out = out.join(more, F.col("id").eqNullSafe(F.col(more.columns[0])), "left").drop(more.columns[0])
    numbers = [F.when(F.col("audit").isNull(), F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias(conv_col), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

"""Conversation structure repair by a square-root checkpointed dynamic programme.

The turns of a conversation, in order, are edited at least cost so that the first letters of
their roles spell ``(s?(ua)+)?``: keep (0), rerole to user or assistant (3), delete (4), insert
an empty user or assistant turn (3).  Blank and repeated turns must go; a truncated turn that
stays adds 3.  Four states say what has been spelled: nothing, the ``s``, up to a ``u``, up to
an ``a``.  In each of them keeping, reroling and inserting lead to one state only, so the
audit (the edits' initials) says all, and the ASCII-least of the cheapest audits is found by
taking the least tight edit at every step.

Backward, the cost from each state to the end is kept at every sqrt(n)-th turn only; forward,
the vectors of one block after the other are computed again from its checkpoint.  A
conversation of n turns so holds about 2 sqrt(n) vectors.

Ordinary conversations are shuffled once, with their text, by ``conv_id``, sorted, and
streamed one by one.  Those of more than ``HOT_TURNS`` turns or ``HOT_CHARACTERS`` characters
(at most one for each so many of the input) never meet in one task: their turns are dealt by
ranges of the order, so each task has a segment.  A segment is summed up as the least cost from
each state to each state; joined from the end, these give the vectors at the segments' edges,
which are the checkpoints of the whole.  Each segment is then walked from all four states, and
the edges' states follow from the start.  Repeated turns are found by a grouping of digests.
Only the hash of the repaired text, a chain by nature, is streamed through one task, in chunks
that the segments' tasks made, and never held.

Cases: turns of null turn number come first; turns of one number are ordered by role and by the
digest of role and text (equal ones are interchangeable).  Nulls in role and text are one
space.  A role without a first letter s, u or a, or without any, fits nowhere as it is.  A
null ``conv_id`` is one conversation.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut, small_batches

HOT_TURNS, HOT_CHARACTERS = 1024, 4 << 20
#: Bytes of repaired text in one chunk of a hot conversation.
CHUNK = 1 << 20
EDGE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing, s, u, a spelled last; the role wanted next, and the state after it.
WANTED = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
NEVER = 1 << 50
#: A turn's class: its role's first letter (place in ``LETTERS``, 3: another) and its fault.
LETTERS = "sua"
BLANK, DUPLICATE, CUT_SHORT = 4, 8, 16
LEGAL = {(0, 1), (1, 2), (2, 1)}

Vector = list[int]


def options(kind: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of a turn of a class, in ASCII order."""
    out = [("D", DELETE, state)]
    if kind & (BLANK | DUPLICATE):
        return out
    more = TRUNCATED if kind & CUT_SHORT else 0
    letter = kind & 3
    if letter == 0 and state == 0:
        out.append(("K", KEEP + more, 1))
    elif letter in (1, 2) and LETTERS[letter] == WANTED[state][0]:
        out.append(("K", KEEP + more, AFTER[state]))
    out.append(("R", REROLE + more, AFTER[state]))
    return out


OPTIONS = [[options(kind, state) for state in range(4)] for kind in range(32)]


def inserting(v: Vector) -> Vector:
    """Costs when turns may also be inserted at this place."""
    u, a = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return [min(v[0], INSERT + u), min(v[1], INSERT + u), u, a]


END = inserting([0, NEVER, NEVER, 0])


def before(kind: int, after: Vector) -> Vector:
    return inserting([min(cost + after[to] for _, cost, to in edits) for edits in OPTIONS[kind]])


def checkpoints(kinds: bytes, after: Vector) -> tuple[list[Vector], int]:
    """Vectors at every block's start and at the end, and the turns of a block."""
    block = isqrt(len(kinds)) + 1
    kept, v = [after], after
    for i in range(len(kinds) - 1, -1, -1):
        v = before(kinds[i], v)
        if i % block == 0:
            kept.append(v)
    return kept[::-1], block


def walk(kinds: bytes, after: Vector, state: int, last: bool, kept: list[Vector], block: int) -> tuple[str, int]:
    """The ASCII-least tight audit from a state, and the state it ends in; inserts behind the
    last turn belong to what follows, unless this is the ``last`` of the conversation."""
    audit: list[str] = []
    for at in range(0, len(kinds), block):
        part = kinds[at:at + block]
        vectors = [kept[at // block + 1]]
        for kind in reversed(part):
            vectors.append(before(kind, vectors[-1]))
        vectors.reverse()
        for i, kind in enumerate(part):
            here, there = vectors[i], vectors[i + 1]
            while True:
                tight = min([(e, to) for e, cost, to in OPTIONS[kind][state] if cost + there[to] == here[state]]
                            + [("I", AFTER[state])] * (INSERT + here[AFTER[state]] == here[state]))
                audit.append(tight[0])
                state = tight[1]
                if tight[0] != "I":
                    break
    while last and after[state]:
        audit.append("I")
        state = AFTER[state]
    return "".join(audit), state


def least_audit(kinds: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    kept, block = checkpoints(kinds, END)
    return kept[0][0], walk(kinds, END, 0, True, kept, block)[0]


def edited(audit: str, turns: Iterator, kinds: bytes, state: int = 0) -> Iterator[tuple]:
    """(turn or None, role or None) of each repaired turn: None for one that was inserted, and
    None for a role that stays."""
    at = 0
    for edit in audit:
        turn = None
        if edit != "I":
            turn, kind = next(turns), kinds[at]
            at += 1
        if edit in "IR":
            yield turn, WANTED[state]
        elif edit == "K":
            yield turn, None
        if edit in "IR":
            state = AFTER[state]
        elif edit == "K":
            state = 1 if kind & 3 == 0 else AFTER[state]


def class_of(role: str, text: str, repeated: bool) -> int:
    end = text.rstrip(EDGE)[-1:]
    fault = BLANK if not end else DUPLICATE if repeated else 0 if end in ".!?" else CUT_SHORT
    return (LETTERS.find(role[:1]) if role[:1] and role[0] in LETTERS else 3) | fault


def illegal_pairs(kinds: bytes) -> int:
    return sum((a & 3, b & 3) not in LEGAL for a, b in zip(kinds, kinds[1:]))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults that a hash of ``conv_id:turn`` chooses."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    text, k = F.coalesce("text", F.lit(" ")), F.col("k")
    return (conversations.select("conv_id", "turn", "role", "text", (F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20).alias("k"))
            .filter(k != 0)
            .select("conv_id", "turn", F.when(k == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                    F.when(k == 1, "").when(k == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _order(*more: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "mark", *more)]


def _same_conversation(a: DataFrame, b: DataFrame) -> Column:
    return a["conv_id"].eqNullSafe(b["conv_id"])


def repair(turns: DataFrame, hot_turns: int = HOT_TURNS, hot_characters: int = HOT_CHARACTERS) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256,
    repaired`` of every conversation.  ``repaired`` is its text, a ``role:text`` for each turn,
    joined by line feeds; null for a hot conversation, whose turns ``hot_lines`` gives."""
    small_batches(turns.sparkSession)
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    marked = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                          F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("mark"))
    hot = cut(turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size"))
              .filter((F.col("n") > hot_turns) | (F.col("size") > hot_characters)).select("conv_id"))
    if hot.isEmpty():
        return _ordinary(marked)
    ordinary = marked.join(hot, _same_conversation(marked, hot), "left_anti")
    return _ordinary(ordinary).unionByName(_hot(cut(
        marked.join(hot, _same_conversation(marked, hot), "left_semi").withColumn("rid", F.monotonically_increasing_id()))))


COLUMNS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, repaired string"


def _ordinary(marked: DataFrame) -> DataFrame:
    kind = marked.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *(c.split()[0] for c in COLUMNS.split(", "))]

    def row(turns: list[tuple]) -> tuple:
        seen: set[str] = set()
        kinds = bytearray()
        for _, role, text, mark in turns:
            kinds.append(class_of(role, text, mark in seen))
            seen.add(mark)
        cost, audit = least_audit(kinds)
        lines = [f"{new or turn[1]}:{turn[2] if turn else ''}" for turn, new in edited(audit, iter(turns), kinds)]
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = numbers[-1] - numbers[0] + 1 - len(set(numbers)) if numbers else 0
        whole = "\n".join(lines)
        return (gaps, *(sum(k & fault > 0 for k in kinds) for fault in (BLANK, DUPLICATE, CUT_SHORT)),
                illegal_pairs(kinds), cost, audit, hashlib.sha256(whole.encode()).hexdigest(), whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_kind, held_id, held = None, None, []
        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            ids, rows, at = [], [], zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "mark")), strict=True)
            for conv_id, *turn in at:
                if held and conv_id != held_id:
                    ids.append(held_id)
                    rows.append(row(held))
                    held = []
                held_id = conv_id
                held.append(turn)
            if rows:
                yield out(ids, rows, id_kind)
        if held:
            yield out([held_id], [row(held)], id_kind)

    def out(ids: list, rows: list[tuple], id_kind: pa.DataType) -> pa.RecordBatch:
        kinds = [pa.int64()] * 6 + [pa.string()] * 3
        return pa.RecordBatch.from_arrays([pa.array(ids, id_kind), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names)

    return (marked.repartition("conv_id").sortWithinPartitions(*_order())
            .mapInArrow(run, f"conv_id {kind}, {COLUMNS}"))


def _segments(rows: DataFrame) -> DataFrame:
    """A row for each conversation in each range of the order: its ``classes`` and ``rids`` in
    order, its numbers of turns, and the least ``costs`` from state to state."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def summed(held_id, held: list[tuple], id_kind: pa.DataType) -> pa.RecordBatch:
        kinds = bytes(np.concatenate([h[0] for h in held]))
        costs = []
        for to in range(4):
            v = [0 if s == to else NEVER for s in range(4)]
            for k in reversed(kinds):
                v = before(k, v)
            costs.append(v)
        numbers = np.concatenate([h[2] for h in held])
        numbers = numbers[numbers.astype(str) != "None"]
        edge = [int(numbers[0]), int(numbers[-1]), len(set(numbers.tolist()))] if len(numbers) else [None, None, 0]
        return pa.RecordBatch.from_arrays(
            [pa.array([held_id], id_kind), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([kinds], pa.binary()),
             pa.array([np.concatenate([h[1] for h in held])], pa.list_(pa.int64())), *(pa.array([x], pa.int64()) for x in edge),
             pa.array([[min(c[s], NEVER) for c in costs for s in range(4)]], pa.list_(pa.int64()))],
            ["conv_id", "part", "kinds", "rids", "first_turn", "last_turn", "numbers", "costs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_kind, held_id, held = None, None, []
        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            ids = batch["conv_id"].to_pylist()
            starts = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]] + [len(ids)]
            for a, z in zip(starts, starts[1:]):
                if held and ids[a] != held_id:
                    yield summed(held_id, held, id_kind)
                    held = []
                held_id = ids[a]
                held.append((batch["kind"].to_numpy()[a:z].astype(np.uint8), batch["rid"].to_numpy()[a:z],
                             np.array(batch["turn"].slice(a, z - a).to_pylist(), dtype=object)))
        if held:
            yield summed(held_id, held, id_kind)

    return (rows.repartitionByRange(*_order("rid")).sortWithinPartitions(*_order("rid")).select("conv_id", "turn", "kind", "rid")
            .mapInArrow(run, f"conv_id {kind}, part long, kinds binary, rids array<long>, first_turn long, last_turn long, "
                             "numbers long, costs array<long>"))


def _edges(parts: pd.DataFrame) -> pd.DataFrame:
    """Of the segments of one conversation the vector behind each, from the last to the first."""
    parts = parts.sort_values("part")
    behind, v = [], END
    for costs in reversed(parts["costs"].tolist()):
        behind.append(v)
        v = inserting([min(NEVER, *(int(costs[4 * to + s]) + v[to] for to in range(4))) for s in range(4)])
    last = parts["part"] == parts["part"].max()
    return pd.DataFrame({"conv_id": parts["conv_id"], "part": parts["part"], "behind": behind[::-1], "last": last, "total": v[0]})


def _entries(parts: pd.DataFrame) -> pd.DataFrame:
    """Of the segments of one conversation the state each is entered in, from the first on, and
    what depends on two neighbours: an illegal pair, a turn number that both have."""
    parts = parts.sort_values("part")
    state, rows, letter, number = 0, [], None, None
    for r in parts.itertuples():
        pair = letter is not None and (letter, r.first_kind & 3) not in LEGAL
        shared = number is not None and number == r.first_turn
        rows.append((r.conv_id, r.part, state, int(pair), int(shared)))
        state, letter = int(r.exits[state]), r.last_kind & 3
        number = number if pd.isna(r.last_turn) else r.last_turn
    return pd.DataFrame(rows, columns=["conv_id", "part", "entry", "pair", "shared"]).astype({"conv_id": parts["conv_id"].dtype})


def _solved(rows: DataFrame) -> DataFrame:
    """The segments with their counts, ``entry`` state and ``audit``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    first = cut(rows.groupBy("conv_id", "mark").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "rid")).alias("first"))
                .select("conv_id", "mark", F.col("first.rid").alias("first_rid")))
    end = F.right(F.rtrim("text", F.lit(EDGE)), F.lit(1))
    letter = F.when(F.left("role", F.lit(1)) == "s", 0).when(F.left("role", F.lit(1)) == "u", 1).when(F.left("role", F.lit(1)) == "a", 2).otherwise(3)
    light = cut(rows.select("conv_id", "turn", "role", "mark", "rid", end.alias("end"), letter.alias("letter")))
    joined = light.join(first, _same_conversation(light, first) & (light["mark"] == first["mark"]))
    fault = F.when(F.col("end") == "", BLANK).when(F.col("rid") != F.col("first_rid"), DUPLICATE).when(~F.col("end").isin(".", "!", "?"), CUT_SHORT).otherwise(0)
    segments = cut(_segments(joined.select(light["conv_id"], "turn", "role", light["mark"], "rid", (F.col("letter") + fault).cast("int").alias("kind"))))
    edges = cut(segments.select("conv_id", "part", "costs").groupBy("conv_id").applyInPandas(
        _edges, f"conv_id {kind}, part long, behind array<long>, last boolean, total long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, exits, counts = [], [], []
            for kinds, behind, last in zip(batch["kinds"].to_pylist(), batch["behind"].to_pylist(), batch["last"].to_pylist(), strict=True):
                kept, block = checkpoints(kinds, behind)
                walked = [walk(kinds, behind, s, last, kept, block) for s in range(4)]
                audits.append([w[0] for w in walked])
                exits.append([w[1] for w in walked])
                counts.append([*(sum(k & fault > 0 for k in kinds) for fault in (BLANK, DUPLICATE, CUT_SHORT)), illegal_pairs(kinds), kinds[0], kinds[-1]])
            kept_columns = [c for c in batch.schema.names if c not in ("behind", "last")]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept_columns), pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int64())),
                 *(pa.array([c[i] for c in counts], pa.int64()) for i in range(6))],
                [*kept_columns, "audits", "exits", "blank", "duplicate", "truncated", "illegal", "first_kind", "last_kind"])

    both = segments.drop("costs").join(edges, _same_conversation(segments, edges) & (segments["part"] == edges["part"])).drop(edges["conv_id"]).drop(edges["part"])
    both = both.select("conv_id", "part", "kinds", "rids", "first_turn", "last_turn", "numbers", "total", "behind", "last")
    solved = cut(both.mapInArrow(run, f"conv_id {kind}, part long, kinds binary, rids array<long>, first_turn long, last_turn long, numbers long, total long, "
                                 "audits array<string>, exits array<long>, blank long, duplicate long, truncated long, illegal long, first_kind long, last_kind long"))
    entries = cut(solved.select("conv_id", "part", "exits", "first_kind", "last_kind", "first_turn", "last_turn").groupBy("conv_id").applyInPandas(
        _entries, f"conv_id {kind}, part long, entry long, pair long, shared long"))
    return cut(solved.join(entries, _same_conversation(solved, entries) & (solved["part"] == entries["part"])).drop(entries["conv_id"]).drop(entries["part"])
               .withColumn("audit", F.get("audits", F.col("entry").cast("int"))).drop("audits", "exits"))


def hot_lines(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``conv_id, part, place, line``: the repaired turns of hot conversations as ``role:text``."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, part, kinds, rids, entry, audit in zip(batch["conv_id"], *(
                    batch[c].to_pylist() for c in ("part", "kinds", "rids", "entry", "audit")), strict=True):
                found = list(edited(audit, iter(rids), kinds, entry))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv.as_py()] * n, conv.type), pa.array([part] * n, pa.int64()), pa.array(range(n), pa.int64()),
                     pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())],
                    ["conv_id", "part", "place", "rid", "new_role"])

    edits = cut(solved.select("conv_id", "part", "kinds", "rids", "entry", "audit").mapInArrow(
        run, f"conv_id {kind}, part long, place long, rid long, new_role string"))
    inserted = edits.filter("rid is null").select("conv_id", "part", "place", F.concat("new_role", F.lit(":")).alias("line"))
    stayed = edits.filter("rid is not null").join(rows.select("rid", "role", "text"), "rid").select(
        "conv_id", "part", "place", F.concat(F.coalesce("new_role", "role"), F.lit(":"), "text").alias("line"))
    return stayed.unionByName(inserted)


def _hot(rows: DataFrame) -> DataFrame:
    """The same result for conversations of any length, from marked turns with a ``rid``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    solved = _solved(rows)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, held, size = None, 0, [], 0
        id_kind = None

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], id_kind), pa.array([key[1]], pa.int64()), pa.array([place], pa.int64()),
                                               pa.array(["\n".join(held).encode()], pa.binary())], ["conv_id", "part", "place", "bytes"])
        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            for conv, part, at, line in zip(*(batch[c].to_pylist() for c in ("conv_id", "part", "place", "line")), strict=True):
                if held and (key != (conv, part) or size >= CHUNK):
                    yield chunk()
                    held, size = [], 0
                if not held:
                    key, place = (conv, part), at
                held.append(line)
                size += len(line)
        if held:
            yield chunk()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, id_kind = None, None, None
        done: list[tuple] = []
        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            for at, more in zip(batch["conv_id"].to_pylist(), batch["bytes"].to_pylist(), strict=True):
                if digest is None or at != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = at, hashlib.sha256(more)
                else:
                    digest.update(b"\n")
                    digest.update(more)
        if digest is not None:
            done.append((conv, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_kind), pa.array([d[1] for d in done], pa.string())], ["conv_id", "h"])

    lines = hot_lines(rows, solved)
    chunked = (lines.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "place")
               .mapInArrow(chunks, f"conv_id {kind}, part long, place long, bytes binary"))
    hashed = cut(chunked.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").select("conv_id", "bytes")
                 .mapInArrow(hashes, f"conv_id {kind}, h string"))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    totals = solved.groupBy("conv_id").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("numbers") - F.col("shared")), F.lit(0)).alias("gaps"), *sums,
        F.sum(F.col("illegal") + F.col("pair")).alias("illegal"), F.max("total").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "").alias("audit"))
    return totals.join(hashed, _same_conversation(totals, hashed), "left").select(
        totals["conv_id"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("h", F.sha2(F.lit(""), 256)).alias("repaired_sha256"), F.lit(None).cast("string").alias("repaired"))

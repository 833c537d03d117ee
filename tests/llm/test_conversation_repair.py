"""Conversation structure repair against brute force."""
import hashlib
import itertools
import random
import re
import zlib

import pytest

from martlane.llm import conversation_repair as cr
from martlane.llm.conversation_repair import damage, least_audit, repair

SCHEMA = "conv_id long, turn long, role string, text string, mark string, kind int, rid long, part long"
EDGE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """Plain (conv_id, turn, role, text) rows after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    mark = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], mark(r)))


def faults(turns):
    out, seen = [], set()
    for _, _, role, text in turns:
        body = text.strip(EDGE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns, wrong):
    """(cost, audit, lines) by keeping the best whole suffix for each state."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    full = {"u": "user", "a": "assistant"}
    never = (10**9, "", ())

    def inserted(best):
        for _ in range(4):
            for state in step:
                to = "a" if state == "u" else "u"
                cost, audit, lines = best[to]
                best[state] = min(best[state], (cost + 3, "I" + audit, (full[to] + ":", *lines)))
        return best

    best = inserted({"": (0, "", ()), "a": (0, "", ()), "s": never, "u": never})
    for (_, _, role, text), fault in zip(reversed(turns), reversed(wrong)):
        now = {}
        for state in step:
            cost, audit, lines = best[state]
            ways = [(cost + 4, "D" + audit, lines)]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] in step[state]:
                    cost, audit, lines = best[step[state][role[:1]]]
                    ways.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                to = "a" if state == "u" else "u"
                cost, audit, lines = best[to]
                ways.append((cost + 3 + more, "R" + audit, (f"{full[to]}:{text}", *lines)))
            now[state] = min(ways)
        best = inserted(now)
    return best[""]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = damaged([r for r in rows if r[0] == conv])
        wrong = faults(turns)
        cost, audit, lines = cheapest(turns, wrong)
        numbers = [t[1] for t in turns if t[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(turns, turns[1:])]
        out[conv] = (gaps, *(wrong.count(x) for x in ("blank", "duplicate", "truncated")),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest(), "\n".join(lines))
    return out


def conversations(seed=1, n=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "ünder"])
            text = rng.choice(["Yes.", "No!", "why", " \t\n", "", None, f"line {turn}?", f"odd {turn}", " ", "end. \n", "Ωé. "])
            rows.append((conv, rng.choice([turn, turn, turn, 2 * turn, None]), role, text))
    rows += [rows[3], rows[3], (10**6, 1, "user", "x" * 300_000 + "."), (10**6, 2, "assistant", "y" * 300_000)]
    # conversations of which nothing is left
    rows += [(c, 0, "user", "gone") for c in range(2000, 2200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "m", 1, 2, 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("hot", [10**6, 6, 0])
def test_repair_matches_brute_force(spark, hot):
    rows = conversations()
    want = {c: v for c, v in expected(rows).items() if damaged([r for r in rows if r[0] == c])}
    got = {r.conv_id: tuple(r)[1:] for r in repair(damage(frame(spark, rows)), hot_turns=hot).collect()}
    assert got.keys() == want.keys()
    for conv, row in want.items():
        assert got[conv][:8] == row[:8], conv
        assert got[conv][8] in (row[8], None) and (got[conv][8] is None or hot < 10**6 or got[conv][8] == row[8])


def test_hot_conversation_over_many_ranges(spark, monkeypatch):
    """One conversation with most of the turns, cut into segments at every size of chunk."""
    rng = random.Random(5)
    rows = [(7, t // 3 if t % 50 == 0 else t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"{t}!", "", "c?"]))
            for t in range(1500)] + [(8, 0, "user", "hi."), (8, 1, "assistant", "ho.")]
    monkeypatch.setattr(cr, "CHUNK", 200)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: tuple(r)[1:9] for r in repair(damage(frame(spark, rows)), hot_turns=100).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = expected(rows)
    assert got == {c: want[c][:8] for c in (7, 8)}


def test_least_audit_against_all_edit_sequences():
    """Every sequence of edits with up to three inserts, of all short conversations."""
    pattern = re.compile("(s?(ua)+)?")
    costs = {"K": 0, "U": 3, "A": 3, "D": 4, "u": 3, "a": 3}
    for n in range(4):
        for kinds in itertools.product([0, 1, 2, 3, 1 | cr.BLANK, 2 | cr.CUT_SHORT], repeat=n):
            best = None
            slots = ["".join(x) for k in range(3) for x in itertools.product("ua", repeat=k)]
            for edits in itertools.product(*["D" if k & cr.BLANK else "KUAD" for k in kinds]):
                for inserts in itertools.product(slots, repeat=n + 1):
                    if sum(map(len, inserts)) > 3:
                        continue
                    cost, spelled, audit = 0, "", ""
                    for i in range(n + 1):
                        spelled, audit, cost = spelled + inserts[i], audit + "I" * len(inserts[i]), cost + 3 * len(inserts[i])
                        if i == n:
                            break
                        e, k = edits[i], kinds[i]
                        cost += costs[e] + (3 if k & cr.CUT_SHORT and e != "D" else 0)
                        spelled += {"K": "suax"[k & 3], "U": "u", "A": "a", "D": ""}[e]
                        audit += {"U": "R", "A": "R"}.get(e, e)
                    if pattern.fullmatch(spelled) and (best is None or (cost, audit) < best):
                        best = cost, audit
            assert least_audit(bytes(kinds)) == best, kinds


def test_long_conversation_keeps_few_vectors():
    kinds = bytes(random.Random(2).choices([0, 1, 2, 3, 1 | cr.BLANK, 2 | cr.CUT_SHORT], k=50_000))
    kept, block = cr.checkpoints(kinds, cr.END)
    assert len(kept) + block < 3 * 50_000**0.5
    cost, audit = least_audit(kinds)
    assert cost == kept[0][0] and sum(c != "I" for c in audit) == len(kinds)


def test_query_keeps_emptied_conversations(spark, tmp_path):
    from martlane.llm.queries import op11_conversation_repair
    rows = conversations(9, 30)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: v[:8] for c, v in expected(rows).items()}
    assert sum(v[-1] == hashlib.sha256(b"").hexdigest() and not v[6] for v in got.values()) >= 3


def test_sql_agrees_on_awkward_rows(spark, tmp_path):
    import duckdb
    from martlane.llm.queries import SQL
    rows = conversations(21, 80)
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = {r[0]: r[1:] for r in con.execute(SQL["op11_conversation_repair"]).fetchall()}
    assert got == {c: v[:8] for c, v in expected(rows).items()}


def test_empty_table(spark, tmp_path):
    from martlane.llm.queries import op11_conversation_repair
    frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert op11_conversation_repair(spark, str(tmp_path)).count() == 0

"""Chat formatting, the pipeline against a brute-force version, and the registered queries."""
import hashlib
import json
import os
import random
import sys
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from fixtures import ENGLISH, documents, sentence, table  # noqa: E402
from test_dedup_and_lines import components_of, expected_fingerprint, expected_lines  # noqa: E402

import corpus_pipeline  # noqa: E402
from martlane.llm import decontaminate, language_id, queries  # noqa: E402
from martlane.llm.chat_format import format_chats, levels  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, id string, calls int"


def canonical(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


TOOLS = {"content": "hi", "tools": [{"name": "add", "parameters": {
    "type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "number"}},
    "required": ["a"], "additionalProperties": False}}]}


def test_links_order_and_schemas(spark):
    rows = [(1, 0, "system", json.dumps(TOOLS)),
            (1, 1, "user", 'what é "x" is {1}?'),
            (1, 2, "assistant", json.dumps({"content": None, "tool_calls": [
                {"id": "c2", "function": {"name": "add", "arguments": '{"b": "x", "z": 1}'}, "depends_on": ["c1"]},
                {"id": "c1", "name": "add", "arguments": {"b": 1.5, "a": 2}}]})),
            (1, 4, "tool", json.dumps({"tool_call_id": "c1", "content": "3.5"})),
            (1, 1, "tool", json.dumps({"content": {"z": 1, "a": [1, 2]}, "tool_call_id": "c2"})),
            (1, 5, "tool", json.dumps({"tool_call_id": "nope", "content": "?"})),
            (1, 6, "tool", json.dumps({"tool_call_id": "c1", "content": "again"})),
            (2, 4, "tool", json.dumps({"tool_call_id": "c1", "content": "other conversation"}))]
    got = {(r.conv_id, r.turn, r.role): r for r in format_chats(chats(spark, rows)).collect()}
    call = got[1, 2, "assistant"]
    assert call.n_calls == 2 and call.n_answered == 2
    assert call.problems == ["c2: missing a", "c2: type of b", "c2: unknown z"]
    assert call.message == canonical({"role": "assistant", "tool_calls": [
        {"id": "c1", "name": "add", "arguments": {"a": 2, "b": 1.5}},
        {"id": "c2", "name": "add", "arguments": {"b": "x", "z": 1}, "depends_on": ["c1"]}]})
    early = got[1, 1, "tool"]
    assert early.message == canonical({"content": '{"a":[1,2],"z":1}', "role": "tool", "tool_call_id": "c2"})
    order = sorted((r for r in got.values() if r.conv_id == 1), key=lambda r: (r.order_turn, r.order_step, r.turn))
    assert order.index(call) < order.index(got[1, 4, "tool"]) and order.index(call) < order.index(early)
    assert got[1, 5, "tool"].problems == ["no such call"] and got[2, 4, "tool"].problems == ["no such call"]
    assert got[1, 6, "tool"].problems == ["repeated result"] and not got[1, 4, "tool"].problems
    assert got[1, 0, "system"].message == canonical({"content": "hi", "role": "system", "tools": TOOLS["tools"]})


def test_tools_and_dependencies_are_kept(spark):
    calls = {"tool_calls": [{"id": "c2", "name": "f", "arguments": {}, "depends_on": ["c1"]}, {"id": "c1", "name": "f", "arguments": {}}]}
    both = {"tools": [{"function": {"name": 'a "b"', "parameters": {"type": "object", "$id": "x"}}}, {"name": "no schema"}, {}], **calls}
    rows = [(1, 0, "system", json.dumps(TOOLS)), (1, 1, "assistant", json.dumps(calls)), (1, 2, "user", "plain"),
            (2, 0, "assistant", json.dumps(both)), (3, 0, "system", '{"tools": []}')]
    got = {(r.conv_id, r.turn): r.message for r in format_chats(chats(spark, rows)).collect()}
    named = [{"name": 'a "b"', "parameters": {"type": "object", "$id": "x"}}, {"name": "no schema"}, {}]
    ordered = [{"id": "c1", "name": "f", "arguments": {}}, {"id": "c2", "name": "f", "arguments": {}, "depends_on": ["c1"]}]
    assert got == {k: canonical(v) for k, v in {
        (1, 0): {"role": "system", **TOOLS}, (1, 1): {"role": "assistant", "tool_calls": ordered},
        (1, 2): {"role": "user", "content": "plain"}, (2, 0): {"role": "assistant", "tool_calls": ordered, "tools": named},
        (3, 0): {"role": "system", "tools": []}}.items()}


def test_arguments_are_checked_at_every_depth(spark):
    schema = {"type": "object", "title": "t", "required": ["unit"], "additionalProperties": {"type": "boolean"}, "properties": {
        "unit": {"enum": ["c", "f", 1]}, "fixed": {"const": {"a": [1]}}, "note": {"type": ["string", "null"]},
        "place": {"type": "object", "properties": {"lat": {"type": "number", "minimum": -90}, "a.b": {"type": "string"}},
                  "required": ["lat"], "additionalProperties": False},
        "ids": {"type": "array", "maxItems": 3, "items": {"type": "integer", "exclusiveMaximum": 10}},
        "code": {"type": "string", "minLength": 2, "pattern": "^a"}, "never": False, "size": {"maximum": 5}}}
    cases = [({"unit": "c"}, []), ({"unit": 1.0, "fixed": {"a": [1]}, "note": None, "extra": True}, []),
             ({"unit": "x", "fixed": {"a": [2]}, "note": 3, "extra": 1}, ["const of fixed", "enum of unit", "type of extra", "type of note"]),
             ({"unit": "f", "place": {"lat": -91, "a.b": 1, "z": 2}}, ["minimum of place.lat", "type of place.a.b", "unknown place.z"]),
             ({"unit": "f", "place": {}}, ["missing place.lat"]), ({"unit": "f", "place": []}, ["type of place"]),
             ({"unit": "f", "ids": [1, "2", 10, 4]}, ["exclusiveMaximum of ids[2]", "maxItems of ids", "type of ids[1]"]),
             ({"unit": "f", "code": "b"}, ["minLength of code", "unsupported keyword pattern of code"]),
             ({"unit": "f", "never": 1}, ["not allowed of never"]), ({"unit": "f", "size": "9"}, []), ({}, ["missing unit"])]
    tools = {"tools": [{"name": "f", "parameters": schema}, {"name": "g", "parameters": {"anyOf": [], "type": "strin"}}]}
    rows = [(1, 0, "system", "\n\t\r " + json.dumps(tools))]
    rows += [(1, 2 * k + 1, "assistant", "\n\t " + json.dumps({"tool_calls": [{"id": f"c{k}", "name": "f", "arguments": a}]})) for k, (a, _) in enumerate(cases)]
    rows += [(1, 2 * k + 2, "tool", "\r\n" + json.dumps({"tool_call_id": f"c{k}", "content": "x"})) for k in range(len(cases))]
    rows += [(2, 0, "system", json.dumps(tools)), (2, 1, "assistant", json.dumps({"tool_calls": [{"id": "h", "name": "g", "arguments": {}}]}))]
    got = {(r.conv_id, r.turn): r for r in format_chats(chats(spark, rows)).collect()}
    for k, (_, problems) in enumerate(cases):
        assert got[1, 2 * k + 1].problems == [f"c{k}: {p}" for p in problems]
        assert got[1, 2 * k + 1].n_answered == 1 and not got[1, 2 * k + 2].problems
    assert got[2, 1].problems == ["h: not answered", "h: unsupported keyword anyOf", "h: unsupported keyword type"]


def test_awkward_turns(spark):
    cycle = {"tool_calls": [{"id": "x", "name": "f", "arguments": [1], "depends_on": ["y"]},
                            {"id": "y", "name": "f", "arguments": {}, "depends_on": ["x"]},
                            {"name": "f", "arguments": {}}]}
    rows = [(1, 6, "assistant", '{"broken": '), (1, 7, None, None), (None, None, "user", ""), (1, 8, "user", '{"a": 1}'),
            (1, 8, "user", '{"a": 1}'), (2, 0, "assistant", json.dumps(cycle)), (3, 0, "user", "x" * 300_000),
            (3, 1, "assistant", json.dumps({"tool_calls": [{"id": "d", "name": "f", "arguments": {}}] * 2}))]
    df = chats(spark, rows)
    got = format_chats(df).collect()
    assert len(got) == len(rows)
    for r in got:
        own = {"content": dict((x[:3], x[3]) for x in rows)[r.conv_id, r.turn, r.role], "role": r.role}
        if r.n_calls == 0:
            assert r.message == canonical({k: v for k, v in own.items() if v is not None})
    problems = {(r.conv_id, r.turn): r.problems for r in got if r.n_problems}
    assert set(problems) == {(2, 0), (3, 1)}
    assert ": no identifier" in problems[2, 0] and "x: cycle or unknown need" in problems[2, 0]
    assert "x: arguments are no object" in problems[2, 0] and problems[3, 1].count("d: repeated identifier") == 1
    assert format_chats(df.limit(0)).count() == 0


def test_levels_follow_a_chain(spark):
    calls = [{"id": f"c{k}", "name": "f", "arguments": {}, "depends_on": [f"c{k - 1}"] if k else []} for k in range(6)]
    rows = [(1, k, "assistant", json.dumps({"tool_calls": [c]})) for k, c in enumerate(reversed(calls))]
    steps = {json.loads(r.message)["tool_calls"][0]["id"]: r.order_step for r in format_chats(chats(spark, rows)).collect()}
    assert [steps[f"c{k}"] for k in range(6)] == [0, 2, 4, 6, 8, 10]


def plain_levels(needs):
    """Longest ways by repeated relaxing; a call whose way grows beyond all calls has none."""
    edges = [(i, n) for i, own in needs.items() for n in own if n in needs]
    level = {x: 0 for e in edges for x in e}
    for _ in range(len(needs) + 1):
        for i, n in edges:
            level[i] = max(level[i], level[n] + 1)
    return {i: v for i, v in level.items() if v <= len(needs)}


def test_levels_of_diamonds_and_cycles(spark):
    rng = random.Random(6)
    needs = {conv: {f"c{k}": sorted({f"c{rng.randrange(max(1, k) if conv % 2 else 14)}" for _ in range(rng.randint(0, 3))} - {f"c{k}"} | ({"gone"} if k == 5 else set()))
                    for k in range(14)} for conv in range(30)}
    needs[100] = {"self": ["self"], "after": ["self"], "free": [], "on": ["free"]}
    rows = [(conv, i, own) for conv, calls in needs.items() for i, own in calls.items()]
    got = {(r.conv_id, r.id): r.level for r in levels(spark.createDataFrame(rows, "conv_id long, id string, needs array<string>")).collect()}
    assert got == {(conv, i): v for conv, calls in needs.items() for i, v in plain_levels(calls).items()}
    assert any((conv, f"c{k}") not in got for conv in range(30) for k in range(14)) and ("after" not in got)


def test_a_chain_of_a_thousand_calls(spark):
    calls = [{"id": f"c{k}", "name": "f", "arguments": {}, **({"depends_on": [f"c{k - 1}"]} if k else {})} for k in range(1000)]
    started = time.time()
    got = format_chats(chats(spark, [(1, k, "assistant", json.dumps({"tool_calls": [c]})) for k, c in enumerate(calls)])).collect()
    assert time.time() - started < 60
    assert [r.order_step for r in sorted(got, key=lambda r: r.turn)] == [2 * k for k in range(1000)]


def plain_chats(rows):
    """Messages, counts and problems of conversations, said plainly (for valid schemas of depth one)."""
    parsed = []
    for place, (conv, turn, role, text) in enumerate(rows):
        try:
            v = json.loads(text) if text and text.lstrip().startswith("{") else None
        except ValueError:
            v = None
        v = v if v and {"tool_calls", "tool_call_id", "tools"} & v.keys() else None
        parsed.append((conv, turn, role, text, v, place))
    first_call, first_result, schema, needs = {}, {}, {}, {}
    for conv, turn, _, _, v, place in sorted(parsed, key=lambda r: (r[1], r[5])):
        for i, c in enumerate((v or {}).get("tool_calls", [])):
            first_call.setdefault((conv, c["id"]), (turn, place, i))
            needs.setdefault(conv, {}).setdefault(c["id"], []).extend(c.get("depends_on", []))
        if v and "tool_call_id" in v:
            first_result.setdefault((conv, v["tool_call_id"]), place)
        for t in (v or {}).get("tools", []):
            schema[conv, t["name"]] = max(schema.get((conv, t["name"]), ""), canonical(t["parameters"]))
    level = {(conv, i): x for conv, own in needs.items() for i, x in plain_levels(own).items()}
    kinds = {"integer": int, "string": str, "boolean": bool}
    out = []
    for conv, turn, role, text, v, place in parsed:
        if v is None:
            out.append((conv, turn, 0, 0, [], canonical({"content": text, "role": role})))
            continue
        message, problems, calls = {"role": role}, [], []
        if v.get("content") is not None:
            message["content"] = v["content"]
        for i, c in enumerate(v.get("tool_calls", [])):
            key = (conv, c["id"])
            wrong = []
            if (conv, c["name"]) in schema:
                s = json.loads(schema[conv, c["name"]])
                wrong += [f"missing {k}" for k in s["required"] if k not in c["arguments"]]
                wrong += [f"type of {k}" for k, x in c["arguments"].items() if k in s["properties"]
                          and type(x) is not kinds[s["properties"][k]["type"]]]
                wrong += [f"unknown {k}" for k in c["arguments"] if k not in s["properties"]]
            wrong += ["repeated identifier"] * (first_call[key][1:] != (place, i)) + ["not answered"] * (key not in first_result)
            wrong += ["cycle or unknown need"] * (bool(c.get("depends_on")) and key not in level)
            problems += [f"{c['id']}: {w}" for w in wrong]
            calls.append((level.get(key, 0), i, c))
        if calls:
            message["tool_calls"] = [c if c.get("depends_on") else {k: x for k, x in c.items() if k != "depends_on"}
                                     for _, _, c in sorted(calls, key=lambda x: x[:2])]
        if "tool_call_id" in v:
            key = (conv, v["tool_call_id"])
            message["tool_call_id"] = v["tool_call_id"]
            problems += ["no such call"] if key not in first_call else ["repeated result"] if first_result[key] != place else []
        if "tools" in v:
            message["tools"] = v["tools"]
        answered = sum((conv, c["id"]) in first_result for _, _, c in calls)
        out.append((conv, turn, len(calls), answered, sorted(problems), canonical(message)))
    return out


def test_random_conversations_against_a_plain_version(spark):
    rng = random.Random(12)
    kinds = ["integer", "string", "boolean"]
    rows = []
    for conv in range(25):
        tools = [{"name": f"f{k}", "parameters": {"type": "object", "additionalProperties": False, "required": rng.sample("abc", rng.randint(0, 2)),
                                                  "properties": {x: {"type": rng.choice(kinds)} for x in "abc"}}} for k in range(2)]
        rows.append((conv, 0, "system", json.dumps({"content": "use é", "tools": tools})))
        for turn in range(1, rng.randint(3, 12)):
            ids = [f"c{k}" for k in range(6)]
            kind = rng.random()
            if kind < 0.4:
                made = [{"id": rng.choice(ids), "name": f"f{rng.randrange(3)}", "arguments": {x: rng.choice([1, "s", True]) for x in rng.sample("abcd", rng.randint(0, 3))},
                         "depends_on": rng.sample(ids, rng.choice([0, 0, 1, 2]))} for _ in range(rng.randint(1, 3))]
                rows.append((conv, turn, "assistant", json.dumps({"content": rng.choice([None, "so"]), "tool_calls": made})))
            elif kind < 0.8:
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": rng.choice(ids), "content": f"r{turn}"})))
            else:
                rows.append((conv, turn, "user", rng.choice(["plain", '{"a": 1}', "{broken", ""])))
    got = [(r.conv_id, r.turn, r.n_calls, r.n_answered, sorted(r.problems), r.message) for r in format_chats(chats(spark, rows)).collect()]
    assert sorted(got) == sorted(plain_chats(rows))
    assert sum(bool(r[4]) for r in got) > 50


def test_hot_conversation(spark):
    """One conversation with a third of all calls, all under one identifier."""
    def turn(conv, k, i):
        return (conv, 2 * k, "assistant", json.dumps({"tool_calls": [{"id": i, "name": "f", "arguments": {}}]}))
    rows = [turn(0, k, "same") for k in range(300)] + [turn(c, 0, "own") for c in range(1, 601)]
    got = format_chats(chats(spark, rows)).collect()
    assert len(got) == 900
    assert sum("same: repeated identifier" in r.problems for r in got) == 299


def bench_rows(rng):
    return [(k, sentence(rng, ENGLISH, 30)) for k in range(4)]


def test_pipeline_against_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer
    rng = random.Random(9)
    bench = bench_rows(rng)
    rows = [r for r in documents(150) if r[0] is None or r[0] < 111]
    rows += [(300 + k, sentence(rng, ENGLISH, 15) + "\n" + bench[k % 4][1], "en") for k in range(6)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    model = language_id.train(docs)
    left = [r for r in rows if not model.predict(r[1])[2]]
    left = [(i, body, None) for i, _, _, body in expected_lines(left)]
    prints = [expected_fingerprint(t) for _, t, _ in left]
    groups = {}
    for row, root in zip(left, components_of(prints, 4), strict=True):
        groups.setdefault(root, []).append(row)
    left = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    own = decontaminate.index([decontaminate.plain(t) for _, t in bench])
    left = [r for r in left if not decontaminate.leaks([r[1]], own)[0]]
    library = Tokenizer.from_file(queries.vocabulary_path())
    expected = Counter()
    for i, text, _ in left:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()] += 1

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in got) == expected
    assert not {300 + k for k in range(6)} & {r.doc_id for r in got} and all(r.exact for r in got)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0

    # columns of the names that operators use, with values of their own
    odd = docs.withColumns({c: F.lit(k) for k, c in enumerate(
        ["__row", "__fp", "__lang", "__rejected", "__leaks", "__lines", "__lost", "__text_hash", "__id", "aside_0"])})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == odd.columns and out.select(*odd.columns[-10:]).distinct().count() == 1
        assert out.count() == stage(spark, docs, str(tmp_path)).count()


def test_pipeline_over_empty_tables(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and "ids_sha256" in got.columns


def test_pipeline_leaves_one_table_behind(spark, tmp_path, monkeypatch):
    from martlane.llm import common
    rows = documents(30)
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a passage of the benchmark that is in no document at all, of no length")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(common, "shared_folder", lambda _: f"{tmp_path}/shared")
    corpus_pipeline.run(spark, str(tmp_path)).count()
    assert len(os.listdir(f"{tmp_path}/shared")) == 1


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(expected)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs_over_its_whole_table(spark, name):
    rows = queries.QUERIES[name](spark, SF).count()
    whole = {"op6_html_extraction": "pages", "op9_chat_format": "conversations", "op11_conversation_repair": "conversations",
             "op12_embedding_whitening": "embeddings"}.get(name, "documents")
    whole = spark.read.parquet(f"{SF}/{whole}.parquet")
    n = whole.count()
    if name.startswith("op4"):
        assert 0 < rows <= n
    elif name.startswith("op13"):
        assert rows >= n  # a piece at least of every document
    else:
        assert rows == {"op11": whole.select(whole.columns[0]).distinct().count(), "op12": 16 * n}.get(name.split("_")[0], n)


def test_native_operators_run_no_python(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver data not present")
    for name in ("op1_license_scan", "op2_exact_dedup", "op9_chat_format"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), name

"""Chat formatting with tool-call linking, in DataFrame functions only.

A turn's text is either plain text or a JSON object of one of these forms:

* calls: ``{"content": .., "tool_calls": [{"id", "name", "arguments", "depends_on"}, ..]}``; a
  call may also hold its name and arguments under ``function``, and its arguments may be a
  JSON text;
* a result: ``{"tool_call_id": .., "content": ..}``;
* tools: ``{"content": .., "tools": [{"name", "parameters"}, ..]}``, ``parameters`` being a JSON
  schema of an object (``properties`` with ``type``, ``required``, ``additionalProperties``).

Calls and results are joined by (conversation, identifier).  Both sides are first reduced to
one row for each identifier (the earliest; later ones with the same identifier are problems),
so the join never multiplies rows and a conversation that holds a third of all turns is summed
before it is shuffled.  Calls are ordered topologically: a call comes after the calls it
depends on, a result after its call, and everything else by turn.  The order is given as a
sort key (``order_turn``, ``order_step``, ``turn``), not by sorting a conversation in one task.
Arguments are checked against the schema that the conversation gives for the tool, one level
of nesting after the other: ``type`` (also a list), ``enum``, ``const``, ``required``,
``properties``, ``additionalProperties``, ``items``, and bounds of numbers, lengths and sizes.
Other keywords that could fail a value (``pattern``, ``anyOf``, ``$ref`` ..) are reported as
not supported where the schema meets a value.  Every
turn is written as canonical JSON: keys sorted, no white space, null fields and empty lists of
dependencies left out; calls stand in their order, with the calls they depend on, and tools
with their names and parameters.

Cases: null texts and roles are left out of the JSON; a text that is not a JSON object of
these forms is plain content; a JSON object with a key twice is plain content.  Calls without
an identifier are never linked.  Calls in a cycle get no level and the problem ``cycle``.
Rows repeated in full are formatted each; other columns are not read.  An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut

#: JSON schema types and the types that a parsed value of them shows.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|DECIMAL.*)", "boolean": "BOOLEAN",
         "array": "ARRAY<.*", "object": "OBJECT<.*", "null": "VOID"}
#: Keywords that are checked, and those that fail no value.
CHECKED = """type enum const properties required additionalProperties items minimum maximum exclusiveMinimum
    exclusiveMaximum minLength maxLength minItems maxItems minProperties maxProperties""".split()
ANNOTATIONS = "title description default examples deprecated readOnly writeOnly $schema $id $comment $defs definitions".split()
ONE = ["conv_id", "id"]


def _get(v: str, path: str, kind: str = "string") -> str:
    return f"try_variant_get({v}, '{path}', '{kind}')"


def parse(conversations: DataFrame) -> DataFrame:
    """One row per turn: its content and, from JSON texts, ``calls``, ``result_of`` and ``tools``."""
    call = f"""transform({_get('v', '$.tool_calls', 'array<variant>')}, (c, i) -> struct(
        i as place, {_get('c', '$.id')} as id, coalesce({_get('c', '$.name')}, {_get('c', '$.function.name')}) as name,
        coalesce({_get('c', '$.arguments', 'variant')}, {_get('c', '$.function.arguments', 'variant')}) as args,
        coalesce({_get('c', '$.depends_on', 'array<string>')}, cast(array() as array<string>)) as needs))"""
    plain = """transform(calls, c -> struct(c.place, c.id, c.name,
        to_json(if(schema_of_variant(c.args) = 'STRING', try_parse_json(cast(c.args as string)), c.args)) as arguments,
        c.needs))"""
    tool = f"""transform({_get('v', '$.tools', 'array<variant>')}, t -> struct(
        coalesce({_get('t', '$.name')}, {_get('t', '$.function.name')}) as name,
        to_json(coalesce({_get('t', '$.parameters', 'variant')}, {_get('t', '$.function.parameters', 'variant')})) as schema))"""
    return cut(
        conversations.select(F.monotonically_increasing_id().alias("rid"), "conv_id", "turn", "role", "text",
                             F.when(F.col("text").rlike(r"^\s*\{"), F.expr("try_parse_json(text)")).alias("v"))
        .withColumn("calls", F.expr(call)).withColumn("result_of", F.expr(_get("v", "$.tool_call_id")))
        .withColumn("tools", F.expr(tool))
        .select("rid", "conv_id", "turn", "role",
                F.expr(f"""case when calls is null and result_of is null and tools is null then text
                           when schema_of_variant({_get('v', '$.content', 'variant')}) = 'VOID' then null
                           else coalesce({_get('v', '$.content')}, to_json({_get('v', '$.content', 'variant')})) end""").alias("content"),
                F.expr(plain).alias("calls"), "result_of", "tools"))


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, id, level`` of the calls that depend on others or are depended on: the longest
    way to a call that needs nothing; those of a cycle, and those after one, have no row.

    The relation "some way of exactly 2^k steps" is joined with itself, so a chain of n calls
    takes log n rounds.  A way longer than its conversation has edges runs into a cycle.  As ways
    of each length up to the longest exist, the longest is found bit by bit, from the highest.
    """
    edges = cut(calls.select("conv_id", "id", F.explode("needs").alias("need"))
                .join(calls.select("conv_id", F.col("id").alias("need")).distinct(), ["conv_id", "need"])
                .distinct())
    most = edges.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    steps, endless = [edges], None
    while not steps[-1].isEmpty():
        if 1 << (len(steps) - 1) > most:
            endless = cut(steps.pop().select("conv_id", "id").distinct())
            break
        first, second = steps[-1], steps[-1].select("conv_id", F.col("id").alias("need"), F.col("need").alias("end"))
        steps.append(cut(first.join(second, ["conv_id", "need"]).select("conv_id", "id", F.col("end").alias("need")).distinct()))
    calls_ = edges.select("conv_id", "id").unionByName(edges.select("conv_id", F.col("need").alias("id"))).distinct()
    if endless is not None:
        calls_ = calls_.join(endless, ONE, "left_anti")
    at = cut(calls_.select("conv_id", "id", F.col("id").alias("at"), F.lit(0).alias("level")))
    for k in range(len(steps) - 1, -1, -1):
        way = steps[k].select("conv_id", F.col("id").alias("at"), "need")
        further = cut(at.join(way, ["conv_id", "at"]).select(
            "conv_id", "id", F.col("need").alias("at"), (F.col("level") + (1 << k)).alias("level")).distinct())
        at = cut(further.unionByName(at.join(further.select(*ONE).distinct(), ONE, "left_anti")))
    return at.select(*ONE, "level").distinct()


def _level_problems() -> Column:
    """Names of what is wrong with the value ``v`` of a ``path``, by its schema ``s`` alone;
    ``members`` and ``elements`` are its parts, ``kind`` its type."""
    kinds = "map(" + ", ".join(f"'{k}', '{v}'" for k, v in TYPES.items()) + ")"
    at = "if(path = '', '', concat(' of ', path))"
    key = "if(path = '', k, concat(path, '.', k))"
    types = f"coalesce({_get('s', '$.type', 'array<string>')}, array({_get('s', '$.type')}))"
    allowed = f"filter({types}, t -> t is not null)"
    # equal numbers are equal however they are written
    same = """(to_json({0}) = to_json(v) or coalesce(kind rlike '^(BIGINT|DOUBLE|DECIMAL|FLOAT)'
        and schema_of_variant({0}) rlike '^(BIGINT|DOUBLE|DECIMAL|FLOAT)'
        and try_variant_get({0}, '$', 'double') = try_variant_get(v, '$', 'double'), false))"""
    is_number = "kind rlike '^(BIGINT|DOUBLE|DECIMAL|FLOAT)'"
    size = {"Length": ("kind = 'STRING'", f"length({_get('v', '$')})"), "Items": ("elements is not null", "size(elements)"),
            "Properties": ("members is not null", "size(members)")}
    bounds = [(f"{word}{what}", on, f"{got} {sign}") for what, (on, got) in size.items() for word, sign in (("min", "<"), ("max", ">"))]
    bounds += [(k, is_number, f"{_get('v', '$', 'double')} {sign}")
               for k, sign in (("minimum", "<"), ("maximum", ">"), ("exclusiveMinimum", "<="), ("exclusiveMaximum", ">="))]
    bound = ", ".join(f"if({on} and coalesce({got} {_get('s', '$.' + k, 'double')}, false), concat('{k}', {at}), null)"
                      for k, on, got in bounds)
    known = ", ".join(f"'{k}'" for k in (*CHECKED, *ANNOTATIONS))
    # keywords whose value is no such thing as this check reads
    shapes = {"type": f"{allowed} = array() or exists({allowed}, t -> not map_contains_key({kinds}, t)) or size({allowed}) < size({types})",
              "enum": f"{_get('s', '$.enum', 'array<variant>')} is null", "items": _no_schema(_get("s", "$.items", "variant")),
              "required": f"{_get('s', '$.required', 'array<string>')} is null",
              "properties": f"{_get('s', '$.properties', 'map<string, variant>')} is null",
              "additionalProperties": _no_schema(_get("s", "$.additionalProperties", "variant")),
              **{k: f"{_get('s', '$.' + k, 'double')} is null" for k, *_ in bounds}}
    odd = " ".join(f"when '{k}' then {test}" for k, test in shapes.items())
    declared = f"coalesce(map_keys({_get('s', '$.properties', 'map<string, variant>')}), array())"
    return F.expr(f"""filter(concat(
        if(coalesce(not {_get('s', '$', 'boolean')}, false), array(concat('not allowed', {at})), cast(array() as array<string>)),
        if(schema_of_variant(s) not like 'OBJECT%' and schema_of_variant(s) <> 'BOOLEAN', array(concat('unsupported schema', {at})), array()),
        transform(filter(coalesce(map_keys({_get('s', '$', 'map<string, variant>')}), array()), k -> k not in ({known})
                         or coalesce(case k {odd} else false end, true)),
                  k -> concat('unsupported keyword ', k, {at})),
        if(path <> '' and size({allowed}) > 0 and not exists({allowed}, t -> coalesce(kind rlike concat('^', element_at({kinds}, t), '$'), true)),
           array(concat('type of ', path)), array()),
        if(not exists({_get('s', '$.enum', 'array<variant>')}, e -> {same.format('e')}), array(concat('enum', {at})), array()),
        if(not {same.format(_get('s', '$.const', 'variant'))}, array(concat('const', {at})), array()),
        if(members is null, array(), transform(array_except(coalesce({_get('s', '$.required', 'array<string>')}, array()), map_keys(members)),
           k -> concat('missing ', {key}))),
        if(members is null or coalesce({_get('s', '$.additionalProperties', 'boolean')}, true), array(),
           transform(array_except(map_keys(members), {declared}), k -> concat('unknown ', {key}))),
        array({bound})), p -> p is not null)""")


def _no_schema(v: str) -> str:
    return f"schema_of_variant({v}) not like 'OBJECT%' and schema_of_variant({v}) <> 'BOOLEAN'"


def argument_problems(calls: DataFrame) -> DataFrame:
    """``rid, place, wrong``: what the schema finds wrong, of the ``calls`` (``rid, place,
    arguments, schema``, both JSON texts) that break theirs."""
    parts = {"members": _get("v", "$", "map<string, variant>"), "elements": _get("v", "$", "array<variant>"), "kind": "schema_of_variant(v)"}
    children = f"""concat(
        if(members is null, array(), transform(map_entries(members), e -> struct(
            if(path = '', e.key, concat(path, '.', e.key)) as path, to_json(e.value) as value,
            to_json(if(coalesce(map_contains_key({_get('s', '$.properties', 'map<string, variant>')}, e.key), false),
                       element_at({_get('s', '$.properties', 'map<string, variant>')}, e.key),
                       if(schema_of_variant({_get('s', '$.additionalProperties', 'variant')}) like 'OBJECT%',
                          {_get('s', '$.additionalProperties', 'variant')}, null))) as schema))),
        if(elements is null, array(), transform(elements, (e, i) -> struct(
            concat(path, '[', i, ']') as path, to_json(e) as value, to_json({_get('s', '$.items', 'variant')}) as schema))))"""
    level = calls.select("rid", "place", F.lit("").alias("path"), F.col("arguments").alias("value"), "schema")
    found = None
    while True:
        level = level.filter("schema is not null").withColumn("v", F.expr("try_parse_json(value)")).withColumn("s", F.expr("try_parse_json(schema)"))
        for name, e in parts.items():
            level = level.withColumn(name, F.expr(e))
        level = cut(level.select("rid", "place", _level_problems().alias("wrong"), F.expr(children).alias("children")))
        wrong = level.filter(F.size("wrong") > 0).select("rid", "place", "wrong")
        found = wrong if found is None else found.unionByName(wrong)
        level = level.select("rid", "place", F.inline("children")).filter("schema is not null")
        if level.isEmpty():
            return found.groupBy("rid", "place").agg(F.flatten(F.collect_list("wrong")).alias("broken"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id, turn, order_turn, order_step, role, n_calls, n_answered,
    n_problems, problems, message`` (canonical JSON)."""
    turns = parse(conversations)
    calls = cut(turns.filter(F.size("calls") > 0).select("rid", "conv_id", "turn", F.inline("calls")))
    results = turns.filter("result_of is not null").select("rid", "conv_id", "turn", F.col("result_of").alias("id"))
    order = F.struct(F.col("turn").isNull().alias("none"), "turn", "rid")
    first_call = cut(calls.filter("id is not null").groupBy(*ONE)
                     .agg(F.min(F.struct(order.alias("at"), "place")).alias("call")))
    first_result = cut(results.groupBy(*ONE).agg(F.min(order).alias("result")))
    schemas = cut(turns.filter(F.size("tools") > 0).select("conv_id", F.inline("tools"))
                  .groupBy("conv_id", "name").agg(F.max("schema").alias("schema")))
    level = cut(levels(calls.filter("id is not null")))
    needs = F.size("needs") > 0

    with_schema = cut(calls.join(schemas, ["conv_id", "name"], "left"))
    is_object = "coalesce(schema_of_variant(try_parse_json(arguments)) like 'OBJECT%', false)"
    broken = argument_problems(with_schema.filter(f"schema is not null and {is_object}"))
    checked = (with_schema.join(first_call, ONE, "left").join(first_result, ONE, "left").join(level, ONE, "left")
               .join(broken, ["rid", "place"], "left")
               .withColumn("repeated", F.coalesce((F.col("call.at.rid") != F.col("rid")) | (F.col("call.place") != F.col("place")), F.lit(False)))
               .withColumn("wrong", F.expr(f"if({is_object}, coalesce(broken, array()), array('arguments are no object'))"))
               .withColumn("wrong", F.concat(
                   "wrong", F.when(F.col("id").isNull(), F.array(F.lit("no identifier"))).otherwise(F.array()),
                   F.when(F.col("repeated"), F.array(F.lit("repeated identifier"))).otherwise(F.array()),
                   F.when(F.col("result").isNull(), F.array(F.lit("not answered"))).otherwise(F.array()),
                   F.when(needs & F.col("level").isNull() & F.col("id").isNotNull(), F.array(F.lit("cycle or unknown need"))).otherwise(F.array()))))
    per_turn = (checked.groupBy("rid").agg(
        F.count("*").alias("n_calls"), F.count("result").alias("n_answered"),
        F.array_sort(F.flatten(F.collect_list(F.transform("wrong", lambda p: F.concat(F.coalesce("id", F.lit("")), F.lit(": "), p))))).alias("call_problems"),
        F.max(F.coalesce("level", F.lit(0))).alias("call_level"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("level", F.lit(0)).alias("level"), "place", "id", "name", "arguments", "needs"))).alias("ordered")))
    linked = (results.join(first_call, ONE, "left").join(first_result, ONE, "left").join(level, ONE, "left")
              .select("rid", F.col("call.at.turn").alias("call_turn"), F.col("level").alias("result_level"),
                      F.when(F.col("call").isNull(), "no such call").when(F.col("result.rid") != F.col("rid"), "repeated result").alias("wrong")))
    plain = turns.filter("coalesce(size(calls), 0) <= 0 and result_of is null")
    tied = (turns.filter("size(calls) > 0 or result_of is not null")
            .join(per_turn, "rid", "left").join(linked, "rid", "left"))
    call_json = F.transform("ordered", lambda c: F.concat(
        F.lit('{"arguments":'), F.coalesce(c["arguments"], F.lit("null")), F.lit(","),
        F.substring(F.to_json(F.struct(F.when(F.size(c["needs"]) > 0, c["needs"]).alias("depends_on"),
                                       c["id"].alias("id"), c["name"].alias("name"))), 2, 1 << 30)))
    problems = F.concat(F.coalesce("call_problems", F.expr("cast(array() as array<string>)")),
                        F.when(F.col("wrong").isNotNull(), F.array("wrong")).otherwise(F.expr("cast(array() as array<string>)")))
    columns = ["conv_id", "turn", "order_turn", "order_step", "role", "n_calls", "n_answered", "n_problems", "problems", "message"]
    head = F.to_json(F.struct("content", "role"))
    tied = (tied.withColumn("order_turn", F.greatest("turn", "call_turn"))
            .withColumn("order_step", F.coalesce(2 * F.col("call_level"), F.when(F.col("call_turn").isNotNull(), 2 * F.coalesce("result_level", F.lit(0)) + 1), F.lit(0)))
            .withColumn("problems", problems).withColumn("n_problems", F.size("problems").cast("long"))
            .withColumn("n_calls", F.coalesce("n_calls", F.lit(0))).withColumn("n_answered", F.coalesce("n_answered", F.lit(0)))
            .withColumn("message", _with_tools(head, F.col("result_of"), F.when(F.size("ordered") > 0, F.array_join(call_json, ",")), _tools_json())))
    plain = (plain.withColumn("order_turn", F.col("turn")).withColumn("order_step", F.lit(0))
             .withColumn("n_calls", F.lit(0).cast("long")).withColumn("n_answered", F.lit(0).cast("long"))
             .withColumn("n_problems", F.lit(0).cast("long")).withColumn("problems", F.expr("cast(array() as array<string>)"))
             .withColumn("message", _with_tools(head, F.col("result_of"), F.lit(None).cast("string"), _tools_json())))
    return plain.select(*columns).unionByName(tied.select(*columns))


def _tools_json() -> Column:
    name = "to_json(struct(t.name as name))"
    return F.expr(f"""concat('[', array_join(transform(tools, t -> concat('{{', concat_ws(',',
        nullif(substring({name}, 2, length({name}) - 2), ''), concat('"parameters":', t.schema)), '}}')), ','), ']')""")


def _with_tools(head: Column, result_of: Column, calls: Column, tools: Column) -> Column:
    """Add the fields that sort after content and role to a message's JSON."""
    start = F.substring(head, 1, F.length(head) - 1)
    more = F.concat_ws(",", F.when(head != "{}", F.substring(start, 2, 1 << 30)),
                       F.when(result_of.isNotNull(), F.expr("substring(to_json(struct(result_of as tool_call_id)), 2, length(to_json(struct(result_of as tool_call_id))) - 2)")),
                       F.when(calls.isNotNull(), F.concat(F.lit('"tool_calls":['), calls, F.lit("]"))),
                       F.when(tools.isNotNull(), F.concat(F.lit('"tools":'), tools)))
    return F.concat(F.lit("{"), more, F.lit("}"))

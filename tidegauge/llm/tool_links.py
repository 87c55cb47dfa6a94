"""Chat formatting: tool calls and their results, linked, ordered, validated and serialised.

A message is ``(conv_id, turn, role, text)``. Its text may be a JSON object with ``tool_calls``
(id, name, arguments, and ``after``: ids of calls it depends on) or with ``tool_call_id`` and
``content``. All is done by SQL functions and joins by (conversation, id), so a conversation
that holds a third of all messages is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.llm.common import stored

CALL = "array<struct<id string, name string, arguments variant, after array<string>>>"

# Type names as the schema of a JSON value gives them.
TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"]}

Schemas = dict[str, dict[str, tuple[str, bool]]]


def parsed(messages: DataFrame) -> DataFrame:
    rows = messages.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("text").cast("string"))
    body = F.when(F.ltrim("text").startswith("{"), F.try_parse_json("text"))
    return compute_once(rows, "body", body).drop("text").where("body IS NOT NULL")


def calls(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, pos, call_id, name, arguments, after)``; calls without an id are left out.

    An id that comes again in a conversation keeps its first call; ``repeats`` counts all.
    """
    listed = parsed(messages).select("conv_id", "turn", F.posexplode(F.try_variant_get("body", "$.tool_calls", CALL)).alias("pos", "call"))
    rows = listed.select(
        "conv_id", "turn", "pos", F.col("call.id").alias("call_id"), F.col("call.name").alias("name"),
        F.to_json("call.arguments").alias("arguments"), F.coalesce("call.after", F.array().cast("array<string>")).alias("after"),
    ).where("call_id IS NOT NULL AND conv_id IS NOT NULL")
    first = F.min(F.struct("turn", "pos", "name", "arguments", "after")).alias("first")
    return rows.groupBy("conv_id", "call_id").agg(first, F.count("*").alias("repeats")).select("conv_id", "call_id", "first.*", "repeats")


def results(messages: DataFrame) -> DataFrame:
    """``(conv_id, call_id, result_turn, content)``: the first result of each id."""
    rows = parsed(messages).select(
        "conv_id", F.try_variant_get("body", "$.tool_call_id", "string").alias("call_id"), F.col("turn").alias("result_turn"),
        F.to_json(F.try_variant_get("body", "$.content", "variant")).alias("content"),
    ).where("call_id IS NOT NULL AND conv_id IS NOT NULL")
    return rows.groupBy("conv_id", "call_id").agg(F.min(F.struct("result_turn", "content")).alias("first")).select("conv_id", "call_id", "first.*")


def problems(schemas: Schemas) -> Column:
    """What is wrong with ``arguments`` by the schema of ``name``: sorted, comma-joined, empty if nothing."""
    value = F.try_parse_json("arguments")
    keys = F.json_object_keys("arguments")
    verdict = F.when(F.col("name").isNull() | ~F.col("name").isin(*schemas), F.lit("unknown tool"))
    for name, parameters in schemas.items():
        found = [F.transform(F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*map(F.lit, parameters))), lambda k: F.concat(F.lit("unexpected "), k))]
        for key, (kind, required) in parameters.items():
            part = F.try_variant_get(value, f"$.{key}", "variant")
            given = F.array_contains(F.coalesce(keys, F.array().cast("array<string>")), key)
            right = F.regexp_extract(F.schema_of_variant(part), "^[A-Z]+", 0).isin(*TYPES[kind])
            wrong = F.when(given & ~F.coalesce(right, F.lit(False)), F.lit(f"type {key}"))
            if required:
                wrong = F.when(~given, F.lit(f"missing {key}")).otherwise(wrong)
            found.append(F.array(wrong))
        text = F.array_join(F.array_sort(F.array_compact(F.concat(*found))), ",")
        verdict = verdict.when(F.col("name") == name, F.when(keys.isNull(), F.lit("no object")).otherwise(text))
    return verdict


def _later(due: Column, steps: Column) -> Column:
    """The place ``steps`` waits behind one; null stays null."""
    return F.when(due.isNotNull(), F.struct(due["turn"].alias("turn"), due["pos"].alias("pos"), (due["hops"] + steps).cast("int").alias("hops")))


def _chains(keys: DataFrame, waits: DataFrame) -> DataFrame:
    """``(conv_id, call_id, to, best, steps, ring)`` of calls that wait for exactly one.

    ``best`` is the latest place that the calls up to ``to`` give. ``to`` is the first call on the
    way that waits for several, null if there is none. Ways are doubled in each round. A way
    longer than there are calls in the conversation leads into a ring.
    """
    single = waits.where("n = 1").select("conv_id", "call_id", F.col("other").alias("to"))
    targets = keys.join(waits.select("conv_id", "call_id", "n").distinct(), ["conv_id", "call_id"], "left")
    targets = targets.select("conv_id", F.col("call_id").alias("to"), F.col("own").alias("to_own"), F.coalesce("n", F.lit(0)).alias("to_n"))
    best = F.greatest("own", F.when(F.col("to_n") == 0, _later(F.col("to_own"), F.lit(1))))
    ways = single.join(keys, ["conv_id", "call_id"]).join(targets, ["conv_id", "to"]).select(
        "conv_id", "call_id", F.when(F.col("to_n") > 0, F.col("to")).alias("to"), best.alias("best"), F.lit(1).cast("bigint").alias("steps"),
        ((F.col("to_n") == 1) & (F.col("to") == F.col("call_id"))).alias("ring"), ((F.col("to_n") != 1) | (F.col("to") == F.col("call_id"))).alias("ended"),
    )
    ways = stored(ways, "ways")
    longest = ways.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while reach <= longest and not ways.where("NOT ended").isEmpty():
        reach *= 2
        next_way = ways.select("conv_id", F.col("call_id").alias("to"), *(F.col(c).alias(f"next_{c}") for c in ("to", "best", "steps", "ring", "ended")))
        ring = F.col("next_ring") | F.coalesce(~F.col("next_ended") & (F.col("next_to") == F.col("call_id")), F.lit(False))
        moved = ways.where("NOT ended").join(next_way, ["conv_id", "to"]).select(
            "conv_id", "call_id", F.col("next_to").alias("to"), F.greatest("best", _later(F.col("next_best"), F.col("steps"))).alias("best"),
            (F.col("steps") + F.col("next_steps")).alias("steps"), ring.alias("ring"), (ring | F.col("next_ended")).alias("ended"),
        )
        ways = stored(ways.where("ended").unionByName(moved), "ways")
    return ways.select("conv_id", "call_id", "to", "best", "steps", (F.col("ring") | ~F.col("ended")).alias("ring"))


def _forks(keys: DataFrame, waits: DataFrame, ways: DataFrame) -> DataFrame:
    """``(conv_id, call_id, due)`` of calls that wait for several and are not in or behind a ring.

    Only those count that can come to a wait for a later one, the rest keep their places. They are
    taken off, round by round, as soon as they wait for none that is left, until none can be.
    """
    spot, several = ["conv_id", "call_id"], waits.where("n > 1").select("conv_id", "call_id", "other")
    other_way = ways.select("conv_id", F.col("call_id").alias("other"), "to", "best", "steps", "ring")
    other_own = keys.select("conv_id", F.col("call_id").alias("other"), F.col("own").alias("other_own"))
    fork_ids = several.select("conv_id", F.col("call_id").alias("other"), F.lit(True).alias("fork")).distinct()
    links = several.join(other_own, ["conv_id", "other"]).join(other_way, ["conv_id", "other"], "left").join(fork_ids, ["conv_id", "other"], "left")
    direct = F.when(F.col("fork").isNull(), F.col("other_own"))
    links = stored(links.select(
        *spot, F.when(F.col("fork"), F.col("other")).otherwise(F.col("to")).alias("to"), _later(F.coalesce("best", direct), F.lit(1)).alias("value"),
        (F.coalesce("steps", F.lit(0)) + 1).alias("steps"), F.coalesce("ring", F.lit(False)).alias("ring"),
    ), "links")
    forks = links.groupBy(*spot).agg(F.max("value").alias("value"), F.max("ring").alias("ring")).join(keys, spot)
    forks = stored(forks.select(*spot, F.greatest("own", "value").alias("due"), "ring"), "forks")
    edges = stored(links.where("to IS NOT NULL AND NOT ring").groupBy(*spot, "to").agg(F.max("steps").alias("steps")), "edges")

    to_due = forks.select("conv_id", F.col("call_id").alias("to"), F.col("due").alias("to_due"))
    def spot_of(due):
        return F.struct(F.col(f"{due}.turn").alias("turn"), F.col(f"{due}.pos").alias("pos"))

    upward = edges.join(to_due, ["conv_id", "to"]).join(forks, spot).where(spot_of("to_due") >= spot_of("due"))
    fresh = moving = stored(forks.where("ring").select(*spot).unionByName(upward.select(*spot)).distinct(), "moving")
    while not fresh.isEmpty():
        fresh = edges.join(fresh.withColumnRenamed("call_id", "to"), ["conv_id", "to"]).select(*spot).distinct()
        fresh = stored(fresh.join(moving, spot, "left_anti"), "fresh")
        moving = stored(moving.unionByName(fresh), "moving")

    done = fresh = stored(forks.join(moving, spot, "left_anti").select(*spot, "due"), "done")
    left = stored(forks.join(moving, spot, "left_semi").where("NOT ring").select(*spot, "due"), "left")
    edges = stored(edges.join(left, spot, "left_semi"), "edges")
    while not left.isEmpty():
        behind = fresh.select("conv_id", F.col("call_id").alias("to"), F.col("due").alias("to_due"))
        met = edges.join(behind, ["conv_id", "to"]).groupBy(*spot).agg(F.max(_later(F.col("to_due"), F.col("steps"))).alias("value"))
        left = stored(left.join(met, spot, "left").select(*spot, F.greatest("due", "value").alias("due")), "left")
        edges = stored(edges.join(behind, ["conv_id", "to"], "left_anti"), "edges")
        fresh = stored(left.join(edges, spot, "left_anti"), "fresh")
        if fresh.isEmpty():
            break
        left = stored(left.join(fresh, spot, "left_anti"), "left")
        done = done.unionByName(fresh)
    return done


def ordered(rows: DataFrame) -> DataFrame:
    """Add ``due_turn``, ``due_pos`` and ``hops``: sorting by them, then by turn and place, puts
    every call behind those it depends on. They are null for calls in or behind a ring.

    A call stands at its own place, or behind the latest of the calls it waits for, directly or
    not; ``hops`` counts the waits between the two. Calls that wait for one form chains, which take
    as many rounds as their length has binary digits; those that wait for several are taken off
    one after the other where they come to a wait for a later call.
    """
    own = F.struct(F.col("turn").alias("turn"), F.col("pos").alias("pos"), F.lit(0).alias("hops"))
    keys = rows.select("conv_id", "call_id", own.alias("own"))
    waits = rows.select("conv_id", "call_id", F.explode(F.array_distinct("after")).alias("other"))
    waits = waits.join(keys.select("conv_id", F.col("call_id").alias("other")), ["conv_id", "other"])
    n_waits = waits.groupBy("conv_id", "call_id").agg(F.collect_list("other").alias("others"))
    waits = stored(n_waits.select("conv_id", "call_id", F.size("others").alias("n"), F.explode("others").alias("other")), "waits")
    keys = stored(keys, "keys")
    ways = _chains(keys, waits)
    due = keys.join(waits, ["conv_id", "call_id"], "left_anti").select("conv_id", "call_id", F.col("own").alias("due"))
    due = due.unionByName(ways.where("NOT ring AND to IS NULL").select("conv_id", "call_id", F.col("best").alias("due")))
    if not waits.where("n > 1").isEmpty():
        forks = _forks(keys, waits, ways)
        behind = ways.where("NOT ring").join(forks.select("conv_id", F.col("call_id").alias("to"), F.col("due").alias("to_due")), ["conv_id", "to"])
        due = due.unionByName(forks).unionByName(behind.select("conv_id", "call_id", F.greatest("best", _later(F.col("to_due"), F.col("steps"))).alias("due")))
    return rows.join(due, ["conv_id", "call_id"], "left").select(
        *rows.columns, F.col("due.turn").alias("due_turn"), F.col("due.pos").alias("due_pos"), F.col("due.hops").alias("hops")
    )


def linked(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """One row for each call and for each result without a call.

    ``status`` is ``linked``, ``no result``, ``early result`` (before its call) or ``no call``;
    ``problems`` is empty for valid arguments; ``canonical`` is the JSON object of the call with
    sorted keys, no white space and its result. Messages that are no JSON objects, empty or null
    texts and null ids give nothing. Equal messages count once; other columns are not looked at.
    """
    made = ordered(calls(messages))
    rows = made.join(results(messages), ["conv_id", "call_id"], "full_outer")
    status = (
        F.when(F.col("turn").isNull(), "no call").when(F.col("result_turn").isNull(), "no result")
        .when(F.col("result_turn") < F.col("turn"), "early result").otherwise("linked")
    )
    def quoted(name):
        value = F.regexp_extract(F.to_json(F.struct(F.col(name).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
        return F.when(F.col(name).isNull(), F.lit("null")).otherwise(value)

    parts = {"arguments": F.coalesce("arguments", F.lit("null")), "id": quoted("call_id"), "name": quoted("name"), "result": F.coalesce("content", F.lit("null"))}
    text = F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{key}":'), value) for key, value in parts.items())), F.lit("}"))
    return rows.select(
        "conv_id", "call_id", "turn", "pos", "name", "result_turn", "repeats", "due_turn", "due_pos", "hops", status.alias("status"),
        F.when(F.col("turn").isNotNull(), problems(schemas)).alias("problems"), text.alias("canonical"),
    )


def derived_messages(conversations: DataFrame) -> DataFrame:
    """Messages with calls and results made from the turns of ``conversations``, whole table.

    An assistant's turn becomes a call that waits for the assistant's turn before it, or, in
    some turns, for the one after it; a user's turn the result of the turn before it. Some calls
    lack an argument, carry a text for a number or name no known tool.
    """
    turn, text = F.col("turn"), F.coalesce("text", F.lit(""))
    name = F.when(turn % 7 == 5, "teleport").when(turn % 4 == 1, "search").otherwise("measure")
    call_id = F.concat(F.lit("c"), turn)
    other = F.when(turn % 10 == 3, turn + 2).when((turn % 10 == 5) & (turn % 50 != 15), turn - 4).otherwise(turn - 2)
    after = F.array(F.concat(F.lit("c"), other))
    size = F.char_length(text)
    search = F.to_json(F.struct(F.left(text, F.lit(24)).alias("query"), F.when(turn % 8 == 1, size).alias("limit")))
    measure = F.when(turn % 3 == 0, F.to_json(F.struct(size.cast("string").alias("size")))).otherwise(F.to_json(F.struct((size / 2).alias("size"), (size > 99).alias("long"))))
    arguments = F.when(name == "search", search).otherwise(measure)
    call = F.concat(
        F.lit('{"tool_calls":[{"name":"'), name, F.lit('","id":"'), call_id, F.lit('","after":'), F.to_json(after), F.lit(',"arguments":'), arguments, F.lit("}]}")
    )
    result = F.concat(F.lit('{"content":'), F.to_json(F.struct(text.alias("t"))), F.lit(',"tool_call_id":"c'), turn - 1, F.lit('"}'))
    body = F.when(F.col("role") == "assistant", call).when(F.col("role") == "user", result).otherwise(F.col("text"))
    return conversations.select("conv_id", "turn", "role", body.alias("text"))


# Parameters of the tools in the derived messages, with their type and whether they are required.
TOOLS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "measure": {"size": ("number", True), "long": ("boolean", True)},
}

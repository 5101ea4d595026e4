"""Tool calls of conversations: linked to results, ordered, validated and written as canonical JSON.

Everything is DataFrame work. Calls and results meet in a hash join on conversation and call id.
A call comes after the calls it depends on: its place is its own turn, or behind the latest of
them where that is later. Arguments are parsed to variants and each field is joined with its
tool's schema. The JSON has its keys in order and no spaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.llm.common import checkpointed

KEY = ["conv_id", "call_id"]


def json_text(value: Column) -> Column:
    """A string as JSON, quoted and escaped; null as ``null``."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNull(), F.lit("null")).otherwise(listed.substr(F.lit(2), F.length(listed) - 2))


def canonical(*fields: tuple[str, Column]) -> Column:
    """A JSON object of fields that are JSON already, by key."""
    parts = [F.concat(F.lit(f'"{name}":'), F.coalesce(value, F.lit("null"))) for name, value in sorted(fields, key=lambda f: f[0])]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _walked(keys: DataFrame, parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys of all calls, each behind its parent, and the calls whose parents lead into a cycle.

    ``keys``: conv_id, call_id, place, step; ``parents``: conv_id, call_id, jump. A call's key is
    the later of its own and its parent's with one step more. Such rules compose to one of the
    same form, so pointers to ever farther ancestors need as many rounds as the logarithm of the
    longest chain.
    """
    start = keys.join(parents, KEY, "left").select(*KEY, F.struct("place", "step").alias("key"), "jump", F.col("jump").isNotNull().cast("long").alias("steps"))
    start = checkpointed(start)
    done, active = start.filter("jump is null"), start.filter("jump is not null")
    left = active.count()
    rounds = left.bit_length() + 1
    while left and rounds:
        targets = done.unionByName(active).select("conv_id", F.col("call_id").alias("at"), F.col("key").alias("next_key"), F.col("jump").alias("next_jump"), F.col("steps").alias("next_steps"))
        moved = active.join(targets, (active.conv_id == targets.conv_id) & (F.col("jump") == F.col("at"))).drop(targets.conv_id)
        behind = F.struct(F.col("next_key.place").alias("place"), (F.col("next_key.step") + F.col("steps")).alias("step"))
        moved = checkpointed(moved.select(*KEY, F.greatest("key", behind).alias("key"), F.col("next_jump").alias("jump"), (F.col("steps") + F.col("next_steps")).alias("steps")))
        done, active = done.unionByName(moved.filter("jump is null")), moved.filter("jump is not null")
        left, rounds = active.count(), rounds - 1
    return done.unionByName(active).select(*KEY, "key.place", "key.step"), active.select(*KEY)


def ordered(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """``conv_id, call_id, place, step, cyclic``: in the order of place, step and id every call follows what it needs.

    ``calls``: conv_id, call_id, turn; ``needs``: conv_id, call_id, needed. Needs that name no call
    are ignored. A call's place is its turn, or that of the latest call it needs, one step later.
    Each call first follows one of its needs, the latest; where another turns out to be later, it
    follows that one and the chains are walked again. Calls on or behind a cycle are ``cyclic``,
    and their order is that of their turns.
    """
    known = calls.select("conv_id", F.col("call_id").alias("needed"))
    edges = checkpointed(needs.select(*KEY, "needed").distinct().join(known, ["conv_id", "needed"], "left_semi").join(calls.select(*KEY), KEY, "left_semi"))
    turns = calls.select(*KEY, F.col("turn").alias("place"), F.lit(0).cast("long").alias("step"))
    keys, cyclic, open_edges = turns, None, edges
    several = edges.groupBy(*KEY).count().filter("count > 1").count()
    tries = 0
    while True:
        needed = keys.select("conv_id", F.col("call_id").alias("needed"), F.struct("place", "step").alias("then"))
        latest = open_edges.join(needed, ["conv_id", "needed"]).groupBy(*KEY).agg(F.max_by("needed", F.struct("then", "needed")).alias("jump"))
        found, stuck = _walked(keys, latest)
        found = checkpointed(found)
        placed = found.select("conv_id", F.col("call_id").alias("needed"), F.struct("place", "step").alias("then"))
        late = open_edges.join(found, KEY).join(placed, ["conv_id", "needed"]).filter(F.struct("place", "step") <= F.col("then")).select(*KEY).distinct()
        tries += 1
        # Without a cycle, each try settles a call with several needs for good.
        if stuck.isEmpty() and tries > several + 1:
            stuck = late
        stuck = checkpointed(stuck)
        if stuck.isEmpty():
            if late.isEmpty():
                break
            keys = found
            continue
        fresh = stuck
        while not fresh.isEmpty():
            cyclic = checkpointed(fresh if cyclic is None else cyclic.unionByName(fresh).distinct())
            held = cyclic.select("conv_id", F.col("call_id").alias("needed"))
            fresh = checkpointed(edges.join(held, ["conv_id", "needed"], "left_semi").select(*KEY).distinct().join(cyclic, KEY, "left_anti"))
        open_edges = checkpointed(edges.join(cyclic, KEY, "left_anti"))
        keys, tries = turns, 0
    if cyclic is None:
        return found.withColumn("cyclic", F.lit(False))
    marked = found.join(cyclic.withColumn("on_cycle", F.lit(True)), KEY, "left").join(calls.select(*KEY, "turn"), KEY)
    bad = F.coalesce("on_cycle", F.lit(False))
    return marked.select(*KEY, F.when(bad, F.col("turn")).otherwise(F.col("place")).alias("place"), F.when(bad, 0).otherwise(F.col("step")).cast("long").alias("step"), bad.alias("cyclic"))


def field_kind(value: Column) -> Column:
    """JSON type of a variant field."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").when(kind == "BIGINT", "integer")
        .when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object").otherwise("number")
    )


def finite_numbers(arguments: Column) -> Column:
    """Whether no number of a JSON text is beyond what a double holds, for which JSON has no text."""
    outside = F.regexp_replace(arguments, r'"(?:[^"\\]|\\.)*+"', '""')
    numbers = F.regexp_extract_all(outside, F.lit(r"-?[0-9]+(?:\.[0-9]+)?[eE][+-]?[0-9]+|-?[0-9]{300,}(?:\.[0-9]+)?"), 0)
    return ~F.exists(numbers, lambda n: F.abs(n.try_cast("double")) == float("inf"))


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``conv_id, call_id, valid, arguments`` (canonical JSON, null if it is none).

    ``schemas``: name, field, kind, required, least, most (bounds of numbers, or null). Valid are
    arguments that are an object with all required fields, no unknown one, each of its kind
    (``number`` takes integers) and in its bounds. Calls of unknown tools are not valid.
    """
    parsed = calls.select(*KEY, "name", F.when(finite_numbers(F.col("arguments")), F.try_parse_json("arguments")).alias("v"))
    parsed = parsed.withColumn("v", F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")))
    # Fields by exploding: a path would have to quote their names.
    exploded = parsed.filter("v is not null").lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("v").outer()))
    fields = exploded.select(*KEY, "name", F.col("key").alias("field"), "value")
    fields = fields.select(*KEY, "name", "field", field_kind(F.col("value")).alias("given"), F.try_variant_get(F.col("value"), "$", "double").alias("amount"))
    rules = schemas.select("name", "field", "kind", "required", F.col("least").cast("double").alias("least"), F.col("most").cast("double").alias("most"))
    number = F.col("kind").isin("integer", "number")
    fits = (F.col("given") == F.col("kind")) | ((F.col("kind") == "number") & (F.col("given") == "integer"))
    in_bounds = ~number | ((F.col("amount") >= F.coalesce("least", "amount")) & (F.col("amount") <= F.coalesce("most", "amount")))
    tested = fields.join(rules, ["name", "field"], "left").groupBy(*KEY).agg(
        F.sum(F.coalesce(fits & in_bounds, F.lit(False)).cast("int")).alias("right"), F.count("*").alias("given"), F.sum(F.coalesce(F.col("required"), F.lit(False)).cast("int")).alias("required")
    )
    wanted = rules.groupBy("name").agg(F.sum(F.col("required").cast("int")).alias("wanted"))
    return parsed.join(wanted, "name", "left").join(tested, KEY, "left").select(
        *KEY, F.coalesce((F.coalesce("right", F.lit(0)) == F.coalesce("given", F.lit(0))) & (F.coalesce("required", F.lit(0)) == F.col("wanted")) & F.col("v").isNotNull(), F.lit(False)).alias("valid"),
        F.to_json("v").alias("arguments"),
    )


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame, needs: DataFrame, messages: DataFrame | None = None) -> DataFrame:
    """One row per call, per result without a call and per other message, with its place in the conversation and its JSON.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON); ``results``: conv_id, call_id, turn,
    content. Rows without conversation or call id are left out, as nothing can be linked to them.
    Of several calls or results with one id the first by turn and then by text counts, and
    ``n_calls`` and ``n_results`` tell how many there are. ``messages``: conv_id, turn, role, content;
    each gives a row without call id. Returns ``conv_id, call_id, turn, place, step, linked, n_calls,
    n_results, valid, cyclic, json``; for a result or message ``turn`` and ``place`` are its turn, ``valid`` is null.
    """
    named = "conv_id is not null and call_id is not null"
    first = calls.filter(named).groupBy(*KEY).agg(F.min(F.struct("turn", "name", "arguments")).alias("c"), F.count("*").alias("n_calls")).select(*KEY, "c.*", "n_calls")
    first = checkpointed(first)
    answers = results.filter(named).groupBy(*KEY).agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    answers = answers.select(*KEY, F.col("r.turn").alias("result_turn"), "r.content", "n_results")
    rows = first.drop("arguments").join(ordered(first, needs), KEY).join(validated(first, schemas), KEY)
    met = rows.join(answers.hint("shuffle_hash"), KEY, "full_outer")
    is_call, is_result = F.col("place").isNotNull(), F.col("n_results").isNotNull()
    result = F.when(is_result, canonical(("content", json_text(F.col("content"))), ("turn", F.col("result_turn").cast("string"))))
    call = canonical(
        ("arguments", F.col("arguments")), ("id", json_text(F.col("call_id"))), ("name", json_text(F.col("name"))), ("result", result),
        ("turn", F.col("turn").cast("string")), ("type", F.lit('"call"')),
    )
    alone = canonical(("id", json_text(F.col("call_id"))), ("result", result), ("type", F.lit('"result"')))
    rows = met.select(
        *KEY, F.when(is_call, F.col("turn")).otherwise(F.col("result_turn")).alias("turn"), F.when(is_call, F.col("place")).otherwise(F.col("result_turn")).alias("place"),
        F.coalesce("step", F.lit(0)).cast("long").alias("step"), (is_call & is_result).alias("linked"),
        F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        "valid", F.coalesce("cyclic", F.lit(False)).alias("cyclic"), F.when(is_call, call).otherwise(alone).alias("json"),
    )
    if messages is None:
        return rows
    turn, none = F.col("turn").cast("long"), F.lit(0).cast("long")
    message = canonical(("content", json_text(F.col("content"))), ("role", json_text(F.col("role"))), ("turn", turn.cast("string")), ("type", F.lit('"message"')))
    return rows.unionByName(messages.select(
        F.col("conv_id").cast("long"), F.lit(None).cast("string").alias("call_id"), turn.alias("turn"), turn.alias("place"), none.alias("step"),
        F.lit(False).alias("linked"), none.alias("n_calls"), none.alias("n_results"), F.lit(None).cast("boolean").alias("valid"), F.lit(False).alias("cyclic"), message.alias("json"),
    ))

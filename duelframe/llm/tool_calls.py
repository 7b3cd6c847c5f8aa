"""Tool calls of conversations: linked with their results, ordered by dependence, validated and written as canonical JSON.

Calls and results meet in a hash join on (conversation, call id). A call may name one earlier call whose result it uses
(parent); calls are ordered by their depth below a call without parent, then by turn and id. Depths come from pointer
doubling, so a chain of n calls takes log n joins, and ranks from counts per block of depths, so that a conversation
with a large part of all rows is never gathered in one task. Status of a call, the first that applies:

* ``duplicate_id``: an earlier call (by turn) of the conversation has the id; it links to nothing;
* ``bad_parent``: the parent does not exist;
* ``cycle``: the parents lead back to the call, or to a cycle;
* ``invalid_arguments``: not JSON, or against the schema of the tool, or the tool is unknown. NaN, infinities and numbers
  beyond a double's range, lone surrogates, and nesting beyond what Python's parser takes are not JSON here;
* ``missing_result``: no result has its id;
* ``ok``.

Null ids never match: such a call, with a parent or without, has status missing_result at best, and results without a call are left out of the
result (``orphan_results`` lists them). If several results have an id, the first by turn counts, then the smallest
text. Ties in turn go by the arguments' text. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import Stored

BLOCK = 256

_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def valid(value: Any, schema: dict) -> bool:
    """JSON value against the schema words type, enum, required, properties, additionalProperties, items and bounds."""
    kind = schema.get("type")
    if kind in ("integer", "number"):
        if isinstance(value, bool) or not isinstance(value, (int, float)) or kind == "integer" and value != int(value):
            return False
    elif kind and not isinstance(value, _KINDS[kind]):
        return False
    if "enum" in schema and not any(same(value, x) for x in schema["enum"]):
        return False
    if isinstance(value, dict):
        known = schema.get("properties", {})
        extra = schema.get("additionalProperties", True)
        if any(k not in value for k in schema.get("required", ())):
            return False
        for k, v in value.items():
            if k in known:
                if not valid(v, known[k]):
                    return False
            elif extra is False or isinstance(extra, dict) and not valid(v, extra):
                return False
    if isinstance(value, list):
        return all(valid(v, schema["items"]) for v in value) if "items" in schema else True
    if isinstance(value, str):
        return schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value))
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return schema.get("minimum", value) <= value <= schema.get("maximum", value)
    return True


def same(a: Any, b: Any) -> bool:
    """Equal as JSON: true is no number."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    return a == b


def _no_number(text: str) -> float:
    raise ValueError(f"{text} is no JSON number")


def _real(text: str) -> float:
    value = float(text)
    return value if math.isfinite(value) else _no_number(text)


def parsed(raw: str) -> tuple[Any, str]:
    """The JSON value and its canonical text; ValueError if it is not JSON."""
    try:
        value = json.loads(raw, parse_constant=_no_number, parse_float=_real)
        text = canonical(value)
    except RecursionError:
        raise ValueError("nested too deeply") from None
    text.encode()  # a lone surrogate is a UnicodeEncodeError, which is a ValueError
    return value, text


def canonical(value: Any) -> str:
    """Keys sorted, no blanks, characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _check(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, text = [], []
            for name, raw in zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist()):
                try:
                    value, form = parsed("null" if raw is None else raw)
                    good.append(name in schemas and raw is not None and valid(value, schemas[name]))
                    text.append(form)
                except ValueError:
                    good.append(False)
                    text.append(canonical(raw))
            keep = [c for c in batch.schema.names if c != "arguments"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(good), pa.array(text, pa.string())],
                                             [*keep, "good", "arguments"])

    return run


def link_calls(spark: SparkSession, calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, call_id, turn, depth, position, status, message: one row per call.

    calls(conv_id, call_id, parent_id, name, arguments, turn), results(conv_id, call_id, content, turn). depth is null
    for calls without an order (duplicate_id, bad_parent, cycle); these come last in position, which counts from 0.
    """
    store = Stored(spark, "calls")
    row = calls.select(F.col("conv_id").cast("long"), "call_id", "parent_id", "name", "turn", "arguments").mapInArrow(
        _check(schemas), "conv_id long, call_id string, parent_id string, name string, turn long, good boolean, arguments string")
    # Ids repeat rarely: the window is over the calls of one id, and rows without id are spread.
    key = F.coalesce("call_id", F.concat(F.lit("\0"), F.xxhash64("turn", "arguments")))
    nth = Window.partitionBy("conv_id", key).orderBy("turn", "arguments", "name")
    rows = row.withColumn("nth", F.when(F.col("call_id").isNull(), 1).otherwise(F.row_number().over(nth)))
    rows = store.save(rows.withColumn("row_id", F.monotonically_increasing_id()))
    first = rows.where("nth = 1 and call_id is not null and conv_id is not null")
    depths = _depths(store, first.select("conv_id", "call_id", "parent_id"))
    answer = results.where("call_id is not null").groupBy(F.col("conv_id").cast("long"), "call_id").agg(
        F.min(F.struct("turn", F.col("content"))).alias("result"))
    lone = (F.col("call_id").isNull() | F.col("conv_id").isNull()) & F.col("parent_id").isNull()
    # A call without id is one step below its parent.
    above = depths.select(F.col("conv_id").alias("up_conv"), F.col("call_id").alias("up_id"), (F.col("depth") + 1).alias("up_depth"),
                          F.col("looped").alias("up_looped"))
    below = F.col("call_id").isNull() & (F.col("conv_id") == F.col("up_conv")) & (F.col("parent_id") == F.col("up_id"))
    joined = (rows.join(depths, ["conv_id", "call_id"], "left").join(answer, ["conv_id", "call_id"], "left").join(above, below, "left")
              .withColumns({"depth": F.when(F.col("nth") > 1, None).when(lone, 0).otherwise(F.coalesce("depth", "up_depth")),
                            "looped": F.coalesce("looped", "up_looped")}).drop("up_conv", "up_id", "up_depth", "up_looped"))
    status = (F.when(F.col("nth") > 1, "duplicate_id")
              .when(F.col("depth").isNull() & ~F.coalesce("looped", F.lit(False)), "bad_parent")
              .when(F.col("depth").isNull(), "cycle").when(~F.col("good"), "invalid_arguments")
              .when(F.col("result").isNull(), "missing_result").otherwise("ok"))
    joined = store.save(joined.withColumn("status", status))
    return _positions(joined).mapInArrow(_messages, "conv_id long, call_id string, turn long, depth long, position long, status string, message string")


def _depths(store: Stored, calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth, looped): steps to a call without parent; depth is null below a missing parent or a cycle."""
    roots = calls.where("parent_id is null").select("conv_id", "call_id", F.lit(0).cast("long").alias("depth"), F.lit(False).alias("looped"))
    state = store.save(calls.where("parent_id is not null").select("conv_id", "call_id", F.col("parent_id").alias("up"), F.lit(1).cast("long").alias("steps"),
                                                                   F.lit("open").alias("state"))
                       .unionByName(roots.select("conv_id", "call_id", F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("steps"),
                                                 F.lit("done").alias("state"))))
    total, span = state.count(), 1
    while True:
        far = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("far_up"), F.col("steps").alias("far_steps"), F.col("state").alias("far_state"))
        active = state.where("state = 'open'").join(far, ["conv_id", "up"], "left")
        after = active.select("conv_id", "call_id", F.when(F.col("far_state").isin("open"), F.col("far_up")).alias("up"),
                              (F.col("steps") + F.coalesce("far_steps", F.lit(0))).alias("steps"),
                              F.coalesce("far_state", F.lit("lost")).alias("state"))
        following = store.save(after.unionByName(state.where("state <> 'open'")))
        store.drop(state)
        state, span = following, span * 2
        # A pointer that has gone more steps than there are calls runs in a circle.
        if not state.where("state = 'open'").limit(1).count() or span > total:
            break
    return state.select("conv_id", "call_id", F.when(F.col("state") == "done", F.col("steps")).alias("depth"), (F.col("state") == "open").alias("looped"))


def _positions(rows: DataFrame) -> DataFrame:
    """Adds position: the rank in the conversation by (depth, turn, call_id), nulls last."""
    order = F.coalesce("depth", F.lit(1 << 40))
    keyed = rows.withColumn("order_", order).withColumn("block_", F.floor(order / BLOCK)).withColumn("slot_", F.floor(F.coalesce("turn", F.lit(0)) / BLOCK))
    # Blocks of depths, and blocks of turns inside one: a window holds a few hundred rows of usual data.
    within = Window.partitionBy("conv_id", "block_", "order_", "slot_").orderBy("turn", "call_id", "row_id")
    counts = keyed.groupBy("conv_id", "block_", "order_", "slot_").agg(F.count("*").alias("n"))
    sums = counts.groupBy("conv_id", "block_").agg(F.sum("n").alias("n"))
    ahead = Window.partitionBy("conv_id").orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("conv_id", "block_").orderBy("order_", "slot_").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col("conv_id").alias("conv_"), F.col("block_").alias("before_"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start_"))
    starts = counts.withColumn("inner_", F.coalesce(F.sum("n").over(inner), F.lit(0))).drop("n").join(
        before, F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("block_") == F.col("before_"))).drop("conv_", "before_")
    ranked = keyed.withColumn("nth_", F.row_number().over(within))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("conv_id", "block_", "order_", "slot_")]
    return (ranked.alias("r").join(starts.alias("s"), same)
            .select("r.*", (F.col("s.start_") + F.col("s.inner_") + F.col("r.nth_") - 1).cast("long").alias("position"))
            .select("conv_id", "call_id", "turn", "depth", "position", "status", "parent_id", "name", "arguments",
                    F.col("result.content").alias("content")))


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The call, its arguments and its result as one canonical JSON object."""
    for batch in batches:
        out = []
        for call, parent, name, arguments, content, status in zip(*(batch.column(c).to_pylist() for c in (
                "call_id", "parent_id", "name", "arguments", "content", "status"))):
            message: dict[str, Any] = {"id": call, "name": name}
            if parent is not None:
                message["parent"] = parent
            if status == "ok":
                message["result"] = content
            # The arguments are canonical already, and their key comes first.
            out.append(f'{{"arguments":{arguments},{canonical(message)[1:]}')
        keep = ["conv_id", "call_id", "turn", "depth", "position", "status"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.string())], [*keep, "message"])


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose id no call of their conversation has."""
    return results.join(calls.select("conv_id", "call_id").where("call_id is not null").distinct(), ["conv_id", "call_id"], "left_anti")

"""Condensed sessions: messages as blocks, tool calls in a line, repeated results by reference, cut to a budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.functions.text import BLANKS, head_tail, is_kind, strip
from duoscope.operators.ordered import dealt, last_seen_dealt, running_sum_dealt
from duoscope.operators.sessions import input_summary
from duoscope.storage import stored

#: Characters of a result that are shown; results are compared as a whole.
SHOWN = 300


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _result_text(content: Column) -> Column:
    """Text of a tool result: a string, the joined text blocks of a list, or another value as it is written."""
    parts = F.transform(_get(content, "$", "array<variant>"), lambda b: F.when(
        is_kind(b, "OBJECT") & (_get(b, "$.type") == "text"), F.coalesce(_get(b, "$.text"), F.lit(""))
    ))
    listed = F.array_join(F.filter(parts, lambda t: t.isNotNull()), " ")
    return strip(F.coalesce(F.when(is_kind(content, "ARRAY"), listed).otherwise(_get(content, "$")), F.lit("")))


def _shown_inputs(block: Column, raw: Column) -> Column:
    """Inputs of a tool call as texts, in the order in which they are written."""
    inputs = F.from_json(F.from_json(raw, "input string")["input"], "map<string,string>")
    kinds = F.transform_values(_get(block, "$.input", "map<string,variant>"), lambda k, v: F.schema_of_variant(v))
    return F.when(is_kind(F.try_variant_get(block, "$.input", "variant"), "OBJECT"), F.transform_values(
        inputs, lambda k, v: F.when(v.isNull(), "None").when(kinds[k] == "BOOLEAN", F.initcap(v)).otherwise(v)
    ))


def message_blocks(lines: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per block of a user's or assistant's message.

    ``lines`` has the keys, ``order``, ``raw`` (the line) and ``event`` (a VARIANT, see ``read_sessions``). Returns keys, order,
    ``role, at`` (place in the message), ``kind`` (text, call or result), ``text``, ``ref`` (id of the call, else
    empty), ``tool`` (name, for calls), ``inputs`` and ``is_error``. A message is a text or a list of blocks; lines of other roles, without
    a message or with an empty one have no rows, nor have blocks of other kinds and an assistant's bare strings.
    """
    content = F.try_variant_get("event", "$.message.content", "variant")
    # The variant tells kinds apart; the text keeps the order of a call's inputs.
    written = F.from_json(F.from_json("raw", "message struct<content:string>")["message"]["content"], "array<string>")
    listed = F.arrays_zip(_get(content, "$", "array<variant>").alias("block"), written.alias("written"))
    rows = lines.select(*keys, order, _get(F.col("event"), "$.message.role").alias("role"), content.alias("content"), listed.alias("listed"))
    rows = rows.filter(F.col("role").isin("user", "assistant"))
    only = F.array(F.struct(F.col("content").alias("block"), F.lit(None).cast("string").alias("written")))
    blocks = rows.select(
        *keys, order, "role",
        F.posexplode(F.when(is_kind(F.col("content"), "ARRAY"), F.col("listed")).when(is_kind(F.col("content"), "STRING"), only)).alias("at", "b"),
        is_kind(F.col("content"), "STRING").alias("is_whole"),
    )
    block, user = F.col("b.block"), F.col("role") == "user"
    kind = _get(block, "$.type")
    named = (
        F.when(is_kind(block, "STRING"), F.when(user | F.col("is_whole"), "text"))
        .when(kind == "text", "text").when(user & (kind == "tool_result"), "result").when(~user & (kind == "tool_use"), "call")
    )
    text = (
        F.when(is_kind(block, "STRING"), _get(block, "$")).when(kind == "text", F.coalesce(_get(block, "$.text"), F.lit("")))
        .when(kind == "tool_result", _result_text(F.try_variant_get(block, "$.content", "variant")))
    )
    ref = F.when(kind == "tool_use", _get(block, "$.id")).when(kind == "tool_result", _get(block, "$.tool_use_id"))
    return blocks.select(
        *keys, order, "role", "at", named.alias("kind"), text.alias("text"), F.coalesce(ref, F.lit("")).alias("ref"),
        F.when(kind == "tool_use", F.coalesce(_get(block, "$.name"), F.lit("?"))).alias("tool"),
        F.when(kind == "tool_use", _shown_inputs(block, F.col("b.written"))).alias("inputs"),
        F.coalesce(_get(block, "$.is_error", "boolean"), F.lit(False)).alias("is_error"), "is_whole",
    ).filter(F.col("kind").isNotNull() & (~F.col("is_whole") | (F.col("text") != ""))).drop("is_whole")


def _entries(base: DataFrame, order: str) -> DataFrame:
    """Add ``entry``, what a block adds to the condensed session."""
    # A result's tool is the name that its id had last before it.
    looked = last_seen_dealt(base, [order, "at"], "_name", "_tool", within=["ref"])
    is_result = (F.col("kind") == "result") & (F.col("text") != "")
    marked = stored(
        looked.withColumn("_hash", F.when(is_result, F.md5(F.col("text").cast("binary")))).withColumn("_at", F.struct(order, "at")), "digest"
    )
    # The first of each text and class; of at most two per text the latest before a row names the tool.
    firsts = marked.filter("_hash IS NOT NULL").groupBy("_key", "_hash", "is_error").agg(
        F.min(F.struct("_at", F.coalesce("_tool", F.lit("")).alias("tool"))).alias("f")
    ).groupBy("_key", "_hash").agg(F.array_sort(F.collect_list(F.struct("f._at", "f.tool", "is_error"))).alias("_firsts"))
    joined = marked.join(firsts, ["_key", "_hash"], "left")
    earlier = F.filter("_firsts", lambda f: f["_at"] < F.col("_at"))
    again = F.exists(earlier, lambda f: f["is_error"] == F.col("is_error"))
    same_as = F.try_element_at(earlier, F.lit(-1))["tool"]
    shown = F.left("text", F.lit(SHOWN))
    result = (
        F.when(F.col("is_error") & again, F.concat(F.lit("[Result: ERROR same as "), same_as, F.lit("]")))
        .when(F.col("is_error"), F.rtrim(F.concat(F.lit("[Result: ERROR] "), shown), F.lit(BLANKS)))
        .when(F.col("text") == "", "[Result: ok]")
        .when(again, F.concat(F.lit("[Result: same as "), same_as, F.lit("]")))
        .otherwise(F.concat(F.lit("[Result: "), shown, F.lit("]")))
    )
    summary = F.coalesce(F.nullif(input_summary(F.col("tool"), F.col("inputs")), F.lit("")), F.lit("..."))
    call = F.concat(F.lit("[Tool: "), F.col("tool"), F.lit("("), summary, F.lit(")]"))
    entry = F.when(F.col("kind") == "result", result).when(F.col("kind") == "call", call).otherwise(F.col("text"))
    return joined.withColumn("entry", entry)


def condensed_sessions(lines: DataFrame, keys: Sequence[str], order: str, budget: int) -> DataFrame:
    """One text per session from its messages: ``keys, condensed``.

    A message is a heading with its role and, in lines, its texts, calls (``[Tool: name(inputs)]``) and results
    (``[Result: ...]``; ``same as <tool>`` where the session had the same result before, errors and others apart). Messages count up to
    the one that passes the budget; of a longer text head and tail stay.

    The rows are dealt once, by session and line, and all steps work on that deal, so a huge session lies in many
    tasks; only what the budget lets through is gathered. ``order`` is unique in a session and may be a struct. Sessions without any block
    have no row; null keys are a session; equal sessions under other keys are judged by themselves.
    """
    blocks = message_blocks(lines, keys, order)
    base = dealt(blocks.withColumn("_name", F.when((F.col("kind") == "call") & (F.col("ref") != ""), F.col("tool"))), keys, [order])
    entries = _entries(base, order)
    # The blocks of one message lie in one part.
    message = entries.groupBy("_key", "_part", order).agg(
        F.first("role").alias("role"), F.array_sort(F.collect_list(F.struct("at", "entry"))).alias("e")
    )
    body = F.array_join(F.transform("e", lambda e: e["entry"]), "\n")
    chunk = F.concat(F.lit("\n=== "), F.upper("role"), F.lit(" ===\n"), body, F.lit("\n"))
    sized = stored(message.select("_key", "_part", order, chunk.alias("chunk")).withColumn("size", F.length("chunk").cast("bigint")), "digest")
    kept = running_sum_dealt(sized, [order], "size", "before").filter(F.col("before") <= budget)
    whole = kept.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct(order, "chunk"))).alias("c"))
    text = F.array_join(F.transform("c", lambda c: c["chunk"]), "")
    return whole.select(*[F.col(f"_key.{k}").alias(k) for k in keys], head_tail(text, budget).alias("condensed"))

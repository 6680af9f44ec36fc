"""Session logs: scan, facts per session, acceptance, condensing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.functions.checks import safe_path_component
from duoscope.functions.text import head_tail, user_text
from duoscope.operators.ordered import first_per_key, last_seen, running_sum
from duoscope.settings import LIMITS, Limits


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Lines of JSON-lines session logs: ``file_path, line_key, raw, event``.

    ``event`` is a VARIANT, NULL for what is no JSON object; blank lines are dropped.
    ``line_key`` grows in file order (place of the split, then place in it), so no
    window over a file is needed and a huge file stays split.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ).alias("line_key"),
        F.trim(F.make_valid_utf8(F.col("value"))).alias("raw"),
    )
    return parsed_lines(lines)


def parsed_lines(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``event``, the VARIANT of a line, NULL for what is no JSON object; blank lines go."""
    is_object = F.startswith(F.col(raw), F.lit("{"))
    return lines.filter(F.col(raw) != "").withColumn("event", F.when(is_object, F.try_parse_json(raw)))


def session_rows(lines: DataFrame) -> DataFrame:
    """The fields of session events as columns (see :func:`session_facts`)."""
    def text(path: str) -> Column:
        return F.try_variant_get("event", path, "string")

    return lines.select(
        F.col("file_path").alias("session_id_key"), "line_key", text("$.type").alias("type"),
        text("$.sessionId").alias("session_id"), text("$.message.model").alias("model"), text("$.cwd").alias("cwd"),
        text("$.timestamp").alias("timestamp"), user_text(F.try_variant_get("event", "$.message.content", "variant")).alias("text"),
    )


def session_facts(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per session: lines, user turns, first session id, models, first and last time, first user text.

    ``rows`` has the keys, ``order`` (unique in a session), ``type``, ``session_id``, ``model``, ``timestamp``, ``text`` and perhaps
    ``cwd``, whose distinct values then come as ``cwds``.
    One aggregation; nothing is sorted and a long session is combined before the shuffle.
    """
    def first(value: str, when: Column) -> Column:
        return F.min(F.when(when, F.struct(order, value)))[value]

    user = F.col("type") == "user"
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(user).alias("user_turns"),
        first("session_id", F.col("session_id") != "").alias("session_id"),
        F.array_sort(F.collect_set(F.when((F.col("type") == "assistant") & (F.col("model") != ""), F.col("model")))).alias("models"),
        first("timestamp", user & F.col("timestamp").isNotNull()).alias("first_user_at"),
        F.max(F.when(F.col("timestamp").isNotNull(), F.struct(order, "timestamp")))["timestamp"].alias("last_at"),
        first("text", user & (F.col("text") != "")).alias("first_user_query"),
        *([F.array_sort(F.collect_set(F.when(F.col("cwd") != "", F.col("cwd")))).alias("cwds")] if "cwd" in rows.columns else []),
    )


def session_issues(facts: DataFrame, key: str, limits: Limits = LIMITS) -> DataFrame:
    """One row per session and broken rule: ``key, rule, severity``."""
    rules = [
        ("too_short", "issue", F.col("line_count") < limits.min_lines),
        ("no_session", "issue", F.coalesce(F.col("session_id"), F.lit("")) == ""),
        ("no_models", "issue", F.size("models") == 0),
        ("few_turns", "issue", F.col("user_turns") < limits.min_turns),
        ("many_turns", "warning", F.col("user_turns") > limits.max_turns),
    ]
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"))) for n, s, c in rules]))
    return facts.select(key, F.inline(found))


def collect_result(runs: DataFrame, facts: DataFrame, key: str, limits: Limits = LIMITS) -> DataFrame:
    """Result of collecting each run: ``key, status, error, recovery``.

    ``runs`` has the key, ``action`` (see :func:`collect_action`), ``provider`` (the expected one) and ``session`` (expected id,
    perhaps empty); ``facts`` those of the file that was found, ``provider`` included, or no row. In order: a session id that no file name could hold fails;
    no file fails, or is skipped in a salvage; another provider fails; too few lines or no model fail, where a salvage asks for fewer lines
    and no model, and keeps any line as partial; another session fails except in a salvage. A forced collection expects no session. What is kept is done, or
    partial from a salvage. Runs that are not collected have no row.
    """
    found = facts.select(
        F.col(key).alias("_key"), "line_count", F.col("session_id").alias("_session"), F.col("provider").alias("_provider"), F.size("models").alias("_models")
    )
    rows = runs.filter(~F.col("action").isin("already_done", "skip")).join(found, F.col(key) == F.col("_key"), "left")
    salvage, forced = F.col("action") == "salvage", F.col("action") == "force_collect"
    wanted = F.when(forced, "").otherwise(F.coalesce("session", F.lit("")))
    lines = F.col("line_count")
    least = F.when(salvage, limits.min_salvage_lines).otherwise(limits.min_lines)
    incomplete = (lines < least) | (~salvage & (F.col("_models") <= 0))
    error = (
        F.when(~safe_path_component(wanted), "bad_session_format")
        .when(lines.isNull(), "no_file").when(~F.col("_provider").isin("unknown") & (F.col("_provider") != F.col("provider")), "provider_mismatch")
        .when(incomplete & ~(salvage & (lines > 0)), "incomplete")
        .when((wanted != "") & (F.coalesce("_session", F.lit("")) != wanted) & ~salvage, "session_mismatch")
    )
    status = (
        F.when(F.col("error").isNull(), F.when(salvage, "partial").otherwise("done"))
        .when((F.col("error") == "no_file") & salvage, "skipped").otherwise("failed")
    )
    return rows.withColumn("error", error).select(key, status.alias("status"), "error", (salvage | forced).alias("recovery"))


def acceptance(facts: DataFrame, expected_provider: Column, provider: Column, expected_session: Column, limits: Limits = LIMITS) -> DataFrame:
    """Add ``status`` and ``error``: the first acceptance rule that a collected session breaks."""
    checks = [
        ("missing", F.col("line_count").isNull()),
        ("provider_mismatch", (provider != "unknown") & (provider != expected_provider)),
        ("too_short", F.col("line_count") < limits.min_lines),
        ("no_models", F.size("models") == 0),
        ("session_mismatch", (expected_session != "") & (F.col("session_id") != expected_session)),
    ]
    error = None
    for name, broken in checks:
        error = F.when(broken, name) if error is None else error.when(broken, name)
    return facts.withColumn("error", error).withColumn("status", F.when(F.col("error").isNull(), "done").otherwise("failed"))


def collect_action(status: Column, forced: Column, salvageable: Sequence[str]) -> Column:
    """What collection does with a run: already_done, force_collect, collect, salvage or skip."""
    return (
        F.when((status == "done") & forced, "force_collect").when(status == "done", "already_done")
        .when(status == "partial", "collect").when(status.isin(*salvageable), "salvage").otherwise("skip")
    )


def files_of_runs(runs: DataFrame, files: DataFrame) -> DataFrame:
    """The log file of each run, and how it was found.

    ``runs``: ``run_id, slug, start, session``; ``files``: ``slug, file, session, mtime``. A file of the run's session wins, then the
    newest file of the folder if it is younger than the run's start, then the session's file in another folder.
    The newest younger file is the newest of the folder or there is none, so the inequality needs no
    range join: both sides meet as one aggregated row per key.
    """
    newest = F.max(F.struct("mtime", "file"))
    by_session = files.filter("session <> ''").groupBy("slug", "session").agg(newest.alias("own"))
    by_folder = files.groupBy("slug").agg(newest.alias("new"))
    anywhere = files.filter("session <> ''").groupBy("session").agg(newest.alias("other"))
    joined = runs.join(by_session, ["slug", "session"], "left").join(by_folder, "slug", "left").join(anywhere, "session", "left")
    own, new = F.col("own.mtime") > F.col("start"), F.col("new.mtime") > F.col("start")
    return joined.select(
        "run_id",
        F.when(own, F.col("own.file")).when(new, F.col("new.file")).otherwise(F.col("other.file")).alias("file"),
        F.when(own, "session").when(new, "newest").when(F.col("other.file").isNotNull(), "elsewhere").otherwise("none").alias("found_by"),
    )


def delivered_file(files: DataFrame, key: str, kinds: Sequence[str]) -> DataFrame:
    """Of each task's files the one of the first kind there is (``kinds`` in order of precedence)."""
    rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    best = F.min(F.when(rank > 0, F.struct(rank.alias("rank"), "file"))).alias("b")
    return files.groupBy(key).agg(best).filter("b IS NOT NULL").select(key, "b.file", F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("b.rank").cast("int")).alias("kind"))


def input_summary(tool: Column, inputs: Column, few: int = 3, more: int = 5, key_fields=C.TOOL_KEY_FIELDS) -> Column:
    """One line of a tool's inputs (a map of texts): the first few, long values cut, key fields later than others."""
    known = tool.isin(*key_fields)
    keys = F.create_map(*[x for t, f in key_fields.items() for x in (F.lit(t), F.array(*[F.lit(v) for v in f]))])[tool]
    entries = F.slice(F.map_entries(inputs), 1, F.when(known, more).otherwise(few))

    def shown(e: Column) -> Column:
        v, is_key = e["value"], F.coalesce(F.array_contains(keys, e["key"]), F.lit(False))
        long_key = F.when(F.length(v) > 300, F.concat(F.left(v, F.lit(200)), F.lit("..."))).otherwise(v)
        long_other = F.when(F.length(v) > 80, F.concat(F.left(v, F.lit(40)), F.lit("..."))).otherwise(v)
        return F.concat(e["key"], F.lit("="), F.when(is_key, long_key).otherwise(long_other))

    return F.array_join(F.transform(entries, shown), ", ")


def salvaged_json(raw: Column) -> Column:
    """A VARIANT from text that is JSON or holds one: the whole, else from the first brace to the last, else brackets."""
    inner = lambda a, b: F.try_parse_json(F.regexp_extract(raw, rf"(?s)(\{a}.*\{b})", 1))
    return F.coalesce(F.try_parse_json(raw), inner("{", "}"), inner("[", "]"))


def repeated_results(rows: DataFrame, keys: Sequence[str], order: str, text: str, kind: str, tool: str) -> DataFrame:
    """Add ``is_first`` (first of its text and kind in the session) and, to repeats, ``same_as``.

    ``same_as`` is the tool of the latest first occurrence, of either kind, of the
    same text before the row. Texts are compared as a whole by a 128-bit hash, and the firsts
    come from one aggregation: each text has at most one first per kind, so a
    text repeated very often stays cheap.
    """
    marked = rows.withColumn("_text", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    by_kind = first_per_key(marked, [*keys, "_text", kind], [order], [order, tool])
    # At most one entry per kind.
    firsts = by_kind.groupBy(*keys, "_text").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(kind).alias("kind"), F.col(tool).alias("tool")))).alias("_firsts")
    )
    joined = marked.join(firsts, [*keys, "_text"])
    is_first = F.exists("_firsts", lambda f: (f["at"] == F.col(order)) & (f["kind"] == F.col(kind)))
    earlier = F.filter("_firsts", lambda f: f["at"] < F.col(order))
    return joined.select(
        *rows.columns, is_first.alias("is_first"),
        F.when(~is_first, F.try_element_at(earlier, F.lit(-1))["tool"]).alias("same_as"),
    )


def tool_names(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, out: str = "tool") -> DataFrame:
    """Name that the id of a result had most recently before it (as-of); empty when none."""
    found = last_seen(rows, keys, order, name, out)
    return found.withColumn(out, F.coalesce(out, F.lit("")))


def within_budget(chunks: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, budget: int) -> DataFrame:
    """Chunks of each session up to the one that passes the budget, which stays.

    The cut is the feature; the budget has no default.
    """
    sized = chunks.withColumn("_size", F.length(F.coalesce(F.col(text), F.lit(""))).cast("bigint"))
    return running_sum(sized, keys, order, "_size", "_before").filter(F.col("_before") <= budget).drop("_size", "_before")


def condensed(rows: DataFrame, keys: Sequence[str], order: Sequence[str], role: str, text: str, budget: int) -> DataFrame:
    """One text per session: role headings and texts, cut to the budget and then to its head and tail.

    Only chunks inside the budget are gathered, so a session's list is bounded by it.
    """
    mark = F.concat(F.lit("\n=== "), F.upper(F.col(role)), F.lit(" ===\n"), F.coalesce(F.col(text), F.lit("")), F.lit("\n"))
    kept = within_budget(rows.withColumn("_chunk", mark), keys, order, "_chunk", budget)
    joined = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, "_chunk"))).alias("_all"))
    whole = F.array_join(F.transform("_all", lambda c: c["_chunk"]), "")
    return joined.select(*keys, head_tail(whole, budget).alias("condensed"))

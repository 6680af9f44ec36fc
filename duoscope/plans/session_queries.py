"""Queries on session logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.functions import checks, names, text
from duoscope.operators import pairs
from duoscope.operators import sessions as S
from duoscope.plans import fixtures as X

BUDGET = 1500


def facts(spark, d) -> DataFrame:
    return S.session_facts(X.session_lines(spark, d), ["session"], "line_no")


def session_facts(spark, d):
    return facts(spark, d).withColumn("models", F.array_join("models", ","))


def session_issues(spark, d):
    return S.session_issues(facts(spark, d), "session")


def providers(spark, d):
    rows = facts(spark, d)
    expected = F.when(F.col("session") % 2 == 0, "qwen").otherwise("claude")
    return rows.select(
        "session", checks.detected_provider(F.col("models")).alias("provider"),
        checks.identity_matches(F.col("models"), expected).alias("identity_ok"),
    )


def acceptance(spark, d):
    rows = facts(spark, d).withColumn("provider", checks.detected_provider(F.col("models")))
    expected = F.when(F.col("session") % 3 == 0, "qwen").otherwise("claude")
    session = F.when(F.col("session") % 5 == 0, "other").otherwise("")
    return S.acceptance(rows, expected, F.col("provider"), session).select("session", "error", "status")


def session_parity(spark, d):
    rows = facts(spark, d).withColumn("task_id", F.expr("session div 2")).withColumn("arm", F.when(F.col("session") % 2 == 0, "baseline").otherwise("candidate"))
    return pairs.session_parity(pairs.pair_arms(rows, ["first_user_query", "user_turns"])).select("task_id", "query_differs", "turn_gap", "turns_unbalanced")


def budget_cut(spark, d):
    kept = S.within_budget(X.session_lines(spark, d), ["session"], ["line_no"], "text", BUDGET)
    return kept.select("session", "line_no")


def condensed(spark, d):
    out = S.condensed(X.session_lines(spark, d), ["session"], ["line_no"], "type", "text", BUDGET)
    return out.select("session", F.length("condensed").alias("n"), F.sha2(F.col("condensed").cast("binary"), 256).alias("digest"))


def truncated(spark, d):
    cut = text.head_tail(F.coalesce("text", F.lit("")), 200)
    return X.table(spark, d, "documents").select("doc_id", F.sha2(cut.cast("binary"), 256).alias("digest"))


def results(spark, d) -> DataFrame:
    """Documents as tool results: blocks of 50 ids are a session, even ids errors, the source the tool."""
    return X.table(spark, d, "documents").select(
        F.expr("doc_id div 50").alias("session"), F.col("doc_id").alias("pos"), (F.col("doc_id") % 2 == 0).alias("is_error"),
        F.col("source").alias("tool"), F.coalesce("text", F.lit("")).alias("text"),
    )


def repeated_results(spark, d):
    return S.repeated_results(results(spark, d), ["session"], "pos", "text", "is_error", "tool").select("session", "pos", "is_first", "same_as")


def tool_asof(spark, d):
    """Events as tool uses and results: the id is the user; views name the tool, the rest look it up."""
    events = X.table(spark, d, "events").select(
        F.col("user_id").alias("tool_id"), F.col("event_id").alias("pos"),
        F.when(F.col("event_type") == "view", F.get_json_object("props", "$.k")).alias("name"), "event_type",
    )
    return S.tool_names(events, ["tool_id"], ["pos"], "name").filter("event_type <> 'view'").select("tool_id", "pos", "tool")


def artifact_names(spark, d):
    task = F.concat(F.lit("CT-"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"))
    return X.table(spark, d, "customer").select(
        "c_custkey", names.session_path(task, F.lit("a")).alias("session_path"), names.score_path(task, F.lit("b")).alias("score_path"),
        names.date_part(F.lpad((F.col("c_custkey") + 20240101).cast("string"), 8, "0")).alias("date_part"),
        names.project_slug(F.concat(F.lit("D:\\work/my_"), F.col("c_name"))).alias("slug"),
        checks.valid_task_id(task, r"^CT-\d{6}$").alias("valid"),
    )


def collect_actions(spark, d):
    from duoscope.plans.ledger_queries import cells

    status, forced = F.coalesce("status", F.lit("")), F.col("task_id") % 4 == 0
    runs = cells(spark, d).filter("stage = 'run'")
    return runs.select("task_id", "arm", S.collect_action(status, forced, C.SALVAGEABLE_STATUSES).alias("action"))


def files_of_runs(spark, d):
    """Suppliers as runs in their nation's folder, customers as files there."""
    runs = X.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("run_id"), F.col("s_nationkey").alias("slug"), F.col("s_acctbal").alias("start"),
        F.concat(F.lit("s"), (F.col("s_suppkey") * 7).cast("string")).alias("session"),
    )
    files = X.table(spark, d, "customer").select(
        F.col("c_nationkey").alias("slug"), F.col("c_name").alias("file"), F.concat(F.lit("s"), F.col("c_custkey")).alias("session"), F.col("c_acctbal").alias("mtime"),
    )
    return S.files_of_runs(runs, files)


def delivered_files(spark, d):
    files = X.table(spark, d, "part").select("p_brand", F.col("p_type").alias("kind"), F.col("p_partkey").alias("file"))
    return S.delivered_file(files, "p_brand", ["PROMO", "ECONOMY", "STANDARD"])


def tool_inputs(spark, d):
    inputs = F.create_map(F.lit("command"), F.coalesce("text", F.lit("")), F.lit("note"), F.coalesce("text", F.lit("")), F.lit("role"), F.col("role"), F.lit("turn"), F.col("turn").cast("string"))
    tool = F.when(F.col("role") == "assistant", "Bash").otherwise("Other")
    return X.table(spark, d, "conversations").select("conv_id", "turn", S.input_summary(tool, inputs).alias("summary"))


def salvaged(spark, d):
    raw = F.concat(F.when(F.col("event_id") % 3 == 0, "Here: ").otherwise(""), F.when(F.col("event_id") % 5 == 0, "no json").otherwise(F.col("props")), F.when(F.col("event_id") % 2 == 0, " done").otherwise(""))
    return X.table(spark, d, "events").select("event_id", F.try_variant_get(S.salvaged_json(raw), "$.k", "int").alias("k"))


_PROVIDER = """CASE WHEN len(list_filter(models, lambda m: contains(lower(m), 'qwen'))) > 0 THEN 'qwen'
  WHEN len(list_filter(models, lambda m: contains(lower(m), 'claude'))) > 0 THEN 'claude' ELSE 'unknown' END"""

def worklist_totals(spark, d):
    return collect_actions(spark, d).groupBy("action").agg(F.count(F.lit(1)).alias("n_runs"))


_CUT = "CASE WHEN length(text) > {0} THEN left(text, {1}) || '...' ELSE coalesce(text, '') END"

QUERIES = {
    "files_of_runs": (files_of_runs, """WITH f AS (SELECT c_nationkey AS slug, c_name AS file, 's' || c_custkey AS session, c_acctbal AS mtime FROM customer),
        r AS (SELECT s_suppkey AS run_id, s_nationkey AS slug, s_acctbal AS start, 's' || (s_suppkey * 7) AS session FROM supplier),
        own AS (SELECT run_id, max_by(file, mtime) AS file FROM r JOIN f USING (slug, session) WHERE mtime > start GROUP BY 1),
        new AS (SELECT run_id, max_by(file, (mtime, file)) AS file FROM r JOIN f USING (slug) WHERE mtime > start GROUP BY 1),
        o AS (SELECT run_id, max_by(f.file, f.mtime) AS file FROM r JOIN f USING (session) GROUP BY 1)
        SELECT r.run_id, coalesce(own.file, new.file, o.file) AS file, CASE WHEN own.file IS NOT NULL THEN 'session' WHEN new.file IS NOT NULL THEN 'newest' WHEN o.file IS NOT NULL THEN 'elsewhere' ELSE 'none' END AS found_by
        FROM r LEFT JOIN own USING (run_id) LEFT JOIN new USING (run_id) LEFT JOIN o USING (run_id)"""),
    "delivered_files": (delivered_files, """WITH r AS (SELECT p_brand, p_partkey AS file, p_type AS kind, list_position(['PROMO', 'ECONOMY', 'STANDARD'], p_type) AS rank FROM part)
        SELECT p_brand, file, kind FROM r WHERE rank > 0 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY rank, file) = 1"""),
    "tool_inputs": (tool_inputs, f"""SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'command=' || {_CUT.format(300, 200)} || ', note=' || {_CUT.format(80, 40)} || ', role=' || role || ', turn=' || turn
        ELSE 'command=' || {_CUT.format(80, 40)} || ', note=' || {_CUT.format(80, 40)} || ', role=' || role END AS summary FROM conversations"""),
    "salvaged_json": (salvaged, "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract(props, '$.k') AS INT) END AS k FROM events"),
    "session_facts": (session_facts, f"WITH {X.LINES} SELECT session, line_count, user_turns, session_id, array_to_string(models, ',') AS models, first_user_at, last_at, first_user_query FROM facts"),
    "session_issues": (session_issues, f"""WITH {X.LINES} SELECT session, 'too_short' AS rule, 'issue' AS severity FROM facts WHERE line_count < 10
        UNION ALL SELECT session, 'no_session', 'issue' FROM facts WHERE coalesce(session_id, '') = '' UNION ALL SELECT session, 'no_models', 'issue' FROM facts WHERE len(models) = 0
        UNION ALL SELECT session, 'few_turns', 'issue' FROM facts WHERE user_turns < 2 UNION ALL SELECT session, 'many_turns', 'warning' FROM facts WHERE user_turns > 8"""),
    "providers": (providers, f"""WITH {X.LINES} SELECT session, {_PROVIDER} AS provider, CASE WHEN len(models) = 0 THEN false
        WHEN session % 2 = 0 THEN len(list_filter(models, lambda m: contains(lower(m), 'qwen'))) > 0
        ELSE len(list_filter(models, lambda m: contains(lower(m), 'claude') OR contains(lower(m), 'anthropic'))) > 0 END AS identity_ok FROM facts"""),
    "acceptance": (acceptance, f"""WITH {X.LINES}, p AS (SELECT *, {_PROVIDER} AS provider FROM facts), e AS (SELECT session, CASE
        WHEN provider <> 'unknown' AND provider <> CASE WHEN session % 3 = 0 THEN 'qwen' ELSE 'claude' END THEN 'provider_mismatch'
        WHEN line_count < 10 THEN 'too_short' WHEN len(models) = 0 THEN 'no_models' WHEN session % 5 = 0 AND session_id <> 'other' THEN 'session_mismatch' END AS error FROM p)
        SELECT session, error, CASE WHEN error IS NULL THEN 'done' ELSE 'failed' END AS status FROM e"""),
    "session_parity": (session_parity, f"""WITH {X.LINES}, p AS (SELECT session // 2 AS task_id, max(first_user_query) FILTER (session % 2 = 0) AS qb, max(first_user_query) FILTER (session % 2 = 1) AS qc,
        max(user_turns) FILTER (session % 2 = 0) AS tb, max(user_turns) FILTER (session % 2 = 1) AS tc FROM facts GROUP BY 1)
        SELECT task_id, coalesce(qb <> '' AND qc <> '' AND qb <> qc, false) AS query_differs, abs(tb - tc) AS turn_gap, coalesce(abs(tb - tc) >= 2, false) AS turns_unbalanced FROM p"""),
    "budget_cut": (budget_cut, f"""WITH {X.LINES}, r AS (SELECT session, line_no, coalesce(sum(length(coalesce(text, ''))) OVER (PARTITION BY session ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM lines)
        SELECT session, line_no FROM r WHERE before <= {BUDGET}"""),
    "condensed": (condensed, f"""WITH {X.LINES}, c AS (SELECT session, line_no, chr(10) || '=== ' || upper(type) || ' ===' || chr(10) || coalesce(text, '') || chr(10) AS chunk FROM lines),
        r AS (SELECT *, coalesce(sum(length(chunk)) OVER (PARTITION BY session ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c),
        t AS (SELECT session, string_agg(chunk, '' ORDER BY line_no) AS t FROM r WHERE before <= {BUDGET} GROUP BY 1),
        f AS (SELECT session, CASE WHEN length(t) > {BUDGET} THEN left(t, {int(BUDGET * 0.3)}) || chr(10) || chr(10) || '[... truncated ...]' || chr(10) || chr(10) || right(t, {BUDGET - int(BUDGET * 0.3)}) ELSE t END AS f FROM t)
        SELECT session, length(f)::INT AS n, sha256(f) AS digest FROM f"""),
    "truncated": (truncated, "SELECT doc_id, sha256(CASE WHEN length(coalesce(text, '')) > 200 THEN left(text, 60) || chr(10) || chr(10) || '[... truncated ...]' || chr(10) || chr(10) || right(text, 140) ELSE coalesce(text, '') END) AS digest FROM documents"),
    "repeated_results": (repeated_results, """WITH r AS (SELECT doc_id // 50 AS session, doc_id AS pos, doc_id % 2 = 0 AS is_error, source AS tool, coalesce(text, '') AS text FROM documents),
        f AS (SELECT *, row_number() OVER (PARTITION BY session, text, is_error ORDER BY pos) = 1 AS is_first FROM r)
        SELECT session, pos, is_first, CASE WHEN NOT is_first THEN last_value(CASE WHEN is_first THEN tool END IGNORE NULLS) OVER (PARTITION BY session, text ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS same_as FROM f"""),
    "tool_asof": (tool_asof, """WITH e AS (SELECT user_id AS tool_id, event_id AS pos, event_type, CASE WHEN event_type = 'view' THEN json_extract_string(props, '$.k') END AS name FROM events),
        s AS (SELECT *, last_value(name IGNORE NULLS) OVER (PARTITION BY tool_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS tool FROM e)
        SELECT tool_id, pos, coalesce(tool, '') AS tool FROM s WHERE event_type <> 'view'"""),
    "artifact_names": (artifact_names, """SELECT c_custkey, 'trajectories/a/a-' || lpad(c_custkey::VARCHAR, 6, '0') || '.jsonl' AS session_path, 'scores/b/b-' || lpad(c_custkey::VARCHAR, 6, '0') || '.quality.toml' AS score_path,
        coalesce(try_cast(substr((c_custkey + 20240101)::VARCHAR, 5, 2) AS INT)::VARCHAR, '') || substr((c_custkey + 20240101)::VARCHAR, 7, 2) AS date_part,
        'D--work-my-' || c_name AS slug, true AS valid FROM customer"""),
    "worklist_totals": (worklist_totals, f"""WITH {X.CELLS} SELECT CASE WHEN status = 'done' AND task_id % 4 = 0 THEN 'force_collect' WHEN status = 'done' THEN 'already_done'
        WHEN status = 'partial' THEN 'collect' WHEN status IN ('running', 'error', 'failed', 'timeout') THEN 'salvage' ELSE 'skip' END AS action, count(*) AS n_runs FROM cells WHERE stage = 'run' GROUP BY 1"""),
    "collect_actions": (collect_actions, f"""WITH {X.CELLS} SELECT task_id, arm, CASE WHEN status = 'done' AND task_id % 4 = 0 THEN 'force_collect' WHEN status = 'done' THEN 'already_done'
        WHEN status = 'partial' THEN 'collect' WHEN status IN ('running', 'error', 'failed', 'timeout') THEN 'salvage' ELSE 'skip' END AS action FROM cells WHERE stage = 'run'"""),
}

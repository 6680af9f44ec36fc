"""Queries that write the given tables as log and ledger files and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.functions.text import BLANKS
from duoscope.operators import ledger as L
from duoscope.operators.digest import condensed_sessions
from duoscope.operators.sessions import files_of_runs, parsed_lines, read_sessions, session_facts, session_rows
from duoscope.plans import fixtures as X
from duoscope.plans.ledger_queries import QUERIES as LEDGER
from duoscope.sources import ledger_files, session_files
from duoscope.storage import shared_dir, stored
from duoscope.streaming import ledger as S

BUDGET = 20_000
FAR = 4_000_000_000


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def session_logs(spark, d) -> DataFrame:
    """Conversations as log lines ``session, line, raw``: every third conversation in one session, five of the others in one.

    Users' turns hold a result and texts, assistants' a text and a call, every fifth is a plain text. Ids of calls come again.
    """
    conv, line = F.col("conv_id"), F.col("conv_id") * 1000 + F.col("turn")
    q = lambda c: F.substring(F.to_json(F.array(c)), 2, 1 << 30)
    quoted = lambda c: F.left(q(c), F.length(q(c)) - 1)
    text = quoted(F.col("text"))
    ref = F.concat(F.lit('"t'), (F.expr("(conv_id * 1000 + turn) div 2") % 7).cast("string"), F.lit('"'))
    kind = line % 4
    result = (
        F.when(kind == 0, '""').when(kind == 1, '"  ok\\n"')
        .when(kind == 2, F.concat(F.lit('[{"type":"text","text":'), text, F.lit('},{"type":"image"},{"type":"text","text":"end"}]')))
        .otherwise(text)
    )
    failed = F.when(conv % 2 == 1, "true").otherwise("false")
    user = F.concat(
        F.lit('[{"type":"tool_result","tool_use_id":'), ref, F.lit(',"is_error":'), failed, F.lit(',"content":'), result,
        F.lit('},{"type":"text","text":'), text, F.lit('},"note",7]'),
    )
    tool = F.element_at(F.array(F.lit("Bash"), F.lit("Edit"), F.lit("Grep")), (conv % 3 + 1).cast("int"))
    model = F.concat(
        F.lit('[{"type":"text","text":'), text, F.lit('},{"type":"tool_use","id":'), ref, F.lit(',"name":"'), tool,
        F.lit('","input":{"command":'), text, F.lit(',"flag":true,"at":'), line.cast("string"), F.lit(',"more":null}},"bare",{"type":"thinking"}]'),
    )
    content = F.when(line % 5 == 0, text).when(F.col("role") == "user", user).otherwise(model)
    session = F.when(conv % 3 == 0, 0).otherwise(F.expr("conv_id div 5"))
    raw = F.concat(
        F.lit('{"type":"'), F.col("role"), F.lit('","sessionId":"s'), session.cast("string"), F.lit('","cwd":"/w'), (conv % 4).cast("string"),
        F.lit('","message":{"role":"'), F.col("role"), F.lit('","content":'), content, F.lit("}}"),
    )
    return X.table(spark, d, "conversations").select(session.cast("bigint").alias("session"), line.alias("line"), raw.alias("raw"))


def session_digest(spark, d):
    """Condensed sessions from their log lines."""
    lines = parsed_lines(session_logs(spark, d))
    out = condensed_sessions(lines, ["session"], "line", BUDGET)
    return out.select("session", F.length("condensed").alias("n"), F.sha2(F.col("condensed").cast("binary"), 256).alias("digest"))


def _written_logs(spark, d) -> str:
    """The logs as one folder per session; a large session has several files."""
    path = _folder(spark, "session-logs")
    logs = session_logs(spark, d).sortWithinPartitions("session", "line")
    logs.select(F.col("session").alias("slug"), F.col("raw").alias("value")).write.partitionBy("slug").text(path)
    return path


def log_facts(spark, d):
    """Facts of the sessions as read from their files."""
    rows = session_rows(read_sessions(spark, _written_logs(spark, d)))
    facts = session_facts(rows.withColumn("session", F.col("session_id")), ["session"], "line_key")
    return facts.select("session_id", "line_count", "user_turns", F.array_join("cwds", ",").alias("cwds"))


def run_files(spark, d):
    """The log file of every session as a run: of even ones the session is known, every fourth began after all files."""
    path = _written_logs(spark, d)
    files = session_files.session_files(spark, path, suffix=".txt").withColumn("slug", F.regexp_extract("slug", r"slug=(\d+)", 1))
    s = F.col("session")
    runs = X.table(spark, d, "conversations").select(F.when(F.col("conv_id") % 3 == 0, 0).otherwise(F.expr("conv_id div 5")).alias("session")).distinct()
    runs = runs.select(
        s.alias("run_id"), s.cast("string").alias("slug"), F.when(s % 4 == 0, FAR).otherwise(0).cast("double").alias("start"),
        F.when(s % 2 == 0, F.concat(F.lit("s"), s)).otherwise("").alias("session"),
    )
    found = files_of_runs(runs, stored(session_files.known_files(files), "files"))
    return found.select("run_id", "found_by", F.regexp_extract("file", r"slug=(\d+)", 1).alias("folder"))


def _ledger_path(spark, documents: DataFrame) -> str:
    """A file per ledger document."""
    path = _folder(spark, "ledgers")
    documents.select("json").write.option("maxRecordsPerFile", 1).text(path)
    return path


def ledger_scan(spark, d):
    """The current state, written as a JSON document per fifty tasks, read back as cells."""
    state = LEDGER["ledger_state"][0](spark, d)
    cells = state.select(
        F.expr("task_id div 50").alias("ledger"), F.concat(F.lit("CT-"), "task_id").alias("task"), "stage", "arm", "status", "retry_count", "duration_s"
    )
    found = ledger_files.ledger_cells(ledger_files.read_ledgers(spark, _ledger_path(spark, ledger_files.ledger_documents(cells))))
    return found.select(F.substring("task", 4, 30).cast("bigint").alias("task_id"), "stage", "arm", "status", "retry_count", "duration_s")


def turn_status(spark, d):
    """Runs' status from the turns in their ledger files."""
    turn = F.struct(
        "event_id", (F.col("event_type") == "error").cast("int").alias("exit_code"), F.col("value").alias("duration_s"),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("s"), F.col("user_id"))).otherwise("").alias("session_id"),
    )
    runs = X.table(spark, d, "events").groupBy(
        F.col("user_id").alias("task"), F.when(F.col("event_id") % 2 == 0, "baseline").otherwise("candidate").alias("arm")
    ).agg(F.array_sort(F.collect_list(turn)).alias("turns_detail"))
    cells = runs.select(
        F.expr("task div 50").alias("ledger"), F.col("task").cast("string").alias("task"), F.lit("run").alias("stage"), "arm", "turns_detail",
        F.lit(30).alias("expected_turns"),
    )
    found = ledger_files.ledger_cells(ledger_files.read_ledgers(spark, _ledger_path(spark, ledger_files.ledger_documents(cells))))
    turns = ledger_files.turn_log(found).withColumn("task_id", F.col("task").cast("bigint"))
    return L.run_status(turns).select("task_id", "arm", "n_turns", "n_errors", F.round("duration_s", 3).alias("duration_s"), "session_id", "status")


def _writes(spark, d) -> DataFrame:
    return X.ledger_writes(spark, d).withColumn("arm", F.coalesce("arm", F.lit("")))


def _plain_arm(state: DataFrame) -> DataFrame:
    return state.withColumn("arm", F.nullif("arm", F.lit("")))


def ledger_stream(spark, d):
    """The ledger's state as a stream gives it: writes land in four files, latest first, one to a batch."""
    land, out = _folder(spark, "landed"), _folder(spark, "followed")
    writes = _writes(spark, d)
    for k in (3, 1, 0, 2, 1):  # one file comes twice
        writes.filter(F.col("seq") % 4 == k).coalesce(1).write.mode("append").parquet(land)
    landed = spark.readStream.schema(writes.schema).option("maxFilesPerTrigger", 1).parquet(land)
    S.follow_ledger(spark, landed, out, name=out.rsplit("/", 1)[1])
    return _plain_arm(S.followed_state(spark, out))


def ledger_compacted(spark, d):
    """State from a snapshot of the earlier half of the writes, one of the third quarter, and the rest as it was appended."""
    out, writes = _folder(spark, "compacted"), _writes(spark, d)
    parts = [writes.filter(F.expr(f"(seq div 16) % 4 {c}")) for c in ("< 2", "= 2", "= 3")]
    for p in parts[:2]:
        S.compact(spark, p, out)
    return _plain_arm(S.compacted_state(spark, out, parts[2]))


def ledger_reset(spark, d):
    """State after runs of even tasks' candidates, one task's cells and all finalize cells were reset."""
    writes = _writes(spark, d)
    state = stored(L.current_state(writes), "state")
    tasks = X.table(spark, d, "events").select(F.col("user_id").alias("task_id")).distinct().filter("task_id % 2 = 0")
    selection = tasks.select("task_id", F.lit("run").alias("stage"), F.lit("candidate").alias("arm")).union(
        spark.createDataFrame([(7, None, None), (None, "finalize", None)], "task_id bigint, stage string, arm string")
    )
    gone = L.reset_writes(state, selection)
    both = writes.select(*gone.columns).unionByName(gone)
    return _plain_arm(L.current_state(both))


def _trimmed(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


_BLANKS = " || ".join(f"chr({ord(c)})" for c in BLANKS)

_LOGS = """logs AS (
  SELECT CASE WHEN conv_id % 3 = 0 THEN 0 ELSE conv_id // 5 END AS session, conv_id * 1000 + turn AS line, conv_id, role, coalesce(text, '') AS text,
    (conv_id * 1000 + turn) // 2 % 7 AS ref, (conv_id * 1000 + turn) % 5 = 0 AS whole, (conv_id * 1000 + turn) % 4 AS kind
  FROM conversations
)"""

_CUT = "CASE WHEN length(text) > {0} THEN left(text, {1}) || '...' ELSE text END"

QUERIES = {
    "session_digest": (session_digest, f"""WITH {_LOGS}, named AS (
          SELECT *, ['Bash', 'Edit', 'Grep'][conv_id % 3 + 1] AS own, role = 'user' AND NOT whole AS is_result,
            {_trimmed("CASE kind WHEN 0 THEN '' WHEN 1 THEN 'ok' WHEN 2 THEN text || ' end' ELSE text END")} AS result, conv_id % 2 = 1 AS failed
          FROM logs WHERE role IN ('user', 'assistant')
        ), looked AS (
          SELECT *, coalesce(last_value(CASE WHEN role = 'assistant' AND NOT whole THEN own END IGNORE NULLS) OVER (
            PARTITION BY session, ref ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS tool FROM named
        ), marked AS (
          SELECT *, row_number() OVER (PARTITION BY session, is_result, result, failed ORDER BY line) AS times FROM looked
        ), seen AS (
          SELECT *, last_value(CASE WHEN times = 1 THEN tool END IGNORE NULLS) OVER (
            PARTITION BY session, is_result, result ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS same FROM marked
        ), entries AS (
          SELECT session, line, role, CASE WHEN whole THEN nullif(text, '') WHEN role = 'assistant' THEN text || chr(10) || '[Tool: ' || own || '(command='
              || CASE own WHEN 'Bash' THEN {_CUT.format(300, 200)} ELSE {_CUT.format(80, 40)} END || ', flag=True, at=' || line
              || CASE own WHEN 'Grep' THEN '' ELSE ', more=None' END || ')]'
            ELSE CASE WHEN failed AND result <> '' AND times > 1 THEN '[Result: ERROR same as ' || same || ']'
              WHEN failed THEN rtrim('[Result: ERROR] ' || left(result, 300), {_BLANKS}) WHEN result = '' THEN '[Result: ok]'
              WHEN times > 1 THEN '[Result: same as ' || same || ']' ELSE '[Result: ' || left(result, 300) || ']' END
              || chr(10) || text || chr(10) || 'note' END AS body
          FROM seen
        ), chunks AS (
          SELECT session, line, chr(10) || '=== ' || upper(role) || ' ===' || chr(10) || body || chr(10) AS chunk FROM entries WHERE body IS NOT NULL
        ), sums AS (
          SELECT *, coalesce(sum(length(chunk)) OVER (PARTITION BY session ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM chunks
        ), joined AS (SELECT session, string_agg(chunk, '' ORDER BY line) AS t FROM sums WHERE before <= {BUDGET} GROUP BY 1),
        cut AS (SELECT session, CASE WHEN length(t) > {BUDGET} THEN left(t, {int(BUDGET * 0.3)}) || chr(10) || chr(10) || '[... truncated ...]' || chr(10) || chr(10)
            || right(t, {BUDGET - int(BUDGET * 0.3)}) ELSE t END AS t FROM joined)
        SELECT session, length(t)::INT AS n, sha256(t) AS digest FROM cut"""),
    "log_facts": (log_facts, f"""WITH {_LOGS} SELECT 's' || session AS session_id, count(*) AS line_count, count(*) FILTER (role = 'user') AS user_turns,
        array_to_string(list_sort(list(DISTINCT '/w' || conv_id % 4)), ',') AS cwds FROM logs GROUP BY 1"""),
    "run_files": (run_files, f"""WITH {_LOGS}, r AS (SELECT DISTINCT session AS s FROM logs)
        SELECT s AS run_id, CASE WHEN s % 4 = 0 THEN 'elsewhere' WHEN s % 2 = 0 THEN 'session' ELSE 'newest' END AS found_by, s::VARCHAR AS folder FROM r"""),
    "ledger_scan": (ledger_scan, f"WITH {X.STATE} SELECT task_id, stage, arm, status, retry_count, duration_s FROM state"),
    "turn_status": (turn_status, LEDGER["run_status"][1]),
    "ledger_stream": (ledger_stream, LEDGER["ledger_state"][1]),
    "ledger_compacted": (ledger_compacted, LEDGER["ledger_state"][1]),
    "ledger_reset": (ledger_reset, f"""WITH {X.STATE} SELECT * FROM state
        WHERE NOT coalesce(stage = 'run' AND arm = 'candidate' AND task_id % 2 = 0 OR task_id = 7 OR stage = 'finalize', false)"""),
}

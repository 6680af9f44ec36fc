"""Queries on the ledger of stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.operators import ledger as L
from duoscope.plans import fixtures as X
from duoscope.settings import ARMS


def state(spark, d) -> DataFrame:
    # A cell without arm has a NULL key, which equi joins drop; it travels as an empty text.
    writes = X.ledger_writes(spark, d).withColumn("arm", F.coalesce("arm", F.lit("")))
    return L.current_state(writes).withColumn("arm", F.nullif("arm", F.lit("")))


def cells(spark, d) -> DataFrame:
    tasks = X.table(spark, d, "events").select(F.col("user_id").alias("task_id")).distinct()
    return L.with_cells(L.scaffold(tasks, C.RETRY_STAGES, ARMS.names), state(spark, d))


def timing_stats(spark, d):
    out = L.timings(cells(spark, d))
    return out.select("stage", "arm", *[F.round(c, 4).alias(c) for c in ("min_s", "max_s", "mean_s", "total_s")], "n_runs")


def health_points(spark, d):
    violations = X.table(spark, d, "events").filter("value > 400").agg(F.count(F.lit(1)).alias("n_violations"))
    return L.health_points(cells(spark, d), violations)


def retry_plan(spark, d):
    split = L.retry_split(L.retryable(state(spark, d)))
    return L.retry_cascade(split.filter("action = 'retry'"), ARMS.names)


def retry_writes(spark, d):
    return L.retry_writes(retry_plan(spark, d), state(spark, d))


def retry_outcomes(spark, d):
    """The earlier ledger is all writes up to the middle one."""
    writes = X.ledger_writes(spark, d).withColumn("arm", F.coalesce("arm", F.lit("")))
    middle = writes.agg(F.expr("max(seq) div 2").alias("middle"))
    early = writes.crossJoin(middle).filter("seq <= middle").drop("middle")
    before = L.retryable(L.current_state(early).withColumn("arm", F.nullif("arm", F.lit(""))))
    return L.retry_outcomes(before, state(spark, d))


def run_status(spark, d):
    """Events of a user as turns: errors fail, purchases know the session, five turns are expected per arm."""
    turns = X.table(spark, d, "events").select(
        F.col("user_id").alias("task_id"), F.when(F.col("event_id") % 2 == 0, "baseline").otherwise("candidate").alias("arm"),
        (F.col("event_type") == "error").cast("int").alias("exit_code"), F.col("value").alias("duration_s"),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("s"), F.col("user_id"))).otherwise("").alias("session_id"), F.lit(30).alias("expected_turns"),
    )
    return L.run_status(turns).select("task_id", "arm", "n_turns", "n_errors", F.round("duration_s", 3).alias("duration_s"), "session_id", "status")


_CASCADE = """, plan AS (
  SELECT DISTINCT s.task_id, t.stage, t.stage_rank,
    CASE WHEN NOT t.armed THEN NULL WHEN s.arm IS NOT NULL AND t.stage <> 'prepare' THEN s.arm ELSE a.arm END AS arm
  FROM state s JOIN stages f ON f.stage = s.stage JOIN stages t ON t.stage_rank >= f.stage_rank
  JOIN (VALUES ('baseline', true), ('candidate', true), (NULL, false)) a(arm, armed) ON a.armed = t.armed
  WHERE s.status IN ('failed', 'partial', 'draft') AND coalesce(s.retry_count, 0) < 3
)"""

QUERIES = {
    "ledger_state": (state, f"WITH {X.STATE} SELECT * FROM state"),
    "stage_counts": (lambda s, d: L.stage_counts(cells(s, d)), f"""WITH {X.CELLS} SELECT stage, arm, count(*) FILTER (class = 'done') AS n_done, count(*) FILTER (class = 'partial') AS n_partial,
        count(*) FILTER (class = 'failed') AS n_failed, count(*) FILTER (class = 'pending') AS n_pending, count(*) AS n_total FROM cells GROUP BY 1, 2"""),
    "stage_gate": (lambda s, d: L.stage_gate(cells(s, d)), f"""WITH {X.CELLS} SELECT stage, count(*) FILTER (status = 'failed') AS n_failed, count(*) FILTER (status = 'partial') AS n_partial,
        count(*) FILTER (coalesce(status, '') IN ('', 'draft')) AS n_missing FROM cells GROUP BY 1"""),
    "bottleneck": (lambda s, d: L.bottleneck(cells(s, d)), f"""WITH {X.CELLS} SELECT stage, count(*) FILTER (class = 'failed') AS n_failed, count(*) FILTER (class IN ('partial', 'pending')) AS n_unfinished
        FROM cells GROUP BY stage, stage_rank ORDER BY 2 DESC, 3 DESC, stage_rank LIMIT 1"""),
    "timing_stats": (timing_stats, f"""WITH {X.CELLS} SELECT stage, arm, round(min(duration_s), 4) AS min_s, round(max(duration_s), 4) AS max_s, round(avg(duration_s), 4) AS mean_s,
        round(sum(duration_s), 4) AS total_s, count(*) AS n_runs FROM cells WHERE stage IN ('run', 'score') AND duration_s > 0 GROUP BY 1, 2"""),
    "slowest_run": (lambda s, d: L.slowest(cells(s, d)), f"WITH {X.CELLS} SELECT task_id, arm, duration_s FROM cells WHERE stage = 'run' AND duration_s > 0 ORDER BY duration_s DESC, task_id, arm DESC LIMIT 1"),
    "task_pivot": (lambda s, d: L.task_pivot(cells(s, d), C.RETRY_STAGES, ARMS.names), f"WITH {X.CELLS} SELECT task_id, " + ", ".join(
        f"max({v}) FILTER (stage = '{s}' AND {f"arm = '{a}'" if a else 'arm IS NULL'}) AS {s}{'_' + a if a else ''}{e}"
        for s in C.RETRY_STAGES for a in (ARMS.names if s in C.ARM_STAGES else [""]) for v, e in (("class", ""), ("duration_s", "_s"))) + " FROM cells GROUP BY 1"),
    "delivery_progress": (lambda s, d: L.delivery_progress(cells(s, d)), f"""WITH {X.CELLS}, t AS (SELECT task_id, bool_and(class = 'done') AS done FROM cells GROUP BY 1)
        SELECT count(*) FILTER (done) AS n_done, count(*) AS n_tasks, round(count(*) FILTER (done) * 100.0 / greatest(count(*), 1), 1)::DOUBLE AS pct FROM t"""),
    "blockers": (lambda s, d: L.blockers(cells(s, d)), f"""WITH {X.CELLS} SELECT task_id, stage, arm, CASE WHEN status = 'permanently_failed' THEN status ELSE 'stuck' END AS kind, retry_count
        FROM cells WHERE status = 'permanently_failed' OR (status IN ('failed', 'partial') AND retry_count >= 2)"""),
    "health_points": (health_points, f"""WITH {X.CELLS}, n AS (SELECT count(*) FILTER (status = 'permanently_failed') AS n_permanently_failed, count(*) FILTER (status = 'failed') AS n_failed,
        count(*) FILTER (status = 'partial') AS n_partial, count(*) FILTER (status IN ('failed', 'partial') AND retry_count >= 2) AS n_stuck, count(*) FILTER (status IS NULL) AS n_missing,
        (SELECT count(*) FROM events WHERE value > 400) AS n_violations FROM cells), p AS (SELECT *, (10 * n_permanently_failed + 3 * n_failed + n_partial + 2 * n_stuck + 5 * n_violations + 4 * n_missing)::BIGINT AS points FROM n)
        SELECT *, CASE WHEN n_permanently_failed > 0 OR points >= 15 THEN 'CRITICAL' WHEN points >= 1 THEN 'WARNING' ELSE 'HEALTHY' END AS verdict FROM p"""),
    "stage_health": (lambda s, d: L.stage_health(L.stage_counts(cells(s, d))), f"""WITH {X.CELLS}, n AS (SELECT stage, arm, count(*) FILTER (class = 'done') AS n_done, count(*) FILTER (class = 'failed') AS n_failed, count(*) AS n_total FROM cells GROUP BY 1, 2)
        SELECT stage, arm, CASE WHEN n_failed > 0 THEN 'critical' WHEN n_done < n_total THEN 'degraded' ELSE 'healthy' END AS health, n_done, n_total FROM n"""),
    "run_status": (run_status, """WITH t AS (SELECT user_id AS task_id, CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'candidate' END AS arm, count(*) AS n_turns, count(*) FILTER (event_type = 'error') AS n_errors,
        round(sum(value), 3) AS duration_s, max(CASE WHEN event_type = 'purchase' THEN 's' || user_id END) AS session_id FROM events GROUP BY 1, 2)
        SELECT *, CASE WHEN n_errors = n_turns OR session_id IS NULL THEN 'failed' WHEN n_errors > 0 OR n_turns < 30 THEN 'partial' ELSE 'done' END AS status FROM t"""),
    "retryable": (lambda s, d: L.retry_split(L.retryable(state(s, d))), f"""WITH {X.STATE} SELECT *, CASE WHEN coalesce(retry_count, 0) >= 3 THEN 'permanently_failed' ELSE 'retry' END AS action FROM state WHERE status IN ('failed', 'partial', 'draft')"""),
    "retry_plan": (retry_plan, f"WITH {X.CELLS}{_CASCADE} SELECT * FROM plan"),
    "retry_writes": (retry_writes, f"""WITH {X.CELLS}{_CASCADE} SELECT p.task_id, p.stage, p.arm, 'pending' AS status, (coalesce(s.retry_count, 0) + 1)::INT AS retry_count, coalesce(s.seq, -1) + 1 AS seq
        FROM plan p LEFT JOIN state s ON s.task_id = p.task_id AND s.stage = p.stage AND s.arm IS NOT DISTINCT FROM p.arm"""),
    "retry_outcomes": (retry_outcomes, f"""WITH {X.STATE}, early AS (SELECT *, coalesce(max(seq) FILTER (deleted) OVER (PARTITION BY task_id, stage, arm), -1) AS gone FROM coded WHERE seq <= (SELECT max(seq) // 2 FROM coded)),
        before AS (SELECT task_id, stage, arm, arg_max(status, seq) FILTER (status IS NOT NULL) AS status FROM early WHERE NOT deleted AND seq > gone GROUP BY 1, 2, 3)
        SELECT CASE WHEN s.status = 'done' THEN 'succeeded' WHEN s.status = 'permanently_failed' THEN 'permanently_failed' WHEN s.status IN ('failed', 'partial', 'draft') THEN 'still_failed' ELSE 'remaining' END AS outcome, count(*) AS n
        FROM before b LEFT JOIN state s ON s.task_id = b.task_id AND s.stage = b.stage AND s.arm IS NOT DISTINCT FROM b.arm WHERE b.status IN ('failed', 'partial', 'draft') GROUP BY 1"""),
}
# Its name of the time when a query over a part of the writes stood beside it.
QUERIES["retry_outcomes_all"] = QUERIES["retry_outcomes"]

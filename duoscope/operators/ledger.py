"""The stage ledger: appended writes to current state, roll-ups and retry plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope import constants as C

CELL = ("task_id", "stage", "arm")


def partial_state(writes: DataFrame, keys: Sequence[str] = CELL, seq: str = "seq") -> DataFrame:
    """What has to be known of each cell's writes so far: one row per cell, in one aggregation.

    ``gone`` is the last deletion, ``last`` the last other write, ``put``, ``tries`` and ``took`` the last known
    status, retry count and duration, each with its number. All are maxima, so writes are combined before the shuffle
    however many a cell has, and partial states of any subsets, late or repeated, add up (:func:`merged_state`).
    """
    s, live = F.col(seq), ~F.coalesce("deleted", F.lit(False))

    def latest(value: str) -> Column:
        return F.max(F.when(live & F.col(value).isNotNull(), F.struct(s.alias("seq"), F.col(value).alias("value"))))

    return writes.groupBy(*keys).agg(
        F.max(F.when(~live, s)).alias("gone"), F.max(F.when(live, s)).alias("last"),
        latest("status").alias("put"), latest("retry_count").alias("tries"), latest("duration_s").alias("took"),
    )


def merged_state(partials: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """Partial states of the same cells as one each."""
    return partials.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("gone", "last", "put", "tries", "took")])


def final_state(partials: DataFrame, keys: Sequence[str] = CELL, seq: str = "seq") -> DataFrame:
    """Current cells of partial states: what lies before the last deletion is gone, and a duration from before the status."""
    since = lambda c: F.col(f"{c}.seq") > F.coalesce("gone", F.lit(-1))
    put = F.when(since("put"), F.col("put.seq"))
    return partials.filter(F.col("last") > F.coalesce("gone", F.lit(-1))).select(
        *keys, F.when(since("put"), F.col("put.value")).alias("status"), F.when(since("tries"), F.col("tries.value")).alias("retry_count"),
        F.when(since("took") & (F.col("took.seq") >= F.coalesce(put, F.lit(-1))), F.col("took.value")).alias("duration_s"),
        F.col("last").alias(seq),
    )


def current_state(writes: DataFrame, keys: Sequence[str] = CELL, seq: str = "seq") -> DataFrame:
    """Latest state per cell from appended writes.

    Columns: keys, ``seq`` (unique per cell), ``status`` (NULL: a write that only
    merges), ``retry_count``, ``duration_s``, ``deleted``. A write with a status replaces the cell but carries
    the retry count; one without merges; a deletion empties the cell. One aggregation, so a
    cell with very many writes is combined before the shuffle.
    """
    return final_state(partial_state(writes, keys, seq), keys, seq)


def reset_writes(state: DataFrame, selection: DataFrame, seq: str = "seq") -> DataFrame:
    """Deletions for the cells of a selection: ``task_id, stage, arm``, where a null matches every task, stage or arm.

    ``state`` are the current cells; the deletions are numbered after them. Only cells there are can be reset.
    """
    exact = [c for c in CELL]
    cells = state.select(*CELL, seq)
    found = None
    # One equi join per combination of named columns, of which there are eight.
    for mask in range(1 << len(exact)):
        named = [c for i, c in enumerate(exact) if mask >> i & 1]
        wanted = selection
        for c in exact:
            wanted = wanted.filter(F.col(c).isNotNull() if c in named else F.col(c).isNull())
        wanted = wanted.select(*[F.col(c).alias(f"_{c}") for c in named], F.lit(True).alias("_all")).distinct()
        same = F.lit(True)
        for c in named:
            same = same & (F.col(c) == F.col(f"_{c}"))
        part = cells.join(wanted, same, "left_semi") if named else cells.filter(F.lit(not wanted.isEmpty()))
        found = part if found is None else found.union(part)
    return found.distinct().select(
        *CELL, (F.col(seq) + 1).alias(seq), F.lit(None).cast("string").alias("status"), F.lit(None).cast("int").alias("retry_count"),
        F.lit(None).cast("double").alias("duration_s"), F.lit(True).alias("deleted"),
    )


def status_class(status: Column) -> Column:
    """done, partial or failed; every other status is pending."""
    return F.when(status.isin("done", "partial", "failed"), status).otherwise("pending")


def scaffold(tasks: DataFrame, stages: Sequence[str], arms: Sequence[str] = (), arm_stages: Sequence[str] = C.ARM_STAGES) -> DataFrame:
    """Every (task, stage, arm) cell there should be; arm is NULL in stages without arms."""
    cells = [
        F.struct(F.lit(s).alias("stage"), F.lit(a).cast("string").alias("arm"), F.lit(i).alias("stage_rank"))
        for i, s in enumerate(stages) for a in (arms if s in arm_stages and arms else [None])
    ]
    return tasks.select("task_id", F.explode(F.array(*cells)).alias("_c")).select("task_id", "_c.*")


def with_cells(cells: DataFrame, state: DataFrame) -> DataFrame:
    """Left join of the scaffold with the current state; ``class`` of a missing cell is pending."""
    state = state.withColumnsRenamed({"task_id": "_t", "stage": "_s", "arm": "_a"})
    same = (F.col("task_id") == F.col("_t")) & (F.col("stage") == F.col("_s")) & F.col("arm").eqNullSafe(F.col("_a"))
    joined = cells.join(state, same, "left").drop("_t", "_s", "_a")
    return joined.withColumn("class", status_class(F.col("status")))


def stage_counts(cells: DataFrame) -> DataFrame:
    """done, partial, failed, pending and total per stage and arm."""
    return cells.groupBy("stage", "arm").agg(
        *[F.count_if(F.col("class") == c).alias(f"n_{c}") for c in ("done", "partial", "failed", "pending")],
        F.count(F.lit(1)).alias("n_total"),
    )


def stage_gate(cells: DataFrame) -> DataFrame:
    """failed, partial and missing per stage; no status, an empty one and drafts are missing."""
    missing = F.coalesce(F.col("status"), F.lit("")).isin("", "draft")
    return cells.groupBy("stage").agg(
        F.count_if(F.col("status") == "failed").alias("n_failed"),
        F.count_if(F.col("status") == "partial").alias("n_partial"),
        F.count_if(missing).alias("n_missing"),
    )


def bottleneck(cells: DataFrame) -> DataFrame:
    """The stage with most failures, then most partial and pending cells, then the earliest; none without either."""
    per = cells.groupBy("stage", "stage_rank").agg(
        F.count_if(F.col("class") == "failed").alias("n_failed"),
        F.count_if(F.col("class").isin("partial", "pending")).alias("n_unfinished"),
    )
    best = F.max(F.struct("n_failed", "n_unfinished", (-F.col("stage_rank")).alias("r"), "stage")).alias("b")
    return per.agg(best).select("b.stage", "b.n_failed", "b.n_unfinished").filter("n_failed + n_unfinished > 0")


def timings(cells: DataFrame, stages: Sequence[str] = ("run", "score")) -> DataFrame:
    """min, max, mean, total and count of positive durations per stage and arm."""
    d = F.col("duration_s")
    return cells.filter(F.col("stage").isin(*stages) & (d > 0)).groupBy("stage", "arm").agg(
        F.min(d).alias("min_s"), F.max(d).alias("max_s"), F.avg(d).alias("mean_s"), F.sum(d).alias("total_s"),
        F.count(F.lit(1)).alias("n_runs"),
    )


def slowest(cells: DataFrame, stage: str = "run") -> DataFrame:
    """The cell with the longest duration; of equal ones the first task."""
    longest = F.max(F.struct("duration_s", (-F.col("task_id")).alias("t"), "arm")).alias("x")
    return cells.filter((F.col("stage") == stage) & (F.col("duration_s") > 0)).agg(longest).filter("x IS NOT NULL").select(
        (-F.col("x.t")).alias("task_id"), "x.arm", "x.duration_s"
    )


def task_pivot(cells: DataFrame, stages: Sequence[str], arms: Sequence[str], armed: Sequence[str] = C.ARM_STAGES) -> DataFrame:
    """One row per task: class and duration per stage, and per arm where the stage has arms; one aggregation.

    Columns are ``<stage>[_<arm>]`` and ``<stage>[_<arm>]_s`` (seconds; null where unknown).
    """
    out = []
    for stage in stages:
        for arm in arms if stage in armed else [None]:
            mine = (F.col("stage") == stage) & (F.col("arm") == arm if arm else F.col("arm").isNull())
            name = f"{stage}_{arm}" if arm else stage
            out += [F.max(F.when(mine, F.col("class"))).alias(name), F.max(F.when(mine, F.col("duration_s"))).alias(f"{name}_s")]
    return cells.groupBy("task_id").agg(*out)


def delivery_progress(cells: DataFrame) -> DataFrame:
    """Tasks with every cell done, of all tasks, in percent with one decimal."""
    per_task = cells.groupBy("task_id").agg(F.bool_and(F.col("class") == "done").alias("done"))
    return per_task.agg(
        F.count_if("done").alias("n_done"), F.count(F.lit(1)).alias("n_tasks"),
        F.round(F.count_if("done") * 100.0 / F.greatest(F.count(F.lit(1)), F.lit(1)), 1).alias("pct"),
    )


def blockers(cells: DataFrame, stuck_after: int = C.STUCK_RETRIES) -> DataFrame:
    """Cells that failed for good, and failed or partial ones tried at least ``stuck_after`` times."""
    kind = F.when(F.col("status") == "permanently_failed", "permanently_failed").when(
        F.col("status").isin("failed", "partial") & (F.col("retry_count") >= stuck_after), "stuck"
    )
    return cells.withColumn("kind", kind).filter("kind IS NOT NULL").select("task_id", "stage", "arm", "kind", "retry_count")


def health_points(cells: DataFrame, n_violations: DataFrame, weights: dict[str, int] = C.HEALTH_POINTS, stuck_after: int = C.STUCK_RETRIES) -> DataFrame:
    """Weighted points and verdict of a delivery. ``n_violations`` is one row with that column."""
    status = F.col("status")
    counts = cells.agg(
        F.count_if(status == "permanently_failed").alias("n_permanently_failed"),
        F.count_if(status == "failed").alias("n_failed"),
        F.count_if(status == "partial").alias("n_partial"),
        F.count_if(status.isin("failed", "partial") & (F.col("retry_count") >= stuck_after)).alias("n_stuck"),
        F.count_if(status.isNull()).alias("n_missing"),
    ).join(F.broadcast(n_violations.select("n_violations")))  # one row each
    points = sum((F.col(f"n_{k}") * w for k, w in weights.items()), F.lit(0))
    critical = (F.col("n_permanently_failed") > 0) | (F.col("points") >= C.HEALTH_CRITICAL_POINTS)
    return counts.withColumn("points", points.cast("bigint")).withColumn(
        "verdict", F.when(critical, "CRITICAL").when(F.col("points") > 0, "WARNING").otherwise("HEALTHY")
    )


def stage_health(counts: DataFrame) -> DataFrame:
    """Status per stage and arm from its counts: critical with failures, degraded when unfinished, else healthy."""
    status = F.when(F.col("n_failed") > 0, "critical").when(F.col("n_done") < F.col("n_total"), "degraded").otherwise("healthy")
    return counts.select("stage", "arm", status.alias("health"), "n_done", "n_total")


def task_health(cells: DataFrame, stuck_after: int = C.STUCK_RETRIES) -> DataFrame:
    """Health per task: critical with cells that failed for good, degraded with failed, stuck or unfinished ones, else healthy."""
    status = F.col("status")
    counts = cells.groupBy("task_id").agg(
        F.count_if(status == "permanently_failed").alias("n_permanently_failed"),
        *[F.count_if(F.col("class") == c).alias(f"n_{c}") for c in ("failed", "partial", "pending", "done")],
        F.count_if(status.isin("failed", "partial") & (F.col("retry_count") >= stuck_after)).alias("n_stuck"), F.count(F.lit(1)).alias("n_total"),
    )
    health = F.when(F.col("n_permanently_failed") > 0, "critical").when(F.col("n_done") < F.col("n_total"), "degraded").otherwise("healthy")
    return counts.withColumn("health", health)


def overall_health(cells: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: critical when any cell failed for good, degraded when there are issue rows, else healthy; with the counts."""
    failed = cells.agg(F.count_if(F.col("status") == "permanently_failed").alias("n_permanently_failed"), F.count_distinct("task_id").alias("n_tasks"))
    found = issues.agg(F.count(F.lit(1)).alias("n_issues"))
    health = F.when(F.col("n_permanently_failed") > 0, "critical").when(F.col("n_issues") > 0, "degraded").otherwise("healthy")
    return failed.join(F.broadcast(found)).withColumn("health", health)  # one row each


def run_status(turns: DataFrame, expected: str = "expected_turns") -> DataFrame:
    """Status of a run from its turns: ``task_id, arm, exit_code, duration_s, session_id`` and the expected number.

    failed when all turns failed or no session is known, partial when some failed or are missing, else done.
    """
    facts = turns.groupBy("task_id", "arm").agg(
        F.count(F.lit(1)).alias("n_turns"), F.count_if(F.col("exit_code") != 0).alias("n_errors"),
        F.max(expected).alias("n_expected"), F.sum("duration_s").alias("duration_s"),
        F.max(F.when(F.col("session_id") != "", F.col("session_id"))).alias("session_id"),
    )
    n, bad = F.col("n_turns"), F.col("n_errors")
    status = F.when((bad == n) | F.col("session_id").isNull(), "failed").when((bad > 0) | (n < F.col("n_expected")), "partial").otherwise("done")
    return facts.withColumn("status", status)


def retryable(state: DataFrame, stages: Sequence[str] = C.RETRY_STAGES) -> DataFrame:
    """Cells whose status asks for a retry."""
    return state.filter(F.col("status").isin(*C.RETRYABLE_STATUSES) & F.col("stage").isin(*stages))


def retry_split(cells: DataFrame, max_retries: int = 3) -> DataFrame:
    """Add ``action``: ``permanently_failed`` from ``max_retries`` tries on, else ``retry``."""
    tries = F.coalesce("retry_count", F.lit(0))
    return cells.withColumn("action", F.when(tries >= max_retries, "permanently_failed").otherwise("retry"))


def retry_cascade(cells: DataFrame, arms: Sequence[str], stages: Sequence[str] = C.RETRY_STAGES) -> DataFrame:
    """Distinct (task, stage, arm) to redo, with ``stage_rank`` for the order of work.

    A cell brings all later stages. Its arm is carried where the later stage has arms; a cell without
    arm brings both. What a stage brings is an array made from literals, so nothing is joined.
    """
    def target(stage: str, arm: Column) -> Column:
        return F.struct(F.lit(stage).alias("stage"), arm.cast("string").alias("arm"), F.lit(stages.index(stage)).alias("stage_rank"))

    chain = None
    for s in stages:
        parts = [F.array(target(s, F.col("arm")))]
        for d in C.DOWNSTREAM[s]:
            if d not in C.ARM_STAGES:
                parts.append(F.array(target(d, F.lit(None))))
            elif s in C.ARM_STAGES:
                both = F.array(*[target(d, F.lit(a)) for a in arms])
                parts.append(F.when(F.col("arm").isNull(), both).otherwise(F.array(target(d, F.col("arm")))))
            else:
                parts.append(F.array(*[target(d, F.lit(a)) for a in arms]))
        all_ = F.concat(*parts)
        chain = F.when(F.col("stage") == s, all_) if chain is None else chain.when(F.col("stage") == s, all_)
    return cells.select("task_id", F.explode(chain).alias("_t")).select("task_id", "_t.*").distinct()


def retry_writes(plan: DataFrame, state: DataFrame, seq: str = "seq") -> DataFrame:
    """Ledger writes of a retry: pending, with the old count plus one, after all that is there."""
    old = state.select(F.col("task_id").alias("_t"), F.col("stage").alias("_s"), F.col("arm").alias("_a"), "retry_count", seq)
    same = (F.col("task_id") == F.col("_t")) & (F.col("stage") == F.col("_s")) & F.col("arm").eqNullSafe(F.col("_a"))
    return plan.join(old, same, "left").select(
        "task_id", "stage", "arm", F.lit("pending").alias("status"),
        (F.coalesce("retry_count", F.lit(0)) + 1).alias("retry_count"),
        (F.coalesce(seq, F.lit(-1)) + 1).alias(seq),
    )


def retry_outcomes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What became of retried cells: succeeded, still failed, permanently failed, remaining."""
    new = after.select(F.col("task_id").alias("_t"), F.col("stage").alias("_s"), F.col("arm").alias("_a"), F.col("status").alias("_status"))
    same = (F.col("task_id") == F.col("_t")) & (F.col("stage") == F.col("_s")) & F.col("arm").eqNullSafe(F.col("_a"))
    outcome = (
        F.when(F.col("_status") == "done", "succeeded").when(F.col("_status") == "permanently_failed", "permanently_failed")
        .when(F.col("_status").isin(*C.RETRYABLE_STATUSES), "still_failed").otherwise("remaining")
    )
    return before.join(new, same, "left").groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))

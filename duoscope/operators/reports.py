"""Reports: one public function each, built from the other operators; and the exported document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.operators import ledger as L
from duoscope.operators import pairs, rubrics, rules
from duoscope.settings import ARMS, LIMITS, THRESHOLDS, Arms, Limits, Thresholds


def task_records(criteria: DataFrame, thresholds: Thresholds = THRESHOLDS, limits: Limits = LIMITS, arms: Arms = ARMS) -> DataFrame:
    """One row per task from rubric rows: both pass rates, broken rules, flags, and both rubrics' reasons."""
    verdicts = rubrics.rubric_verdict(rubrics.rubric_facts(criteria.drop("description")), limits, check_names=True)
    both = pairs.pair_arms(verdicts, ["passrate", "reason"], arms=arms)
    return pairs.with_verdict(both, thresholds)


def finalize_report(criteria: DataFrame, dimensions: DataFrame | None = None, **options) -> DataFrame:
    """The finalized delivery: every task's record with its status, and its dimensions where they are given (by ``task_id``)."""
    records = task_records(criteria, **options)
    done = rules.finalize(records.drop("baseline_reason", "candidate_reason"), records.select("task_id", "baseline_reason", "candidate_reason"))
    return done if dimensions is None else done.join(dimensions, "task_id", "left")


def validate_report(
    criteria: DataFrame, published: DataFrame, sessions: DataFrame | None = None, vocabulary: DataFrame | None = None,
    label: str = "label", deep: bool = False, **options,
) -> DataFrame:
    """Issue rows ``task_id, rule`` of a delivery.

    Rubrics without a verdict, broken acceptance rules, pass rates that differ from the published ones; labels outside the
    vocabulary; unequal sessions of both arms (``sessions``: ``task_id, arm, first_user_query, user_turns`` and perhaps
    ``commit_hash, n_followups``). ``deep`` adds invalid names, contradicting rationales and differences between the arms' criteria.
    """
    records = task_records(criteria, **options)
    parts = [
        records.select("task_id", F.explode(F.array_distinct(F.array_compact(F.array("baseline_reason", "candidate_reason")))).alias("rule")),
        pairs.violation_rows(records),
        rules.reconcile(records.select("task_id", "candidate_passrate"), published, "candidate_passrate").select("task_id", "rule"),
    ]
    if vocabulary is not None:
        parts.append(rules.unknown_labels(published, vocabulary, label).select("task_id", F.lit("unknown_label").alias("rule")))
    if sessions is not None:
        facts = [c for c in ("first_user_query", "user_turns", "commit_hash", "n_followups") if c in sessions.columns]
        parity = pairs.session_parity(pairs.pair_arms(sessions, facts))
        flags = [c for c in ("query_differs", "turns_unbalanced", "commit_differs", "followups_differ") if c in parity.columns]
        parts.append(parity.select("task_id", F.explode(F.array_compact(F.array(*[F.when(F.col(c), c) for c in flags]))).alias("rule")))
    if deep:
        parts += [
            rubrics.invalid_names(criteria).select("task_id", F.lit("invalid_criterion_name").alias("rule")),
            rubrics.contradictions(criteria).select("task_id", F.lit("contradiction").alias("rule")),
            pairs.criterion_differences(pairs.pair_criteria(criteria)).select("task_id", "rule"),
        ]
    return rules.all_issues(parts)


def stats_report(cells: DataFrame, records: DataFrame, fields: Sequence[str], arms: Arms = ARMS) -> dict[str, DataFrame]:
    """The tables of the statistics report by name."""
    return {
        "stages": L.stage_counts(cells), "tasks": L.task_pivot(cells, C.RETRY_STAGES, arms.names), "bottleneck": L.bottleneck(cells),
        "timings": L.timings(cells), "slowest": L.slowest(cells), "groups": rules.arm_stats(records, fields, arms),
        "difference": pairs.paired_difference(records),
    }


def health_report(cells: DataFrame, n_violations: DataFrame, stuck_after: int = C.STUCK_RETRIES) -> dict[str, DataFrame]:
    """The tables of the health report by name; ``stages`` and ``tasks`` have a health of their own."""
    return {
        "delivery": L.health_points(cells, n_violations, stuck_after=stuck_after), "progress": L.delivery_progress(cells),
        "stages": L.stage_health(L.stage_counts(cells)), "tasks": L.task_health(cells, stuck_after), "blockers": L.blockers(cells, stuck_after),
    }


def document_lines(info: dict[str, str | None], entries: DataFrame, summary: DataFrame, key: str = "task_id") -> DataFrame:
    """The exported document as lines ``section, key, line``: its head, one task to a line, and its end.

    ``entries`` has a row per task with unique, non-null keys, whose columns become the task's object (null ones are kept);
    ``summary`` is one row. Nothing is gathered: only the first key and the number of tasks, one row, meet the lines.
    """
    options = {"ignoreNullFields": "false"}
    first = entries.agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("task_count"))
    tasks = entries.join(F.broadcast(first.select("_first"))).select(  # one row
        F.lit(1).alias("section"), F.col(key).alias("key"),
        F.concat(F.when(F.col(key) == F.col("_first"), "").otherwise(","), F.to_json(F.struct(*entries.columns), options)).alias("line"),
    )
    kind = dict(tasks.dtypes)["key"]
    head_fields = [F.lit(v).cast("string").alias(k) for k, v in info.items()]
    head = first.select(
        F.lit(0).alias("section"), F.lit(None).cast(kind).alias("key"),
        F.concat(F.lit('{"batch_info": '), F.to_json(F.struct(*head_fields, "task_count"), options), F.lit(', "tasks": [')).alias("line"),
    )
    end = summary.select(
        F.lit(2).alias("section"), F.lit(None).cast(kind).alias("key"),
        F.concat(F.lit('], "summary": '), F.to_json(F.struct(*summary.columns), options), F.lit("}")).alias("line"),
    )
    return head.union(tasks).union(end)


def write_document(lines: DataFrame, path: str) -> None:
    """Write the document's lines in order: its part files, one after the other, are one JSON document."""
    lines.repartitionByRange("section", "key").sortWithinPartitions("section", "key").select("line").write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The parts of a written document as one VARIANT column ``v`` each: ``batch_info``, ``tasks`` (a row each), ``summary``."""
    lines = spark.read.text(path)
    head, end = '{"batch_info": ', '], "summary": '
    body = lambda mark, tail: F.substring("value", len(mark) + 1, 1 << 30).substr(F.lit(1), F.length("value") - len(mark) - len(tail))
    is_head, is_end = F.startswith("value", F.lit(head)), F.startswith("value", F.lit(end))
    return {
        "batch_info": lines.filter(is_head).select(F.parse_json(body(head, ', "tasks": [')).alias("v")),
        "tasks": lines.filter(~is_head & ~is_end).select(F.parse_json(F.ltrim("value", F.lit(","))).alias("v")),
        "summary": lines.filter(is_end).select(F.parse_json(body(end, "}")).alias("v")),
    }

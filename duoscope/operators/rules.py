"""Reconciliation, issue rows, record statistics and the final status of tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.functions import names
from duoscope.settings import ARMS, Arms

#: Largest difference between a published and a computed pass rate.
TOLERANCE = 1e-4
#: Reasons for which a task counts as failed, not just partial.
FAILING = ("missing", "unscored", "incomplete")


def reconcile(computed: DataFrame, published: DataFrame, value: str, key: str = "task_id", tolerance: float = TOLERANCE) -> DataFrame:
    """One row ``key, rule`` per task whose published value does not agree with the computed one."""
    joined = computed.join(published.select(key, "published", F.lit(True).alias("_there")), key, "left")
    number = F.expr("try_cast(published AS double)")
    c = F.col(value)
    rule = (
        F.when(F.col("_there").isNull(), "not_published")
        .when(F.col("published").isNull() & c.isNull(), None)
        .when(F.col("published").isNull(), "passrate_missing")
        .when(number.isNull(), "passrate_unreadable")
        .when(c.isNull(), "passrate_not_computed")
        .when(F.abs(number - c) > tolerance, "passrate_differs")
    )
    return joined.select(key, rule.alias("rule")).filter("rule IS NOT NULL")


def unknown_labels(rows: DataFrame, vocabulary: DataFrame, label: str, key: str = "task_id") -> DataFrame:
    """Rows whose label is not in the vocabulary; an empty label is allowed."""
    return rows.filter(F.col(label) != "").join(vocabulary, label, "left_anti").select(key, label)


def all_issues(parts: Sequence[DataFrame]) -> DataFrame:
    """Issue rows of several checks, one below the other."""
    return reduce(lambda a, b: a.union(b), parts)


def mean4(value: str):
    """Mean of 4-decimal values, rounded half up to 4 decimals in whole numbers, so that no sum's order matters."""
    units = F.round(F.col(value) * 10000).cast("bigint")
    total, n = F.sum(units), F.count(units)
    return F.floor((2 * total + n) / (2 * n)) / 10000


def group_stats(records: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Statistics by each field for itself, in one aggregation over grouping sets."""
    sets = [[F.col(f)] for f in fields]
    grouped = records.groupingSets(sets, *fields).agg(
        F.count(F.lit(1)).alias("n_tasks"),
        *[F.grouping(f).alias(f"_{f}") for f in fields],
        mean4("baseline_passrate").alias("baseline_mean"), mean4("candidate_passrate").alias("candidate_mean"),
        F.min("candidate_passrate").alias("candidate_min"), F.max("candidate_passrate").alias("candidate_max"),
        F.count_if("threshold_ok").alias("n_threshold_ok"),
    )
    name = value = None
    for f in fields:
        mine = F.col(f"_{f}") == 0
        name = F.when(mine, f) if name is None else name.when(mine, f)
        value = F.when(mine, F.col(f)) if value is None else value.when(mine, F.col(f))
    return grouped.select(
        name.alias("field"), F.coalesce(value, F.lit("")).alias("value"), "n_tasks", "baseline_mean", "candidate_mean",
        "candidate_min", "candidate_max", "n_threshold_ok",
    )


def arm_stats(records: DataFrame, fields: Sequence[str], arms: Arms = ARMS, digits: int = 6) -> DataFrame:
    """Six statistics of both arms' pass rates by each field for itself, in one aggregation over grouping sets.

    ``n_tasks`` counts all tasks of a group, ``<arm>_count`` those with a pass rate; the deviation of one value is 0, the statistics of
    none are null. Pass rates have four decimals, so the exact median keeps at most 10 001 values per group.
    """
    stats = []
    for arm in ("baseline", "candidate"):
        v = F.round(f"{arm}_passrate", 4)
        deviation = F.when(F.count(v) > 1, F.stddev_samp(v)).when(F.count(v) == 1, 0.0)
        stats += [
            F.min(v).alias(f"{arm}_min"), F.max(v).alias(f"{arm}_max"), F.round(F.avg(v), digits).alias(f"{arm}_mean"),
            F.round(F.median(v), digits).alias(f"{arm}_median"), F.round(deviation, digits).alias(f"{arm}_std"), F.count(v).alias(f"{arm}_count"),
        ]
    grouped = records.groupingSets([[F.col(f)] for f in fields], *fields).agg(
        F.count(F.lit(1)).alias("n_tasks"), *[F.grouping(f).alias(f"_{f}") for f in fields], *stats
    )
    name = value = None
    for f in fields:
        mine = F.col(f"_{f}") == 0
        name = F.when(mine, f) if name is None else name.when(mine, f)
        value = F.when(mine, F.col(f).cast("string")) if value is None else value.when(mine, F.col(f).cast("string"))
    own = [f"{arm}_{s}" for arm in ("baseline", "candidate") for s in ("min", "max", "mean", "median", "std", "count")]
    return grouped.select(name.alias("field"), F.coalesce(value, F.lit("")).alias("value"), "n_tasks", *own)


def reconcile_arms(facts: DataFrame, published: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row ``task_id, arm, rule`` per thing that a published row says otherwise than the delivery.

    ``facts`` has ``task_id`` (the public id), ``arm, session_file, session_id, passrate`` of what was delivered; ``published`` the same keys
    and ``trajectory, session_id, score_path, passrate`` as published texts. A published path may be the delivered file or
    its regular name, if any; the score path its regular or its older name.
    """
    p = published.select("task_id", "arm", *[F.col(c).alias(f"_{c}") for c in ("trajectory", "session_id", "score_path", "passrate")], F.lit(True).alias("_there"))
    joined = facts.join(p, ["task_id", "arm"], "left")
    said = lambda c: F.coalesce(F.col(f"_{c}"), F.lit(""))
    task, arm = F.col("task_id"), F.col("arm")
    number = F.expr("try_cast(_passrate AS double)")
    rules = {
        "not_published": F.col("_there").isNull(),
        "session_path_differs": F.col("_there") & (said("trajectory") != "") & (said("trajectory") != F.coalesce("session_file", F.lit(""))) & (said("trajectory") != names.session_path(task, arm)),
        "session_differs": F.col("_there") & (said("session_id") != F.coalesce("session_id", F.lit(""))),
        "score_path_differs": F.col("_there") & (said("score_path") != names.score_path(task, arm)) & (said("score_path") != names.legacy_score_path(task, arm)),
        "passrate_unreadable": F.col("_there") & (said("passrate") != "") & number.isNull() & F.col("passrate").isNotNull(),
        "passrate_differs": F.col("_there") & (F.abs(number - F.round("passrate", 4)) > tolerance),
    }
    found = F.array_compact(F.array(*[F.when(c, n) for n, c in rules.items()]))
    return joined.select("task_id", "arm", F.explode(found).alias("rule"))


def batch_summary(records: DataFrame) -> DataFrame:
    """One row: tasks, passed tasks and the range of both arms' pass rates."""
    stats = [
        s for arm in ("baseline", "candidate") for c in [F.col(f"{arm}_passrate")]
        for s in (F.min(c).alias(f"{arm}_min"), F.max(c).alias(f"{arm}_max"), mean4(f"{arm}_passrate").alias(f"{arm}_mean"), F.count(c).alias(f"{arm}_count"))
    ]
    return records.agg(
        F.count(F.lit(1)).alias("n_tasks"), F.count_if("export_ok").alias("n_passed"), F.count_if("threshold_ok").alias("n_threshold_ok"), *stats
    )


def finalize(records: DataFrame, reasons: DataFrame, key: str = "task_id") -> DataFrame:
    """Add ``status``: failed by a rubric's reason, partial without both pass rates inside the limits, else done.

    ``reasons`` has ``baseline_reason`` and ``candidate_reason``; records without a row there have none.
    """
    bad = F.coalesce(F.col("baseline_reason").isin(*FAILING), F.lit(False)) | F.coalesce(F.col("candidate_reason").isin(*FAILING), F.lit(False))
    status = F.when(bad, "failed").when(~F.col("threshold_ok"), "partial").otherwise("done")
    return records.join(reasons, key, "left").withColumn("status", status)


def with_context(tasks: DataFrame, sources: Sequence[DataFrame], fields: Sequence[str], default: str = "unknown", key: str = "task_id") -> DataFrame:
    """Each field from the first source that has a non-empty value, else the default; ``defaulted`` names the latter.

    Every source has the key, once per task, and all fields.
    """
    out = tasks.select(key)
    for i, source in enumerate(sources):
        out = out.join(source.select(key, *[F.col(f).alias(f"_{f}_{i}") for f in fields]), key, "left")
    found = {f: F.coalesce(*[F.nullif(F.trim(F.col(f"_{f}_{i}").cast("string")), F.lit("")) for i in range(len(sources))]) for f in fields}
    missing = F.array_compact(F.array(*[F.when(c.isNull(), f) for f, c in found.items()]))
    return out.select(key, *[F.coalesce(c, F.lit(default)).alias(f) for f, c in found.items()], missing.alias("defaulted"))


def score_mode(rows: DataFrame) -> DataFrame:
    """Add ``mode`` and ``skip`` to (task, arm) rows with the facts of their rubric and session.

    Columns: ``has_template``, ``template_scored``, ``has_custom_descriptions``, ``session_status``, ``forced``. A rubric with own
    descriptions is scored as custom, one with a template as fixed, without one as free; slots that are
    scored already and sessions that are not done are skipped.
    """
    mode = F.when(F.col("has_template") & F.col("has_custom_descriptions"), "custom").when(F.col("has_template"), "fixed").otherwise("free")
    skip = (
        F.when(~F.coalesce(F.col("session_status") == "done", F.lit(False)), "no_session")
        .when(F.col("template_scored") & ~F.col("forced"), "already_scored")
    )
    return rows.withColumns({"mode": mode, "skip": skip})

"""Both arms of a task side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.functions.checks import relative_gain, rule_flags, violations
from duoscope.settings import ARMS, THRESHOLDS, Arms, Thresholds


def with_arms(tasks: DataFrame, arms: Arms = ARMS) -> DataFrame:
    """Every task once per arm. The arms are a literal list, so nothing is joined."""
    return tasks.withColumn("arm", F.explode(F.array(*[F.lit(a) for a in arms.names])))


def pair_arms(
    df: DataFrame, values: Sequence[str], key: str = "task_id", arms: Arms = ARMS
) -> DataFrame:
    """One row per task with ``baseline_*`` and ``candidate_*`` columns.

    Rows of a task are combined on the map side before the shuffle. Of several rows of
    one (task, arm) the largest, column by column from the left, gives all values.
    """
    packed = F.struct(*values)
    sides = {"baseline": arms.baseline, "candidate": arms.candidate}
    if len(values) == 1:
        picked = [F.max(F.when(F.col("arm") == a, F.col(values[0]))).alias(f"{p}_{values[0]}") for p, a in sides.items()]
        return df.groupBy(key).agg(*picked)
    both = df.groupBy(key).agg(*[F.max(F.when(F.col("arm") == a, packed)).alias(p) for p, a in sides.items()])
    return both.select(key, *[F.col(f"{p}.{v}").alias(f"{p}_{v}") for p in sides for v in values])


def with_verdict(pairs: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Add broken rules, relative gain and both overall flags.

    ``threshold_ok`` needs both pass rates; ``export_ok`` is the rule of the exported report, for which one is enough.
    """
    b, c = F.col("baseline_passrate"), F.col("candidate_passrate")
    clean = F.size("violations") == 0
    return (
        pairs.withColumn("violations", violations(b, c, thresholds))
        .withColumn("relative_gain", F.round(relative_gain(b, c), 4))
        .withColumn("threshold_ok", clean & b.isNotNull() & c.isNotNull())
        .withColumn("export_ok", clean & (b.isNotNull() | c.isNotNull()))
    )


def rule_columns(pairs: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """Add one boolean column per acceptance rule."""
    flags = rule_flags(F.col("baseline_passrate"), F.col("candidate_passrate"), thresholds)
    return pairs.withColumns(flags)


def violation_rows(verdicts: DataFrame, key: str = "task_id") -> DataFrame:
    """One row per task and broken rule."""
    return verdicts.select(key, F.explode("violations").alias("rule"))


def pair_criteria(criteria: DataFrame, key: str = "task_id", arms: Arms = ARMS) -> DataFrame:
    """Both arms' score and description hash per (task, criterion name), for tasks with both arms.

    A name that an arm uses twice counts with its last row. This is a full outer
    join on (task, name) done as one aggregation; of descriptions only 64-bit hashes travel.
    """
    placed = F.struct("pos", "score")

    def side(arm: str, prefix: str) -> list[Column]:
        mine = F.col("arm") == arm
        return [
            F.bool_or(mine).alias(f"in_{prefix}"),
            F.max(F.when(mine, placed)).alias(f"_{prefix}"),
            F.max_by(F.when(mine, F.xxhash64("description")), F.when(mine, F.col("pos"))).alias(f"{prefix}_description"),
        ]

    named = criteria.groupBy(key, "name").agg(*side(arms.baseline, "baseline"), *side(arms.candidate, "candidate"))
    armed = criteria.groupBy(key).agg(F.count_distinct("arm").alias("_arms")).filter("_arms > 1").select(key)

    def score(prefix: str) -> Column:
        return F.col(f"_{prefix}.score").cast("int").alias(f"{prefix}_score")

    return named.join(armed, key, "left_semi").select(
        key, "name", "in_baseline", "in_candidate", score("baseline"), score("candidate"),
        "baseline_description", "candidate_description",
    )


def criterion_differences(paired: DataFrame, key: str = "task_id") -> DataFrame:
    """Names in only one arm and shared names with unequal descriptions, one row each."""
    both = F.col("in_baseline") & F.col("in_candidate")
    rule = (
        F.when(~F.col("in_candidate"), "only_in_baseline")
        .when(~F.col("in_baseline"), "only_in_candidate")
        .when(both & ~F.col("baseline_description").eqNullSafe(F.col("candidate_description")),
              "description_differs")
    )
    return paired.select(key, "name", rule.alias("rule")).filter("rule IS NOT NULL")


def criterion_agreement(paired: DataFrame, key: str = "task_id") -> DataFrame:
    """Per task: shared names, names in one arm only, and whether any score is equal."""
    both = F.col("in_baseline") & F.col("in_candidate")
    equal = both & (F.col("baseline_score") == F.col("candidate_score"))
    return paired.groupBy(key).agg(
        F.count_if(both).alias("n_shared"),
        F.count_if(~F.col("in_candidate")).alias("n_only_baseline"),
        F.count_if(~F.col("in_baseline")).alias("n_only_candidate"),
        F.count_if(both & ~F.col("baseline_description").eqNullSafe(F.col("candidate_description")))
        .alias("n_descriptions_differ"),
        F.count_if(equal).alias("n_equal_scores"),
    ).withColumn(
        "no_equal_score", (F.col("n_shared") > 0) & (F.col("n_equal_scores") == 0)
    )


def session_parity(pairs: DataFrame) -> DataFrame:
    """Flags on paired session facts: first query, turn gap, commit, follow-ups.

    A flag is computed only when its input columns exist.
    """
    have = set(pairs.columns)

    def two(name: str) -> tuple[Column, Column] | None:
        cols = (f"baseline_{name}", f"candidate_{name}")
        return (F.col(cols[0]), F.col(cols[1])) if set(cols) <= have else None

    out = pairs
    if q := two("first_user_query"):
        differs = (q[0] != "") & (q[1] != "") & (q[0] != q[1])
        out = out.withColumn("query_differs", F.coalesce(differs, F.lit(False)))
    if t := two("user_turns"):
        out = out.withColumn("turn_gap", F.abs(t[0] - t[1])).withColumn(
            "turns_unbalanced", F.coalesce(F.col("turn_gap") >= 2, F.lit(False))
        )
    if h := two("commit_hash"):
        differs = (h[0] != "") & (h[1] != "") & (h[0] != h[1])
        out = out.withColumn("commit_differs", F.coalesce(differs, F.lit(False)))
    if f := two("n_followups"):
        same = F.coalesce(f[0], F.lit(0)) == F.coalesce(f[1], F.lit(0))
        out = out.withColumn("followups_differ", ~same)
    return out


def distribution(values: DataFrame, keys: Sequence[str], value: str = "passrate") -> DataFrame:
    """min, max, mean, median, sample deviation (0 for one value) and count per group.

    Pass rates have four decimals, hence at most 10 001 distinct values, so the
    exact median keeps a small map per group whatever the number of rows.
    """
    v = F.round(value, 4)
    return values.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.avg(v).alias("mean"),
        F.median(v).alias("median"),
        F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("std"),
        F.count(F.lit(1)).alias("count"),
    )


def paired_difference(pairs: DataFrame) -> DataFrame:
    """Distribution of candidate minus baseline, with wins, losses and ties.

    Differences are taken in units of 1/10000, so ties are exact. No row comes
    back when no task has both pass rates.
    """
    units = (
        F.round(F.col("candidate_passrate") * 10000).cast("bigint")
        - F.round(F.col("baseline_passrate") * 10000).cast("bigint")
    )
    d = F.col("units")
    return (
        pairs.select(units.alias("units"))
        .filter("units IS NOT NULL")
        .agg(
            (F.avg(d) / 10000).alias("mean"),
            (F.median(d) / 10000).alias("median"),
            F.coalesce(F.stddev_samp(d) / 10000, F.lit(0.0)).alias("std"),
            F.count(F.lit(1)).alias("count"),
            F.count_if(d > 0).alias("positive"),
            F.count_if(d < 0).alias("negative"),
            F.count_if(d == 0).alias("tie"),
        )
        .filter("count > 0")
    )


def mean_flags(means: DataFrame, thresholds: Thresholds = THRESHOLDS) -> DataFrame:
    """One row of flags on the arms' mean pass rates; the gain of means may equal its limit."""
    both = means.agg(
        F.max(F.when(F.col("arm") == ARMS.baseline, F.col("mean"))).alias("b"),
        F.max(F.when(F.col("arm") == ARMS.candidate, F.col("mean"))).alias("c"),
    )
    b, c = F.col("b"), F.col("c")
    return both.select(
        F.coalesce(b >= thresholds.baseline_max, F.lit(False)).alias("baseline_high"),
        F.coalesce(c <= thresholds.candidate_min, F.lit(False)).alias("candidate_low"),
        F.coalesce((c - b) / b >= thresholds.gain_min, F.lit(False)).alias("gain_ok"),
    )

"""Rubric rows to pass rates and verdicts. One hash aggregation serves all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.functions.checks import valid_criterion_name
from duoscope.functions.text import contradiction_hits, has_score_tiers
from duoscope.settings import LIMITS, Limits

KEYS = ("task_id", "arm")

# What a rubric row without the field has.
ROW_DEFAULTS = {"type": "likert", "points": 5, "weight": 1.0, "score": 0, "rationale": ""}


def with_defaults(criteria: DataFrame) -> DataFrame:
    """Fill absent fields of rubric rows, so every later test is true or false."""
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in ROW_DEFAULTS.items() if c in criteria.columns}
    return criteria.withColumns(filled)


def pass_rates(criteria: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Weighted pass rate per rubric; NULL when the total of points is not positive."""
    points = F.sum(F.col("points") * F.col("weight"))
    return with_defaults(criteria).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_criteria"),
        F.when(points > 0, F.sum(F.col("score") * F.col("weight")) / points).alias("passrate"),
    )


def rubric_facts(criteria: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All that later rules need to know about a rubric, in one aggregation of fixed-width values."""
    score, silent = F.col("score"), F.col("rationale") == ""
    in_range = score.between(1, 5)
    full = in_range & (F.col("points") == 5) & (F.col("type") == "likert") & ~silent
    points = F.sum(F.col("points") * F.col("weight"))
    described = [F.bool_and(F.coalesce(has_score_tiers(F.col("description")), F.lit(False))).alias("has_custom_descriptions")]
    return with_defaults(criteria).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_criteria"),
        F.bool_and((score == 0) & silent).alias("is_unscored"),
        F.bool_and(full).alias("rows_complete"),
        F.count_if(in_range & ~silent).alias("n_scored"),
        F.bool_and(valid_criterion_name(F.col("name"))).alias("names_valid"),
        F.min(F.when(~in_range, F.col("pos"))).alias("bad_score_pos"),
        F.min(F.when(silent, F.col("pos"))).alias("no_rationale_pos"),
        F.when(points > 0, F.sum(score * F.col("weight")) / points).alias("raw_passrate"),
        *(described if "description" in criteria.columns else []),
    )


def rubric_verdict(facts: DataFrame, limits: Limits = LIMITS, check_names: bool = False) -> DataFrame:
    """Add ``reason`` (first failing check or NULL), the position it points at, and ``passrate``."""
    n = F.col("n_criteria")
    checks = [
        ("missing", n.isNull() | (n == 0), None),
        ("unscored", F.col("is_unscored"), None),
        ("wrong_count", ~n.between(limits.min_criteria, limits.max_criteria), None),
        ("score_out_of_range", F.col("bad_score_pos").isNotNull(), F.col("bad_score_pos")),
        ("no_rationale", F.col("no_rationale_pos").isNotNull(), F.col("no_rationale_pos")),
        ("incomplete", ~F.col("rows_complete"), None),
    ]
    if check_names:
        checks.append(("invalid_name", ~F.col("names_valid"), None))
    checks.append(("no_points", F.col("raw_passrate").isNull(), None))
    none = F.lit(None).cast("bigint")
    reason = at = None
    for name, failed, place in checks:
        place = none if place is None else place
        reason = F.when(failed, name) if reason is None else reason.when(failed, name)
        at = F.when(failed, place) if at is None else at.when(failed, place)
    return facts.withColumns({"reason": reason, "at_pos": at.cast("bigint")}).withColumn(
        "passrate", F.when(F.col("reason").isNull(), F.round("raw_passrate", 4))
    )


def _escaped(text: Column) -> Column:
    """Text as it stands between the quotes of the rubric format."""
    for plain, mark in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def rubric_texts(criteria: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every rubric in the text format that people edit: ``keys, rubric``; rows in order of ``pos``, absent fields filled."""
    row = with_defaults(criteria)
    quoted = lambda c: F.concat(F.lit(f'{c} = "'), _escaped(F.coalesce(F.col(c), F.lit(""))), F.lit('"\n'))
    plain = lambda c: F.concat(F.lit(f"{c} = "), F.col(c).cast("string"), F.lit("\n"))
    block = F.concat(
        F.lit("[[criterion]]\n"), quoted("name"), quoted("description"), quoted("type"), plain("points"), plain("weight"), plain("score"), quoted("rationale"),
    )
    # A rubric is a few rows.
    listed = row.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("p"), block.alias("b")))).alias("l"))
    return listed.select(*keys, F.array_join(F.transform("l", lambda x: x["b"]), "\n").alias("rubric"))


def any_issue(verdicts: DataFrame) -> DataFrame:
    """One row: True when any rubric has no pass rate (the strict flag)."""
    return verdicts.agg(
        F.coalesce(F.bool_or(F.col("reason").isNotNull()), F.lit(False)).alias("has_issue"),
        F.count_if(F.col("reason").isNotNull()).alias("n_issues"),
    )


def contradictions(criteria: DataFrame, **words: Sequence[str]) -> DataFrame:
    """Rubric rows whose rationale speaks against their score, with the words found."""
    hits = contradiction_hits(F.col("score"), F.coalesce("rationale", F.lit("")), **words)
    return criteria.withColumn("words", hits).filter(F.size("words") > 0)


def invalid_names(criteria: DataFrame) -> DataFrame:
    """Rubric rows whose name is not snake_case."""
    return criteria.filter(~valid_criterion_name(F.col("name")))


def repeated_names(criteria: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rubrics that use a name more than once: they are rejected as a whole."""
    per_name = criteria.groupBy(*keys, "name").agg(F.count(F.lit(1)).alias("uses"))
    return per_name.groupBy(*keys).agg(
        F.bool_or(F.col("uses") > 1).alias("has_repeats"),
        F.count_if(F.col("uses") > 1).alias("n_repeated_names"),
    )


def names_match(criteria: DataFrame, expected: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per rubric: is its set of names the expected set? ``expected`` has keys and ``name``."""
    has = criteria.select(*keys, "name", F.lit(1).alias("found"), F.lit(0).alias("wanted"))
    want = expected.select(*keys, "name", F.lit(0).alias("found"), F.lit(1).alias("wanted"))
    per_name = has.unionByName(want).groupBy(*keys, "name").agg(F.max("found").alias("found"), F.max("wanted").alias("wanted"))
    return per_name.groupBy(*keys).agg(F.bool_and(F.col("found") == F.col("wanted")).alias("names_match"))

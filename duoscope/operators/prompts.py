"""What goes out to a judge and what comes back: prompts as a table, answers as a table. The model call is outside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Context fields in the order in which a prompt shows them, with their titles.
CONTEXT = (
    ("project_name", "Project"), ("task_type", "Task type"), ("domain", "Domain"), ("language", "Language"), ("task_title", "Title"),
    ("task_description", "Description"), ("acceptance_criteria", "Acceptance criteria"), ("prompts", "Prompts"), ("followups", "Follow-ups"),
)


def context_block(fields: Sequence[tuple[str, str]] = CONTEXT, have: Sequence[str] | None = None) -> Column:
    """A line per field that is not empty."""
    lines = [
        F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"- {title}: "), F.col(c)))
        for c, title in fields if have is None or c in have
    ]
    return F.concat_ws("\n", *lines)


def criteria_block(criteria: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rubric of each task as numbered lines ``name (weight): description``: ``keys, rubric``. A rubric is a few rows."""
    line = F.concat(F.col("name"), F.lit(" ("), F.format_number("weight", 1), F.lit("): "), F.coalesce("description", F.lit("")))
    listed = criteria.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("pos").cast("bigint").alias("pos"), line.alias("line")))).alias("_l"))
    return listed.select(*keys, F.array_join(F.transform("_l", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["line"])), "\n").alias("rubric"))


def judge_prompts(
    sessions: DataFrame, contexts: DataFrame, criteria: DataFrame | None, instructions: str, key: str = "task_id", session_key: str = "session",
) -> DataFrame:
    """One prompt per condensed session: instructions, context, rubric, session: ``session_key, key, prompt``.

    ``sessions`` has both keys and ``condensed``, ``contexts`` the task's fields by ``key``, ``criteria`` the template rows by ``key``. A judge sees neither
    the arm nor an expected score. Tasks without context or template have a prompt without that part; sessions of unknown tasks
    stay.
    """
    have = [c for c, _ in CONTEXT if c in contexts.columns]
    known = contexts.select(key, context_block(have=have).alias("_context"))
    rows = sessions.select(session_key, key, "condensed").join(known, key, "left")
    if criteria is not None:
        rows = rows.join(criteria_block(criteria, [key]), key, "left")
    else:
        rows = rows.withColumn("rubric", F.lit(None).cast("string"))
    part = lambda title, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"## {title}\n\n"), F.col(c)))
    prompt = F.concat_ws("\n\n", F.lit(instructions), part("Task", "_context"), part("Criteria", "rubric"), F.lit("---"), part("Session", "condensed"))
    return rows.select(session_key, key, prompt.alias("prompt"))

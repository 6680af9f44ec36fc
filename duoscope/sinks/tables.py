"""Report and ledger writers. All write in parallel; none gathers its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.settings import ARMS, Arms


def write_submission(rows: DataFrame, path: str, arms: Arms = ARMS) -> None:
    """The published table as CSV with its published column names; absent columns are empty."""
    names = {"baseline": arms.baseline, "candidate": arms.candidate}
    columns = [
        (F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")).alias(header.format(**names))
        for c, header in C.SUBMISSION_HEADERS.items()
    ]
    rows.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_rubrics(texts: DataFrame, path: str) -> None:
    """Rubrics as texts (``task_id, arm, rubric``), by arm; a row each, as a file each would be too many."""
    texts.write.mode("overwrite").partitionBy("arm").parquet(path)


def append_ledger(writes: DataFrame, path: str) -> None:
    """Append writes to the ledger, by stage. A reset is a write with ``deleted`` set."""
    writes.write.mode("append").partitionBy("stage").parquet(path)


def merge_manifest(old: DataFrame, new: DataFrame, key: str = "task_id") -> DataFrame:
    """Old tasks, and of the new ones those whose id is not there yet."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def write_sessions(events: DataFrame, accepted: DataFrame, path: str, key: str = "session") -> None:
    """Events of accepted sessions, by arm; a huge session may fill several files."""
    kept = events.join(accepted.select(key, "arm"), key)
    kept.write.mode("overwrite").partitionBy("arm").parquet(path)


def write_drafts(answers: DataFrame, path: str, error: str = "error") -> DataFrame:
    """Keep answers that could not be read for people to look at; returns the others."""
    answers.filter(F.col(error).isNotNull()).withColumn("status", F.lit("draft")).write.mode("append").parquet(path)
    return answers.filter(F.col(error).isNull())

"""Incremental collection of landed session logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.functions.checks import detected_provider
from duoscope.operators.sessions import collect_result, parsed_lines, session_facts, session_rows
from duoscope.settings import LIMITS, Limits
from duoscope.storage import shared_dir


def landed_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of all session files that land in a folder, each file once: ``file_path, block, raw``."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.trim(F.make_valid_utf8("value")).alias("raw"),
    )


def collect_sessions(
    spark: SparkSession, path: str, out: str, name: str = "collect", runs: DataFrame | None = None, limits: Limits = LIMITS
):
    """Append the facts of newly landed sessions to ``out``; what is there already is left alone.

    With ``runs`` (``file_path, action, provider, session``, see ``collect_result``) each file's facts come with the result of collecting its
    run: ``status, error, recovery``, null for a file of no run.

    A file is one session and lands whole, so its lines are always in one batch. The batch number
    names the batch's folder, and a batch that is run again overwrites just that. The
    progress is kept in the folder that all executors share. Returns when all that has landed is done.
    """
    def write(batch: DataFrame, number: int) -> None:
        lines = batch.withColumn("line_key", F.struct("block", F.monotonically_increasing_id().alias("line")))
        rows = session_rows(parsed_lines(lines)).withColumnRenamed("session_id_key", "file_path")
        facts = session_facts(rows, ["file_path"], "line_key")
        if runs is not None:
            known = facts.withColumn("provider", detected_provider(F.col("models")))
            mine = runs.join(facts.select("file_path"), "file_path", "left_semi")
            facts = facts.join(collect_result(mine, known, "file_path", limits), "file_path", "left")
        facts.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        landed_lines(spark, path).writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{shared_dir(spark).rstrip('/')}/{name}").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query

"""Ledgers as nested JSON files: task, stage and, for some stages, arm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.functions.text import is_kind


def read_ledgers(spark: SparkSession, path: str) -> DataFrame:
    """The ledger files of a folder, one document each: ``file, raw, doc``.

    ``doc`` is a VARIANT, null where the file holds no JSON object.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("raw")
    )
    doc = F.try_parse_json("raw")
    return files.withColumn("doc", F.when(is_kind(doc, "OBJECT"), doc))


def quarantined(ledgers: DataFrame) -> DataFrame:
    """One row per file that is no ledger: ``file, reason``."""
    blank = F.trim(F.translate("raw", "\r\n\t", "   ")) == ""
    reason = F.when(blank, "empty").when(F.try_parse_json("raw").isNull(), "not_json").otherwise("not_an_object")
    return ledgers.filter("doc IS NULL").select("file", reason.alias("reason"))


def _entries(v: Column) -> Column:
    return F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))


def ledger_cells(ledgers: DataFrame, arm_stages: Sequence[str] = C.ARM_STAGES) -> DataFrame:
    """One row per cell: ``file, task, stage, arm, attrs`` and the known attributes as columns.

    Names beginning with ``_`` hold no tasks. Stages of ``arm_stages`` have an object per arm, others none (``arm`` is null). What
    is no object where one belongs is left out.
    """
    tasks = ledgers.select("file", F.inline(_entries(F.col("doc"))).alias("task", "stages")).filter(~F.startswith("task", F.lit("_")))
    stages = tasks.select("file", "task", F.inline(_entries(F.col("stages"))).alias("stage", "v"))
    armed = F.col("stage").isin(*arm_stages)
    one = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("v").alias("value")))
    cells = stages.select("file", "task", "stage", F.inline(F.when(armed, _entries(F.col("v"))).otherwise(one)).alias("arm", "attrs"))
    known = {
        "status": "string", "retry_count": "int", "duration_s": "double", "session_id": "string", "passrate": "double",
        "expected_turns": "int", "start_time": "double", "error": "string",
    }
    return cells.filter(is_kind(F.col("attrs"), "OBJECT")).select(
        "*", *[F.try_variant_get("attrs", f"$.{n}", t).alias(n) for n, t in known.items()]
    )


def turn_log(cells: DataFrame, stage: str = "run") -> DataFrame:
    """The turns of every run: ``file, task, arm, turn, exit_code, duration_s, session_id, expected_turns``.

    A run without a number of turns to expect (its session was never known) expects those it has.
    """
    turns = F.try_variant_get("attrs", "$.turns_detail", "array<variant>")
    rows = cells.filter(F.col("stage") == stage).select(
        "file", "task", "arm", F.coalesce("expected_turns", F.size(turns)).alias("expected_turns"), F.explode(turns).alias("t")
    )
    get = lambda name, kind: F.try_variant_get("t", f"$.{name}", kind)
    return rows.select(
        "file", "task", "arm", get("turn", "int").alias("turn"), F.coalesce(get("exit_code", "int"), F.lit(0)).alias("exit_code"),
        get("duration_s", "double").alias("duration_s"), F.coalesce(get("session_id", "string"), F.lit("")).alias("session_id"), "expected_turns",
    )


def ledger_documents(cells: DataFrame, ledger: str = "ledger", arm_stages: Sequence[str] = C.ARM_STAGES) -> DataFrame:
    """The way back: one JSON document per ledger, ``ledger, json``.

    ``cells`` has ``ledger, task, stage, arm`` and any attributes; null attributes are not written. A document
    holds one delivery, which is what a file can hold.
    """
    own = [c for c in cells.columns if c not in (ledger, "task", "stage", "arm")]
    attrs = cells.select(ledger, "task", "stage", "arm", F.to_json(F.struct(*own)).alias("a"))
    quoted = lambda c: F.to_json(F.array(F.col(c)))
    name = lambda c: F.substring(quoted(c), 2, 1 << 30).substr(F.lit(1), F.length(quoted(c)) - 2)

    def nested(df: DataFrame, keys: list[str], key: str) -> DataFrame:
        pair = F.concat(name(key), F.lit(":"), F.col("a"))
        return df.groupBy(*keys).agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(pair)), ","), F.lit("}")).alias("a"))

    armed = F.col("stage").isin(*arm_stages)
    with_arms = nested(attrs.filter(armed), [ledger, "task", "stage"], "arm")
    stages = attrs.filter(~armed).drop("arm").unionByName(with_arms)
    return nested(nested(stages, [ledger, "task"], "stage"), [ledger], "task").select(ledger, F.col("a").alias("json"))

"""From raw documents to token files: five stages, each written and reread as the next one's input.

Every stage function takes ``(spark, docs, sf_dir)``, works on all documents
that its predecessor kept, and returns the columns of documents; the last one
returns what the token files hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.llm.common import stored
from duoscope.llm.crf_quality import score_quality
from duoscope.llm.decontaminate import contamination
from duoscope.llm.mixing import mix, word_count
from duoscope.llm.near_dedup import near_duplicates
from duoscope.llm.token_files import token_output


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality field does not reject: each row by its text, null texts as empty ones, ids and repeats regardless."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return score_quality(docs, labels).filter("predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: each row by its own text, whether its id is null or repeated.

    Of a group the row with the smallest id stays, null ids last; of rows that tie any one. Null and empty texts are
    no near-duplicates and stay. An empty table gives no rows.
    """
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "rows", "zstd")
    groups = near_duplicates(rows.select("_row", "text"), key="_row").select("_row", "component_id")
    ids = rows.select("_row", F.col("doc_id").isNull().alias("_none"), "doc_id")
    first = groups.join(ids, "_row").groupBy("component_id").agg(F.min(F.struct("_none", "doc_id", "_row")).alias("_f"))
    return rows.join(first.select(F.col("_f._row").alias("_row")), "_row", "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark: each row by its own id and text, whether the id is null or repeated."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    own = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))), 256)
    rows = docs.withColumn("_row", own)
    leaks = contamination(rows.select("_row", "text"), items, key="_row").filter("contaminated").select("_row").distinct()
    return rows.join(leaks, "_row", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Sizes are words; null and empty texts have none and are not taken. A null source is a source of its own; equal rows are
    taken each for itself; an empty table gives no rows.
    """
    mixed = mix(docs.withColumn("_size", word_count()), size="_size")
    return mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: one row per document and copy.

    Null texts count as empty (the end id alone), null ids come first, equal ids follow each other; an empty table gives no rows.
    """
    return token_output(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mixing),
    ("token-ID output", tokens),
]

#: A learned score, sketches and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs

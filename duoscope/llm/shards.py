"""Contiguous shards of nearly equal byte size, by global prefix sums of part totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.llm.common import stored


def byte_size(text: str = "text"):
    """UTF-8 bytes of the text plus 1; a null text has none."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(1)).cast("bigint")


def byte_shards(
    df: DataFrame, shards: int, order: str = "doc_id", size: str = "size", parts: int | None = None
) -> DataFrame:
    """Add ``start`` (bytes before the row), ``shard`` and ``slot`` to rows with a size.

    Rows are dealt into parts by ranges of ``order``; each part's total and
    count give, summed over the earlier parts, where the part starts. Inside a
    part a running sum goes on from there. A row belongs to the shard in which
    its middle byte lies when the whole is cut at equal targets, so each shard
    is within one row's size of its target and keeps the order.

    Null keys come first; rows with an equal key are ordered by all their other
    columns, so equal rows are interchangeable and reruns agree. An empty table
    gives no rows. Columns named ``part``, ``start``, ``shard`` or ``slot`` are
    replaced.
    """
    spark = df.sparkSession
    # The row travels as one value, so none of its columns can clash with those that are made here.
    own = [c for c in df.columns if c not in ("part", "start", "shard", "slot")]
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = df.select(
        F.col(f"`{order}`").alias("key"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col(f"`{size}`").alias("bytes")
    )
    dealt = stored(packed.repartitionByRange(parts, "key", "row").withColumn("part", F.spark_partition_id()), "shards")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # One row per part, of which there are as many as were asked for above.
    totals = dealt.groupBy("part").agg(F.sum("bytes").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(W.partitionBy()).alias("total"),
    )
    number = W.partitionBy("part").orderBy("key", "row")
    start = F.coalesce(F.sum("bytes").over(number.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col("bytes_before")
    shard = F.least(F.expr(f"(2 * start + bytes) * {int(shards)} div (2 * total)"), F.lit(int(shards) - 1)).cast("int")
    placed = stored(
        dealt.join(F.broadcast(offsets), "part")
        .withColumn("start", start)
        .withColumn("number", F.row_number().over(number) - 1 + F.col("rows_before"))
        .withColumn("shard", shard)
        .select("row", "start", "number", "shard"),
        "shards",
    )
    firsts = placed.groupBy("shard").agg(F.min("number").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        *[F.col("row").getField(c).alias(c) for c in own], "start", "shard", (F.col("number") - F.col("first")).alias("slot")
    )


def op7_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards in order of doc_id.

    A null text has size 1 and the checksum of an empty text.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        byte_size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return byte_shards(docs, 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "start",
    )

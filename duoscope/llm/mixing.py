"""Mixing sources to target weights with hash-threshold histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.llm.common import stored

#: A hash has 60 bits: the first 15 hex digits of md5, which other engines can compute as well.
HASH_DIGITS = 15
#: Hex digits that each level of histograms adds.
LEVEL_DIGITS = 3
LEVELS = HASH_DIGITS // LEVEL_DIGITS
REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text"):
    """Number of words (runs of anything but white space); 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = REPEATS) -> DataFrame:
    """Target size per source. Input: one row per source with ``source`` and ``source_size``.

    Sources in code-point order (null last) weigh 1, 2, 3, repeating. All sizes
    are shared by weight; no target goes beyond ``repeats`` times its source, and
    what that frees is shared again by weight among the others. With sources in
    order of the weight-free level at which they fill up, the first one that does
    not fill up at the level of the rest gives the level for all. The windows run
    over one row per source, never over documents.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    by_name = W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    whole = W.partitionBy()
    limit = F.col("source_size") * repeats
    # A source without words can take nothing and is full from the start.
    fills = W.orderBy(limit / F.col("weight"), F.col("source").isNull(), "source")
    earlier = fills.rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(earlier), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    )
    weighted = sizes.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    )
    leveled = weighted.withColumn("_level", level)
    fits = F.when(limit >= F.col("_level") * F.col("weight"), F.col("_level"))
    return leveled.withColumn("_level", F.max(fits).over(whole)).select(
        "source",
        "source_size",
        "weight",
        F.coalesce(F.least(limit.cast("double"), F.col("_level") * F.col("weight")), F.lit(0.0)).alias("target"),
    )


def _bucket(level: int):
    return F.substring("_hash", 1, LEVEL_DIGITS * level)


def mix(
    docs: DataFrame, key: str = "doc_id", size: str = "size", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), repeats: int = REPEATS,
) -> DataFrame:
    """Add ``source_size``, ``target``, ``taken`` and ``copies`` to documents with a size.

    A source takes every document ``floor(target / source_size)`` times. What is
    left of its target is a budget on hashes of the keys: sizes are summed by
    source and leading hash digits, and only the bucket in which the running
    total passes the budget is summed again by further digits, down to single
    hash values. Documents below the threshold are taken once more; of the one on
    the threshold just the words that fill the budget. ``copies`` is the same in
    whole documents, the one on the threshold rounded. Documents are filtered,
    not sorted, and budgets are nested: a larger one takes a superset.

    Rows with an equal key (and null keys) cross the threshold together and
    share what is left evenly, rounded down, so the total can then stay below the
    target by fewer words than there are such rows. Empty documents take 0. What is known of
    each source is written and joined as the planner sees fit: broadcast while it is small,
    else by a shuffle of ids and sizes. A
    null source is a source of its own. Existing columns of these names are
    replaced. An empty table gives no rows.
    """
    made = ("source_size", "target", "taken", "copies")
    own = [c for c in docs.columns if c not in made and not c.startswith("_m_")]
    rows = docs.select(
        *own,
        F.col(source).alias("_m_source"),
        F.col(size).alias("_m_size"),
        F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, HASH_DIGITS).alias("_hash"),
    )
    # What thresholds are looked for in: sizes alone, written once, however wide the documents are.
    counted = stored(rows.select("_m_source", "_m_size", "_hash"), "mix")
    small = counted.groupBy("_m_source", _bucket(1).alias("_b")).agg(F.sum("_m_size").alias("_s"))
    level = stored(small, "mix")
    targets = stored(
        source_targets(
            level.groupBy(F.col("_m_source").alias("source")).agg(F.sum("_s").alias("source_size")), weights, repeats
        ),
        "mix",
    )
    whole = F.floor(F.col("target") / F.col("source_size"))
    state = targets.select(
        F.col("source").alias("_m_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, whole).otherwise(0).cast("bigint").alias("_whole"),
    ).withColumn(
        "_budget",
        F.round(F.col("target") - F.col("_whole") * F.col("source_size")).cast("bigint"),
    ).withColumn("_cut", F.lit(""))
    for n in range(1, LEVELS + 1):
        if n > 1:
            inside = counted.join(
                state.select(F.col("_m_source").alias("_src"), "_cut"),  # written, so its size is known to the planner
                F.col("_m_source").eqNullSafe(F.col("_src")) & (_bucket(n - 1) == F.col("_cut")),
                "left_semi",
            )
            level = inside.groupBy("_m_source", _bucket(n).alias("_b")).agg(F.sum("_m_size").alias("_s"))
        # At most 16**LEVEL_DIGITS buckets per source: the children of one bucket.
        before = W.partitionBy("_m_source").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
        running = level.select(
            F.col("_m_source").alias("_src"), "_b", "_s", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_below")
        )
        # The first bucket that the budget does not fill; none when the budget is the whole.
        crossing = (
            running.join(state.select("_m_source", "_budget"), F.col("_src").eqNullSafe(F.col("_m_source")))
            .filter(F.col("_below") + F.col("_s") > F.col("_budget"))
            .groupBy("_src").agg(F.min(F.struct("_b", "_below", "_s")).alias("_at"))
        )
        state = stored(
            state.join(crossing, F.col("_m_source").eqNullSafe(F.col("_src")), "left").select(
                "_m_source", "source_size", "target", "_whole",
                F.coalesce(F.col("_budget") - F.col("_at._below"), F.col("_budget")).alias("_budget"),
                F.coalesce(F.col("_at._b"), F.lit("~")).alias("_cut"),
                F.coalesce(F.col("_at._s"), F.lit(0)).alias("_cut_size"),
            ),
            "mix",
        )
    # Rows on the threshold, and how many there are of each source (1 unless keys repeat).
    on_cut = (
        counted.join(
            state.select(F.col("_m_source").alias("_src"), "_cut"),
            F.col("_m_source").eqNullSafe(F.col("_src")) & (F.col("_hash") == F.col("_cut")),
            "left_semi",
        )
        .filter("_m_size > 0").groupBy(F.col("_m_source").alias("_src")).agg(F.count(F.lit(1)).alias("_ties"))
    )
    final = stored(state.join(on_cut, F.col("_m_source").eqNullSafe(F.col("_src")), "left").drop("_src"), "mix")
    joined = rows.join(final.withColumnRenamed("_m_source", "_src"), F.col("_m_source").eqNullSafe(F.col("_src")))
    below, at = F.col("_hash") < F.col("_cut"), F.col("_hash") == F.col("_cut")
    part = F.when(
        F.col("_ties") > 1, F.floor(F.col("_budget") * F.col("_m_size") / F.col("_cut_size"))
    ).otherwise(F.col("_budget"))
    taken = F.col("_whole") * F.col("_m_size") + F.when(below, F.col("_m_size")).when(at, part).otherwise(0)
    rounded = F.when(below, 1).when(at & (2 * F.col("_budget") >= F.col("_cut_size")), 1).otherwise(0)
    return joined.select(
        *own, "source_size", "target",
        F.least(taken, F.col("_m_size") * repeats).cast("bigint").alias("taken"),
        F.when(F.col("_m_size") > 0, F.least(F.col("_whole") + rounded, F.lit(repeats))).otherwise(0).cast("int").alias("copies"),
    )


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents by source, in words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", word_count().alias("size"))
    return mix(stored(docs, "mix")).select("doc_id", "size", "source_size", "target", "taken", "copies")

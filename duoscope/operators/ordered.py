"""Order-dependent operators that never bring a whole key into one task.

A plain ``row_number() OVER (PARTITION BY key ORDER BY pos)`` sorts all rows of
a key in one task, which a hot key cannot afford. Here the rows are dealt into
parts by ranges of (key, order) and written once, so a hot key lies in as many
parts as it needs, whatever its order values look like. A window runs inside
each (key, part); what earlier parts contribute comes from one small summary
row per key and part.

``order`` holds column names or sort expressions and must tell all rows of a key apart, or rows that
tie are ordered arbitrarily (but once and for all).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.storage import stored

_KEY, _PART, _LOCAL, _CARRY = "_key", "_part", "_local", "_carry"


def _parted(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    # A struct key compares NULL fields as equal, so rows with NULL keys are kept.
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    parts = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn(_KEY, key).repartitionByRange(parts, _KEY, *order)
    return stored(dealt.withColumn(_PART, F.spark_partition_id()), "ordered")


def dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The rows, dealt once; the ``..._dealt`` functions below may then follow each other on this one deal.

    Rows that are equal in key and order lie in one part.
    """
    return _parted(df, keys, order)


def _combine(
    base: DataFrame, order: Sequence[str | Column], local: Column, strictly_before: bool, summary: Column, carry: Column,
    within: Sequence[str] = (),
) -> DataFrame:
    inside = W.partitionBy(_KEY, _PART, *within).orderBy(*order)
    if strictly_before:
        inside = inside.rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(_KEY, *within).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        base.groupBy(_KEY, _PART, *within).agg(summary.alias("_summary"))
        .select(_KEY, _PART, *within, carry.over(earlier).alias(_CARRY))
    )
    return base.withColumn(_LOCAL, local.over(inside)).join(carried, [_KEY, _PART, *within])


def running_sum_dealt(base: DataFrame, order: Sequence[str | Column], value: str, out: str) -> DataFrame:
    """:func:`running_sum` on rows that are dealt already, and stay so."""
    joined = _combine(base, order, F.sum(value), True, F.sum(value), F.sum("_summary"))
    total = F.coalesce(_LOCAL, F.lit(0)) + F.coalesce(_CARRY, F.lit(0))
    return joined.select(*base.columns, total.alias(out))


def last_seen_dealt(base: DataFrame, order: Sequence[str], value: str, out: str, within: Sequence[str] = ()) -> DataFrame:
    """:func:`last_seen` on rows that are dealt already, and stay so; among the key's rows with equal ``within``, which is never null."""
    newest = F.max(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v"))))
    joined = _combine(
        base, order, F.last(value, ignorenulls=True), True, newest["_v"], F.last("_summary", ignorenulls=True), within
    )
    return joined.select(*base.columns, F.coalesce(_LOCAL, _CARRY).alias(out))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str) -> DataFrame:
    """Number the rows of every key from 1 in ``order``; column ``out``."""
    joined = _combine(_parted(df, keys, order), order, F.row_number(), False, F.count(F.lit(1)), F.sum("_summary"))
    number = (F.col(_LOCAL) + F.coalesce(_CARRY, F.lit(0))).cast("bigint")
    return joined.select(*df.columns, number.alias(out))


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, out: str
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the key (0 for the first row)."""
    return running_sum_dealt(_parted(df, keys, order), order, value, out).select(*df.columns, out)


def last_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Latest non-null ``value`` among the earlier rows of the key (as-of lookup)."""
    return last_seen_dealt(_parted(df, keys, order), order, value, out).select(*df.columns, out)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The first row of every key, as one aggregation that combines before the shuffle."""
    least = F.min(F.struct(*order, *[v for v in values if v not in order])).alias("_first")
    return df.groupBy(*keys).agg(least).select(*keys, *[F.col(f"_first.{v}").alias(v) for v in values])

"""Row filters on task records, built as Columns."""

from __future__ import annotations

import operator
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields a task filter may use: columns of a task record with its rule flags.
FILTER_FIELDS = (
    "task_type", "domain", "language", "bad_pattern",
    "baseline_passrate", "candidate_passrate", "relative_gain",
    "threshold_ok", "finalize_status",
    "baseline_over_limit", "candidate_under_limit",
    "candidate_not_better", "gain_too_small",
)

_OPS = {
    "=": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    ">": operator.gt,
    "<=": operator.le,
    ">=": operator.ge,
}


def condition(
    df: DataFrame,
    field: str,
    op: str,
    value: str | float | bool,
    allowed: Collection[str] = FILTER_FIELDS,
) -> Column:
    """Comparison of one field. Absent and empty values match no operator.

    Combine conditions with ``&`` and ``|``.
    """
    if field not in allowed:
        raise ValueError(f"field {field!r} is not one of {sorted(allowed)}")
    if op not in _OPS:
        raise ValueError(f"unknown operator {op!r}")
    kind = df.schema[field].dataType
    column = F.col(field)
    if isinstance(kind, T.StringType):
        column = F.nullif(column, F.lit(""))
    present, equality = column.isNotNull(), op in ("=", "!=")
    # A value of another type differs from every value of the field.
    other = F.coalesce(present & F.lit(op == "!="), F.lit(False))
    is_bool = isinstance(value, bool) or (isinstance(value, str) and value.lower() in ("true", "false"))
    is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if isinstance(kind, T.BooleanType):
        if is_number:
            column = column.cast("double")
        elif is_bool:
            value = value if isinstance(value, bool) else value.lower() == "true"
        elif equality:
            return other
        else:
            raise ValueError(f"{field} is true or false; compare it with = or !=")
    elif isinstance(kind, T.StringType):
        if isinstance(value, bool):
            return other
        if is_number:
            as_number = column.try_cast("double")
            matched = F.when(as_number.isNotNull(), _OPS[op](as_number, F.lit(float(value))))
            return F.coalesce(matched, other)
    elif isinstance(kind, T.NumericType) and not is_number:
        if not equality:
            raise ValueError(f"{field} is a number; compare it with a number")
        return other
    return F.coalesce(_OPS[op](column, F.lit(value)), F.lit(False))


def select_tasks(tasks: DataFrame, ids: list | None, key: str = "task_id") -> DataFrame:
    """The named tasks with ``requested``, their place in the list; all tasks when there is no list.

    The list is a parameter of the call, so it goes into the scan as a filter. An
    id without a task gives a row with ``known`` false instead of vanishing.
    """
    if not ids:
        return tasks.withColumns({"requested": F.lit(None).cast("int"), "known": F.lit(True)})
    kind = tasks.schema[key].dataType
    wanted = tasks.sparkSession.createDataFrame(
        list(enumerate(ids)),
        T.StructType([T.StructField("requested", T.IntegerType()), T.StructField(key, kind)]),
    )
    found = tasks.filter(F.col(key).isin(*ids)).withColumn("known", F.lit(True))
    joined = wanted.join(found, key, "left")
    return joined.withColumn("known", F.coalesce("known", F.lit(False))).select(*tasks.columns, "requested", "known")


def select_delivery_tasks(
    manifest: DataFrame, configured: DataFrame, ids: list | None = None, key: str = "task_id"
) -> DataFrame:
    """Tasks of the manifest, or the configured ones when the manifest is empty."""
    any_row = manifest.agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0")
    source = manifest.unionByName(configured.join(F.broadcast(any_row), F.lit(True), "left_anti"))
    return select_tasks(source, ids, key)


def known_tasks(manifest: DataFrame, configured: DataFrame, key: str = "task_id") -> DataFrame:
    """Union of both task lists; the manifest wins for ids in both."""
    return manifest.unionByName(configured.join(manifest.select(key), key, "left_anti"))

"""Names and paths derived from task ids, arms, dates and folders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_stem(task_id: Column, arm: Column) -> Column:
    """``CT-0038`` and arm ``a`` give ``a-0038``; ids without a hyphen stay whole."""
    return F.concat(arm, F.lit("-"), F.regexp_replace(task_id, r"\A[^-]*-", ""))


def session_path(task_id: Column, arm: Column) -> Column:
    return F.concat(F.lit("trajectories/"), arm, F.lit("/"), file_stem(task_id, arm), F.lit(".jsonl"))


def score_path(task_id: Column, arm: Column) -> Column:
    stem = file_stem(task_id, arm)
    return F.concat(F.lit("scores/"), arm, F.lit("/"), stem, F.lit(".quality.toml"))


def legacy_score_path(task_id: Column, arm: Column) -> Column:
    return F.concat(F.lit("scores/"), arm, F.lit("/"), task_id, F.lit(".quality.toml"))


def date_part(date: Column) -> Column:
    """``20260607`` gives ``607``; other lengths are returned unchanged."""
    month = F.substring(date, 5, 2).cast("int").cast("string")
    return F.when(F.length(date) == 8, F.concat(month, F.substring(date, 7, 2))).otherwise(date)


def submission_id(person: Column, date: Column, task_type: Column, seq: Column) -> Column:
    number = F.format_string("%02d", seq.cast("bigint"))
    return F.concat_ws("-", person, date_part(date), task_type, number)


def project_slug(path: Column) -> Column:
    """Folder name that stands for an absolute drive path; NULL for other paths."""
    unix = F.rtrim(F.replace(path, F.lit("\\"), F.lit("/")), F.lit("/"))
    at = F.instr(unix, ":/")
    drive = F.left(unix, at - 1)
    rest = F.substring(unix, at + 2, F.length(unix))
    slug = F.concat(drive, F.lit("--"), F.translate(rest, "/ _.", "----"))
    bare_drive = F.concat(F.left(unix, F.lit(1)), F.lit("--"))
    return F.when((at > 1) & (rest != ""), slug).when(F.substring(unix, 2, 1) == ":", bare_drive)

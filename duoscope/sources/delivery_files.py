"""Files of a delivery: task manifests, published submissions, weight sheets, pools, assignments and task metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.functions.text import BLANKS, is_kind, strip
from duoscope.operators.ordered import row_numbers
from duoscope.settings import ARMS, Arms


def _entries(v: Column) -> Column:
    return F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))


def _documents(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    """JSON objects of a folder, one per file or one per line: ``file, doc`` (VARIANT); what is no object is left out."""
    files = spark.read.text(path, wholetext=whole).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json(F.make_valid_utf8("value")).alias("doc"))
    return files.filter(is_kind(F.col("doc"), "OBJECT"))


def read_manifests(spark: SparkSession, path: str, whole: bool = True, arms: Arms = ARMS) -> DataFrame:
    """Tasks of ``{"tasks": [...]}`` documents in their order: ``file, pos, task_id`` and the task's fields.

    The prompt of the older form, one per arm, is the first arm's, else the second's. A document without
    tasks has no rows; entries without an id are left out.
    """
    one, two = arms.baseline_provider, arms.candidate_provider
    tasks = _documents(spark, path, whole).select("file", F.posexplode(F.try_variant_get("doc", "$.tasks", "array<variant>")).alias("pos", "t"))
    text = lambda name: F.try_variant_get("t", f"$.{name}", "string")
    listed = lambda name: F.coalesce(
        F.transform(F.try_variant_get("t", f"$.{name}", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string")), F.array().cast("array<string>")
    )
    plain = {n: F.coalesce(text(n), F.lit(d)) for n, d in (
        ("project_path", ""), ("clone_method", "git"), ("task_type", ""), ("domain", ""), ("language", ""), ("bad_pattern", ""),
        ("task_title", ""), ("task_description", ""),
    )}
    return tasks.filter(text("id").isNotNull()).select(
        "file", "pos", text("id").alias("task_id"), *[c.alias(n) for n, c in plain.items()],
        F.coalesce(text("prompt"), text(f"prompt_{one}"), text(f"prompt_{two}"), F.lit("")).alias("prompt"),
        listed(f"followups_{one}").alias(f"{arms.baseline}_followups"), listed(f"followups_{two}").alias(f"{arms.candidate}_followups"),
        listed("acceptance_criteria").alias("acceptance_criteria"),
    )


def read_submission(spark: SparkSession, path: str, arms: Arms = ARMS) -> DataFrame:
    """Published rows under internal names; of an id the last row counts, rows without an id do not.

    A byte order mark before the header is passed over; columns that a file lacks are null. Order is that of files by name and of
    rows in them. One aggregation, so an id repeated very often is combined before the shuffle.
    """
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rows = rows.withColumnsRenamed({c: c.lstrip("﻿") for c in rows.columns if c.startswith("﻿")})
    names = {"baseline": arms.baseline, "candidate": arms.candidate}
    have = {internal: header.format(**names) for internal, header in C.SUBMISSION_HEADERS.items()}
    own = [(F.col(f"`{h}`") if h in rows.columns else F.lit(None).cast("string")).alias(i) for i, h in have.items()]
    placed = rows.select(
        *own, F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")).alias("_at")
    ).filter(F.coalesce("id", F.lit("")) != "")
    values = [c for c in have if c != "id"]
    last = placed.groupBy("id").agg(F.max_by(F.struct(*values), "_at").alias("_r"))
    return last.select("id", *[F.col(f"_r.{c}").alias(c) for c in values])


def weight_rows(sheet: DataFrame, key: str = "task_type") -> DataFrame:
    """Rows of a weight sheet ``nr, task_type, domain, language, count`` that are data: a number first, and no empty key."""
    filled = [F.coalesce(strip(F.col(c)), F.lit("")) != "" for c in (key, "domain", "language")]
    good = F.expr("try_cast(nr AS double)").isNotNull()
    for f in filled:
        good = good & f
    return sheet.filter(good).select(
        *[strip(F.col(c)).alias(c) for c in (key, "domain", "language")], F.coalesce(F.expr("try_cast(count AS double)"), F.lit(0.0)).alias("count")
    )


#: Projects in one written document.
CHUNK = 1000


def write_pool(pool: DataFrame, needed: DataFrame, path: str, header: Mapping[str, str] | None = None) -> None:
    """Write a pool as JSON documents, a line each: ``{key: {"needed", "from", "repos": [...]}}``, at most ``CHUNK`` projects in one.

    ``pool`` has ``key, repo, pos`` and any further fields of a project, ``needed`` has ``key, needed``. The header's fields, under
    names with ``_`` before them, come as a document of their own.
    """
    fields = [c for c in pool.columns if c not in ("key", "pos")]
    ranked = row_numbers(pool, ["key"], ["pos", "repo"], "_rank").withColumn("_chunk", F.expr(f"(_rank - 1) div {CHUNK}"))
    chunks = ranked.groupBy("key", "_chunk").agg(F.array_sort(F.collect_list(F.struct("_rank", *fields))).alias("_r"))
    body = F.struct("needed", (F.col("_chunk") * CHUNK).alias("from"), F.transform("_r", lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias("repos"))
    lines = chunks.join(needed, "key", "left").select(F.to_json(F.create_map("key", body)).alias("value"))
    if header:
        lines = lines.union(pool.sparkSession.range(1).select(F.to_json(F.create_map(*[x for k, v in header.items() for x in (F.lit(f"_{k}"), F.lit(str(v)))]))))
    lines.write.mode("overwrite").text(path)


def read_pool(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Projects of pool documents: ``key, needed, pos, repo, clone_url, description, stars``; names with ``_`` before them are no keys.

    ``whole``: a file is one document, however it is laid out; else a line is. A project is an object or just its name.
    """
    keys = _documents(spark, path, whole).select(F.inline(_entries(F.col("doc"))).alias("key", "v")).filter(~F.startswith("key", F.lit("_")))
    get = lambda v, name, kind: F.try_variant_get(v, f"$.{name}", kind)
    rows = keys.select(
        "key", get("v", "needed", "bigint").alias("needed"), F.coalesce(get("v", "from", "bigint"), F.lit(0)).alias("_from"),
        F.posexplode(get("v", "repos", "array<variant>")).alias("_at", "r"),
    )
    name = F.coalesce(get("r", "full_name", "string"), get("r", "repo", "string"), F.when(is_kind(F.col("r"), "STRING"), F.try_variant_get("r", "$", "string")))
    return rows.select(
        "key", "needed", (F.col("_from") + F.col("_at")).alias("pos"), name.alias("repo"),
        *[get("r", n, t).alias(n) for n, t in (("clone_url", "string"), ("description", "string"), ("stars", "bigint"))],
    )


def write_assignments(assigned: DataFrame, path: str, header: Mapping[str, str] | None = None) -> None:
    """Write who has which projects as JSON documents, a line each: ``{"assignments": {person: {key: [repo, ...]}}}``.

    ``assigned`` has ``person, key, repo, rank``; a document holds at most ``CHUNK`` projects, in order of rank. The header has the fields given and
    ``_total_assigned``.
    """
    ranked = row_numbers(assigned, ["person", "key"], ["rank", "repo"], "_rank").withColumn("_chunk", F.expr(f"(_rank - 1) div {CHUNK}"))
    chunks = ranked.groupBy("person", "key", "_chunk").agg(F.array_sort(F.collect_list(F.struct("_rank", "repo"))).alias("_r"))
    repos = F.transform("_r", lambda r: r["repo"].cast("string"))
    one = F.struct(F.create_map(F.col("person").cast("string"), F.create_map(F.col("key").cast("string"), repos)).alias("assignments"), (F.col("_chunk") * CHUNK).alias("from"))
    total = assigned.agg(F.count(F.lit(1)).alias("_total_assigned"))
    fields = [F.lit(str(v)).alias(f"_{k}") for k, v in (header or {}).items()]
    chunks.select(F.to_json(one).alias("value")).union(total.select(F.to_json(F.struct(*fields, "_total_assigned")))).write.mode("overwrite").text(path)


def read_assignments(spark: SparkSession, path: str, whole: bool = False, person: str | None = None) -> DataFrame:
    """Assigned projects: ``person, key, pos, repo``, of all people or one. A person without assignments has no rows."""
    docs = _documents(spark, path, whole).select(
        F.coalesce(F.try_variant_get("doc", "$.from", "bigint"), F.lit(0)).alias("_from"), F.try_variant_get("doc", "$.assignments", "variant").alias("a")
    )
    people = docs.select("_from", F.inline(_entries(F.col("a"))).alias("person", "v"))
    if person is not None:
        people = people.filter(F.col("person") == person)
    keys = people.select("_from", "person", F.inline(_entries(F.col("v"))).alias("key", "v"))
    rows = keys.select("_from", "person", "key", F.posexplode(F.try_variant_get("v", "$", "array<variant>")).alias("_at", "r"))
    return rows.select("person", "key", (F.col("_from") + F.col("_at")).alias("pos"), F.try_variant_get("r", "$", "string").alias("repo"))


# Labels of the metadata format.
METADATA_FIELDS = {
    "project_path": r"(?d)Project path:(?U)\s*(.+)", "task_type": r"(?d)Task type:(?U)\s*(.+)", "domain": r"(?d)Application domain:(?U)\s*(.+)",
    "language": r"(?d)Language:(?U)\s*(.+)", "task_title": r"(?d)- Title:(?U)\s*(.+)", "task_description": r"(?d)- Description:(?U)\s*(.+)",
    "project_summary": r"(?s)## Project Summary\s*\n```text\n(.+?)\n```",
}
METADATA_BLOCKS = {
    "prompts": r"(?s)Initial prompt:\s*\n```text\n(.+?)\n```[^\S\n]*(?:\n|\z)",
    "followups": r"(?s)Follow-up summary:\s*\n```text\n(.+?)\n```[^\S\n]*(?:\n|\z)",
}
METADATA_CRITERIA = r"(?d)- Acceptance criteria:\n((?:\s++- .+\n?)+)"


def metadata_fields(files: DataFrame, text: str = "text") -> DataFrame:
    """Add the fields of task metadata, texts with labelled lines and fenced blocks; null where there is none.

    Several blocks of a kind, and the acceptance criteria, are joined with `` | ``; the project's name is the last part
    of its path; without a description the first prompt takes its place.
    """
    body = F.col(text)
    one = {n: F.nullif(strip(F.regexp_extract(body, p, 1)), F.lit("")) for n, p in METADATA_FIELDS.items()}
    lists = {n: F.transform(F.regexp_extract_all(body, F.lit(p), F.lit(1)), strip) for n, p in METADATA_BLOCKS.items()}
    joined = {n: F.when(F.size(c) > 0, F.array_join(c, " | ")) for n, c in lists.items()}
    # Each item without the signs and blanks before it.
    items = F.transform(F.split(strip(F.regexp_extract(body, METADATA_CRITERIA, 1)), "\n"), lambda x: F.ltrim(strip(x), F.lit("- ")))
    criteria = F.when(F.regexp_extract(body, METADATA_CRITERIA, 1) != "", F.array_join(items, " | "))
    out = files.withColumns({**one, **joined, "acceptance_criteria": criteria})
    parts = F.split(F.rtrim("project_path", F.lit("/" + BLANKS)), r"[/\\]")
    return out.withColumns({
        "project_name": F.when(F.col("project_path").isNotNull(), F.element_at(parts, -1)),
        "task_description": F.coalesce("task_description", F.get(lists["prompts"], F.lit(0))),
    })


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata files, one per task, with their fields: ``file, task_id`` (the file's name) and :func:`metadata_fields`."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.regexp_replace("_metadata.file_name", r"\.[^.]*\z", "").alias("task_id"), F.make_valid_utf8("value").alias("text")
    )
    return metadata_fields(files).drop("text")

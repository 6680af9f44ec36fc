"""Session log files: their listing, and the sessions named in their first lines."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines of a file in which its session is looked for.
HEAD_LINES = 50
#: Bytes that are read from a file at once.
STEP = 1 << 16


def session_files(spark: SparkSession, path: str, suffix: str = ".jsonl") -> DataFrame:
    """The files of a folder and of those in it: ``file, slug, stem, mtime, size``.

    ``slug`` is the folder a file lies in, ``stem`` its name without the suffix, ``mtime`` seconds. Only the listing
    is read, no content; empty files are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return files.select(
        F.col("path").alias("file"), F.try_element_at(parts, F.lit(-2)).alias("slug"),
        F.left(name, F.length(name) - len(suffix)).alias("stem"),
        F.col("modificationTime").cast("double").alias("mtime"), F.col("length").alias("size"),
    )


def _first_lines(stream, lines: int) -> Iterator[bytes]:
    """Up to so many lines, reading no further than the block that ends the last of them."""
    rest, given = b"", 0
    while given < lines:
        block = stream.read(STEP)
        if not block:
            if rest:
                yield rest
            return
        *whole, rest = (rest + block).split(b"\n")
        for line in whole[: lines - given]:
            given += 1
            yield line


def head_sessions(files: DataFrame, lines: int = HEAD_LINES) -> DataFrame:
    """Sessions named in the first ``lines`` lines of every file: ``file, session`` (distinct), and ``read``, the bytes read.

    Blank lines count; what is no JSON object, and bytes that are no UTF-8, are passed over. A file without a session in its head has one row
    with a null session. The rest of a file is not read. Files lie in any store that Arrow can open.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file in batch.column("file").to_pylist():
                store, path = fs.FileSystem.from_uri(file)
                found: dict[str, None] = {}
                with store.open_input_file(path) as stream:
                    for line in _first_lines(stream, lines):
                        try:
                            event = json.loads(line.decode("utf-8", "replace"))
                        except ValueError:
                            continue
                        session = event.get("sessionId") if isinstance(event, dict) else None
                        if isinstance(session, str) and session:
                            found[session] = None
                    read = stream.tell()
                out += [(file, s, read) for s in found or [None]]
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                names=["file", "session", "read"],
            )

    tasks = 4 * int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("file").repartition(tasks, "file").mapInArrow(run, "file string, session string, read bigint")


def known_files(files: DataFrame, lines: int = HEAD_LINES) -> DataFrame:
    """Files with the sessions they belong to, by name or by head, as ``files_of_runs`` takes them: ``slug, file, session, mtime``.

    A file has a row for its stem and one for every other session in its head.
    """
    heads = head_sessions(files, lines).filter("session IS NOT NULL").join(files, "file").select("slug", "file", "session", "mtime")
    return files.select("slug", "file", F.col("stem").alias("session"), "mtime").union(heads).distinct()

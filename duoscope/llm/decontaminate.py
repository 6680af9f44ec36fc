"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.llm.common import ALNUM, HashFilter, runs_of, stored, text_chunks, trimmed, word_hashes, word_spans

WINDOW = 10
SHINGLE = 3
SALTS = 16

WINDOWS = "item_id string, win string, n int, shingles array<bigint>"
COUNTS = "shingle bigint, freq bigint"
FOUND = "_key {kind}, n_words bigint, found array<struct<shingle:bigint,pos:bigint,first:bigint,context:string>>"


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    folded = ALNUM.fold[data].tobytes()
    return [folded[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]


def _item_windows(window: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column("item_id"), 0
            out: list[tuple] = []
            for first, last, data, offsets in text_chunks(batch.column("text")):
                starts, ends, rows = word_spans(data, offsets, ALNUM)
                hashes = word_hashes(data, starts, ends, ALNUM)
                words = _words(data, starts, ends)
                for i in range(last - first):
                    a, b = int(rows[i]), int(rows[i + 1])
                    n = min(window, b - a)
                    size = min(shingle, n)
                    for p in range(a, b - n + 1) if n else ():
                        runs = runs_of(hashes[p : p + n], size).view(np.int64)
                        out.append((ids[at + i].as_py(), " ".join(words[p : p + n]), n, runs.tolist()))
                at += last - first
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "win", "n", "shingles"]
            )

    return run


def _hits(hashes: np.ndarray, rows: np.ndarray, sizes: list[int], wanted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of wanted shingles that lie inside one row, with their hashes."""
    ends = np.repeat(rows[1:], np.diff(rows))
    for size in sizes:
        runs = runs_of(hashes, size)
        at = np.flatnonzero(wanted(runs) & (np.arange(len(runs)) + size <= ends[: len(runs)]))
        yield at, runs[at]


def _frequencies(sizes: list[int], wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for _, _, data, offsets in text_chunks(batch.column("text")):
                starts, ends, rows = word_spans(data, offsets, ALNUM)
                hashes = word_hashes(data, starts, ends, ALNUM)
                found += [h for _, h in _hits(hashes, rows, sizes, wanted)]
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["shingle", "freq"])

    return run


def _candidates(sizes: list[int], wanted, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("shingle", pa.int64()), ("pos", pa.int64()), ("first", pa.int64()), ("context", pa.string())]))
        for batch in batches:
            keys, at = batch.column("_key"), 0
            for first, last, data, offsets in text_chunks(batch.column("text")):
                starts, ends, rows = word_spans(data, offsets, ALNUM)
                hashes = word_hashes(data, starts, ends, ALNUM)
                folded = ALNUM.fold[data].tobytes()
                found: list[list] = [[] for _ in range(last - first)]
                for places, values in _hits(hashes, rows, sizes, wanted):
                    owners = np.searchsorted(rows, places, side="right") - 1
                    for p, h, row in zip(places.tolist(), values.view(np.int64).tolist(), owners.tolist()):
                        a, b = int(rows[row]), int(rows[row + 1])
                        # All windows that can hold this shingle lie within these words.
                        lo, hi = max(a, p - window + 1), min(b, p + window)
                        text = b" ".join(folded[s:e] for s, e in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist()))
                        found[row].append({"shingle": h, "pos": p - a, "first": lo - a, "context": text.decode("utf-8", "replace")})
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, last - first), pa.array(np.diff(rows).astype(np.int64)), pa.array(found, kind)],
                    names=["_key", "n_words", "found"],
                )
                at += last - first

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
    key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: ``key, n_words, n_hit, n_items, items, contaminated``.

    A window is ``window`` consecutive words of an item, or a shorter item as a
    whole. It occurs in a document only if all its shingles do, so the rarest of
    them is a sufficient prefix: shingles are counted over all documents, each
    window is filed under its rarest one (or dropped when one of its shingles never occurs), and the
    documents' occurrences of just these shingles are joined with the windows.
    The shingle's offset fixes where the window would lie; it must lie inside the document, and its
    words must equal the document's there.

    ``n_hit`` counts document words inside any occurrence, ``items`` is the
    sorted list of ids (as text) whose windows occur. Null texts have no words; items without
    words and null item ids match nothing. Equal documents and items are each judged for
    themselves. Empty tables give empty results or no hits; other columns are
    ignored.
    """
    spark = docs.sparkSession
    windows = stored(
        benchmark.filter(F.col(item).isNotNull())
        .select(F.col(item).cast("string").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
        .mapInArrow(_item_windows(window, shingle), WINDOWS),
        "leaks",
    )
    unique = windows.groupBy("win", "n", "shingles").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    sizes = sorted(
        r[0] for r in windows.select(F.least(F.lit(shingle), F.col("n")).alias("s")).distinct().collect()
    )  # at most ``shingle`` values
    rows = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    vocabulary = windows.select(F.explode("shingles").alias("shingle")).distinct()
    wanted = HashFilter(spark, vocabulary)
    rarity = rows.select("text").mapInArrow(trimmed(_frequencies(sizes, wanted)), COUNTS).groupBy("shingle").agg(
        F.sum("freq").alias("freq")
    )
    # One row per window, under its rarest shingle.
    offered = unique.select("win", "n", "items", F.posexplode("shingles").alias("offset", "shingle"))
    ranked = offered.join(rarity, "shingle", "left").groupBy("win", "n", "items").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "shingle", "offset")).alias("best")
    )
    filed = stored(
        ranked.filter("best.freq > 0").select("win", "n", "items", "best.shingle", "best.offset"), "leaks"
    )
    wanted.close()
    prefix = HashFilter(spark, filed.select("shingle").distinct())
    kind = dict(rows.dtypes)["_key"]
    # Row numbers stay as they are once the rows are written.
    found = stored(
        rows.mapInArrow(trimmed(_candidates(sizes, prefix, window)), FOUND.format(kind=kind))
        .withColumn("uid", F.monotonically_increasing_id()),
        "leaks",
    )
    prefix.close()
    spread = F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int")
    seen = found.select("uid", "n_words", F.inline("found")).withColumn("salt", spread)
    under = filed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    start = F.col("pos") - F.col("offset")
    there = F.array_join(F.slice(F.split("context", " "), (start - F.col("first") + 1).cast("int"), F.col("n")), " ")
    inside = (start >= F.col("first")) & (start + F.col("n") <= F.col("n_words"))
    hits = stored(
        seen.join(under, ["shingle", "salt"])
        .filter(inside)
        .filter(F.when(inside, there) == F.col("win"))
        .select("uid", start.alias("start"), (start + F.col("n")).alias("end"), "items"),
        "leaks",
    )
    before = W.partitionBy("uid").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    covered = (
        hits.select("uid", "start", "end").distinct()
        .withColumn("_reach", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("uid").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "_reach"))).alias("n_hit"))
    )
    items = (
        hits.select("uid", F.explode("items").alias("item")).distinct()
        .groupBy("uid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    judged = found.select("uid", "_key", "n_words").join(covered, "uid", "left").join(items, "uid", "left")
    return judged.select(
        F.col("_key").alias(key), "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contamination of all documents by the benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )

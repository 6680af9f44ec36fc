"""Order MinHash: signatures of a document that follow its text order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.llm.common import default_parts, mix64, order_bounds, seeded

#: Characters of a k-mer, tuples of a signature, k-mers of a tuple.
K = 5
TUPLES = 64
PER_TUPLE = 2

#: K-mers that are ranked in all orders at once.
BLOCK = 4096

_U = np.uint64
_MOST = np.uint32(0xFFFFFFFF)


def fingerprint(text: str, k: int = K, tuples: int = TUPLES, per_tuple: int = PER_TUPLE) -> np.ndarray:
    """``tuples`` 16-bit values; all 0 for an empty text, which has no k-mer.

    Each k-mer with its occurrence number gets one hash, and every tuple has an order of its own
    over all of them: the hash mixed with the tuple's seed. The ``per_tuple`` smallest of each order are put in
    text order and hashed together. A text shorter than k is one k-mer; one with fewer than ``per_tuple``
    k-mers has all of them in each tuple.
    """
    units = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
    n = len(units)
    if not n:
        return np.zeros(tuples, np.uint16)
    size = min(k, n)
    mixed = mix64(units + _U(size << 32))
    factors = seeded(size, 400 + size) | _U(1)
    m = n - size + 1
    kmers = mixed[:m] * factors[0]
    for j in range(1, size):
        kmers += mixed[j : j + m] * factors[j]
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    # Occurrence number: place of a k-mer among equal ones, which stand in text order.
    fresh = np.ones(m, bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    starts = np.flatnonzero(fresh)
    occurrence = np.arange(m) - np.repeat(starts, np.diff(np.append(starts, m)))
    hashes = np.empty(m, _U)
    hashes[order] = mix64(ranked + occurrence.astype(_U) * _U(0xD6E8FEB86659FD93))
    places = np.sort(_smallest((hashes >> _U(32)).astype(np.uint32), tuples, min(per_tuple, m)), axis=1)
    chosen = hashes[places] ^ np.arange(1, places.shape[1] + 1).astype(_U) * _U(0x9E3779B97F4A7C15)
    sums = mix64(chosen).sum(axis=1, dtype=_U)
    return np.maximum(mix64(sums) >> _U(48), _U(1)).astype(np.uint16)


def _smallest(hashes: np.ndarray, tuples: int, count: int) -> np.ndarray:
    """Places of the ``count`` smallest of all hashes in each tuple's own order (of equal ones the first in the text)."""
    seeds = (seeded(tuples, 64) >> _U(32)).astype(np.uint32)[:, None]
    rows = np.arange(tuples)
    best, where = np.zeros((tuples, 0), np.uint32), np.zeros((tuples, 0), np.int64)
    room = np.empty((2, tuples * min(BLOCK, len(hashes))), np.uint32)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[None, at : at + BLOCK]
        x, high = (part[: tuples * block.shape[1]].reshape(tuples, -1) for part in room)
        np.bitwise_xor(block, seeds, out=x)
        x *= np.uint32(0x85EBCA6B)
        x ^= np.right_shift(x, np.uint32(15), out=high)
        x *= np.uint32(0xC2B2AE35)
        x ^= np.right_shift(x, np.uint32(16), out=high)
        values, places = [best], [where]
        for _ in range(min(count, x.shape[1])):
            p = x.argmin(axis=1)
            values.append(x[rows, p][:, None])
            places.append(p[:, None] + at)
            x[rows, p] = _MOST
        best, where = np.concatenate(values, axis=1), np.concatenate(places, axis=1)
        if best.shape[1] > count:
            keep = np.argsort(best, axis=1, kind="stable")[:, :count]
            best, where = np.take_along_axis(best, keep, 1), np.take_along_axis(where, keep, 1)
    return where


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal tuples among those that either text fills; 1 for two empty texts."""
    either = (a != 0) | (b != 0)
    n = int(either.sum())
    return float(((a == b) & either).sum() / n) if n else 1.0


def _hex(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def _bytes(values: np.ndarray) -> bytes:
    return values.astype(">u2").tobytes()


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            prints = [_hex(fingerprint(t)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], names=[*batch.schema.names, "fingerprint"])


_PACKED = "part int, packed binary, print binary"


def _part_of(bounds: np.ndarray):
    """Part of each id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("doc_id")
            parts = np.searchsorted(bounds, keys.fill_null(np.iinfo(np.int64).min).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([keys, pa.array(parts, pa.int32())], names=["doc_id", "part"])

    return run


def _packed(bounds: np.ndarray | None):
    """Texts and fingerprints as few bytes as possible, for they go through the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts = batch.column("_text").to_pylist()
                if bounds is None:
                    parts = batch.column("part")
                else:
                    keys = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
                    parts = pa.array(np.searchsorted(bounds, keys, side="right"), pa.int32())
                columns = {
                    "part": parts,
                    "packed": pa.array([pack(t.encode("utf-8")) for t in texts], pa.binary()),
                    "print": pa.array([_bytes(fingerprint(t)) for t in texts], pa.binary()),
                }
                if bounds is not None:
                    columns = {"doc_id": batch.column("doc_id")} | columns
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint`` (hex text) to every document.

    Null texts count as empty; an empty text has a fingerprint of zeros; equal
    texts have equal fingerprints. An existing column of that name is replaced.
    """
    own = [c for c in docs.columns if c not in ("fingerprint", "_text")]
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in own), "_text string, fingerprint string"])
    body = F.coalesce(F.col(text), F.lit("")).alias("_text")
    return docs.select(*own, body).mapInArrow(_prints, schema).drop("_text")


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``doc_id, packed, print, next_packed, next_print`` in descending doc_id order (texts zstd-compressed).

    The next of the last document is the first. Ranges of doc_id form parts that
    are sorted by themselves; only the first document of each part is carried
    over to the part before it. Equal ids follow each other by their packed text; null ids come last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))
    n = parts or default_parts(spark, rows.count())
    bounds = order_bounds(rows, "doc_id", n)
    printed = rows.mapInArrow(_packed(bounds), f"doc_id bigint, {_PACKED}")
    order = W.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), "packed")
    head = F.struct("packed", "print")
    inside = printed.select("*", F.lead(head).over(order).alias("_next"))
    # First document of each part: as many rows as there are parts.
    tops = rows.select("doc_id").mapInArrow(_part_of(bounds), "doc_id bigint, part int").groupBy("part").agg(F.max("doc_id").alias("doc_id"))
    heads = (
        rows.join(F.broadcast(tops.select(F.col("doc_id").alias("_top"), "part")), F.col("doc_id").eqNullSafe(F.col("_top")))
        .select("part", "_text").mapInArrow(_packed(None), _PACKED)
        .groupBy("part").agg(F.min(head).alias("x")).select("part", F.struct("x.packed", "x.print").alias("_wrap"))
    )
    # Which part follows which is found on the numbers alone; texts only meet the part before them.
    across = W.orderBy(F.col("part").desc())
    whole = across.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    follows = tops.select("part", F.coalesce(F.lead("part").over(across), F.first("part").over(whole)).alias("_after"))
    following = follows.join(heads.withColumnRenamed("part", "_after"), "_after").select("part", "_wrap")
    after = F.coalesce("_next", "_wrap")
    # The window has dealt and sorted its rows by part already, so only the heads move.
    return inside.join(following, "part").select(
        "doc_id", "packed", "print", after["packed"].alias("next_packed"), after["print"].alias("next_print")
    )


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    names = ("doc_id", "packed", "print", "next_packed", "next_print")
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            out = []
            for doc_id, packed, own, after, other in zip(*(batch.column(c).to_pylist() for c in names)):
                text = unpack(packed).decode("utf-8")
                cut = len(text) // 3
                edited = text[: len(text) - cut] + (unpack(after).decode("utf-8")[:cut] if cut else "")
                mine, changed = np.frombuffer(own, ">u2"), fingerprint(edited)
                out.append((
                    doc_id, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), own.hex(), _hex(changed),
                    likeness(mine, changed), likeness(mine, np.frombuffer(other, ">u2")),
                ))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[f.split()[0] for f in _RESULT.split(", ")]
            )


def op4_order_minhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and the likeness of both."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_next(docs).mapInArrow(_edited, _RESULT)

"""Helpers shared by the operators: folds, order parts, vectorised word hashing, bit-table filters."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.storage import shared_dir, stored  # noqa: F401  (for the operators)

#: Bytes of text that a vectorised step handles at once; one longer text is a step of its own.
CHUNK_BYTES = 1 << 20


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def held_out(doc_id: Column) -> Column:
    return crc_fold(doc_id) == 0


def order_bounds(df: DataFrame, key: str, parts: int) -> np.ndarray:
    """At most ``parts - 1`` ascending values that cut the key's range into like counts.

    Only these values reach the driver. Any bounds give right results; the
    approximate quantiles only make the parts alike in size.
    """
    if parts < 2:
        return np.array([], dtype=np.int64)
    shares = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(key, shares, 20 * parts).alias("cuts")).first()["cuts"]
    return np.unique(np.array(cuts or [], dtype=np.int64))


def default_parts(spark: SparkSession, rows: int, rows_per_part: int = 20_000, most: int = 20_000) -> int:
    """Parts of an ordered table: by rows, at least two per shuffle partition.

    There are at most ``most`` of them, so that their bounds stay a small list; beyond that parts grow, and
    their sorts spill.
    """
    return min(most, max(rows // rows_per_part + 1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def trim() -> None:
    """Give memory that is free in this process back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def trimmed(step):
    """A ``mapInArrow`` step after which a worker, which waits for its next task, keeps no free memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            trim()

    return run


# ---- vectorised hashing of words in Arrow string arrays -------------------------------------

_U = np.uint64
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed * 2 + 1))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        for name, b in (("up", base), ("down", inverse)):
            steps = np.full(size, _U(b))
            steps[0] = _U(1)
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class WordKind:
    """Which bytes form words, and how they are folded. Separators are ASCII bytes."""

    def __init__(self, separators: set[int]):
        self.is_word = np.ones(256, dtype=bool)
        self.is_word[list(separators)] = False
        fold = np.arange(256)
        fold[65:91] += 32
        self.fold = fold.astype(np.uint8)
        self.values = seeded(256, 7)[fold]
        self.values[~self.is_word] = 0


#: Words are runs of anything but white space.
SPACED = WordKind({0x20, *range(0x09, 0x0E)})
#: Words are runs of digits, letters and everything beyond ASCII (A-Z count as a-z).
ALNUM = WordKind({*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of rows: (first, last + 1, UTF-8 bytes, row offsets in them)."""
    texts = texts.fill_null("").cast(pa.large_string())
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: WordKind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per row the index of its first word (one more at the end)."""
    word = kind.is_word[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: WordKind) -> np.ndarray:
    """64-bit hash of each word's folded bytes, from one running sum over the chunk."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(kind.values[data] * up[: len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts])


def runs_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words (len - size + 1 values; rows are not respected)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    factors = seeded(size, 1000 + size) | _U(1)
    out = hashes[:n] * factors[0]
    for j in range(1, size):
        out = out + hashes[j : j + n] * factors[j]
    return mix64(out)


#: Bits of a filter: 2**14 to 2**27 (16 MB), by the number of hashes.
FILTER_BITS = (14, 27)


#: Bits of a filter that one row brings to the driver.
_BLOCK_BITS = 17


def _filter_blocks(bits: int):
    """Per block of the table its bits; the slots of a block come together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << min(bits, _BLOCK_BITS)
        at, block = None, np.zeros(size, bool)

        def row():
            packed = np.packbits(block, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([packed], pa.binary())], names=["block", "bits"])

        for batch in batches:
            slots = batch.column("slot").to_numpy()
            for b in np.unique(slots >> _BLOCK_BITS).tolist():
                if b != at:
                    if at is not None:
                        yield row()
                    at, block = b, np.zeros(size, bool)
                block[slots[slots >> _BLOCK_BITS == b] & (size - 1)] = True
        if at is not None:
            yield row()

    return run


class HashFilter:
    """A broadcast bit table of 64-bit hashes: never a false negative, of bounded size.

    ``hashes`` has one column of distinct values. With very many of them the table fills up
    and lets more pass; what passes is compared exactly by the caller. The table is put together in blocks where the
    hashes are; at most 16 MB of bits come to the driver. ``close`` frees it.
    """

    def __init__(self, spark: SparkSession, hashes: DataFrame):
        low, high = FILTER_BITS
        bits = min(high, max(low, int(hashes.count() * 16).bit_length()))
        slot = F.col(hashes.columns[0]).bitwiseAND(F.lit((1 << bits) - 1)).alias("slot")
        dealt = hashes.select(slot).repartition(F.shiftright("slot", _BLOCK_BITS)).sortWithinPartitions("slot")
        table = np.zeros((1 << bits) // 64, np.uint64)
        blocks = dealt.mapInArrow(_filter_blocks(bits), "block bigint, bits binary").toArrow()
        for block, packed in zip(blocks.column("block").to_pylist(), blocks.column("bits")):
            words = np.frombuffer(packed.as_buffer(), np.uint64)
            table[block << (_BLOCK_BITS - 6) :][: len(words)] = words
        self.mask = np.uint64((1 << bits) - 1)
        self.table = spark.sparkContext.broadcast(table)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & self.mask
        return (self.table.value[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    def close(self) -> None:
        """Free the table, once all that uses it is written."""
        self.table.destroy()

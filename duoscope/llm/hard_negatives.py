"""Hard negatives of anchors: exact bounded top-k searches by inner product with coordinate pruning.

All rows are sorted by length and cut into buckets, whose rows have like lengths; a bucket keeps a sorted list of every
coordinate of its normalised vectors. A search with a least score (the bound it was given, or its k-th best so far) leaves out buckets
whose lengths cannot reach it. In the others each *focus coordinate* of the anchor, one of its largest, gives a feasible
range of values; the ranges cut from the sorted lists are intersected, and what is left is scored exactly. Where no
range is narrow, which random vectors of many dimensions make common, the whole bucket is scored at once.

Anchors are worked off in blocks of bounded size that are broadcast, one job each over all rows. A task returns only its
best rows of each search.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.llm.common import stored

#: Rows of a bucket; a bucket's shortest row has at least this share of its longest row's length.
BUCKET_ROWS, BUCKET_SHARE = 4096, 0.9
#: Coordinates looked at per anchor, and the share of a bucket below which a range counts as narrow.
FOCUS, NARROW = 4, 0.1
#: Bytes of the vectors in a broadcast block of anchors, and anchors scored at once.
BLOCK_BYTES, STEP = 32 << 20, 256
#: Scores beyond this bound count as the bound, so that 100 times a score fits a long.
LARGEST = 9 * 10**16
_NONE = np.iinfo(np.int64).max


@dataclass
class Searches:
    """A block of anchors and, per anchor, up to m searches in rows of its own label or of the others.

    ``low`` and ``high`` bound the scores that count (both included); a search that is not used has ``low`` above ``high``.
    """

    uid: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of two sets of integral vectors."""
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]  # a shorter vector counts as filled up with zeros
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(n, 1)
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    if most < 2**62:
        return np.clip(a.astype(np.int64) @ b.T.astype(np.int64), -LARGEST, LARGEST)
    whole = [[int(x) for x in row] for row in b]
    return np.array(
        [[max(-LARGEST, min(LARGEST, sum(x * y for x, y in zip(map(int, row), other)))) for other in whole] for row in a], np.int64
    ).reshape(len(a), len(b))


class Bucket:
    """Rows of like length with sorted coordinate lists."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray):
        self.vectors, self.longest = vectors, float(lengths.max(initial=0))
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.lists = np.take_along_axis(unit, self.order, axis=0)

    def feasible(self, anchors: np.ndarray, lengths: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, list]:
        """Which anchors may have a row with a score of ``low`` at least, and the rows of those with a narrow range.

        The second is, per anchor, None (any row) or the places of the rows inside all its ranges.
        """
        n, dims = len(self.vectors), min(anchors.shape[1], self.vectors.shape[1])
        reach = lengths * self.longest
        bounded = low > 0
        # A little below the least cosine, for rounding.
        cosine = np.where(bounded, low / np.where(reach > 0, reach, 1) - 1e-9, -1.0)
        possible = ~bounded | ((reach > 0) & (cosine <= 1))
        found: list = [None] * len(anchors)
        todo = np.flatnonzero(possible & bounded & (cosine > 0))
        if not len(todo) or not dims:
            return possible, found
        unit = anchors[todo, :dims] / lengths[todo, None]
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        q, c = np.take_along_axis(unit, focus, axis=1), np.minimum(cosine[todo], 1)[:, None]
        spread = np.sqrt((1 - c * c) * np.maximum(1 - q * q, 0))
        least = np.where(q <= -c, -1.0, q * c - spread) - 1e-9
        most = np.where(q >= c, 1.0, q * c + spread) + 1e-9
        first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus):
            mine = focus == f
            first[mine] = np.searchsorted(self.lists[:, f], least[mine], side="left")
            last[mine] = np.searchsorted(self.lists[:, f], most[mine], side="right")
        width = last - first
        for i in np.flatnonzero(width.min(axis=1) <= NARROW * n):
            inside = None
            for j in np.argsort(width[i]):
                rows = self.order[first[i, j] : last[i, j], focus[i, j]]
                inside = rows if inside is None else np.intersect1d(inside, rows)
            found[todo[i]] = inside
        return possible, found


class _Best:
    """The best rows of every search so far."""

    def __init__(self, s: Searches):
        self.s, self.low = s, s.low.copy()
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, search: np.ndarray, score: np.ndarray, vec_id: np.ndarray, known: np.ndarray, uid: np.ndarray) -> None:
        self.held.append((search, score, vec_id, known, uid))
        self.size += len(search)
        if self.size > 200_000:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Keep the k best of each search; from then on only better or equal scores are looked for."""
        if not self.held:
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        search, score, vec_id, known, uid = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((uid, vec_id, ~known, -score, search))
        search = search[order]
        first = np.flatnonzero(np.r_[True, search[1:] != search[:-1]])
        place = np.arange(len(search)) - np.repeat(first, np.diff(np.r_[first, len(search)]))
        keep = order[place < self.s.k]
        kth = order[place == self.s.k - 1]
        flat = self.low.reshape(-1)
        flat[search[place == self.s.k - 1]] = np.maximum(flat[search[place == self.s.k - 1]], score[kth])
        out = tuple(x[keep] for x in (np.concatenate([h[0] for h in self.held]), score, vec_id, known, uid))
        self.held, self.size = [out], len(keep)
        return out


def _search(block):
    """Best rows of each search among a task's rows, which come in descending length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Searches = block.value
        best = _Best(s)
        lengths = np.sqrt((s.vectors**2).sum(axis=1))
        for batch in batches:
            for bucket in _buckets(batch):
                _score_bucket(s, lengths, best, *bucket)
        search, score, vec_id, known, uid = best.settle()
        m = s.low.shape[1]
        yield pa.RecordBatch.from_arrays([
            pa.array(s.uid[search // m], pa.int64()), pa.array((search % m).astype(np.int32), pa.int32()), pa.array(score, pa.int64()),
            pa.array(vec_id, pa.int64(), mask=known == 0), pa.array(uid, pa.int64()),
        ], names=["anchor", "search", "score", "vec_id", "uid"])

    return run


def _buckets(batch: pa.RecordBatch):
    """(uid, vec_id, whether it is known, label, vectors, lengths) of consecutive rows of like length."""
    length = batch.column("length").to_numpy()
    at = 0
    while at < len(length):
        end = min(at + BUCKET_ROWS, len(length))
        alike = np.flatnonzero(length[at:end] < BUCKET_SHARE * length[at])
        end = at + int(alike[0]) if len(alike) else end
        rows = batch.slice(at, end - at)
        vectors = _matrix(rows.column("v"))
        ids = rows.column("vec_id")
        yield (
            rows.column("uid").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False),
            rows.column("label").to_numpy(), vectors, length[at:end],
        )
        at = end


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list array side by side, filled up with zeros."""
    sizes = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _score_bucket(s: Searches, lengths, best: _Best, uid, vec_id, known, label, vectors, row_lengths) -> None:
    bucket = Bucket(vectors, row_lengths)
    m = s.low.shape[1]
    for at in range(0, len(s.uid), STEP):
        part = slice(at, at + STEP)
        used = best.low[part] <= s.high[part]
        least = np.where(used, best.low[part], _NONE).min(axis=1)
        possible, narrow = bucket.feasible(s.vectors[part], lengths[part], least.astype(float))
        possible &= least < _NONE
        some = [i for i in np.flatnonzero(possible) if narrow[i] is not None]
        every = np.array([i for i in np.flatnonzero(possible) if narrow[i] is None], np.int64)
        for anchors, rows in [(every, np.arange(len(uid)))] + [(np.array([i]), np.sort(narrow[i])) for i in some]:
            if not len(anchors) or not len(rows):
                continue
            got = scores(s.vectors[at + anchors], vectors[rows])
            fits = (s.label[at + anchors, None] == label[rows]) == s.same
            fits &= s.uid[at + anchors, None] != uid[rows]
            for j in range(m):
                a, r = np.nonzero(fits & (got >= best.low[at + anchors, j, None]) & (got <= s.high[at + anchors, j, None]))
                if len(a):
                    hit = rows[r]
                    best.add((at + anchors[a]) * m + j, got[a, r], vec_id[hit], known[hit].astype(np.int64), uid[hit])
    best.settle()


def _best_rows(table: DataFrame, anchors: DataFrame, blocks: int, searches, k: int) -> DataFrame:
    """``anchor, search, rank, score, vec_id, uid`` of the k best rows of every search, block by block."""
    spark = table.sparkSession
    done = []
    for i in range(blocks):
        # At most BLOCK_BYTES of vectors.
        rows = anchors.filter(F.col("block") == i).toArrow().combine_chunks()
        if rows.num_rows == 0:
            continue
        block = spark.sparkContext.broadcast(searches(rows))
        found = table.mapInArrow(_search(block), "anchor bigint, search int, score bigint, vec_id bigint, uid bigint")
        order = W.partitionBy("anchor", "search").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        done.append(stored(ranked, "negatives"))
        block.destroy()
    out = spark.createDataFrame([], "anchor bigint, search int, score bigint, vec_id bigint, uid bigint, rank int")
    for d in done:
        out = out.unionByName(d)
    return out


def _column(rows: pa.Table, name: str) -> pa.Array:
    c = rows.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def _positives(k: int):
    def searches(rows: pa.Table) -> Searches:
        n = rows.num_rows
        return Searches(
            _column(rows, "uid").to_numpy(), _column(rows, "label").to_numpy(), _matrix(_column(rows, "v")),
            np.full((n, 1), -_NONE, np.int64), np.full((n, 1), _NONE - 1, np.int64), True, k,
        )

    return searches


def _negatives(positives: int, k: int, least: int, most: int):
    def searches(rows: pa.Table) -> Searches:
        low = np.full((rows.num_rows, positives), _NONE, np.int64)
        high = np.full((rows.num_rows, positives), -_NONE, np.int64)
        for i, mine in enumerate(_column(rows, "positives").to_pylist()):
            for p in mine or []:
                low[i, p["search"]] = -(-least * p["score"] // 100)
                high[i, p["search"]] = most * p["score"] // 100
        return Searches(
            _column(rows, "uid").to_numpy(), _column(rows, "label").to_numpy(), _matrix(_column(rows, "v")), low, high, False, k
        )

    return searches


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For every anchor and each of its nearest rows of the same label, the nearest rows of other labels inside a band.

    ``rows`` has ``vec_id``, ``label`` and ``v`` (a list of whole numbers, as doubles). A row's score is its inner
    product with the anchor, an integer; higher scores come first, then smaller ids. Positives are the first
    ``positives`` other rows of the anchor's label; negatives the first ``negatives`` rows of other labels with a
    score between ``least`` and ``most`` percent of the positive's. Returns ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    Rows with a null label or vector, or a null in it, take no part. Rows are told apart by themselves, not by their ids: of
    repeated rows each is another row than the anchor, and repeated anchors give a result each. Null ids come last among equal
    scores. A shorter vector counts as filled up with zeros. An anchor without positives or negatives, and an empty
    table, give no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    sound = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("v").cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter(
        F.col("label").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    )
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = stored(sound.withColumn("uid", F.monotonically_increasing_id()).withColumn("length", length), "vectors")
    table = stored(
        numbered.repartitionByRange(parts, F.desc("length"), "uid").sortWithinPartitions(F.desc("length"), "uid"), "vectors"
    )
    sizes = numbered.filter("is_anchor").agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = -(-sizes[0] * 8 * max(sizes[1] or 0, 1) // block_bytes)
    anchors = stored(
        numbered.filter("is_anchor").select("uid", "label", "v", "vec_id", F.pmod(F.xxhash64("uid"), F.lit(max(1, blocks))).alias("block")),
        "anchors",
    )
    near = _best_rows(table, anchors, blocks, _positives(positives), positives)
    by_anchor = near.groupBy("anchor").agg(F.collect_list(F.struct(
        (F.col("rank") - 1).alias("search"), "score", F.col("vec_id").alias("positive_id")
    )).alias("positives"))  # at most ``positives`` entries
    known = stored(
        anchors.join(by_anchor.withColumnRenamed("anchor", "uid"), "uid", "left"), "anchors"
    )
    found = _best_rows(table, known.select("uid", "label", "v", "positives", "block"), blocks, _negatives(positives, negatives, least, most), negatives)
    pairs = known.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.inline("positives"))
    return found.select("anchor", "search", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        pairs.withColumnRenamed("score", "positive_score"), ["anchor", "search"]
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 50, among all embeddings."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: _floored(256 * x.cast("double")))
    return hard_negatives(rows.select("vec_id", moved.alias("label"), whole.alias("v")), F.col("vec_id") % 50 == 0)


def _floored(x: Column) -> Column:
    """The floor as a double; from 2**62 on every double is whole."""
    return F.when(F.abs(x) < 2.0**62, F.floor(x).cast("double")).otherwise(x)


OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS vec_id, b.label AS label, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
      row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k
    FROM s WHERE own = label
  ) WHERE k <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.own <> s.label
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

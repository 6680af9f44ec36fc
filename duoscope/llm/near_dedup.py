"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import (
    SPACED, HashFilter, mix64, runs_of, seeded, stored, text_chunks, trimmed, word_hashes, word_spans,
)

SHINGLE = 5
#: A pair at 0.75 shares no band with probability (1 - 0.75**6)**48, below 1e-4.
BANDS, ROWS = 48, 6
HASHES = BANDS * ROWS
#: Low bits kept of each minimum; equal by chance with probability 2**-BITS.
BITS = 2
PACKED = -(-HASHES * BITS // 64)
#: Four deviations of the estimate at 0.75: pairs that lie further below it are not confirmed.
DEVIATIONS = 4
#: The finer signature of documents that are still apart in a bucket.
FINE_HASHES, FINE_BITS = 2048, 4
FINE_PACKED = FINE_HASHES * FINE_BITS // 64
#: Comparisons of signatures in one bucket that one task should do.
TASK_COMPARISONS = 4_000_000
#: Comparisons in all that are preferred to a round of pivots.
FEW_COMPARISONS = 500_000
PIVOT_ROUNDS = 2
#: Share of all rows from which on a class of equal sets is dealt out row by row.
HOT = 1 / 1000

_SIG = [f"s{i}" for i in range(PACKED)]
SKETCH = "doc bigint, n_shingles bigint, set_hi bigint, set_lo bigint, bands array<bigint>, " + ", ".join(
    f"{s} bigint" for s in _SIG
)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words is one shingle, a text without words has none.
    """
    for first, last, data, offsets in text_chunks(texts):
        starts, ends, rows = word_spans(data, offsets, SPACED)
        hashes = word_hashes(data, starts, ends, SPACED)
        runs = runs_of(hashes, size)
        for i in range(last - first):
            a, b = rows[i], rows[i + 1]
            if b - a >= size:
                yield np.unique(runs[a : b - size + 1])
            else:
                yield runs_of(hashes[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64)


def _minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 256):
        block = shingles[at : at + 256, None] * a
        block += b
        np.minimum(out, block.min(axis=0), out=out)
    return out


def _packed(minima: np.ndarray, bits: int, words: int) -> np.ndarray:
    """The low bits of each row's minima, packed into 64-bit words."""
    low = (mix64(minima) & np.uint64(2**bits - 1)).astype(np.uint8)
    out = np.zeros((len(minima), words * 64), np.uint8)
    for j in range(bits):
        out[:, j : minima.shape[1] * bits : bits] = (low >> j) & 1
    return np.packbits(out, axis=1, bitorder="little").view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = seeded(HASHES, 11) | np.uint64(1), seeded(HASHES, 12)
    factors = seeded(ROWS, 13) | np.uint64(1)
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            n = batch.num_rows
            minima = np.zeros((n, HASHES), np.uint64)
            counts = np.zeros(n, np.int64)
            sums = np.zeros((n, 2), np.uint64)
            for i, s in enumerate(shingle_sets(batch.column("text"))):
                counts[i] = len(s)
                if len(s):
                    minima[i] = _minima(s, a, b)
                    sums[i] = mix64(s).sum(), mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum()
                else:
                    sums[i] = mix64(np.array([at + i, i], np.uint64))
            banded = minima.reshape(n, BANDS, ROWS)
            keys = mix64((banded * factors).sum(axis=2, dtype=np.uint64) + seeded(BANDS, 14))
            packed = _packed(minima, BITS, PACKED)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, (n + 1) * BANDS, BANDS), pa.int32()), pa.array(keys.view(np.int64).ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(counts), pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].view(np.int64)), lists]
                + [pa.array(np.ascontiguousarray(packed[:, j])) for j in range(PACKED)],
                names=["doc", "n_shingles", "set_hi", "set_lo", "bands", *_SIG],
            )


def _chosen(batches: Iterator[pa.RecordBatch], wanted: HashFilter) -> Iterator[pa.RecordBatch]:
    """Rows whose id may be among the wanted ones."""
    for whole in batches:
        live = wanted(whole.column("hash").to_numpy().view(np.uint64))
        some = whole.filter(pa.array(live))
        for at in range(0, some.num_rows, 512):
            yield some.slice(at, 512)


def _full_sets(wanted: HashFilter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chosen(batches, wanted):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"))]
            ends = np.cumsum([0, *map(len, sets)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))],
                names=["doc", "shingles"],
            )

    return run


def _fine_signatures(wanted: HashFilter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = seeded(FINE_HASHES, 21) | np.uint64(1), seeded(FINE_HASHES, 22)
        for batch in _chosen(batches, wanted):
            minima = np.stack([_minima(s, a, b) for s in shingle_sets(batch.column("text"))])
            packed = _packed(minima, FINE_BITS, FINE_PACKED)
            ends = np.arange(0, (len(packed) + 1) * FINE_PACKED, FINE_PACKED)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(packed.ravel()))],
                names=["doc", "fine"],
            )

    return run


def _of_ids(texts: DataFrame, ids: DataFrame, step, schema: str) -> DataFrame:
    """Apply a step to the texts of some documents (and perhaps a few others).

    The ids are met as a bit table of bounded size where the texts are read, so texts are not shuffled.
    """
    wanted = HashFilter(texts.sparkSession, ids.select(F.xxhash64("doc").alias("hash")))
    out = stored(texts.withColumn("hash", F.xxhash64("doc")).mapInArrow(trimmed(step(wanted)), schema), "near")
    wanted.close()
    return out


def _differing(x: Column, bits: int) -> Column:
    """Number of slots of ``bits`` (2 or 4) bits that are not all zero."""
    any_bit = x
    for j in range(1, bits):
        any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, j))
    return F.bit_count(any_bit.bitwiseAND(F.lit(0x5555555555555555 if bits == 2 else 0x1111111111111111)))


def _matches(left: str, right: str) -> Column:
    """Number of equal slots of two packed signatures."""
    differ = F.lit(0)
    for s in _SIG:
        differ = differ + _differing(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}")), BITS)
    return F.lit(HASHES) - differ


def _floor(hashes: int, bits: int, percent: int) -> float:
    """Least number of equal slots that a pair at the threshold is likely to have.

    Slots are also equal by chance; the expected share at a similarity j is
    ``j + (1 - j) / 2**bits``.
    """
    share = percent / 100 + (1 - percent / 100) / 2**bits
    return hashes * share - DEVIATIONS * (hashes * share * (1 - share)) ** 0.5


def estimate(matches: Column, hashes: int = HASHES, bits: int = BITS) -> Column:
    """Similarity from the share of equal slots, less what chance makes equal."""
    by_chance = 2.0**-bits
    return (matches / hashes - by_chance) / (1 - by_chance)


def _similar(left: str, right: str, percent: int) -> Column:
    """Could this pair reach the threshold? By set sizes, then by estimate."""
    n, m = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (
        estimate(_matches(left, right)) >= estimate(F.lit(_floor(HASHES, BITS, percent)))
    )


def _finely_similar(left: str, right: str, percent: int) -> Column:
    slots = F.zip_with(f"{left}.fine", f"{right}.fine", lambda a, b: _differing(a.bitwiseXOR(b), FINE_BITS))
    matches = F.lit(FINE_HASHES) - F.aggregate(slots, F.lit(0), lambda n, x: n + x)
    return matches >= _floor(FINE_HASHES, FINE_BITS, percent)


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold.

    The sets of the b side are sent once per pair; those of the a side, which may
    stand in very many pairs, once per 512 of them, so no task gets more.
    """
    ids = pairs.select(F.col("a").alias("doc")).union(pairs.select("b"))
    sets = _of_ids(texts, ids, _full_sets, "doc bigint, shingles array<bigint>")
    often = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 512).cast("int").alias("salts"))
    left = often.join(sets.withColumnsRenamed({"doc": "a", "shingles": "set_a"}), "a").select(
        "a", "set_a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    right = (
        pairs.join(often, "a")
        .withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
        .join(sets.withColumnsRenamed({"doc": "b", "shingles": "set_b"}), "b")
    )
    common = F.size(F.array_intersect("set_a", "set_b"))
    linked = 100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)
    return stored(right.join(left, ["a", "salt"]).filter(linked).select("a", "b").distinct(), "near")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges (a, b); root is the smallest node reachable.

    Each round hooks every node to its smallest neighbour and follows these
    pointers, doubling their reach, to the roots; edges between different roots
    go into the next round. Nodes, edges and roots stay distributed.
    """
    spark = edges.sparkSession
    labels, rest = None, edges.filter("a <> b")
    while True:
        both = rest.select("a", "b").union(rest.select("b", "a"))
        parents = stored(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
            .select("node", F.least("node", "m").alias("root")),
            "near",
        )
        if parents.isEmpty():
            break
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = stored(
                parents.join(up, "root", "left").select(
                    "node", F.coalesce("next", "root").alias("root"), (F.col("next") < F.col("root")).alias("moved")
                ),
                "near",
            )
            parents = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = parents
        else:
            step = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = stored(
                labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "near"
            )
        a = parents.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = parents.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = stored(
            rest.join(a, "a").join(b, "b").filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "near",
        )
    return labels if labels is not None else spark.createDataFrame([], "node bigint, root bigint")


def _merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after further edges: the graph of their roots is solved and composed."""
    if labels is None:
        return components(edges)
    for end in ("a", "b"):
        edges = edges.join(labels.withColumnsRenamed({"node": end, "root": "r"}), end, "left").withColumn(
            end, F.coalesce("r", end)
        ).drop("r")
    step = components(stored(edges.filter("a <> b").distinct(), "near"))
    old = labels.join(step.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select(
        "node", F.coalesce("next", "root").alias("root")
    )
    return stored(old.unionByName(step.join(labels.select("node"), "node", "left_anti")), "near")


def _all_apart(opened: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """All pairs of one bucket in different components that could reach the threshold.

    ``opened`` has every bucket's members with their component. Those outside a bucket's
    largest component meet all its members; both signatures are compared inside
    the join, so only pairs that pass come out of it, and only from the first of the bands that they share. A bucket with much to compare is
    dealt over several tasks.
    """
    fine = _of_ids(texts, opened.select("doc"), _fine_signatures, "doc bigint, fine array<bigint>")
    salts = F.ceil(F.col("n") * F.col("minor") / TASK_COMPARISONS).cast("int")
    known = opened.withColumn("salts", salts).join(reps.join(fine, "doc"), "doc")
    one = known.filter("root <> main").withColumn(
        "salt", F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int")
    ).withColumnRenamed("doc", "b").alias("r")
    other = known.withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    ).withColumnRenamed("doc", "a").alias("l")
    apart = (F.col("l.root") != F.col("r.root")) & (
        (F.col("l.root") == F.col("l.main")) | (F.col("a") < F.col("b"))
    )
    same = (F.col("l.band") == F.col("r.band")) & (F.col("l.salt") == F.col("r.salt"))
    shares = F.array_position(F.zip_with("l.bands", "r.bands", lambda x, y: x == y), F.lit(True))
    once = F.element_at("l.bands", shares.cast("int")) == F.col("l.band")
    close = _similar("l", "r", percent) & once & _finely_similar("l", "r", percent)
    return other.join(one, same & apart & close).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """One row per document: ``key, n_shingles, component_id, kept``.

    Documents link when ``100 * |A and B| >= percent * |A or B|`` on their full
    sets of five-word shingles. Equal sets are one class and enter once, under
    their smallest id. Each class is compared, over the buckets of its bands, with the
    buckets' smallest members by b-bit estimate; the likeliest is confirmed. What stays
    in one bucket but in different components is then compared in full: with new
    pivots while that is much, and at last all such pairs whose estimate could
    reach the threshold. Pairs inside a component change nothing and are skipped,
    so a bucket with a huge group of near copies costs a few comparisons each.

    Keys are whole numbers. Rows with an equal key are one node. A null key has no component (null)
    and is kept; null texts and texts without words have an empty set and are
    their own component. An empty table gives no rows; further columns are
    ignored.
    """
    texts = docs.select(F.col(key).cast("bigint").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sketch = stored(texts.mapInArrow(trimmed(_sketches), SKETCH), "near")
    classes = stored(
        sketch.filter("n_shingles > 0 AND doc IS NOT NULL")
        .groupBy("set_hi", "set_lo").agg(F.min("doc").alias("class"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1"),
        "near",
    )
    # There are at most 1 / HOT classes with that share of all rows. Their copies get the class where they are, and are dealt
    # by themselves from then on.
    hot = classes.filter(F.col("n") >= max(2, int(sketch.count() * HOT)))
    marked = sketch.join(F.broadcast(hot.select("set_hi", "set_lo", F.col("class").alias("hot"))), ["set_hi", "set_lo"], "left")
    others = classes.select(F.col("set_hi").alias("key"), "set_lo", "class")
    classed = marked.withColumn("key", F.when(F.col("hot").isNotNull(), F.xxhash64("doc")).otherwise(F.col("set_hi"))).join(
        others, ["key", "set_lo"], "left"
    ).withColumn("class", F.coalesce("hot", "class", "doc"))
    members = stored(classed.select("doc", "n_shingles", "class"), "near")
    reps = stored(
        classed.filter("doc = class AND n_shingles > 0").select("doc", "n_shingles", "bands", *_SIG)
        .dropDuplicates(["doc", "n_shingles", *_SIG]),
        "near",
    )
    signatures = reps.drop("bands")
    rows = reps.select("doc", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    shared = stored(rows.join(buckets, "band").select("band", "doc", "low", "high"), "near")

    def likeliest(pairs: DataFrame) -> DataFrame:
        """Of each b's candidates a, the one with the highest estimate."""
        left = signatures.withColumnRenamed("doc", "a").alias("l")
        right = signatures.withColumnRenamed("doc", "b").alias("r")
        scored = pairs.join(left, "a").join(right, "b").filter(_similar("l", "r", percent))
        best = scored.groupBy("b").agg(F.max(F.struct(_matches("l", "r").alias("m"), (-F.col("a")).alias("a"))).alias("x"))
        return stored(best.select((-F.col("x.a")).alias("a"), "b"), "near")

    # Two members of each bucket are its first pivots: the smallest and the largest.
    ends = [
        likeliest(shared.filter(f"doc <> {end}").select(F.col(end).alias("a"), F.col("doc").alias("b")).distinct())
        for end in ("low", "high")
    ]
    tried = stored(ends[0].union(ends[1]).distinct(), "near")
    labels = _merged(None, _confirmed(tried, texts, percent))

    found = True
    for turn in range(PIVOT_ROUNDS + 1):
        label = labels.withColumnRenamed("node", "doc")
        labelled = shared.select("band", "doc").join(label, "doc", "left").withColumn("root", F.coalesce("root", "doc"))
        if turn == 0:
            # A bucket that lies in one component stays so; only the others go on.
            apart = labelled.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
            labelled = labelled.join(apart.select("band"), "band", "left_semi")
        shared = stored(labelled, "near")
        # A member of each bucket and component, another one every turn: the first in an order by changed bits.
        bits = F.xxhash64(F.lit(turn))
        parts = shared.groupBy("band", "root").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.col("doc").bitwiseXOR(bits)).alias("any")
        )
        mixed = stored(
            parts.groupBy("band").agg(F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"), F.max(F.struct("n", "root", "any")).alias("main"))
            .filter("roots > 1").select("band", "n", F.col("main.root").alias("main"), F.col("main.any").bitwiseXOR(bits).alias("pivot"), (F.col("n") - F.col("main.n")).alias("minor")),
            "near",
        )
        work = mixed.agg(F.sum(F.col("n") * F.col("minor")).alias("w")).first()["w"]
        if not work:
            break
        opened = shared.join(mixed, "band")
        last = turn == PIVOT_ROUNDS or work <= FEW_COMPARISONS or not found
        if last:
            fresh = stored(_all_apart(opened, reps, texts, percent).join(tried, ["a", "b"], "left_anti"), "near")
        else:
            pairs = opened.filter("root <> main").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
            fresh = stored(likeliest(pairs).join(tried, ["a", "b"], "left_anti"), "near")
        links = _confirmed(fresh, texts, percent)
        labels = _merged(labels, links)
        if last:
            break
        found = not links.isEmpty()
        tried = stored(tried.union(fresh), "near")

    known = hot.select("class").join(labels.withColumnRenamed("node", "class"), "class", "left").select(
        "class", F.coalesce("root", "class").alias("hot")
    )
    rooted = members.join(F.broadcast(known), "class", "left")
    final = rooted.withColumn("node", F.when(F.col("hot").isNotNull(), F.xxhash64("doc")).otherwise(F.col("class"))).join(labels, "node", "left")
    root = F.coalesce("hot", "root", "class")
    return final.select(
        F.col("doc").alias(key), "n_shingles", root.alias("component_id"),
        F.coalesce(F.col("doc") == root, F.lit(True)).alias("kept"),
    )


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

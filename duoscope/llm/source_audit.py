"""How the sources of a language differ in their words: exact divergences by a frequent-pattern tree of term rows.

A kept term's row is its counts in the sources that have it. Most counts are zero, so a pair of sources differs by

    sum over terms f(p, q) = V * f(z, z') + what terms of one source change + what terms of both change besides

with z the value of a count of zero. The last part comes from a tree: rows, in source order and with multiplicities, are
inserted as paths of (source, count) nodes, and a node meets each of its ancestors once, for all rows that share the path.
The tree is never whole in memory: rows are dealt out by their first entries and arrive sorted, so a task holds one path at a time, and a path that
lies in two tasks gives two nodes whose sums add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.llm.common import WordKind, stored, word_spans
from duoscope.llm.sorted_files import blocks

#: A language keeps the terms of so many of its documents at least; a group reports so many of its terms.
LEAST_DOCS, TOP_TERMS = 10, 10
#: Rows with so many first entries in common are in one task.
SHARED_START = 3
#: Terms are runs of letters and of everything beyond ASCII (A-Z count as a-z).
LETTERS = WordKind({*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _summed(groups: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> pa.Table:
    table = pa.table({"group": pa.array(groups, pa.int64()), "term": terms, "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64())})
    out = table.group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return out.select(["group", "term", "n_sum", "docs_sum"]).rename_columns(["group", "term", "n", "docs"])


def _terms(block) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of a block, and per (row, term): row, place of the term, occurrences."""
    starts, ends, edges = word_spans(block.data, block.offsets, LETTERS)
    letters = LETTERS.fold[block.data[LETTERS.is_word[block.data]]]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters)))
    coded = words.dictionary_encode()
    rows = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    size = max(1, len(coded.dictionary))
    pairs, n = np.unique(rows * size + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    return coded.dictionary, pairs // size, pairs % size, n


def _merged(found: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    """Sum (group, term) counts that were made block by block, each with terms of its own."""
    coded = pa.concat_arrays([f[0] for f in found]).dictionary_encode()
    places = np.split(coded.indices.to_numpy(), np.cumsum([len(f[0]) for f in found])[:-1])
    size = max(1, len(coded.dictionary))
    keys = np.concatenate([f[1] * size + place[f[2]] for f, place in zip(found, places)])
    keys, back = np.unique(keys, return_inverse=True)
    n, docs = (np.bincount(back, np.concatenate([f[k] for f in found]), len(keys)).astype(np.int64) for k in (3, 4))
    return pa.table({"group": keys // size, "term": coded.dictionary.take(pa.array(keys % size)), "n": n, "docs": docs})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        width = max(1, len(source.dictionary))
        group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
        found, long_text = [], None
        for b in blocks(batch.column("text"), LETTERS):
            terms, rows, at, n = _terms(b)
            if b.continued or not b.complete:
                # Pieces of one text: it counts as one document for each of its terms.
                piece = _summed(np.full(len(n), group[b.first]), terms.take(pa.array(at)), n, np.zeros(len(n), np.int64))
                if long_text is not None:
                    both = pa.concat_tables([long_text, piece]).combine_chunks()
                    piece = _summed(
                        both.column("group").to_numpy(), both.column("term").combine_chunks(), both.column("n").to_numpy(),
                        both.column("docs").to_numpy(),
                    )
                long_text = None if b.complete else piece
                if b.complete:
                    k = piece.num_rows
                    found.append((
                        piece.column("term").combine_chunks(), piece.column("group").to_numpy(), np.arange(k),
                        piece.column("n").to_numpy(), np.ones(k, np.int64),
                    ))
            elif len(n):
                size = len(terms)
                keys, back = np.unique(group[b.first + rows] * size + at, return_inverse=True)
                found.append((terms, keys // size, keys % size, np.bincount(back, n, len(keys)), np.bincount(back, minlength=len(keys))))
        if not found:
            continue
        whole = _merged(found)
        of = whole.column("group").to_numpy()
        out = pa.table({
            "lang": lang.dictionary.take(pa.array(of // width)), "source": source.dictionary.take(pa.array(of % width)),
            "term": pc.cast(whole.column("term"), pa.string()), "n": whole.column("n"), "docs": whole.column("docs"),
        })
        yield from out.combine_chunks().to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences and documents of every term in every (lang, source) of ``lang, source, text`` without nulls."""
    counted = docs.select("lang", "source", "text").mapInArrow(_count, _COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _div(a: Column, b: Column) -> Column:
    """Quotient of two integers, exact also for decimals that no long holds."""
    return F.call_function("div", a, b)


def scaled_share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)); null where there are no terms."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = F.when(terms > 0, (total + 2 * terms).cast("decimal(20,0)"))
    return _div(above, below) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)) of two scaled shares; the square fits a long."""
    return _div((p - q) * (p - q), p + q)


class _Path:
    """The path of the row at hand, whose nodes hold the multiplicities of all rows below them so far."""

    def __init__(self) -> None:
        self.items: list[tuple] = []
        self.times: list[int] = []
        #: Per node its share and the share of a count of zero, and the number of its source.
        self.shares, self.ids = np.ones((2, 16), np.int64), np.zeros(16, np.int64)
        self.sources: dict[str, int] = {}
        self.sums: dict[int, np.ndarray] = {}

    def _close(self) -> None:
        """Leave the deepest node: it meets its ancestors once, with all rows that went through it."""
        d = len(self.items) - 1
        times = self.times.pop()
        self.items.pop()
        if d == 0:
            return
        self.times[-1] += times
        # Gaps of both shares of this node to both shares of every ancestor.
        mine, theirs = self.shares[:, d][:, None, None], self.shares[:, :d]
        gaps = (mine - theirs) ** 2 // (mine + theirs)
        both = gaps[0, 0] - gaps[0, 1] - gaps[1, 0] + gaps[1, 1]
        sums = self.sums.get(self.ids[d])
        if sums is None or len(sums) < len(self.sources):
            grown = np.zeros(2 * len(self.sources), np.int64)
            grown[: 0 if sums is None else len(sums)] = 0 if sums is None else sums
            sums = self.sums[self.ids[d]] = grown
        sums[self.ids[:d]] += times * both

    def insert(self, row: list[tuple], times: int) -> None:
        """Rows come in sorted order, each a list of (source, count, share, share of a count of zero)."""
        shared = 0
        while shared < min(len(row), len(self.items)) and row[shared] == self.items[shared]:
            shared += 1
        while len(self.items) > shared:
            self._close()
        if len(row) > len(self.ids):
            more = 2 * len(row) - len(self.ids)
            self.shares, self.ids = np.pad(self.shares, ((0, 0), (0, more))), np.pad(self.ids, (0, more))
        for i in range(shared, len(row)):
            source, _, p, z = row[i]
            self.ids[i] = self.sources.setdefault(source, len(self.sources))
            self.shares[:, i] = p, z
            self.items.append(row[i])
            self.times.append(0)
        if row:
            self.times[-1] += times

    def close(self, lang: str) -> pa.RecordBatch:
        """Sums of all pairs of sources met; the path is empty afterwards."""
        while self.items:
            self._close()
        names = list(self.sources)
        found = [(names[a], names[b], int(v)) for b, sums in self.sums.items() for a, v in enumerate(sums[: len(names)]) if v]
        self.sources, self.sums = {}, {}
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.int64())],
            names=["lang", "a", "b", "value"],
        )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, lang = _Path(), None
    for batch in batches:
        langs, times, rows = (batch.column(c) for c in ("lang", "times", "row"))
        ends = rows.offsets.to_numpy() - rows.offsets[0].as_py()
        items = list(zip(*(x.to_pylist() for x in rows.flatten().flatten())))
        for i, (of, n) in enumerate(zip(langs.to_pylist(), times.to_pylist())):
            if of != lang and lang is not None:
                yield path.close(lang)
            lang = of
            path.insert(items[ends[i] : ends[i + 1]], n)
    if lang is not None:
        yield path.close(lang)


def tree_sums(rows: DataFrame) -> DataFrame:
    """Per language and pair of sources, what the terms of both change: ``lang, a, b, value``, in several rows a pair.

    ``rows`` has ``lang``, ``row`` (a list of source, count, share and share of a count of zero, in
    source order) and ``times``; equal rows come once.
    """
    # Rows that begin alike meet; no more of a row is needed to deal it, and none goes to the driver as a sample.
    start = F.xxhash64("lang", F.slice("row", 1, SHARED_START))
    dealt = rows.select("lang", "times", "row").repartition(start).sortWithinPartitions("lang", "row")
    return dealt.mapInArrow(_walk, "lang string, a string, b string, value bigint")


def divergences(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS,
) -> DataFrame:
    """How far each (lang, source) is from the other sources of its language, and by which terms it stands out.

    Returns ``lang, source, part, item, value, rank``. Part ``pair`` has every other source of the language with the
    summed gaps of all kept terms; part ``term`` the ``top_terms`` terms that the group has more often than its
    language, by their gap. All arithmetic is in integers. Ties go to the first item in byte order.

    Null texts, languages and sources count as empty ones; every row is a document of its own, repeated or
    not; texts of any length count in full. A language without kept terms has gaps of 0 and no terms; a language of one source
    has no pairs; an empty table gives no rows. Other columns are not read. A term's row has an entry per source,
    as many as a source has rows in the result.
    """
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    own = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))
    groups = stored(own.select("lang", "source").distinct(), "audit")
    terms = stored(
        term_counts(own).groupBy("lang", "term").agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("row"),
        ).filter(F.col("docs") >= least_docs), "audit",
    )
    cells = terms.select("lang", F.explode("row").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("total"))
    sizes = terms.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    counted = groups.join(cells, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("v", F.lit(0)).alias("v"),
    )
    # A row per language, with an entry per source.
    langs = stored(
        counted.withColumn("zero", scaled_share(F.lit(0), F.col("total"), F.col("v"))).groupBy("lang", "n", "v").agg(
            F.array_sort(F.collect_list(F.struct("source", "total", "zero"))).alias("sources")
        ).withColumnsRenamed({"n": "lang_total"}).withColumn(
            "known", F.map_from_entries(F.transform("sources", lambda s: F.struct(s["source"], s)))
        ), "audit",
    )

    def item(c: Column) -> Column:
        known = F.col("known")[c["source"]]
        return F.struct(
            c["source"].alias("source"), c["n"].alias("n"),
            scaled_share(c["n"], known["total"], F.col("v")).alias("p"), known["zero"].alias("z"),
        )

    shares = stored(terms.join(langs, "lang").select(
        "lang", "term", scaled_share(F.col("n"), F.col("lang_total"), F.col("v")).alias("q"), F.transform("row", item).alias("row"),
    ), "audit")
    patterns = shares.groupBy("lang", "row").agg(F.count(F.lit(1)).alias("times"))
    cell = shares.select("lang", "term", "q", F.explode("row").alias("c")).select("lang", "term", "q", "c.*")

    def other(rows: DataFrame) -> DataFrame:
        pairs = rows.join(langs.select("lang", "v", "sources"), "lang").withColumn("o", F.explode("sources"))
        return pairs.select("*", F.col("o.source").alias("b"), F.col("o.zero").alias("w")).filter("source <> b")

    none = other(langs.select("lang", F.explode("sources").alias("s")).select("lang", "s.source", F.col("s.zero").alias("z"))).filter(
        "source < b"
    ).select("lang", F.col("source").alias("a"), "b", F.coalesce(F.col("v") * gap(F.col("z"), F.col("w")), F.lit(0)).alias("value"))
    single = other(cell.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("times"))).select(
        "lang", F.col("source").alias("a"), "b",
        (F.col("times") * (gap(F.col("p"), F.col("w")) - gap(F.col("z"), F.col("w")))).alias("value"),
    )
    sums = none.union(single).union(tree_sums(patterns)).groupBy(
        "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pair = sums.select("lang", "value", F.inline(ways)).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    term = cell.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value")
    )
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pair.withColumn("rank", F.row_number().over(order)).union(
        term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    )


def op12_source_audit(spark, sf_dir: str) -> DataFrame:
    """Divergences of all documents' sources."""
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS u, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'
    ) AS terms
  FROM documents
), t AS (SELECT u, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT u) >= 10),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
cell AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
gsize AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM grp g LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source
  GROUP BY g.lang, g.source
), full_ AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * s.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (s.total + 2 * s.v) AS q
  FROM gsize g JOIN kept k ON k.lang = g.lang JOIN size s ON s.lang = g.lang
  LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM full_ a JOIN full_ b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), marks AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM full_ WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marks)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

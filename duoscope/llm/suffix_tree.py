"""A probabilistic suffix tree over words: contexts that pass a divergence test, and scores by the longest of them.

A *state* is a context of up to ``depth`` words. With c occurrences and u different next symbols, a state gives

    P(w | s) = (n - 1) / c + u / c * P(w | s')        n: times w follows s (at least 1), else the first term is 0

where s' is s without its earliest word, down to the root, whose distribution is (c + 0.1) / (N + 0.1 * (V + 1)).
As one is taken off every count, next symbols seen once need not be stored, and no counted symbol is left out.
A context is looked at if it occurs ``least_seen`` times and its parent is a state; it becomes a state if the training
tokens that follow it gain at least ``least_gain`` nats against the parent's distribution, which is c times the
divergence between both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.llm.common import SPACED, crc_fold, mix64, stored, trimmed, word_hashes, word_spans
from duoscope.llm.sorted_files import SortedFiles, blocks, new_folder, read_file, write_file, write_sorted

#: Words of the longest context, its least number of occurrences, and the least gain of a state in nats.
DEPTH, LEAST_SEEN, LEAST_GAIN = 2, 24, 4.0
#: Counts that a Python worker merges before they leave it, and n-grams of a range that it sorts at once.
HELD, RANGE_ROWS = 1_500_000, 1_500_000
#: A context with this share of all tokens has its next symbols dealt by themselves; so there are at most 1/HOT of them.
HOT = 1 / 1000

_U = np.uint64
#: Hash of the end of a text.
END = mix64(np.array([0xE17D], _U))[0]
#: A code keeps its context in the upper bits, so that a context's next symbols lie side by side.
_LOW = _U((1 << 44) - 1)
_SIGN = _U(1 << 63)


def file_code(context: np.ndarray, symbol: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """64-bit code of a symbol after a context."""
    mixed = mix64(mix64(context) * _U(3) + symbol)
    top = mix64(context ^ _U(0x51ED270B))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        top = np.where(hot[at] == context, mixed, top)
    return (top & ~_LOW) | (mixed & _LOW)


def range_of(codes: np.ndarray, ranges: int) -> np.ndarray:
    """Which of ``ranges`` equal ranges of signed codes a code lies in."""
    return (((codes ^ _SIGN) >> _U(44)) * _U(ranges) >> _U(20)).astype(np.int32)


def token_blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Row and hash of every token, in blocks; the first ``carried`` tokens only serve as context."""
    kept = 0, np.zeros(0, _U)
    for b in blocks(texts, SPACED):
        starts, ends, edges = word_spans(b.data, b.offsets, SPACED)
        n_rows = len(b.offsets) - 1
        words = word_hashes(b.data, starts, ends, SPACED)
        of = np.repeat(np.arange(n_rows), np.diff(edges))
        if b.complete:
            # An end after each row's words.
            words = np.insert(words, edges[1:], END)
            of = np.insert(of, edges[1:], np.arange(n_rows))
        before = kept[1] if b.continued else np.zeros(0, _U)
        words = np.concatenate([before, words])
        of = np.concatenate([np.zeros(len(before), np.int64), of]) + b.first
        yield of, words, len(before)
        kept = b.first, words[len(words) - min(len(words), 8) :]


@dataclass
class Level:
    """What is known of contexts of one length: counts of n-grams, distributions and states."""

    hot: np.ndarray
    counts: SortedFiles
    likely: SortedFiles
    states: SortedFiles


@dataclass
class Tree:
    """The tree as files of the shared folder; only their lists are in it."""

    n_tokens: int
    n_types: int
    words: SortedFiles
    least_seen: int
    levels: list[Level] = field(default_factory=list)

    def root(self, seen: np.ndarray) -> np.ndarray:
        return (seen + 0.1) / (self.n_tokens + 0.1 * (self.n_types + 1))

    def contexts(self, of: np.ndarray, words: np.ndarray, hots: list[np.ndarray]):
        """Per length 1, 2, ...: positions that have such a context, its code, and the symbol's code below it."""
        code = words
        for k, hot in enumerate(hots, 1):
            at = np.flatnonzero(of[k:] == of[: len(of) - k]) + k
            # Codes of this length, at each position that has one; others stay 0 and are never read.
            next_code = np.zeros(len(words), _U)
            next_code[at] = file_code(code[at - 1], code[at], hot)
            yield at, code[at - 1], code[at], next_code[at]
            code = next_code

    def candidates(self, of: np.ndarray, words: np.ndarray, hot: np.ndarray):
        """Positions whose context of the next length is looked at: codes of context, symbol below, and both."""
        k = len(self.levels) + 1
        found = list(self.contexts(of, words, [v.hot for v in self.levels] + [hot]))
        at, context, below, code = found[-1]
        # A context of one word is the word before, so it is looked up once per different word.
        distinct, back = np.unique(words.view(np.int64), return_inverse=True)
        if k == 1:
            live = self.words.find(distinct, {"n": np.int64}, True)[0][back[at - 1]] >= self.least_seen
        else:
            if k == 2:
                parent = self.levels[-1].states.find(distinct, {"rest": np.float64}, True)[0][back[at - 1]] > 0
            else:
                is_state = np.zeros(len(words), bool)
                p_at, p_context, _, _ = found[-2]
                is_state[p_at] = self.levels[-1].states.find(p_context.view(np.int64), {"rest": np.float64})[0] > 0
                parent = is_state[at]
            live = np.zeros(len(at), bool)
            live[parent] = self.levels[-1].counts.find(context[parent].view(np.int64), {"n": np.int64})[0] >= self.least_seen
        return at[live], context[live], below[live], code[live]

    def probabilities(self, of: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each token occurs in the training tokens, and its probability in its longest state."""
        distinct, back = np.unique(words.view(np.int64), return_inverse=True)
        seen = self.words.find(distinct, {"n": np.int64}, True)[0]
        out, seen = self.root(seen)[back], seen[back]
        open_ = np.ones(len(words), bool)
        for k, (level, (at, context, _, code)) in enumerate(zip(self.levels, self.contexts(of, words, [v.hot for v in self.levels]))):
            # Only below a state there are longer ones.
            some = open_[at]
            rest = np.zeros(len(at))
            if k == 0:
                rest = level.states.find(distinct, {"rest": np.float64}, True)[0][back[at - 1]]
            else:
                rest[some] = level.states.find(context[some].view(np.int64), {"rest": np.float64})[0]
            mine = rest > 0
            p = level.likely.find(code[mine].view(np.int64), {"p": np.float64})[0]
            out[at[mine]] = np.where(p > 0, p, rest[mine] * out[at[mine]])
            open_ = np.zeros(len(words), bool)
            open_[at[mine]] = True
        return seen, out


def _merged(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sum the counts (last array) of equal codes (first array), in ascending signed order of codes."""
    code = np.concatenate([h[0] for h in held]).view(np.int64)
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.r_[True, code[order][1:] != code[order][:-1]]) if len(code) else np.zeros(0, np.int64)
    others = [np.concatenate([h[j] for h in held])[order[first]] for j in range(1, len(held[0]) - 1)]
    n = np.concatenate([h[-1] for h in held])[order]
    return code[order[first]], *others, np.add.reduceat(n, first) if len(first) else n


def _count(tree: Tree | None, hot: np.ndarray, ranges: int):
    """Per range of codes: the n-grams of the next length with context, symbol below and count; words where there is no tree."""
    names = ["context", "below", "n"] if tree else ["code", "n"]

    def flush(held):
        code, *rest = _merged(held)
        part = range_of(code.view(_U), ranges)
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
        ends = pa.array(np.r_[cuts, len(part)].astype(np.int32), pa.int32())
        columns = rest if tree else [code, *rest]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[cuts], pa.int32()), *(pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(c).view(np.int64))) for c in columns)],
            names=["part", *names],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for of, words, carried in token_blocks(batch.column("text")):
                if tree is None:
                    code, n = np.unique(words[carried:].view(np.int64), return_counts=True)
                    held.append((code, n))
                else:
                    at, context, below, code = tree.candidates(of, words, hot)
                    new = at >= carried
                    _, first, n = np.unique(code[new], return_index=True, return_counts=True)
                    held.append((code[new][first], context[new][first], below[new][first], n))
                size += len(n)
                if size > HELD:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run, "part int, " + ", ".join(f"{n} array<bigint>" for n in names)


def _ranges(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, list[tuple[np.ndarray, ...]]]]:
    """Gather the rows of each range; they come sorted by range."""
    part, held = None, []
    for batch in batches:
        parts = batch.column("part").to_pylist()
        for i, p in enumerate(parts):
            if p != part and held:
                yield part, held
                held = []
            part = p
            held.append(tuple(batch.column(c)[i].values.to_numpy() for c in names))
    if held:
        yield part, held


def _file_words(base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _ranges(batches, ["code", "n"]):
            code, n = _merged(held)
            path = write_file(base, {"code": code, "n": n})
            yield pa.RecordBatch.from_pylist([{
                "first": int(code[0]), "path": path, "n_types": len(code), "n_tokens": int(n.sum()),
            }])

    return run


def _file_counts(base: str, hot: np.ndarray):
    """File the n-grams seen twice or more; a row with the file and rows with each context's counts come out."""
    names = ["first", "path", "context", "c", "u"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _ranges(batches, ["context", "below", "n"]):
            coded = [(file_code(c.view(_U), b.view(_U), hot), c, b, n) for c, b, n in held]
            code, context, below, n = _merged(coded)
            order = np.argsort(context, kind="stable")
            first = np.flatnonzero(np.r_[True, context[order][1:] != context[order][:-1]])
            total, kinds = np.add.reduceat(n[order], first), np.diff(np.r_[first, len(order)])
            often = n > 1
            path = None
            if often.any():
                path = write_file(base, {"code": code[often], "context": context[often], "below": below[often], "n": n[often]})
            k = len(first)
            yield pa.RecordBatch.from_arrays([
                pa.array([int(code[often][0]) if path else None] + [None] * k, pa.int64()), pa.array([path] + [None] * k, pa.string()),
                pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(context[order][first])]),
                pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(total)]), pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(kinds)]),
            ], names=names)

    return run


def _test(tree: Tree, base: str, contexts: SortedFiles, target: str):
    """Distributions of a file's contexts, filed under the same codes, and what each context gains by them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                t = read_file(base, path)
                c, u = contexts.find(t["context"], {"c": np.int64, "u": np.int64})
                if tree.levels:
                    lower = tree.levels[-1].likely.find(t["below"], {"p": np.float64})[0]
                else:
                    lower = tree.root(tree.words.find(t["below"], {"n": np.int64})[0])
                p = (t["n"] - 1) / c + u / c * lower
                gain = t["n"] * np.log(p / lower)
                order = np.argsort(t["context"], kind="stable")
                context = t["context"][order]
                first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
                k = len(first)
                out = write_file(target, {"code": t["code"], "p": p.astype(np.float32)})
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(t["code"][0])] + [None] * k, pa.int64()), pa.array([out] + [None] * k, pa.string()),
                    pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(context[first])]),
                    pa.concat_arrays([pa.nulls(1, pa.float64()), pa.array(np.add.reduceat(gain[order], first))]),
                    pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(np.diff(np.r_[first, len(order)]))]),
                ], names=["first", "path", "context", "gain", "often"])

    return run


def _dealt(rows: DataFrame, ranges: int, tasks: int) -> DataFrame:
    """A task takes neighbouring ranges, one after the other."""
    return rows.repartitionById(tasks, F.expr(f"cast(cast(part as bigint) * {tasks} div {ranges} as int)")).sortWithinPartitions("part")


def _files(rows: DataFrame) -> list[tuple[int, str]]:
    return [(r["first"], r["path"]) for r in rows.filter("path IS NOT NULL").select("first", "path").collect()]  # a row per file


def _plan(spark: SparkSession, n: int) -> tuple[int, int]:
    """Ranges of codes for so many rows, and tasks for them."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(tasks, 2 * n // RANGE_ROWS + 1), 1 << 20), tasks


def grow_tree(
    docs: DataFrame, text: str = "text", depth: int = DEPTH, least_seen: int = LEAST_SEEN, least_gain: float = LEAST_GAIN
) -> Tree:
    """Learn the tree from all rows of ``docs``.

    Null texts count as empty (one token, the end). An empty table gives a tree whose only
    distribution is uniform. Repeated rows count as often as they occur.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # Half of its characters is more than a text has words.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges, tasks = _plan(spark, size // 32)
    count, schema = _count(None, np.zeros(0, _U), ranges)
    base = new_folder(spark, "suffix-tree")
    filed = stored(_dealt(texts.mapInArrow(trimmed(count), schema), ranges, tasks).mapInArrow(
        _file_words(f"{base}/words"), "first bigint, path string, n_types bigint, n_tokens bigint"
    ), "suffix-tree")
    sums = filed.agg(F.sum("n_types"), F.sum("n_tokens")).first()
    tree = Tree(sums[1] or 0, sums[0] or 0, SortedFiles(f"{base}/words", _files(filed)), least_seen)
    counts = tree.words
    for k in range(1, depth + 1):
        if not counts.paths:
            break
        hot = _hot(spark, counts, max(2, HOT * tree.n_tokens))
        ranges, tasks = _plan(spark, tree.n_tokens)
        count, schema = _count(tree, hot, ranges)
        folder = f"{base}/counts-{k}"
        filed = stored(_dealt(texts.mapInArrow(trimmed(count), schema), ranges, tasks).mapInArrow(
            _file_counts(folder, hot), "first bigint, path string, context bigint, c bigint, u bigint"
        ), "suffix-tree")
        counts = SortedFiles(folder, _files(filed))
        sums = stored(
            filed.filter("context IS NOT NULL").groupBy("context").agg(F.sum("c").alias("c"), F.sum("u").alias("u")), "suffix-tree"
        )
        contexts = write_sorted(sums, f"{base}/contexts-{k}", "context", {"c": np.int64, "u": np.int64})
        tests = stored(_paths(spark, counts.paths).mapInArrow(
            _test(tree, folder, contexts, f"{base}/likely-{k}"), "first bigint, path string, context bigint, gain double, often bigint"
        ), "suffix-tree")
        likely = SortedFiles(f"{base}/likely-{k}", _files(tests))
        gains = tests.filter("context IS NOT NULL").groupBy("context").agg(F.sum("gain").alias("gain"), F.sum("often").alias("often"))
        rest = F.col("u") / F.col("c")
        passed = gains.join(sums, "context").withColumn("rest", rest).filter(
            F.col("gain") + (F.col("u") - F.col("often")) * F.log("rest") >= least_gain
        )
        states = write_sorted(passed, f"{base}/states-{k}", "context", {"rest": np.float64})
        tree = replace(tree, levels=[*tree.levels, Level(hot, counts, likely, states)])
    return tree


def _paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))


def _hot(spark: SparkSession, counts: SortedFiles, least: float) -> np.ndarray:
    """Codes that hold at least that many tokens, of which there can be few only."""
    base = counts.base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                t = read_file(base, path)
                yield pa.RecordBatch.from_arrays([pa.array(t["code"][t["n"] >= least])], names=["code"])

    rows = _paths(spark, counts.paths).mapInArrow(run, "code bigint").collect()
    return np.sort(np.array([r["code"] for r in rows], np.int64).view(_U))


_SCORES = "n_tokens bigint, n_known bigint, base_score double, score double"


def _score(tree: Tree, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [np.zeros(batch.num_rows) for _ in range(4)]
            for of, words, carried in token_blocks(batch.column("_text")):
                seen, p = tree.probabilities(of, words)
                of, seen, p = of[carried:], seen[carried:], p[carried:]
                for total, value in zip(sums, (np.ones(len(of)), seen > 0, np.log10(tree.root(seen)), np.log10(p))):
                    total += np.bincount(of, value, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(s.astype(np.int64)) for s in sums[:2]] + [pa.array(s) for s in sums[2:]],
                names=[*kept, "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def score_texts(docs: DataFrame, tree: Tree, text: str = "text") -> DataFrame:
    """Add ``n_tokens, n_known, train_tokens, base_score, score`` to every row.

    Scores are log10 probabilities of the whole text with its end. Null texts count as empty;
    a text of any length is read in blocks. Columns of these names are replaced.
    """
    own = [c for c in docs.columns if c not in ("n_tokens", "n_known", "train_tokens", "base_score", "score", "_text")]
    fields = ", ".join([f"`{c}` {t}" for c, t in docs.dtypes if c in own] + [_SCORES])
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")
    scored = docs.select(*[F.col(f"`{c}`") for c in own], body).mapInArrow(trimmed(_score(tree, own)), fields)
    return scored.withColumn("train_tokens", F.lit(tree.n_tokens).cast("bigint"))


def op13_suffix_tree(spark, sf_dir: str) -> DataFrame:
    """All documents' scores by a tree of the training fold, beside those of single words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    fold = crc_fold(F.col("doc_id"), 10)
    tree = grow_tree(docs.filter(fold != 0))
    ids = docs.select("doc_id", (fold == 0).alias("held_out"), "text")
    return score_texts(ids, tree).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )

"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import (
    CHUNK_BYTES, SPACED, WordKind, held_out, mix64, text_chunks, trim, trimmed, word_hashes, word_spans,
)

#: Bounds of the labelled sample that the field is fitted on: documents, and bytes of one.
SAMPLE_DOCS = 6000
SAMPLE_BYTES = 16_000
#: Every so many-th sampled document calibrates and is not fitted on; a document's weight in fitting is bounded.
CALIBRATED, MOST_WEIGHT = 5, 50.0
#: Lines whose features are in memory at once, and lines that the chain is run over at once.
LINES, SCANNED = 8192, 1 << 16
THRESHOLD = 0.3

_LINE = WordKind({0x0A})
#: Byte classes: each ASCII sign by itself; then lower, upper, digit, blank, control, lead and other byte.
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
_N = len(_SIGNS)
LOWER, UPPER, DIGIT, BLANK, CONTROL, LEAD, TAIL = range(_N, _N + 7)
CLASSES = _N + 7


def _byte_classes() -> np.ndarray:
    out = np.full(256, CONTROL, np.int64)
    out[_SIGNS] = np.arange(_N)
    out[97:123], out[65:91], out[48:58], out[32] = LOWER, UPPER, DIGIT, BLANK
    out[0xC0:], out[0x80:0xC0] = LEAD, TAIL
    return out


_CLASS = _byte_classes()


@dataclass
class Lines:
    """What a block of lines is known by: own features and gist (both without repeats), lengths, hashes, and rows."""

    own: np.ndarray
    gist: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    owners: np.ndarray
    first: np.ndarray


def _read_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    feeds = np.flatnonzero(data == 10)
    rows = np.arange(len(offsets) - 1)
    # Line starts: each row's start, and what follows each line feed.
    owner = np.searchsorted(offsets, feeds, side="right") - 1
    starts = np.concatenate([offsets[:-1], feeds + 1])
    owners = np.concatenate([rows, owner])
    order = np.lexsort((starts, owners))
    starts, owners = starts[order], owners[order]
    first = np.searchsorted(owners, np.arange(len(offsets)))
    n = len(starts)
    ends = np.empty(n, np.int64)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = offsets[1:]
    lengths = ends - starts
    # Byte classes by line; the line feeds themselves are left out.
    line_of = np.repeat(np.arange(n), np.append(starts[1:], len(data)) - starts)
    counts = np.bincount(line_of * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float32)
    counts[line_of[feeds], CONTROL] -= 1
    chars = np.maximum(lengths - counts[:, TAIL], 0)
    share = np.sqrt(counts / np.maximum(lengths, 1)[:, None])
    w_starts, w_ends, _ = word_spans(data, offsets, SPACED)
    words = np.bincount(line_of[w_starts], minlength=n) if len(w_starts) else np.zeros(n)
    long_words = np.bincount(line_of[w_starts], weights=(w_ends - w_starts) > 14, minlength=n) if len(w_starts) else np.zeros(n)
    # Words that repeat the word before them, and words that stand in their line already.
    w_hashes, w_lines = word_hashes(data, w_starts, w_ends, SPACED), line_of[w_starts]
    stutter = np.zeros(n)
    if len(w_hashes) > 1:
        same = (w_hashes[1:] == w_hashes[:-1]) & (w_lines[1:] == w_lines[:-1])
        stutter = np.bincount(w_lines[1:], weights=same, minlength=n)
    places = np.unique(mix64(w_hashes ^ mix64(w_lines.astype(np.uint64))), return_index=True)[1]
    distinct = np.bincount(w_lines[places], minlength=n) if len(places) else np.zeros(n)
    stutter, distinct = stutter / np.maximum(words, 1), distinct / np.maximum(words, 1)
    hashes = np.zeros(n, np.uint64)
    l_starts, l_ends, _ = word_spans(data, offsets, _LINE)
    hashes[line_of[l_starts]] = word_hashes(data, l_starts, l_ends, _LINE)
    none = np.zeros(n)
    own = np.column_stack([
        share,
        np.log1p(chars) / 5,
        chars / np.maximum(words, 1) / 10 * (words > 0),
        long_words / np.maximum(words, 1),
        np.sqrt(stutter),
        distinct,
        none,
        lengths == 0,
    ]).astype(np.float32)
    gist = np.column_stack([
        share[:, :_N].max(axis=1), share[:, UPPER], share[:, DIGIT], np.log1p(chars) / 5, stutter, none, np.ones(n)
    ]).astype(np.float32)
    return Lines(own, gist, lengths, hashes, owners, first)


#: Where own features and gist say that a line stands more than once in its row.
_OWN_AGAIN, _GIST_AGAIN = CLASSES + 5, 5


def _joined(own: np.ndarray, gist: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return np.column_stack([own, before, after, np.ones(len(own), np.float32)])


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths, and per row the index of its first line (one more at the end).

    A line ends at a line feed or with its row, so a row has one line more than
    it has line feeds. Features of a line are its own and those of the lines before and after it
    in the row.
    """
    x = _read_lines(data, offsets)
    tagged = mix64(x.hashes ^ (x.owners.astype(np.uint64) << np.uint64(32)))
    _, back, times = np.unique(tagged, return_inverse=True, return_counts=True)
    again = (times[back] > 1) & (x.lengths > 0)
    x.own[:, _OWN_AGAIN] = x.gist[:, _GIST_AGAIN] = again
    before, after = np.zeros_like(x.gist), np.zeros_like(x.gist)
    before[1:], after[:-1] = x.gist[:-1], x.gist[1:]
    before[x.first[:-1]] = 0
    after[x.first[1:] - 1] = 0
    return _joined(x.own, x.gist, before, after), x.lengths, x.first


def _line_blocks(data: np.ndarray) -> Iterator[Lines]:
    """The lines of one long text in blocks of bounded size; only a single longer line is a larger block."""
    at = 0
    while True:
        window = data[at : at + CHUNK_BYTES]
        feeds = np.flatnonzero(window == 10)[:LINES]
        cut = None
        if len(feeds) == LINES or (len(feeds) and at + len(window) < len(data)):
            cut = at + int(feeds[-1])
        else:
            ahead = at + len(window)
            while ahead < len(data) and cut is None:
                more = np.flatnonzero(data[ahead : ahead + CHUNK_BYTES] == 10)
                cut = ahead + int(more[0]) if len(more) else None
                ahead += CHUNK_BYTES
        block = data[at:cut]
        # The line feed at the cut ends the block's last line.
        yield _read_lines(block, np.array([0, len(block)]))
        if cut is None:
            return
        at = cut + 1


@dataclass
class Field:
    """Weights of a two-state field (state 1 is good) and the calibration of its document quality."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    change: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights

    def marginals(self, emissions: np.ndarray, first: np.ndarray, labels: np.ndarray | None = None):
        """P(good) of every line. With ``labels`` also what a step of fitting needs.

        That is per row the weight of (all lines good) less (what is expected), and the sum of this difference over state changes. A row of label 1 has
        just good lines. Of a row of label 0 only that is known that some line is bad; then the difference counts
        by -p / (1 - p), with p the probability that all its lines are good.
        """
        out = np.empty(len(emissions))
        sizes = np.diff(first)
        weights, changes = np.zeros(len(sizes)), np.zeros((2, 2))
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            # Rows of like length, padded to the longest.
            end = at + 1
            while end < len(order) and end - at < 1024 and sizes[order[end]] <= 1.3 * sizes[order[at]] + 4:
                end += 1
            group = order[at:end]
            at = end
            n = sizes[group]
            t, b = int(n.max()), len(group)
            place = first[group][:, None] + np.minimum(np.arange(t), n[:, None] - 1)
            e = emissions[place].transpose(1, 2, 0)
            live = np.arange(t)[:, None] < n
            alpha, beta = np.empty((t, 2, b)), np.zeros((t, 2, b))
            alpha[0] = e[0]
            c = self.change
            for i in range(1, t):
                p = alpha[i - 1]
                step = np.stack([np.logaddexp(p[0] + c[0, k], p[1] + c[1, k]) for k in (0, 1)]) + e[i]
                alpha[i] = np.where(live[i], step, p)
            for i in range(t - 2, -1, -1):
                q = beta[i + 1] + e[i + 1]
                step = np.stack([np.logaddexp(q[0] + c[k, 0], q[1] + c[k, 1]) for k in (0, 1)])
                beta[i] = np.where(live[i + 1], step, 0.0)
            z = np.logaddexp(alpha[-1, 0], alpha[-1, 1])
            good = np.exp(alpha[:, 1] + beta[:, 1] - z)
            out[place[live.T]] = good.T[live.T]
            if labels is not None:
                all_good = np.exp(np.minimum((e[:, 1] * live).sum(axis=0) + (n - 1) * c[1, 1] - z, 0.0))
                w = np.where(labels[group] == 1, 1.0, -np.minimum(all_good / np.maximum(1 - all_good, 1e-9), MOST_WEIGHT))
                weights[group] = w
                changes[1, 1] += (w * (n - 1)).sum()
                if t > 1:
                    for j in (0, 1):
                        for k in (0, 1):
                            p = np.exp(alpha[:-1, j] + c[j, k] + e[1:, k] + beta[1:, k] - z)
                            changes[j, k] -= (p * w * live[1:]).sum()
        return (out, weights, changes) if labels is not None else out

    def good_lines(self, emissions: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """P(good) of the lines of one long row, from its end: ``(place of the first, values)`` block by block.

        A block is cut into segments, whose products of step matrices are taken side by side, so there are few
        steps; between blocks only the state is carried, forward first and then back.
        """
        n, size = len(emissions), SCANNED
        starts = [np.array([0.0, -np.inf])]
        with np.errstate(invalid="ignore"):
            for at in range(0, n, size):
                alpha = self._forward(emissions[at : at + size], starts[-1], at == 0)
                starts.append(alpha[-1])
            total = np.logaddexp(*starts[-1])
            after = np.zeros(2)
            for k in range(len(starts) - 2, -1, -1):
                at = k * size
                alpha = self._forward(emissions[at : at + size], starts[k], at == 0)
                beta, after = self._backward(emissions[at : at + size], after, at == 0)
                yield at, np.exp(alpha[:, 1] + beta[:, 1] - total)

    def _steps(self, e: np.ndarray, is_first: bool) -> np.ndarray:
        """Log step matrices in segments: (segment, place, from, to); those behind the end change nothing."""
        length = max(1, int(len(e) ** 0.5))
        steps = np.full((-(-len(e) // length) * length, 2, 2), -np.inf)
        steps[:, 0, 0] = steps[:, 1, 1] = 0.0
        steps[: len(e)] = self.change + e[:, None, :]
        if is_first:
            steps[0] = [[e[0, 0], e[0, 1]], [-np.inf, -np.inf]]
        return steps.reshape(-1, length, 2, 2)

    def _forward(self, e: np.ndarray, start: np.ndarray, is_first: bool) -> np.ndarray:
        """Log forward values of a block from those before it."""
        steps = self._steps(e, is_first)
        sums = steps.copy()
        for i in range(1, steps.shape[1]):
            sums[:, i] = np.logaddexp(sums[:, i - 1, :, :1] + steps[:, i, :1, :], sums[:, i - 1, :, 1:] + steps[:, i, 1:, :])
        starts = np.empty((len(steps), 2))
        for s in range(len(steps)):
            starts[s] = start
            start = np.logaddexp(start[0] + sums[s, -1, 0], start[1] + sums[s, -1, 1])
        alpha = np.logaddexp(starts[:, None, :1] + sums[:, :, 0], starts[:, None, 1:] + sums[:, :, 1])
        return alpha.reshape(-1, 2)[: len(e)]

    def _backward(self, e: np.ndarray, after: np.ndarray, is_first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Log backward values of a block from those after it, and those before it."""
        steps = self._steps(e, is_first)
        sums = steps.copy()
        for i in range(steps.shape[1] - 2, -1, -1):
            sums[:, i] = np.logaddexp(steps[:, i, :, :1] + sums[:, i + 1, :1, :], steps[:, i, :, 1:] + sums[:, i + 1, 1:, :])
        ends = np.empty((len(steps), 2))
        for s in range(len(steps) - 1, -1, -1):
            ends[s] = after
            after = np.logaddexp(sums[s, 0, :, 0] + after[0], sums[s, 0, :, 1] + after[1])
        beta = np.empty(steps.shape[:2] + (2,))
        beta[:, -1] = ends
        rest = sums[:, 1:]
        beta[:, :-1] = np.logaddexp(rest[..., 0] + ends[:, None, None, 0], rest[..., 1] + ends[:, None, None, 1])
        return beta.reshape(-1, 2)[: len(e)], after

    def quality(self, features: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Share of good text per row: marginals weighted by line length (an empty row counts its one line)."""
        good = self.marginals(self.emissions(features), first)
        weight = lengths + 1e-3
        return np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])

    def long_quality(self, data: np.ndarray) -> float:
        """:meth:`quality` of one long text, whose features are in memory a block at a time."""
        hashes = [x.hashes[x.lengths > 0] for x in _line_blocks(data)]
        every = np.sort(np.concatenate(hashes))
        del hashes
        repeated = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        emissions, lengths, held = [], [], None

        def settle(x: Lines, before: np.ndarray, after: np.ndarray) -> None:
            around = np.concatenate([before[None], x.gist, after[None]])
            emissions.append(self.emissions(_joined(x.own, x.gist, around[:-2], around[2:])).astype(np.float32))
            lengths.append(x.lengths.astype(np.int32))

        nothing = before = None
        for x in _line_blocks(data):
            at = np.minimum(np.searchsorted(repeated, x.hashes), max(len(repeated) - 1, 0))
            again = (repeated[at] == x.hashes) & (x.lengths > 0) if len(repeated) else np.zeros(len(x.lengths), bool)
            x.own[:, _OWN_AGAIN] = x.gist[:, _GIST_AGAIN] = again
            if nothing is None:
                nothing = before = np.zeros(x.gist.shape[1], np.float32)
            if held is not None:
                settle(held, before, x.gist[0])
                before = held.gist[-1]
            held = x
        settle(held, before, nothing)
        e, weight = np.concatenate(emissions), np.concatenate(lengths)
        del emissions, lengths
        share = sum(float((good * (weight[at : at + len(good)] + 1e-3)).sum()) for at, good in self.good_lines(e))
        return share / float(weight.sum(dtype=np.float64) + 1e-3 * len(weight))

    def shares(self, texts: pa.Array) -> np.ndarray:
        """Share of good text of every text."""
        out = []
        for _, _, data, offsets in text_chunks(texts):
            lines = np.diff(np.searchsorted(np.flatnonzero(data == 10), offsets)) + 1
            is_long = (lines > LINES) | (np.diff(offsets) > CHUNK_BYTES)
            at = 0
            while at < len(lines):
                if is_long[at]:
                    out.append(np.array([self.long_quality(data[offsets[at] : offsets[at + 1]])]))
                    at += 1
                    continue
                end = at + max(1, int(np.searchsorted(np.cumsum(lines[at:]), LINES, side="right")))
                later = np.flatnonzero(is_long[at:end])
                end = at + int(later[0]) if len(later) else end
                out.append(self.quality(*line_features(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])))
                at = end
        return np.concatenate(out) if out else np.zeros(0)

    def score(self, shares: np.ndarray) -> np.ndarray:
        """Calibrated scores of shares of good text."""
        q = np.clip(shares, 1e-4, 1 - 1e-4)
        return 1 / (1 + np.exp(-(self.slope * np.log(q / (1 - q)) + self.shift)))


def fit_field(texts: list[str], labels: list[int], steps: int = 120, ridge: float = 1e-3) -> Field:
    """Fit by gradient ascent, with line labels that are not given.

    A document of label 1 has good lines only; of one of label 0 it is only known that some line is bad. For the first
    half of the steps all lines of the latter count as bad, which gives the field a start; then their lines are free,
    and those that look like lines of good documents become good. Every ``CALIBRATED``-th document takes no part in this: the scores are
    calibrated on them. Without both labels in the sample the score is the share of label 1 (or 0.5 for an empty
    sample).
    """
    width = line_features(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0].shape[1]
    y = np.asarray(labels, int)
    if len(set(labels)) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        flat = Field(np.zeros(width), np.ones(width), np.zeros((width, 2)), np.zeros((2, 2)))
        flat.slope, flat.shift = 0.0, float(np.log(share / (1 - share)))
        return flat
    kept = np.arange(len(y)) % CALIBRATED == 0
    if len(set(y[kept])) < 2 or len(set(y[~kept])) < 2:
        kept[:] = False
    apart = np.flatnonzero(kept) if kept.any() else np.arange(len(y))
    used = np.flatnonzero(~kept)
    y_fit = y[used]
    parts = [line_features(data, offsets) for _, _, data, offsets in text_chunks(pa.array([texts[i] for i in used], pa.string()))]
    lengths = np.concatenate([p[1] for p in parts])
    sizes = np.concatenate([np.diff(p[2]) for p in parts])
    # One matrix in float32, filled and then scaled in place.
    z, at = np.empty((len(lengths), width), np.float32), 0
    while parts:
        x = parts.pop(0)[0]
        z[at : at + len(x)] = x
        at += len(x)
    first = np.concatenate([[0], np.cumsum(sizes)])
    mean, scale = z.mean(axis=0, dtype=np.float64), z.std(axis=0, dtype=np.float64) + 1e-3
    mean[-1], scale[-1] = 0.0, 1.0
    field = Field(mean, scale, np.zeros((width, 2)), np.zeros((2, 2)))
    z -= mean.astype(np.float32)
    z /= scale.astype(np.float32)
    lines = np.repeat(y_fit, sizes)
    m = [np.zeros_like(field.weights), np.zeros((2, 2))]
    v = [np.zeros_like(field.weights), np.zeros((2, 2))]
    for step in range(1, steps + 1):
        emissions = (z @ field.weights.astype(np.float32)).astype(float)
        if 2 * step <= steps:
            # Both states' lines are pulled towards their documents' labels; the chain is left alone.
            difference = lines - 1 / (1 + np.exp(np.clip(emissions[:, 0] - emissions[:, 1], -60, 60)))
            changes = np.zeros((2, 2))
        else:
            good, weights, changes = field.marginals(emissions, first, y_fit)
            difference = np.repeat(weights, sizes) * (1 - good)
        pull = z.T @ np.column_stack([-difference, difference]).astype(np.float32)
        gradients = [pull / len(z) - ridge * field.weights, changes / len(z) - ridge * field.change]
        for i, (g, value) in enumerate(zip(gradients, (field.weights, field.change))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            value += 0.05 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    del z
    # Calibrate the document quality on documents that the field has not seen, where there are enough.
    q = np.clip(field.shares(pa.array([texts[i] for i in apart], pa.string())), 1e-4, 1 - 1e-4)
    logit, known = np.log(q / (1 - q)), y[apart]
    ones, zeros = known.sum(), len(known) - known.sum()
    goal = np.where(known == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design = np.column_stack([logit, np.ones(len(known))])
    theta = np.array([0.5, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ theta))
        h = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        theta += np.clip(np.linalg.solve(h, design.T @ (goal - p) - 1e-3 * theta), -1, 1)
    field.slope, field.shift = max(float(theta[0]), 0.0), float(theta[1])
    return field


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCS, longest: int = SAMPLE_BYTES):
    """At most ``limit`` labelled documents of at most ``longest`` bytes, in order of a hash of their ids.

    Only ids outside the held-out fold count that have a document of that size. Of an id's labels the smallest counts. At most
    ``limit`` ids are chosen, so their documents are met with a broadcast of bounded size.
    """
    labelled = (
        labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    short = docs.filter(F.octet_length("text") <= longest).select("doc_id").distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = labelled.join(short, "doc_id", "left_semi").orderBy(*order).limit(limit)
    rows = (
        docs.select("doc_id", "text").filter(F.octet_length("text") <= longest)
        .join(F.broadcast(chosen), "doc_id").orderBy(*order, "text").limit(limit).collect()
    )
    return [r["text"] for r in rows], [int(r["quality"] == 1) for r in rows]


def score_quality(
    docs: DataFrame, labels: DataFrame, text: str = "text", keep: list[str] | None = None, **sample
) -> DataFrame:
    """Add ``score`` (0 to 1, higher is better), ``predicted`` (1 from 0.3 on) and ``good_share`` (of its text) to every document.

    ``docs`` has ``doc_id`` and the text; labels have ``doc_id, quality``. The field is
    learned from labelled documents outside the held-out fold; a score depends on nothing
    but the whole text. A null text counts as empty, and an empty text as one
    empty line. ``keep`` names the columns to return with them (default: all). Columns of these names are replaced; equal texts get
    equal scores; an empty table gives no rows.
    """
    texts, quality = training_sample(docs.select("doc_id", F.col(text).alias("text")), labels, **sample)
    field = fit_field(texts, quality)
    del texts
    trim()
    own = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted", "good_share", "_text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                shares = field.shares(batch.column("_text"))
                score = field.score(shares)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(shares)],
                    names=[*batch.schema.names[:-1], "score", "predicted", "good_share"],
                )

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in own) + ", score double, predicted int, good_share double"
    return docs.select(*own, F.col(text).alias("_text")).mapInArrow(trimmed(run), schema)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    thin = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score_quality(thin, labels, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted")

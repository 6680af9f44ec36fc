"""Hard negatives against plain loops, with pruning, ties and rows that take no part."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duoscope.llm import hard_negatives as H

SCHEMA = "vec_id bigint, label int, v array<double>, uid string, score int"


def brute(rows, is_anchor, positives=5, negatives=3, least=50, most=95):
    live = [
        (n, i, label, v) for n, (i, label, v) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, i, label, v in live:
        if i is None or not is_anchor(i):
            continue
        near = [(sum(int(a) * int(b) for a, b in zip(v, w)), j, other) for m, j, other, w in live if m != n]
        for score, j, _ in sorted((x for x in near if x[2] == label), key=key)[:positives]:
            band = sorted((x for x in near if x[2] != label and least * score <= 100 * x[0] <= most * score), key=key)
            out += [(i, j, k, y[1], score, y[0]) for k, y in enumerate(band[:negatives], 1)]
    return sorted(out, key=repr)


def run(spark, rows, is_anchor, **options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    found = H.hard_negatives(frame, is_anchor, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def vectors(seed, n, dims=6, labels=3, most=9):
    r = random.Random(seed)
    return [(i, r.randrange(labels), [float(r.randint(-most, most)) for _ in range(dims)]) for i in range(n)]


def test_equals_loops_with_ties_and_blocks(spark):
    rows = vectors(1, 150)
    rows += [(r[0] + 1000, r[1], r[2]) for r in rows[:40]]  # equal vectors
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and run(spark, rows, F.col("vec_id") % 5 == 0) == want
    # Several blocks of anchors give the same.
    assert run(spark, rows, F.col("vec_id") % 5 == 0, block_bytes=6 * 8 * 7) == want
    assert run(spark, rows, F.col("vec_id") % 5 == 0, positives=2, negatives=4, least=20, most=80) == brute(
        rows, lambda i: i % 5 == 0, 2, 4, 20, 80
    )


def test_awkward_rows(spark):
    rows = vectors(2, 40)
    rows += [
        (5, 1, None), (10, None, [1.0] * 6), (15, 1, [1.0, None]), (20, 1, [float("nan")] * 6), (25, 2, [float("inf")] * 6),
        (None, 0, [9.0] * 6), (None, 1, [8.0] * 6), (30, 0, []), (35, 1, [7.0, 7.0]), (40, 2, [0.0] * 6),
        (45, 0, [3e17] * 6), (50, 1, [3e17] * 6),  # scores beyond the bound
    ]
    rows += rows[:5]  # repeated rows, anchors among them
    got = run(spark, rows, F.col("vec_id") % 5 == 0)
    want = [
        (*r[:4], *(max(-H.LARGEST, min(H.LARGEST, s)) for s in r[4:])) for r in brute(rows, lambda i: i % 5 == 0)
    ]
    small = lambda found: [r for r in found if r[0] not in (45, 50) and max(map(abs, r[4:])) < H.LARGEST]
    assert small(got) == small(want)
    assert run(spark, [], F.col("vec_id") % 5 == 0) == []
    assert run(spark, vectors(3, 4), F.lit(False)) == []


@pytest.mark.parametrize("seed", range(4))
def test_pruning_loses_no_row(seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(40, 8))
    rows = centres[r.integers(0, 40, 400)] + r.normal(size=(400, 8)) * 0.05
    rows = np.floor(1000 * rows / np.sqrt((rows**2).sum(axis=1))[:, None])
    lengths = np.sqrt((rows**2).sum(axis=1))
    anchors = rows[:60] + np.floor(r.normal(size=(60, 8)) * 3)
    found = anchors @ rows.T
    low = np.sort(found, axis=1)[:, -4]
    bucket = H.Bucket(rows, lengths)
    possible, narrow = bucket.feasible(anchors, np.sqrt((anchors**2).sum(axis=1)), low)
    used = 0
    for i in range(len(anchors)):
        hits = set(np.flatnonzero(found[i] >= low[i]).tolist())
        if not possible[i]:
            assert low[i] > 0 and not hits
        elif narrow[i] is not None:
            used += 1
            assert hits <= set(narrow[i].tolist()) and len(narrow[i]) <= H.NARROW * len(rows)
    assert used  # the coordinate lists did prune
    assert not bucket.feasible(anchors, np.sqrt((anchors**2).sum(axis=1)), np.full(60, 1e9))[0].any()


def test_scores_are_exact_at_every_size():
    for most in (100, 2**26, 2**30, 2**40):
        r = random.Random(most)
        a = [[float(r.randint(-most, most)) for _ in range(5)] for _ in range(4)]
        want = [[max(-H.LARGEST, min(H.LARGEST, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in a] for p in a]
        assert H.scores(np.array(a), np.array(a)).tolist() == want

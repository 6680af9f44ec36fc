"""The suffix tree against one on dicts of words, held-out gains, long texts and awkward rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from duoscope.llm import suffix_tree as T
from duoscope.llm.sorted_files import SortedFiles, blocks, write_sorted
from tests.llm.data import awkward, frame, lower_ascii

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return [*WORD.findall(lower_ascii(text)), None]


class Plain:
    def __init__(self, texts, depth, least_seen, least_gain):
        lists = [tokens(t) for t in texts]
        self.c, self.n = Counter(w for x in lists for w in x), sum(map(len, lists))
        self.states, self.depth = {}, depth
        for k in range(1, depth + 1):
            follow = defaultdict(Counter)
            for x in lists:
                for i in range(k, len(x)):
                    follow[tuple(x[i - k : i])][x[i]] += 1
            new = {}
            for s, after in follow.items():
                if sum(after.values()) < least_seen or (k > 1 and s[1:] not in self.states):
                    continue
                c, u = sum(after.values()), len(after)
                p = {w: (n - 1) / c + u / c * self.p(s[1:], w) for w, n in after.items()}
                if sum(n * math.log(p[w] / self.p(s[1:], w)) for w, n in after.items()) >= least_gain:
                    new[s] = (after, c, u)
            self.states |= new

    def root(self, w):
        return (self.c[w] + 0.1) / (self.n + 0.1 * (len(self.c) + 1))

    def p(self, s, w):
        if not s:
            return self.root(w)
        if s not in self.states:
            return self.p(s[1:], w)
        after, c, u = self.states[s]
        return max(after[w] - 1, 0) / c + u / c * self.p(s[1:], w)

    def score(self, text):
        x = tokens(text)
        out = 0.0
        for i, w in enumerate(x):
            s = ()
            for k in range(1, self.depth + 1):
                if i >= k and tuple(x[i - k : i]) in self.states:
                    s = tuple(x[i - k : i])
            out += math.log10(self.p(s, w))
        return len(x), sum(self.c[w] > 0 for w in x), self.n, sum(math.log10(self.root(w)) for w in x), out


def corpus(seed, n):
    r = random.Random(seed)
    after = {f"w{i}": [f"w{r.randrange(60)}" for _ in range(3)] for i in range(60)}
    out = []
    for _ in range(n):
        w, text = f"w{r.randrange(60)}", []
        for _ in range(r.randrange(60)):
            text.append(w)
            w = r.choice(after[w]) if w in after and r.random() < 0.8 else r.choice([f"w{r.randrange(60)}", f"W{r.randrange(200)}"])
        out.append(r.choice([" ", "  \n"]).join(text))
    return out


@pytest.mark.parametrize("depth,seen,gain", [(2, 8, 1.0), (3, 4, 0.5), (1, 20, 4.0)])
def test_equals_dicts(spark, monkeypatch, depth, seen, gain):
    monkeypatch.setattr(T, "HOT", 1 / 60)  # the most frequent words are dealt by themselves
    texts = corpus(1, 150)
    train = frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(900, None, "en", "s", 0)])
    tree = T.grow_tree(train.repartition(4), depth=depth, least_seen=seen, least_gain=gain)
    assert len(tree.levels) == depth and len(tree.levels[0].hot)
    plain = Plain([*texts, None], depth, seen, gain)
    assert {len(s) for s in plain.states} == set(range(1, depth + 1))
    asked = corpus(2, 60) + texts[:40] + [None, "", "unseen", "w1 unseen w2 w3"]
    found = T.score_texts(frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(asked)]), tree)
    for r in found.collect():
        want = plain.score(asked[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["base_score"] == pytest.approx(want[3], rel=1e-9)
        assert r["score"] == pytest.approx(want[4], rel=1e-5)


def test_held_out_texts_gain(spark):
    texts = corpus(3, 400)
    train = frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts[:300])])
    held = T.score_texts(frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts[300:])]), T.grow_tree(train)).collect()
    assert sum(r["score"] for r in held) > 0.9 * sum(r["base_score"] for r in held)


def test_awkward_rows(spark):
    rows = awkward()
    tree = T.grow_tree(frame(spark, rows), least_seen=3, least_gain=0.5)
    docs = frame(spark, rows).withColumnsRenamed({"n_chars": "score", "source": "n"})
    got = T.score_texts(docs, tree).collect()
    assert len(got) == len(rows) and {"n", "lang", "score", "doc_id"} <= set(got[0].asDict())
    plain = Plain([r[1] for r in rows], 2, 3, 0.5)
    for r in got:
        assert r["score"] == pytest.approx(plain.score(r["text"])[4], rel=1e-5, abs=1e-9)
    empty = T.grow_tree(frame(spark, []))
    assert empty.n_tokens == 0 and not empty.levels
    assert T.score_texts(frame(spark, [(1, "a b", "en", "s", 3)]), empty).first()["score"] == 0
    assert T.score_texts(frame(spark, []), tree).count() == 0


def test_blocks_cut_between_words():
    texts = ["a bb  ccc " * 40, None, "", "x" * 300 + " y " + "z" * 20, "tail of it"]
    whole = [(r, h) for of, words, k in T.token_blocks(pa.array(texts)) for r, h in zip(of[k:].tolist(), words[k:].tolist())]
    default = blocks.__defaults__
    try:
        blocks.__defaults__ = (50,)
        pieces, carried = [], 0
        for of, words, k in T.token_blocks(pa.array(texts)):
            carried += k
            pieces += list(zip(of[k:].tolist(), words[k:].tolist()))
    finally:
        blocks.__defaults__ = default
    assert carried and pieces == whole
    assert len(whole) == sum(len(tokens(t)) for t in texts)


def test_sorted_files(spark, tmp_path):
    codes = [-(2**63), -5, 0, 7, 2**63 - 1, *range(100, 200)]
    rows = spark.createDataFrame([(c, i + 1) for i, c in enumerate(codes)], "code bigint, n bigint")
    files = write_sorted(rows, str(tmp_path / "f"), "code", {"n": np.int64}, most=7)
    assert isinstance(files, SortedFiles) and len(files.paths) > 10
    asked = np.array([*reversed(codes), 1, -6, 2**62, 7], np.int64)
    assert files.find(asked, {"n": np.int64})[0].tolist() == [*range(len(codes), 0, -1), 0, 0, 0, 4]
    assert write_sorted(rows.limit(0), str(tmp_path / "g"), "code", {"n": np.int64}).find(asked, {"n": np.int64})[0].sum() == 0

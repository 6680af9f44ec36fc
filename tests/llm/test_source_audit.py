"""Divergences of sources against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from duoscope.llm import source_audit as A
from duoscope.llm.sorted_files import blocks
from tests.llm.data import awkward, frame, lower_ascii

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least_docs=10, top=10):
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        found = Counter(TERM.findall(lower_ascii(text)))
        groups[lang, source] += found
        docs[lang].update(found.keys())
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang in docs.keys() | {k[0] for k in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        mine = {s: c for (of, s), c in groups.items() if of == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in mine.items()}
        q = shares(sum(mine.values(), Counter()))
        for s in mine:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in mine if o != s)
            out += [(lang, s, "pair", o, -v, k) for k, (v, o) in enumerate(pairs, 1)]
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if mine[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(terms, 1)]
    return sorted(out)


def rows(seed, n, sources=6):
    r = random.Random(seed)
    names = ["das", "les", "Über", "naïve", "one", "TWO", "three", "漢字", "x"] + [f"t{c}" for c in "abcdefghijklm"]
    out = []
    for i in range(n):
        lang, source = r.choice(["en", "de", None]), f"s{min(r.randrange(sources), r.randrange(sources))}"
        body = [r.choice(names[: 5 + r.randrange(len(names) - 4)]) for _ in range(r.randrange(30))]
        text = " ".join(body + [f"rare{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}"]) + r.choice(["", "!", "\x00", "3"])
        out.append((i, text, lang, source, len(text)))
    return out


def got(spark, data, **options):
    found = A.divergences(frame(spark, data).repartition(5), **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def test_equals_plain_counting(spark):
    data = rows(1, 300)
    want = brute(data)
    assert {r[2] for r in want} == {"pair", "term"} and got(spark, data) == want
    assert got(spark, data, least_docs=3, top_terms=2) == brute(data, 3, 2)


def test_awkward_rows_and_a_hot_source(spark):
    data = awkward() + rows(2, 120, 3) + [(1000 + i, "one two das " * 3, "en", "s0", 36) for i in range(200)]
    data += [(2000, None, "xx", "a", 0), (2001, "", "xx", "b", 0), (2002, "lonely", "yy", None, 6)]
    assert got(spark, data) == brute(data)
    assert got(spark, [], least_docs=1) == []


def test_clashing_columns(spark):
    data = rows(3, 80)
    names = ["a", "b", "value", "rank", "item", "term", "row", "total", "sources"]
    df = frame(spark, data)
    for n in names:
        df = df.withColumn(n, df.doc_id)
    assert sorted(tuple(r) for r in A.divergences(df).collect()) == brute(data)


def test_long_text_counts_as_one_document(monkeypatch):
    monkeypatch.setattr(blocks, "__defaults__", (64,))
    texts = ["ab cd ef " * 100, "zz" * 200 + " ab", "ab"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 3, "source": ["s", "s", "t"], "text": texts})
    total = Counter()
    for out in A._count([batch]):
        for r in out.to_pylist():
            total[r["source"], r["term"], "n"] += r["n"]
            total[r["source"], r["term"], "docs"] += r["docs"]
    assert total["s", "ab", "n"] == 101 and total["s", "ab", "docs"] == 2
    assert total["s", "cd", "n"] == 100 and total["s", "cd", "docs"] == 1
    assert total["s", "zz" * 200, "docs"] == 1 and total["t", "ab", "docs"] == 1

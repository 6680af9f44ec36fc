"""Near-duplicates, decontamination, token files, fingerprints and both classifiers."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from duoscope.llm import (
    common, crf_quality, decontaminate, language_id, near_dedup, order_minhash, token_files,
)
from tests.llm.data import SCHEMA, awkward, frame, lower_ascii, row, sentence, words

TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


# ---- near-duplicates ------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def plain_components(rows):
    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows(seed, n=160):
    r = random.Random(seed)
    base = [words(s, 60 + 30 * s, 3000) for s in range(4)]
    rows = []
    for i in range(n):
        w = list(base[r.randrange(4)])
        for _ in range(r.choice((0, 0, 1, 2, 3, 5, 9))):
            w[r.randrange(len(w))] = f"n{r.randrange(10**6)}"
        rows.append(row(i * 3 + 100, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", (1, 2))
def test_components_equal_all_pairs(spark, seed):
    rows = near_rows(seed) + [row(1, "A b C"), row(2, "a B c"), row(3, "a b c d"), row(4, ""), row(5, None)]
    out = near_dedup.near_duplicates(frame(spark, rows)).collect()
    want = plain_components(rows)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in out)


def test_residual_rounds_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "FEW_COMPARISONS", 0)
    rows = near_rows(7, 80)
    out = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == plain_components(rows)


def test_near_duplicates_of_awkward_rows(spark):
    out = near_dedup.near_duplicates(frame(spark, awkward()).selectExpr("*", "1 AS kept", "2 AS doc")).collect()
    assert len(out) == len(awkward())
    by = {x.doc_id: x for x in out}
    assert by[6].component_id == 5 and not by[6].kept and by[1].kept and by[2].kept and by[3].n_shingles == 0
    assert by[None].component_id is None and by[None].kept
    assert near_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_long_chain(spark):
    n = 200
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001)], "a bigint, b bigint")
    out = {x.node: x.root for x in near_dedup.components(edges).collect()}
    assert out == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def test_estimate_is_corrected_for_chance():
    share = 0.6 + 0.4 / 4
    assert near_dedup._floor(200, 2, 75) < 200 * (0.75 + 0.25 / 4)
    assert share * 200 - 50 == pytest.approx(0.6 * 150)


# ---- decontamination ------------------------------------------------------


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def plain_hits(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = alnum(t)
        n = min(window, len(w))
        for p in range(len(w) - n + 1) if n and i is not None else ():
            wins.setdefault(tuple(w[p : p + n]), set()).add(str(i))
    out = []
    for i, t, *_ in docs:
        w, hit, found = alnum(t), set(), set()
        for n in {len(k) for k in wins}:
            for p in range(len(w) - n + 1):
                if (k := tuple(w[p : p + n])) in wins:
                    hit |= set(range(p, p + n))
                    found |= wins[k]
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def test_contamination_equals_plain_search(spark):
    r = random.Random(4)
    items = [(i, " ".join(words(i, r.choice((1, 2, 3, 9, 10, 11, 40)), 60))) for i in range(30)]
    items += [(100, ""), (101, None), (None, "some words"), (102, items[0][1]), (103, "Ünï 漢字 x")]
    docs = [row(i, " - ".join(words(500 + i, r.randrange(0, 60), 60))) for i in range(120)]
    docs += [row(900 + i, "Intro, text! " + (t or "").upper() + "; end") for i, t in items[:25]] + awkward() + [row(999, "ünï ünï 漢字 X y")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS n")
    out = decontaminate.contamination(frame(spark, docs).selectExpr("*", "2 AS found", "3 AS uid"), bench).collect()
    assert sorted(((x.doc_id, x.n_words, x.n_hit, tuple(x["items"])) for x in out), key=str) == plain_hits(docs, items)
    assert all(x.contaminated == (x.n_hit > 0) and x.n_items == len(x["items"]) for x in out)


def test_contamination_with_empty_tables(spark):
    docs, none = frame(spark, awkward()), spark.createDataFrame([], "item_id bigint, text string")
    out = decontaminate.contamination(docs, none).collect()
    assert len(out) == len(awkward()) and not any(x.contaminated for x in out)
    some = spark.createDataFrame([(1, "a b")], none.schema)
    assert decontaminate.contamination(spark.createDataFrame([], SCHEMA), some).collect() == []


# ---- token files ----------------------------------------------------------


def check_tokens(rows, out, order=lambda r: (r[0] is not None, r[0] or 0)):
    it = token_files.Encoder(TOKENIZER).tokenizer
    start, want = 0, []
    for r in sorted(rows, key=order):
        ids = it.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_token_files_round_trip(spark, tmp_path):
    rows = awkward() + [row(100 + i, sentence(i, i * 7)) for i in range(60)]
    signs = "".join(map(chr, [*range(9, 14), *range(32, 127), *range(0x85, 0x180), 0x301, 0x130, 0x3A3, 0x4E2D, 0x1F600]))
    r = random.Random(6)
    rows += [row(300 + i, "".join(r.choice(signs) for _ in range(300)) + " IT'S \u00b2\u00bd3a\u00aa ÀÉß") for i in range(40)]
    rows += [row(500, "<|endoftext|> \t a\u00a0b\u2003c don't WON'T " + "é" * 90), row(501, "ab" * 60 + " " + "cd" * 60)]
    df = frame(spark, rows).selectExpr("*", "1 AS part", "2 AS ids")
    base = f"file://{tmp_path}/files"
    manifest = token_files.write_tokens(df, TOKENIZER, base, sequence=64, parts=5)
    check_tokens(rows, token_files.read_tokens(manifest, base).collect())
    import pyarrow as pa

    for m in manifest.collect():
        with pa.memory_map(m.path) as f:
            table = pa.ipc.open_file(f).read_all()
        assert table.schema.field("ids").type.list_size == 64
        masks = np.array(table.column("mask").to_pylist()).ravel()
        masks = masks.astype(int)
        assert masks.sum() == m.n_tokens and (np.diff(masks) <= 0).all()


def test_token_files_of_an_empty_table(spark):
    assert token_files.token_output(spark.createDataFrame([], SCHEMA), TOKENIZER).collect() == []


# ---- fingerprints ---------------------------------------------------------


def test_fingerprints_of_edited_and_next_texts(spark, tmp_path):
    rows = [r for r in awkward() if r[0] not in (None, 6)] + [row(50 + i, sentence(i, 80)) for i in range(30)]
    rows += [row(90, sentence(3, 80))]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = {x.doc_id: x for x in order_minhash.op4_order_minhash(spark, str(tmp_path)).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    for n, (i, text, *_) in enumerate(ordered):
        text, after = text or "", ordered[(n + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        x = out[i]
        assert x.n_chars == len(text) and x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert x.fingerprint == order_minhash._hex(order_minhash.fingerprint(text))
        assert x.edited_fingerprint == order_minhash._hex(order_minhash.fingerprint(edited))
        assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
    assert out[90].fingerprint == out[53].fingerprint
    assert sum(out[50 + i].near_edited > out[50 + i].near_next for i in range(30)) == 30


def test_fingerprints_with_ties_nulls_and_no_rows(spark):
    out = order_minhash.with_next(frame(spark, awkward()), parts=4).collect()
    assert len(out) == len(awkward())
    assert order_minhash.with_next(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = order_minhash.fingerprints(frame(spark, awkward()).selectExpr("*", "1 AS fingerprint")).collect()
    assert len({x.fingerprint for x in twice if x.doc_id in (5, 6)}) == 1


def test_order_counts():
    a = [f"p{i}" for i in range(300)]
    same, turned = " ".join(a), " ".join(a[150:] + a[:150])
    mixed = " ".join(random.Random(1).sample(a, 300))
    print_of = order_minhash.fingerprint
    like = order_minhash.likeness
    assert like(print_of(same), print_of(same)) == 1 and like(print_of(""), print_of("")) == 1
    assert like(print_of(same), print_of(mixed)) < like(print_of(same), print_of(turned)) < 1


@pytest.mark.parametrize("size", [10, 20, 40, 80, 130])
def test_order_counts_in_short_texts(size):
    r = random.Random(size)
    print_of, like = order_minhash.fingerprint, order_minhash.likeness
    seen = []
    for _ in range(40):
        # A turned text keeps all k-mers but those over the seam; only their order is another.
        text = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=size))
        half = text + text[:4]
        turned = half[size // 2 : size] + half[: size // 2 + 4]
        assert (print_of(text) != 0).all() and like(print_of(text), print_of(text[:])) == 1
        seen.append(like(print_of(text), print_of(turned)))
    assert np.mean(seen) < 0.55


def test_tuples_hold_the_smallest_of_all_kmers():
    r = np.random.default_rng(3)
    for n in (1, 2, 5, 4095, 4096, 4097, 9000):
        hashes = r.integers(0, 1 << 32, n, dtype=np.uint32)
        x = hashes[None] ^ (common.seeded(64, 64) >> np.uint64(32)).astype(np.uint32)[:, None]
        x = x * np.uint32(0x85EBCA6B)
        x = (x ^ x >> np.uint32(15)) * np.uint32(0xC2B2AE35)
        x = x ^ x >> np.uint32(16)
        count = min(2, n)
        assert (order_minhash._smallest(hashes, 64, count) == np.argsort(x, axis=1, kind="stable")[:, :count]).all()


# ---- quality --------------------------------------------------------------


def quality_rows(n=240):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        lines = [sentence(i * 50 + j, r.randrange(3, 15)) for j in range(r.randrange(1, 8))]
        bad = i % 4 == 0
        if bad:
            lines = [re.sub(" ", " | ", x).upper() + "!!" for x in lines]
        rows.append(row(i, "\n".join(lines)))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_quality_of_held_out_documents(spark, tmp_path):
    rows, labels = quality_rows()
    extra = [(2000 + (i or 0), *r) for i, *r in awkward()]
    frame(spark, rows + extra).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    out = crf_quality.op5_quality(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) + len(extra)
    truth = dict(labels)
    for x in out:
        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
        assert 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3)
        if x.held_out and x.doc_id in truth:
            assert x.predicted == truth[x.doc_id]


def test_quality_without_labels_and_with_clashing_columns(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    df = frame(spark, awkward()).selectExpr("*", "1 AS score", "2 AS predicted")
    out = crf_quality.score_quality(df, none).collect()
    assert len(out) == len(awkward()) and {x.score for x in out} == {0.5}
    assert crf_quality.score_quality(df.filter("false"), none).collect() == []


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    field = crf_quality.Field(np.zeros(1), np.ones(1), np.zeros((1, 2)), rng.normal(size=(2, 2)))
    sizes = [1, 4, 2, 6, 3]
    first = np.concatenate([[0], np.cumsum(sizes)])
    e = rng.normal(size=(sum(sizes), 2))
    got = field.marginals(e, first)
    for a, b in zip(first, first[1:]):
        n, total, good = b - a, 0.0, np.zeros(b - a)
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            s = sum(e[a + k, y[k]] for k in range(n)) + sum(field.change[y[k], y[k + 1]] for k in range(n - 1))
            total += np.exp(s)
            good += np.exp(s) * np.array(y)
        assert np.allclose(got[a:b], good / total)


def test_fitting_follows_the_gradient_of_latent_labels():
    rng = np.random.default_rng(1)
    sizes, y = [1, 3, 2, 4], np.array([1, 0, 0, 1])
    first = np.concatenate([[0], np.cumsum(sizes)])
    e, change = rng.normal(size=(sum(sizes), 2)), rng.normal(size=(2, 2))

    def objective(e, change):
        total = 0.0
        for d, (a, b) in enumerate(zip(first, first[1:])):
            n = b - a
            paths = [sum(e[a + k, c >> k & 1] for k in range(n)) + sum(change[c >> k & 1, c >> (k + 1) & 1] for k in range(n - 1)) for c in range(2**n)]
            p = np.exp(paths[-1]) / np.exp(paths).sum()  # all lines good
            total += np.log(p if y[d] else 1 - p)
        return total

    field = crf_quality.Field(np.zeros(1), np.ones(1), np.zeros((1, 2)), change)
    good, weights, changes = field.marginals(e, first, y)
    step = 1e-6
    for j in (0, 1):
        for k in (0, 1):
            up = change.copy()
            up[j, k] += step
            assert (objective(e, up) - objective(e, change)) / step == pytest.approx(changes[j, k], abs=1e-4)
    pull = np.repeat(weights, sizes) * (1 - good)
    for i in range(len(e)):
        up = e.copy()
        up[i, 1] += step
        assert (objective(up, change) - objective(e, change)) / step == pytest.approx(pull[i], abs=1e-4)


def test_long_texts_are_scored_in_blocks_as_in_one(monkeypatch):
    r = random.Random(5)
    lines = [r.choice(["", "a b", "BAD | LINE !!", sentence(i, 9), "x" * 40, "again and again", "é漢"]) for i in range(500)]
    texts = ["\n".join(lines), "\n".join(lines) + "\n", "\n" * 300, "one line only " * 50, "", "short\ntext"]
    rng = np.random.default_rng(2)
    width = crf_quality.line_features(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0].shape[1]
    field = crf_quality.Field(rng.normal(size=width), rng.random(width) + 0.5, rng.normal(size=(width, 2)) / 9, rng.normal(size=(2, 2)))
    whole = field.shares(pa.array(texts))
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    plain = [field.quality(*crf_quality.line_features(d, np.array([0, len(d)])))[0] for d in data]
    assert np.allclose(whole, plain)
    for most, size, scanned in ((7, 60, 13), (64, 1 << 20, 100), (1000, 50, 1)):
        monkeypatch.setattr(crf_quality, "LINES", most)
        monkeypatch.setattr(crf_quality, "CHUNK_BYTES", size)
        monkeypatch.setattr(crf_quality, "SCANNED", scanned)
        assert np.allclose(field.shares(pa.array(texts)), plain, atol=1e-5)


def test_a_text_of_line_feeds_takes_little_memory():
    import resource

    field = crf_quality.fit_field(["fine words here"] * 9 + ["BAD !! | |\nBAD ||"] * 9, [1] * 9 + [0] * 9)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    share = field.shares(pa.array(["\n" * 3_000_000]))
    assert len(share) == 1 and 0 <= share[0] <= 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000


def test_lines_of_bad_documents_may_be_good():
    r = random.Random(4)
    good = [sentence(i, 8) for i in range(400)]
    texts = ["\n".join(r.sample(good, 4)) for _ in range(150)] + ["\n".join([*r.sample(good, 3), "BAD | LINE !! || !!"]) for _ in range(150)]
    field = crf_quality.fit_field(texts, [1] * 150 + [0] * 150)
    data = np.frombuffer(texts[-1].encode(), np.uint8)
    x, _, first = crf_quality.line_features(data, np.array([0, len(data)]))
    lines = field.marginals(field.emissions(x), first)
    assert lines[-1] < 0.2 and lines[0] > 0.8  # though all of them stand in a document of label 0
    score = field.score(field.shares(pa.array(texts)))
    assert score[:150].min() > score[150:].max()


# ---- languages ------------------------------------------------------------


def test_languages_of_held_out_documents(spark, tmp_path):
    r = random.Random(3)
    parts = {"xx": ["ka", "lo", "mi", "ru"], "yy": ["sch", "ung", "ein", "ö"], "zz": ["qu", "ait", "é", "eux"]}
    rows = []
    for i in range(300):
        lang = r.choice(list(parts))
        text = " ".join("".join(r.choice(parts[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(4, 60)))
        rows.append(row(i, text.title() if i % 3 else text, lang=lang))
    extra = [(2000 + (i or 0), t, None, s, n) for i, t, _, s, n in awkward()]
    frame(spark, rows + extra + [row(5000, "12 34 !! 😀", lang=None)]).write.parquet(str(tmp_path / "documents.parquet"))
    out = {x.doc_id: x for x in language_id.op1_language_id(spark, str(tmp_path)).collect()}
    right = [out[i].lang_pred == lang for i, _, lang, *_ in rows if out[i].held_out]
    assert sum(right) >= 0.98 * len(right)
    for i in (2001, 2002, 2003, 5000):
        assert out[i].lang_pred == "und" and out[i].score == 0 and out[i].rejected
    assert all(x.lang_pred in {*parts, "und"} and 0 <= x.score <= 1 for x in out.values())
    assert out[2008].lang_pred != "und"


def test_probabilities_sum_to_one():
    codes, ends = language_id.grams(["abab abba abc", "cab"])
    assert ends[-1] == len(codes)
    values, n = np.unique(codes, return_counts=True)
    rows = {"lang": [], "n_chars": [], "code": [], "n": [], "total": []}
    level = dict(zip(values.tolist(), n.tolist()))
    for k in range(4, 0, -1):
        if k < 4:
            up = {}
            for c in level:
                up[c & (1 << 16 * k) - 1] = up.get(c & (1 << 16 * k) - 1, 0) + 1
            level = up
        for c, m in level.items():
            total = sum(v for d, v in level.items() if d >> 16 == c >> 16)
            for name, value in zip(rows, ("xx", k, c, m, total)):
                rows[name].append(value)
    tables = language_id.build_tables({k: np.array(v, dtype=object if k == "lang" else np.uint64 if k == "code" else np.int64) for k, v in rows.items()})
    letters = sorted({c & 0xFFFF for c in values.tolist()})
    for context in ("aba", "zzz", "   ", "cab"):
        head = sum(ord(x) << 16 * (3 - i) for i, x in enumerate(context))
        p = 2.0 ** tables.log_probabilities(np.array([head | c for c in [*letters, 0x3A9]], np.uint64))
        assert p.sum() == pytest.approx(1, abs=0.02)


def test_languages_without_training_and_with_clashing_columns(spark):
    df = frame(spark, awkward()).selectExpr("*", "1 AS score", "'q' AS lang_pred")
    out = language_id.identify(df, df.filter("false")).collect()
    assert len(out) == len(awkward()) and {x.lang_pred for x in out} == {"und"}
    assert language_id.identify(df.filter("false"), df).collect() == []


def plain_tables(texts):
    """The model in memory from all n-grams of ``{language: texts}``."""
    rows = {"lang": [], "n_chars": [], "code": [], "n": [], "total": []}
    for name, mine in texts.items():
        codes, n = np.unique(language_id.grams(mine)[0], return_counts=True)
        for k in range(4, 0, -1):
            if k < 4:
                codes, n = np.unique(codes & np.uint64((1 << 16 * k) - 1), return_counts=True)
            _, of = np.unique(codes >> np.uint64(16), return_inverse=True)
            total = np.bincount(of, weights=n)[of].astype(np.int64)
            for column, value in zip(rows, ([name] * len(codes), [k] * len(codes), codes, n, total)):
                rows[column].append(value)
    return language_id.build_tables({c: np.concatenate(v) for c, v in rows.items()})


def test_rare_ngrams_of_a_large_corpus_are_kept(spark, monkeypatch):
    # Two million characters of one language, where a word stands once; files of a few rows, so that there are many.
    monkeypatch.setattr(language_id, "FILE_BYTES", 24 * 100)
    r = random.Random(5)
    draw = lambda letters, n: " ".join("".join(r.choices(letters, k=r.randrange(2, 8))) for _ in range(n))
    texts = {"aa": [(draw("abcdefgh", 50) + " ") * 200 for _ in range(40)] + ["zyxwv"], "bb": [draw("efghijkl", 60) for _ in range(50)]}
    assert sum(map(len, texts["aa"])) > 2_000_000
    training = spark.createDataFrame([(k, t) for k, v in texts.items() for t in v], "lang string, text string")
    model = language_id.learn(common.stored(language_id.gram_counts(training), "test"))
    want = plain_tables(texts)
    assert model.languages == want.languages and sum(len(f[1]) for f in model.files.values()) > 10
    codes, _ = language_id.grams(["zyxwv zyxwv", draw("abcdefgh", 30), draw("ghijklmn", 30), "\u03a9 q\U0001d400 zyx"])
    assert np.allclose(model.log_probabilities(codes), want.log_probabilities(codes), atol=1e-3)
    rare, _ = language_id.grams(["zyxwv"])
    assert model.log_probabilities(rare)[3:, 0].min() > -3


# ---- pipeline -------------------------------------------------------------


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, labels = quality_rows(120)
    passage = sentence(77_777, 30)
    rows += [row(1000 + i, sentence(60_000 + i, 50), source=f"s{i % 3}") for i in range(40)]
    rows += [row(1100, rows[-1][1] + " more"), row(1101, sentence(5, 20) + " " + passage)]
    docs, bench = frame(spark, rows), spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    for name, df in (("documents", docs), ("benchmark", bench), ("labels", spark.createDataFrame(labels, "doc_id bigint, quality int"))):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    path, seen = str(tmp_path), docs
    by_stage = []
    for _, stage in corpus_pipeline.STAGES:
        seen = common.stored(stage(spark, seen, path), "test")
        by_stage.append(seen)
    kept = [sorted(x.doc_id for x in s.collect()) for s in by_stage]
    good = sorted(x.doc_id for x in crf_quality.score_quality(docs, spark.read.parquet(f"{path}/labels.parquet")).filter("predicted = 1").collect())
    assert kept[0] == good and all(by_stage[k].columns == docs.columns for k in range(4))
    text = {r[0]: r for r in rows}
    components = plain_components([text[i] for i in good])
    assert kept[1] == sorted(i for i, (_, c) in components.items() if i == c)
    clean = [h[0] for h in plain_hits([text[i] for i in kept[1]], [(1, passage)]) if not h[2]]
    assert kept[2] == sorted(clean) and 1101 in kept[1] and 1101 not in kept[2]
    assert set(kept[3]) <= set(kept[2]) and max(kept[3].count(i) for i in kept[3]) <= 3
    check_tokens([text[i] for i in kept[3]], by_stage[4].collect())
    assert sorted(map(str, corpus_pipeline.run(spark, path).collect())) == sorted(map(str, by_stage[4].collect()))


def test_pipeline_judges_rows_with_null_and_repeated_ids_by_themselves(spark, tmp_path):
    passage = sentence(77_777, 30)
    leak = sentence(5, 20) + " " + passage
    rows = [row(None, leak), row(None, sentence(11, 40)), row(7, leak), row(7, sentence(12, 40)), row(8, sentence(13, 40)), row(9, None)]
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.decontaminate(spark, frame(spark, rows), str(tmp_path)).collect()
    assert sorted(((x.doc_id, x.text) for x in out), key=repr) == sorted(((r[0], r[1]) for r in rows if r[1] != leak), key=repr)


def test_near_dedup_stage_judges_rows_with_null_and_repeated_ids_by_themselves(spark, tmp_path):
    a, b, c = sentence(21, 60), sentence(22, 60), sentence(23, 60)
    near = a.split()
    near[-1] = "other"
    rows = [
        row(1, a), row(7, " ".join(near)), row(7, b), row(None, c), row(None, c), row(None, a), row(8, None), row(9, ""), row(9, ""),
        row(7, b), row(3, "a b"), row(2, "a b"),
    ]
    out = corpus_pipeline.near_dedup(spark, frame(spark, rows), str(tmp_path))
    assert out.columns == frame(spark, rows).columns
    got = sorted(((x.doc_id, x.text) for x in out.collect()), key=repr)
    assert got == sorted([(1, a), (7, b), (None, c), (8, None), (9, ""), (9, ""), (2, "a b")], key=repr)
    assert corpus_pipeline.near_dedup(spark, frame(spark, []), str(tmp_path)).count() == 0


def test_pipeline_of_an_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    for name, schema in (("benchmark", "item_id bigint, text string"), ("labels", "doc_id bigint, quality int")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_documents_are_not_broadcast_when_tokens_are_read(spark):
    docs = frame(spark, [row(i, sentence(i, 20)) for i in range(50)])
    out = token_files.token_output(docs, TOKENIZER, parts=5)
    assert out.count() == 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_hash_filter_has_no_false_negative(spark):
    values = np.random.default_rng(3).integers(-(2**63), 2**63, 300_000)
    table = common.HashFilter(spark, spark.createDataFrame([(int(v),) for v in values[:60_000]], "h bigint"))
    assert table(values[:60_000].view(np.uint64)).all()
    assert table(values[60_000:].view(np.uint64)).mean() < 0.1
    table.close()
    empty = common.HashFilter(spark, spark.createDataFrame([], "h bigint"))
    assert not empty(values.view(np.uint64)).any()


def test_copies_of_one_text_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "HOT", 1 / 10)
    rows = [row(i, sentence(31, 30)) for i in range(400)] + [row(1000 + i, sentence(500 + i, 30)) for i in range(30)] + [row(2000, sentence(31, 30) + " more words")]
    out = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert {x.doc_id: x.component_id for x in out} == {i: c for i, (_, c) in plain_components(rows).items()}
    plan = near_dedup.near_duplicates(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64(doc" in plan  # a large class's rows have keys of their own

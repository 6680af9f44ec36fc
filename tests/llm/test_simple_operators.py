"""Shards, mixing, secrets and URL rules against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from duoscope.llm import mixing, secrets, shards, url_rules
from tests.llm.data import SCHEMA, awkward, frame, row, sentence

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)


def write(spark, tmp_path, name, df):
    df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


# ---- shards ---------------------------------------------------------------


def test_shards_are_contiguous_and_balanced(spark, tmp_path):
    r = random.Random(1)
    rows = [row(i, "y" * r.randrange(0, 90)) for i in range(500)] + [row(1000, "z" * 700), row(1001, None)]
    out = shards.op7_shards(spark, write(spark, tmp_path, "documents", frame(spark, rows))).orderBy("doc_id").collect()
    assert len(out) == len(rows)
    start, total = 0, sum(len(t or "") + 1 for _, t, *_ in rows)
    slots = defaultdict(list)
    for (doc_id, text, *_), got in zip(sorted(rows), out):
        size = len(text or "") + 1
        assert (got.doc_id, got.size, got.start) == (doc_id, size, start)
        assert got.text_crc32 == zlib.crc32((text or "").encode())
        assert got.shard == min(15, (2 * start + size) * 16 // (2 * total))
        assert got.law == "bytes" and got.grown_shard is None
        slots[got.shard].append(got.slot)
        start += size
    assert all(v == list(range(len(v))) for v in slots.values())


def test_shards_of_awkward_rows(spark, tmp_path):
    path = write(spark, tmp_path, "documents", frame(spark, awkward()))
    first = sorted(map(str, shards.op7_shards(spark, path).collect()))
    assert len(first) == len(awkward())
    assert first == sorted(map(str, shards.op7_shards(spark, path).collect()))


def test_shards_of_an_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, size bigint, shard string, part string")
    assert shards.byte_shards(empty, 4).collect() == []
    rows = spark.createDataFrame([(1, 5, "a", "b"), (2, 5, "a", "b")], empty.schema)
    assert sorted(r.shard for r in shards.byte_shards(rows, 2).collect()) == [0, 1]


def test_shards_keep_columns_of_any_name(spark):
    names = ["doc_id", "size", "row", "key", "bytes", "total", "_total", "_rows_before", "number", "first", "a.b"]
    rows = spark.createDataFrame([tuple([i, 5] + [i * 10 + k for k in range(len(names) - 2)]) for i in range(20)], ", ".join(f"`{n}` bigint" for n in names))
    out = shards.byte_shards(rows, 4).collect()
    assert sorted(tuple(r[n] for n in names) for r in out) == sorted(tuple(r) for r in rows.collect())
    assert sorted((r.shard, r.slot) for r in out) == [(s, k) for s in range(4) for k in range(5)]


# ---- mixing ---------------------------------------------------------------


def water(sizes, weights, repeats=3):
    """Targets by sharing the excess again until no source is above its limit."""
    total, full = float(sum(sizes.values())), {}
    open_ = {s for s in sizes}
    while open_:
        left = total - sum(full.values())
        whole = sum(weights[s] for s in open_)
        above = {s for s in open_ if left * weights[s] / whole > repeats * sizes[s]}
        if not above:
            return full | {s: left * weights[s] / whole for s in open_}
        full |= {s: float(repeats * sizes[s]) for s in above}
        open_ -= above
    return full


@pytest.mark.parametrize("seed", range(3))
def test_mixing_meets_targets(spark, seed):
    r = random.Random(seed)
    names = ["a", "B", "é", "z", None]
    rows = [(i, r.choice(names[: 2 + seed]) if i % 7 else None, r.randrange(0, 60)) for i in range(400)]
    rows += [(9000, "a", 4000), (9001, "tiny", 1)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")).collect()
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    targets = water(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    taken = defaultdict(int)
    for x in out:
        assert x.source_size == sizes[x.source]
        assert x.target == pytest.approx(targets[x.source])
        assert 0 <= x.taken <= 3 * x.size and 0 <= x.copies <= 3
        taken[x.source] += x.taken
    assert len(out) == len(rows)
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 1


def test_mixing_awkward_rows_and_clashing_columns(spark):
    df = frame(spark, awkward()).withColumn("size", mixing.word_count())
    for name in ("target", "taken", "copies", "source_size"):
        df = df.selectExpr("*", f"'x' AS {name}")
    out = mixing.mix(df).collect()
    assert len(out) == len(awkward())
    assert all(x.taken <= 3 * x.size for x in out)
    assert mixing.mix(df.filter("false")).collect() == []


def test_mixing_of_wordless_documents(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "doc_id bigint, source string, size bigint")
    assert [x.taken for x in mixing.mix(df).collect()] == [0, 0]


def test_equal_keys_cross_the_threshold_together(spark):
    rows = [(1, "a", 10)] * 4 + [(2, "b", 200)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")).collect()
    assert len({x.taken for x in out if x.source == "a"}) == 1


# ---- secrets --------------------------------------------------------------


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def label(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'token')[k]}:{a}:{b}" for a, k, b in spans)


TOKEN_A, TOKEN_B, TOKEN_C = "Zz0" + "aB3" * 8, "Yy1" + "cD4" * 8, "Xx2" + "eF5" * 8


def test_tokens_by_owners_and_repositories(spark):
    rows = [(i, f"see {TOKEN_A}, ok", o, "r") for i, o in enumerate(["a", "b", None])]  # three owners
    rows += [(10 + i, f"{TOKEN_B} {TOKEN_B}", "c", f"r{i}") for i in range(3)] + [(20, "none", "c", "r3"), (21, "none", "c", "r4")]  # 3 of 5 repositories
    rows += [(30 + i, TOKEN_C, "d", f"r{i}") for i in range(3)] + [(40 + i, None, "d", f"r{3 + i}") for i in range(3)]  # 3 of 6
    schema = "doc_id bigint, text string, who string, place string"
    df = spark.createDataFrame(rows + rows[:1], schema).selectExpr("*", "1 AS base", "2 AS spans", "3 AS owner", "4 AS repo", "5 AS salt", "6 AS source")
    from pyspark.sql import functions as F

    out = secrets.scan_secrets(df, owner=F.col("who"), repo=F.col("place")).collect()
    assert len(out) == len(rows) + 1
    for x in out:
        found = [(s.start, s.kind, s.end) for s in x.spans]
        assert (x.n_live, x.n_examples) == ((0, 1) if x.doc_id < 10 else (0, 2) if x.doc_id < 20 else (1, 0) if 30 <= x.doc_id < 40 else (0, 0))
        assert found == ([(0, 3, 27)] if 30 <= x.doc_id < 40 else [])
        if x.doc_id < 10:
            assert [(e.start, e.n_owners, e.n_repos) for e in x.examples] == [(4, 3, 3)]
        if 10 <= x.doc_id < 20:
            assert [(e.start, e.n_owners, e.n_repos) for e in x.examples] == [(0, 1, 3), (28, 1, 3)]
    looser = secrets.scan_secrets(df, owner=F.col("who"), repo=F.col("place"), max_owners=3, min_repos=9).collect()
    assert all(x.n_examples == 0 for x in looser)


def test_tokens_that_overlap_base_spans_are_left_out(spark):
    rows = [row(1, f"token={TOKEN_A}x {TOKEN_B}"), row(2, f"{TOKEN_A}secret={TOKEN_B}"), row(3, f"{TOKEN_C}0123456789abcdef")]
    out = {x.doc_id: [(s.start, s.kind, s.end) for s in x.spans] for x in secrets.scan_secrets(frame(spark, rows)).collect()}
    assert out[1] == [(0, 0, 34), (35, 3, 62)]
    assert out[2] == [(27, 0, 61)]
    assert all(k < 3 for _, k, _ in out[3])


def test_many_matches_in_one_text(spark):
    import time

    text = " ".join(f"{i:016x}" for i in range(60_000)) + " 😀 " + "deadbeef" * 3
    began = time.time()
    out = secrets.scan_secrets(frame(spark, [row(1, text), row(2, "x")])).filter("doc_id = 1").first()
    assert len(out.base) == 60_001 and (out.base[-1].start, out.base[-1].end) == (60_000 * 17 + 2, 60_000 * 17 + 26)
    assert time.time() - began < 60


def test_base_spans_equal_plain_matching(spark, tmp_path):
    r = random.Random(3)
    bits = ["password", "PassWd", "secret:", "token=", "api_key", "APIKEY", "AKIA", "AKIAAKIA", ": ", "= ", "\"", "'", "😀é",
            "0123456789abcdef", "deadbeef", "Zz09+/_.=-", "XYZ0123456789", " ", "\n", "a", "=="]
    rows = [row(1000 + i, "".join(r.choice(bits) for _ in range(r.randrange(1, 25)))) for i in range(400)] + awkward()
    path = write(spark, tmp_path, "documents", frame(spark, rows))
    out = secrets.op3_secrets(spark, path).collect()
    assert len(out) == len(rows)
    by_id = {i: t or "" for i, t, *_ in rows}
    for x in out:
        spans = plain_spans(by_id[x.doc_id])
        assert x.base_sha256 == hashlib.sha256(label(spans).encode()).hexdigest()
        assert (x.n_assign, x.n_access, x.n_hex) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))
        assert set(filter(None, label(spans).split(","))) <= set(x.spans.split(","))


def test_owner_specific_tokens_are_added_and_examples_are_not(spark):
    mine, example = "Xk29fQmZ81LpTr46WbNc", "Ab3Ab3Ab3Ab3Ab3Ab3Ab3Ab3"
    rows = [row(1, f"see {mine} here", source="o1"), row(2, f"and {mine}", source="o1")]
    rows += [row(10 + i, f"like {example} always", source=f"o{i}") for i in range(4)]
    out = {x.doc_id: x for x in secrets.scan_secrets(frame(spark, rows)).collect()}
    assert [s.kind for s in out[1].spans] == [3] and out[1].spans[0].start == 4 and out[1].n_live == 1
    assert out[10].spans == [] and out[10].n_examples == 1
    assert secrets.scan_secrets(spark.createDataFrame([], SCHEMA)).collect() == []


# ---- URL rules ------------------------------------------------------------


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
        host = re.sub("[A-Z]", lambda m: m[0].lower(), cut[1])
        path = cut[2]
    fits = [
        (len(h) + len(p), len(h), a == "block", h + p, a) for h, p, a in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = min(fits, key=lambda f: (-f[0], -f[1], not f[2], f[3])) if fits else None
    return host, path, best and best[3], best[4] if best else default


def test_urls(spark):
    r = random.Random(5)
    hosts = ["net", "example.net", "a.EXAMPLE.net", "xexample.net", "example.com", "b.c.example.com", "org", "x.org", "org.", ".org", ""]
    paths = ["", "/", "/en/", "/en", "/en/1", "/de/x", "/fr/", "/FR/", "//fr/", "?/fr/", "#a", "/fr/?q#z", "/ü/é"]
    urls = [f"http://{r.choice(hosts)}{r.choice(paths)}" for _ in range(300)]
    urls += [None, "", "net/", "://net/", "a://b://net/", "http://net:80/", "http://u@net/", "http://" + "a." * 5000 + "net/" + "x/" * 5000]
    rows = list(enumerate(urls)) + [(0, urls[0])]
    rules = [*url_rules.RULES, ("net", "/en", "allow"), ("c.example.com", "/de/x", "allow"), ("", "/", "block")]
    table = spark.createDataFrame(rules, url_rules.RULE_SCHEMA)
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "'x' AS host", "'y' AS verdict")
    out = url_rules.judge_urls(pages, table).collect()
    assert len(out) == len(rows)
    wanted = [x for x in rules if x[0]]
    for x in out:
        assert (x.host, x.path, x.rule, x.verdict) == plain_verdict(x.url, wanted)
    assert url_rules.judge_urls(pages.filter("false"), table).collect() == []
    assert {x.verdict for x in url_rules.judge_urls(pages, table.filter("false")).collect()} == {"allow"}

"""Cases that the given tables do not hold."""

import random

import pytest
from pyspark.sql import functions as F

from duoscope.functions import checks, text
from duoscope.operators import filters, ledger, ordered, pairs, rubrics, sessions
from duoscope.sinks import tables
from duoscope.streaming.collect import collect_sessions

ROW = "task_id int, arm string, pos int, name string, description string, type string, points int, weight double, score int, rationale string"


def rubric(spark, n=7, **change):
    base = dict(task_id=1, arm="baseline", description="d", type="likert", points=5, weight=1.0, score=4, rationale="r")
    rows = [{**base, "pos": i + 1, "name": f"n_{i}"} for i in range(n)]
    rows[2] |= change
    fields = [f.split()[0] for f in ROW.split(", ")]
    return spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], ROW)


def verdict(df):
    return rubrics.rubric_verdict(rubrics.rubric_facts(df)).first()


def test_absent_score_is_out_of_range(spark):
    got = verdict(rubric(spark, score=None))
    assert got.reason == "score_out_of_range" and got.at_pos == 3 and got.passrate is None


@pytest.mark.parametrize("change, reason", [({}, None), ({"score": 6}, "score_out_of_range"), ({"rationale": None}, "no_rationale"),
                                            ({"points": 4}, "incomplete"), ({"type": None}, None)])
def test_verdicts(spark, change, reason):
    assert verdict(rubric(spark, **change)).reason == reason


def test_too_few_and_too_many_rows(spark):
    assert [verdict(rubric(spark, n)).reason for n in (6, 11)] == ["wrong_count"] * 2


def test_verdict_plan_has_no_sort(spark):
    df = rubrics.rubric_verdict(rubrics.rubric_facts(rubric(spark).drop("description")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_one_arm_is_not_ok(spark):
    df = spark.createDataFrame([(1, "baseline", 0.3), (2, "baseline", 0.3), (2, "candidate", 0.9)], "task_id int, arm string, passrate double")
    got = {r.task_id: r for r in pairs.with_verdict(pairs.pair_arms(df, ["passrate"])).collect()}
    assert not got[1].threshold_ok and got[1].export_ok and got[2].threshold_ok


def test_values_of_one_row_stay_together(spark):
    df = spark.createDataFrame([(1, "baseline", 1, 9), (1, "baseline", 2, 0)], "task_id int, arm string, a int, b int")
    got = pairs.pair_arms(df, ["a", "b"]).first()
    assert (got.baseline_a, got.baseline_b, got.candidate_a) == (2, 0, None)


def test_one_armed_tasks_have_no_differences(spark):
    one = rubric(spark)
    assert pairs.criterion_differences(pairs.pair_criteria(one)).count() == 0
    two = one.union(rubric(spark, name="other").withColumn("arm", F.lit("candidate")))
    assert sorted(r.rule for r in pairs.criterion_differences(pairs.pair_criteria(two)).collect()) == ["only_in_baseline", "only_in_candidate"]


def test_unknown_ids_stay_visible(spark):
    tasks = spark.createDataFrame([(1, "x"), (2, None)], "task_id long, kind string")
    got = filters.select_tasks(tasks, [2, 99, 1]).orderBy("requested").collect()
    assert [(r.task_id, r.known) for r in got] == [(2, True), (99, False), (1, True)]
    assert filters.select_tasks(tasks, [1, 99]).filter("kind IS NOT NULL OR NOT known").count() == 2


def test_delivery_tasks(spark):
    a, b = (spark.createDataFrame(x, "task_id int") for x in ([(1,)], [(2,)]))
    assert [r.task_id for r in filters.select_delivery_tasks(a, b).collect()] == [1]
    assert [r.task_id for r in filters.select_delivery_tasks(a.filter("false"), b).collect()] == [2]


def test_filters_across_types(spark):
    df = spark.createDataFrame([(1, "3", True), (2, "x", False), (3, "", None)], "task_id int, domain string, threshold_ok boolean")
    ids = lambda f, op, v: sorted(r.task_id for r in df.filter(filters.condition(df, f, op, v)).collect())
    assert ids("threshold_ok", "=", "maybe") == [] and ids("threshold_ok", "!=", "maybe") == [1, 2]
    assert ids("threshold_ok", "=", "TRUE") == [1] and ids("domain", "=", True) == [] and ids("domain", "!=", False) == [1, 2]
    assert ids("domain", ">", 2) == [1] and ids("domain", "!=", 3) == [2]
    with pytest.raises(ValueError):
        filters.condition(df, "nope", "=", 1)


def test_identity_without_models(spark):
    df = spark.createDataFrame([(None, "qwen"), ([], "other"), (["Qwen-1"], "qwen"), (["m"], "other")], "m array<string>, p string")
    assert [r[0] for r in df.select(checks.identity_matches(F.col("m"), F.col("p"))).collect()] == [False, False, True, True]


def test_urls(spark):
    urls = ["https://my_host/a", "http://a b/c d", "ftp://x/y", "https:///x", None, "git://h"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(checks.safe_url(F.col("u"))).collect()] == [True, True, False, False, False, True]


@pytest.mark.parametrize("raw, want", [
    ("# h\n" * 100_000 + "x", "x"), ("```toml\na = 1\n```", "a = 1"), ("```\r\n[[meta]]\r\n```\r\n", "[[meta]]"),
    ("text ```toml\na\n``` more", "a"), ("no fence", "no fence"), ("a" + " " * 200_000 + "b", "a" + " " * 200_000 + "b"), ("", ""),
])
def test_cleaned_output(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "r string").select(text.clean_output(F.col("r"))).first()[0] == want


def test_pattern_labels(spark):
    cases = [
        ("x BAD pattern: q2 then q1", "q1"), ("bad pattern: none, q1", ""), ("bad pattern: " + "-" * 120 + " none q2", "q2"), ("q1 and q2", ""), (None, ""), ("", ""),
        ("bad pattern: q3", ""), ("[__claude_meta: q1]\n# bad pattern: q2\nbad pattern: q1", "q1"), ("```\nbad pattern: q2\n```", "q2"),
        ("bad pattern: q1 ```toml\nx = 1\n``` end", ""), ("bad pattern: q1 ```sql\nx = 1\n``` end", "q1"), ("bad pattern: q1 ``` q2", "q1"),
    ]
    label = text.bad_pattern_label(F.col("r"), ("q1", "q2"), ("no such", "Bad Pattern"), ("none",))
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(cases)], "i int, r string")
    assert [r.v for r in df.select("i", label.alias("v")).orderBy("i").collect()] == [want for _, want in cases]


def test_texts_are_cleaned_once(spark):
    df = spark.createDataFrame([("x",)], "r string").repartition(2)
    for out in (text.bad_pattern_label(F.col("r")), text.toml_section(F.col("r"))):
        plan = df.select(out.alias("v")).filter("v <> 'y'")._jdf.queryExecution().optimizedPlan().toString()
        # The result and the filter on it.
        assert 0 < plan.count("regexp_replace") <= 4 and 0 < plan.count("lower(") <= 2


def test_hot_key_is_split_and_numbered(spark):
    r = random.Random(1)
    rows = [("hot", r.getrandbits(62), i) for i in range(3000)] + [(None, 5, 3000), (None, 5, 3001)] + [(f"k{i}", i, i) for i in range(50)]
    df = spark.createDataFrame(rows, "key string, at long, id long")
    for order, plain in ((["at", "id"], lambda x: (x[1], x[2])), ([F.col("at").desc(), F.col("id")], lambda x: (-x[1], x[2]))):
        got = {x.id: x.n for x in ordered.row_numbers(df, ["key"], order, "n").collect() if x.key == "hot"}
        want = {x[2]: i + 1 for i, x in enumerate(sorted((x for x in rows if x[0] == "hot"), key=plain))}
        assert got == want
    parts = ordered._parted(df, ["key"], ["at", "id"]).groupBy("_part").count().collect()
    assert max(p["count"] for p in parts) < 1500


def test_running_sum_and_last_seen(spark):
    r = random.Random(2)
    rows = [(r.choice("ab"), i, r.randrange(9), r.choice([None, "x", "y"])) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, at int, v long, w string")
    sums = {x.at: x.s for x in ordered.running_sum(df, ["key"], ["at"], "v", "s").collect()}
    seen = {x.at: x.l for x in ordered.last_seen(df, ["key"], ["at"], "w", "l").collect()}
    total, last = {"a": 0, "b": 0}, {"a": None, "b": None}
    for k, at, v, w in rows:
        assert sums[at] == total[k] and seen[at] == last[k]
        total[k] += v
        last[k] = w or last[k]


def test_ledger_rules(spark):
    rows = [(1, "run", "a", 1, "done", 2, 5.0, False), (1, "run", "a", 2, None, 3, None, False), (1, "run", "a", 3, "failed", None, None, False),
            (2, "run", "a", 1, "done", 1, 1.0, False), (2, "run", "a", 2, None, None, None, True),
            (3, "run", "a", 1, "done", 1, 1.0, True), (3, "run", "a", 2, "partial", None, 7.0, False)]
    df = spark.createDataFrame(rows, "task_id int, stage string, arm string, seq long, status string, retry_count int, duration_s double, deleted boolean")
    got = {r.task_id: (r.status, r.retry_count, r.duration_s) for r in ledger.current_state(df).collect()}
    assert got == {1: ("failed", 3, None), 3: ("partial", None, 7.0)}


def test_repeats_are_compared_as_a_whole(spark):
    head = "h" * 400
    rows = [(1, 1, False, "A", head + "1"), (1, 2, False, "B", head + "2"), (1, 3, True, "C", head + "1"), (1, 4, False, "D", head + "1")]
    df = spark.createDataFrame(rows, "s int, at int, err boolean, tool string, text string")
    got = [(r.is_first, r.same_as) for r in sessions.repeated_results(df, ["s"], "at", "text", "err", "tool").orderBy("at").collect()]
    assert got == [(True, None), (True, None), (True, None), (False, "C")]


def test_session_scan(spark, tmp_path):
    lines = ['{"type":"user","sessionId":"s1","timestamp":"t1","message":{"content":"hi"}}', "", "[1]", "bad", '{"type":"assistant","timestamp":"t2","message":{"model":"m1"}}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    rows = sessions.session_rows(sessions.read_sessions(spark, str(tmp_path)))
    got = sessions.session_facts(rows, ["session_id_key"], "line_key").first()
    assert (got.line_count, got.user_turns, got.session_id, got.models, got.last_at, got.first_user_query) == (4, 1, "s1", ["m1"], "t2", "hi")


def test_stream_collects_once(spark, tmp_path):
    land, out = tmp_path / "land", str(tmp_path / "out")
    land.mkdir()
    line = '{"type":"user","sessionId":"%s","message":{"content":"q"}}\n'
    for i in range(3):
        (land / f"{i}.jsonl").write_text((line % f"s{i}") * (i + 1))
    for more in (0, 0, 1):
        if more:
            (land / "9.jsonl").write_text(line % "s9")
        collect_sessions(spark, str(land), out, f"collect-{tmp_path.name}")
        rows = spark.read.parquet(out).collect()
        assert sorted(r.line_count for r in rows) == sorted([1, 2, 3] + [1] * more)


def test_stream_judges_what_it_collects(spark, tmp_path):
    land, out = tmp_path / "land", str(tmp_path / "out")
    land.mkdir()
    user = '{"type":"user","sessionId":"s1","message":{"role":"user","content":[{"type":"text","text":"q"}]}}\n'
    model = '{"type":"assistant","message":{"role":"assistant","model":"Qwen-1","content":"a"}}\n'
    (land / "good.jsonl").write_text((user + model) * 6)
    (land / "short.jsonl").write_text(user + model)
    (land / "other.jsonl").write_text(user)
    seen = spark.read.text(str(land)).select(F.col("_metadata.file_path").alias("file_path")).distinct().filter("file_path NOT LIKE '%other%'")
    runs = seen.select("file_path", F.lit("collect").alias("action"), F.lit("qwen").alias("provider"), F.lit("s1").alias("session"))
    collect_sessions(spark, str(land), out, f"judged-{tmp_path.name}", runs)
    got = {r.file_path.rsplit("/", 1)[1]: (r.status, r.error, r.first_user_query) for r in spark.read.parquet(out).collect()}
    assert got == {"good.jsonl": ("done", None, "q"), "short.jsonl": ("failed", "incomplete", "q"), "other.jsonl": (None, None, "q")}


def test_session_defaults(spark):
    from duoscope.session import DEFAULTS, build_session

    session = build_session("x", **{"spark.sql.adaptive.enabled": "false"})
    assert session.conf.get("spark.sql.adaptive.enabled") == "false" and "spark.sql.adaptive.skewJoin.enabled" in DEFAULTS
    session.conf.set("spark.sql.adaptive.enabled", "true")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("x-1", 0.5)], "id string, baseline_passrate double")
    tables.write_submission(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert len(back.columns) == 13 and back.first()["baseline passrate"] == "0.5"
    writes = spark.createDataFrame([(1, "run", "a", 1, "done", None, None, False)], "task_id int, stage string, arm string, seq long, status string, retry_count int, duration_s double, deleted boolean")
    for _ in range(2):
        tables.append_ledger(writes, str(tmp_path / "ledger"))
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2
    good = tables.write_drafts(spark.createDataFrame([("a", None), ("b", "bad")], "answer string, error string"), str(tmp_path / "drafts"))
    assert [r.answer for r in good.collect()] == ["a"] and spark.read.parquet(str(tmp_path / "drafts")).first().status == "draft"
    old, new = (spark.createDataFrame(x, "task_id int, v string") for x in ([(1, "old")], [(1, "new"), (2, "new")]))
    assert sorted((r.task_id, r.v) for r in tables.merge_manifest(old, new).collect()) == [(1, "old"), (2, "new")]

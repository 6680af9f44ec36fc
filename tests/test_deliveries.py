"""Answers, reports and files of deliveries, in cases that the given tables do not hold."""

import json

import pytest
from pyspark.sql import functions as F

from duoscope.operators import answers, pairs, pool, prompts, reports, rules, sessions
from duoscope.sources import delivery_files as D

ROW = "answer int, pos int, name string, score string, rationale string, description string, weight double"


def rubric(n=7, **change):
    rows = [dict(answer=1, pos=i + 1, name=f"n_{i}", score="4", rationale="r", description="d", weight=1.0) for i in range(n)]
    for k, v in change.items():
        rows[2][k] = v
    return rows


def verdict(spark, rows, **options):
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in ROW.split(", ")) for r in rows], ROW)
    got = answers.answer_verdicts(df, ["answer"], **options).first()
    return got.error, got.at_pos


@pytest.mark.parametrize("change, want", [
    ({}, (None, None)), ({"name": "Bad"}, ("invalid_name", 3)), ({"name": None}, ("invalid_name", 3)), ({"name": "n_0"}, ("repeated_name", 3)),
    ({"score": "3.0"}, ("score_not_whole", 3)), ({"score": "x"}, ("score_not_whole", 3)), ({"score": "6"}, ("score_out_of_range", 3)),
    ({"score": None}, ("score_out_of_range", 3)), ({"score": "99999999999999999999"}, ("score_out_of_range", 3)), ({"rationale": ""}, ("no_rationale", 3)),
    ({"name": "n_0", "score": "9"}, ("repeated_name", 3)), ({"name": "Bad", "score": "9"}, ("invalid_name", 3)),
])
def test_first_failing_check(spark, change, want):
    assert verdict(spark, rubric(**change)) == want


def test_counts_templates_and_tiers(spark):
    assert verdict(spark, rubric(6)) == ("wrong_count", None) and verdict(spark, rubric(11, name="Bad")) == ("wrong_count", None)
    names = "answer int, name string, description string, weight double"
    same = spark.createDataFrame([(1, f"n_{i}", "T", 2.0) for i in range(7)], names)
    assert verdict(spark, rubric(), template=same) == (None, None)
    assert verdict(spark, rubric(8), template=same) == ("names_differ", None)
    assert verdict(spark, rubric(name="n_9"), template=same) == ("names_differ", None)
    other = spark.createDataFrame([(2, "x", "T", 2.0)], names)
    assert verdict(spark, rubric(), template=other) == (None, None)
    assert verdict(spark, rubric(), own_descriptions=True) == ("no_tiers", 1)
    assert verdict(spark, rubric(), own_descriptions=True, template=same) == (None, None)
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in ROW.split(", ")) for r in rubric()], ROW)
    kept = answers.accepted_rows(df, answers.answer_verdicts(df, ["answer"], same), ["answer"], same).collect()
    assert len(kept) == 7 and {(r.description, r.weight, r.score, r.points) for r in kept} == {("T", 2.0, 4, 5)}


@pytest.mark.parametrize("raw, want", [
    ('{"prompt":"p","followups_qwen":["a","b"],"followups_claude":["a","b","c"]}', (None, "p", False)),
    ('x {"prompt":null,"followups_qwen":["a","b"],"followups_claude":["a","b","c"]} y', (None, None, False)),
    ('{"prompt_qwen":"q","prompt_claude":"c","followups_qwen":["a","b"],"followups_claude":["a","b","c"]}', (None, "q", True)),
    ('{"prompt_qwen":"q","followups_qwen":["a","b"],"followups_claude":["a","b","c"]}', ("keys_missing", None, None)),
    ('{"prompt":"p","followups_qwen":["a","b"]}', ("keys_missing", None, None)), ('{"x":1}', ("no_prompt", None, None)),
    ('{"prompt":"p","followups_qwen":"ab","followups_claude":["a","b","c"]}', ("followups_not_a_list", None, None)),
    ('{"prompt":"p","followups_qwen":["a"],"followups_claude":["a","b","c"]}', ("too_few_followups", None, None)),
    ("[1]", ("not_an_object", None, None)), ('{"a":1} and {"b":2}', ("unreadable", None, None)), ("", ("unreadable", None, None)), (None, ("unreadable", None, None)),
    ("[__claude_meta: x]\n" + '{"x":1}', ("no_prompt", None, None)),
])
def test_salvaged_tasks(spark, raw, want):
    got = answers.salvaged_tasks(spark.createDataFrame([(raw,)], "raw string")).first()
    assert (got.error, got.prompt, got.is_legacy) == want


def test_salvaged_ideas(spark):
    idea = '{"task_title":"t","task_description":"d"}'
    raws = [idea, f"x [{idea}, 3, {{}}] y", "[1]", "7", "nothing", None]
    df = spark.createDataFrame(list(enumerate(raws)), "a int, raw string")
    out = answers.salvaged_ideas(df)
    assert [r.error for r in out.orderBy("a").collect()] == [None, None, "no_idea", "wrong_kind", "unreadable", "unreadable"]
    assert sorted((r.a, r.n, r.title) for r in answers.idea_rows(out, "a").collect()) == [(0, 1, "t"), (1, 1, "t")]


def test_answers_are_parsed_once(spark):
    good = '{"task_title":"t","task_description":"d"}'
    raws = [f"Ideas: [{good}, {good}, {{}}] end", "t [1]", "-1", '"s"', "null", "Infinity", "", f"{good}, {good}", f"[__claude_meta: x]\n[{good}]", f"x [__claude_meta: y]\n{good}"]
    out = answers.salvaged_ideas(spark.createDataFrame(list(enumerate(raws)), "a int, raw string"))
    assert [(r.error, r.n) for r in out.selectExpr("a", "error", "size(ideas) AS n").orderBy("a").collect()] == [
        (None, 2), ("no_idea", None), ("wrong_kind", None), ("wrong_kind", None), ("wrong_kind", None),
        ("unreadable", None), ("unreadable", None), ("unreadable", None), (None, 1), (None, 1)]
    parses = lambda df: df._jdf.queryExecution().executedPlan().toString().count("parseJson")
    # The whole, its part in braces and its part in brackets; a filter on the error looks at them once more.
    assert parses(answers.idea_rows(out, "a")) == 3 and parses(out.filter("error IS NOT NULL")) <= 6
    assert parses(answers.salvaged_tasks(out.select("a", "raw")).filter("error IS NULL")) <= 4


def test_scores_of_any_size_are_paired(spark):
    rows = [(1, a, p, "n", s, "d") for a, p, s in (("baseline", 1, 3), ("baseline", 2, 9), ("candidate", 1, -20), ("candidate", 0, 5))]
    got = pairs.pair_criteria(spark.createDataFrame(rows, "task_id int, arm string, pos int, name string, score int, description string")).first()
    assert (got.baseline_score, got.candidate_score) == (9, -20)


def test_records_without_reasons_stay(spark):
    records = spark.createDataFrame([(1, True), (2, False)], "task_id int, threshold_ok boolean")
    reasons = spark.createDataFrame([(2, "missing", None)], "task_id int, baseline_reason string, candidate_reason string")
    assert {r.task_id: r.status for r in rules.finalize(records, reasons).collect()} == {1: "done", 2: "failed"}


def test_reconciled_arms(spark):
    facts = spark.createDataFrame([("CT-1", "a", "f.jsonl", "s", 0.5), ("CT-2", "a", None, None, None), ("CT-3", "a", "f", "s", 0.5)], "task_id string, arm string, session_file string, session_id string, passrate double")
    said = spark.createDataFrame(
        [("CT-1", "a", "trajectories/a/a-1.jsonl", "s", "scores/a/a-1.quality.toml", "0.50005"), ("CT-2", "a", "x", "s", "y", "z")],
        "task_id string, arm string, trajectory string, session_id string, score_path string, passrate string")
    got = sorted((r.task_id, r.rule) for r in rules.reconcile_arms(facts, said).collect())
    assert got == [("CT-2", "score_path_differs"), ("CT-2", "session_differs"), ("CT-2", "session_path_differs"), ("CT-3", "not_published")]


def test_collection_of_salvaged_and_forced_runs(spark):
    runs = [("a", "collect", "qwen", "s1"), ("b", "salvage", "qwen", "s1"), ("c", "salvage", "qwen", ""), ("d", "force_collect", "qwen", "other"),
            ("e", "collect", "qwen", "a/b"), ("f", "salvage", "qwen", ""), ("g", "collect", "qwen", ""), ("h", "skip", "qwen", ""), ("i", "collect", "claude", "")]
    facts = [("a", 20, "s2", "qwen", ["m"]), ("b", 20, "s2", "qwen", []), ("c", 1, None, "unknown", []), ("d", 20, "s1", "qwen", ["m"]), ("e", 20, "s", "qwen", ["m"]), ("g", 5, "s", "qwen", ["m"]), ("i", 20, "s", "qwen", ["m"])]
    got = sessions.collect_result(
        spark.createDataFrame(runs, "run string, action string, provider string, session string"),
        spark.createDataFrame(facts, "run string, line_count bigint, session_id string, provider string, models array<string>"), "run")
    assert {r.run: (r.status, r.error, r.recovery) for r in got.collect()} == {
        "a": ("failed", "session_mismatch", False), "b": ("partial", None, True), "c": ("partial", None, True), "d": ("done", None, True),
        "e": ("failed", "bad_session_format", False), "f": ("skipped", "no_file", True), "g": ("failed", "incomplete", False), "i": ("failed", "provider_mismatch", False),
    }


def test_samples_of_strata(spark):
    rows = spark.createDataFrame([(i, "hot" if i < 300 else f"s{i % 5}", 0.0 if i % 50 == 0 else 1.0 + i % 3) for i in range(400)], "slot bigint, domain string, weight double")
    drawn = pool.stratified_sample(rows, ["domain"], "slot", "weight", 7, 3)
    sizes = {r.domain: r["count"] for r in drawn.groupBy("domain").count().collect()}
    assert sizes == {"hot": 7, **{f"s{i}": 7 for i in range(5)}} and drawn.filter("weight = 0").count() == 0
    again = pool.stratified_sample(rows.repartition(7), ["domain"], "slot", "weight", 7, 3)
    assert sorted(r.slot for r in again.collect()) == sorted(r.slot for r in drawn.collect())
    assert "WindowGroupLimit" in drawn._jdf.queryExecution().executedPlan().toString()
    assert pool.stratified_sample(rows, ["domain"], "slot", "weight", 999, 3, excluded=rows.filter("slot < 300")).count() == 98
    heavy = [pool.stratified_sample(rows.withColumn("weight", F.when(F.col("slot") == 1, 1e6).otherwise(1.0)), [], "slot", "weight", 1, s).first().slot for s in range(5)]
    assert heavy == [1] * 5


def test_document_is_one_json_document(spark, tmp_path):
    entries = spark.createDataFrame([(i, f'v"{i}\n') for i in range(50, 0, -1)] + [(51, None)], "task_id bigint, v string").repartition(6)
    summary = spark.createDataFrame([(51, None)], "n bigint, mean double")
    reports.write_document(reports.document_lines({"delivery_date": None, "person_id": "p1"}, entries, summary), str(tmp_path / "d"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "d").glob("part-*")))
    doc = json.loads(text)
    assert doc["batch_info"] == {"delivery_date": None, "person_id": "p1", "task_count": 51} and doc["summary"] == {"n": 51, "mean": None}
    assert [t["task_id"] for t in doc["tasks"]] == list(range(1, 52)) and doc["tasks"][-1]["v"] is None and doc["tasks"][0]["v"] == 'v"1\n'
    parts = reports.read_document(spark, str(tmp_path / "d"))
    assert parts["tasks"].count() == 51 and parts["summary"].count() == parts["batch_info"].count() == 1
    reports.write_document(reports.document_lines({}, entries.limit(0), summary), str(tmp_path / "e"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "e").glob("part-*"))))["tasks"] == []


def test_reports_of_rubrics(spark):
    rows = [(t, a, i + 1, f"n_{i}", "d", "likert", 5, 1.0, s, "r") for t in (1, 2) for a, s in (("baseline", 2), ("candidate", 5)) for i in range(7 if t == 1 else 6)]
    criteria = spark.createDataFrame(rows, "task_id bigint, arm string, pos int, name string, description string, type string, points int, weight double, score int, rationale string")
    done = {r.task_id: r.status for r in reports.finalize_report(criteria, spark.createDataFrame([(1, "x")], "task_id bigint, kind string")).collect()}
    assert done == {1: "done", 2: "partial"}
    published = spark.createDataFrame([(1, "1.0", "odd"), (2, None, "core")], "task_id bigint, published string, label string")
    people = spark.createDataFrame([(1, "baseline", "q", 2, "h", 2), (1, "candidate", "z", 5, "h", 3)], "task_id bigint, arm string, first_user_query string, user_turns int, commit_hash string, n_followups int")
    issues = reports.validate_report(criteria, published, people, spark.createDataFrame([("core",)], "label string"), deep=True)
    got = sorted((r.task_id, r.rule) for r in issues.collect())
    assert got == [(1, "followups_differ"), (1, "query_differs"), (1, "turns_unbalanced"), (1, "unknown_label"), (2, "wrong_count")]


def test_submission_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffid,baseline passrate,任务类型\nCT-1,0.1,"a ""b"",\nc"\n,9,x\nCT-2,0.2,y\nCT-1,0.3,z\n', encoding="utf-8")
    got = {r.id: (r.baseline_passrate, r.task_type, r.domain) for r in D.read_submission(spark, str(tmp_path)).collect()}
    assert got == {"CT-1": ("0.3", "z", None), "CT-2": ("0.2", "y", None)}


def test_manifests_pools_and_assignments_as_others_write_them(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"tasks": [{"id": "CT-1", "prompt_claude": "c", "followups_qwen": ["x"]}, {"title": "no id"}, {"id": "CT-2", "prompt": "p", "clone_method": "zip"}]}, indent=2))
    got = [(r.task_id, r.pos, r.prompt, r.clone_method, r.baseline_followups) for r in D.read_manifests(spark, str(tmp_path)).orderBy("pos").collect()]
    assert got == [("CT-1", 0, "c", "git", ["x"]), ("CT-2", 2, "p", "zip", [])]
    folder = tmp_path / "p"
    folder.mkdir()
    (folder / "pool.json").write_text(json.dumps({"_generated": "x", "k": {"needed": 3, "repos": [{"full_name": "a/b", "clone_url": "u", "stars": 5}, "c/d"]}, "e": {"needed": 1, "repos": []}}, indent=1))
    assert [(r.key, r.needed, r.pos, r.repo, r.stars) for r in D.read_pool(spark, str(folder), whole=True).orderBy("pos").collect()] == [("k", 3, 0, "a/b", 5), ("k", 3, 1, "c/d", None)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a/as.json").write_text(json.dumps({"_persons": 2, "assignments": {"1": {"k": ["a", "b"]}, "2": {"k": ["c"]}}}, indent=1))
    rows = D.read_assignments(spark, str(tmp_path / "a"), whole=True)
    assert sorted((r.person, r.pos, r.repo) for r in rows.collect()) == [("1", 0, "a"), ("1", 1, "b"), ("2", 0, "c")]
    assert D.read_assignments(spark, str(tmp_path / "a"), whole=True, person="3").count() == 0


def test_long_keys_are_written_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "CHUNK", 10)
    rows = spark.createDataFrame([("k", f"r{i:03}", i) for i in range(37)], "key string, repo string, pos bigint")
    D.write_pool(rows, spark.createDataFrame([("k", 9)], "key string, needed bigint"), str(tmp_path / "p"), {"generated": "now"})
    back = D.read_pool(spark, str(tmp_path / "p")).orderBy("pos").collect()
    assert [(r.repo, r.pos, r.needed) for r in back] == [(f"r{i:03}", i, 9) for i in range(37)]
    lines = [json.loads(x) for p in (tmp_path / "p").glob("part-*") for x in p.read_text().splitlines()]
    assert {"_generated": "now"} in lines and max(len(x["k"]["repos"]) for x in lines if "k" in x) == 10


def test_metadata(spark):
    md = (
        "# CT-1\n- Project path: C:\\work\\proj  \n- Task type:  fix \n- Application domain:\n- Language: py\n\n## Project Summary\n```text\n a\nb \n```\n\n- Title: T\n"
        "- Acceptance criteria:\n  - one\n    - two -\n\n- Initial prompt:\n\n```text\np1\n\n```\n- Initial prompt: \n```text\np2\n```  "
    )
    got = D.metadata_fields(spark.createDataFrame([(md,), ("",), (None,)], "text string")).collect()
    r = got[0]
    assert (r.project_path, r.project_name, r.task_type, r.language, r.project_summary) == ("C:\\work\\proj", "proj", "fix", "py", "a\nb")
    assert (r.prompts, r.task_description, r.followups, r.acceptance_criteria) == ("p1 | p2", "p1", None, "one | two - |  | Initial prompt:")
    assert all(v is None for x in got[1:] for k, v in x.asDict().items() if k != "text")


def test_prompts_show_neither_arm_nor_score(spark):
    sessions_ = spark.createDataFrame([(1, 7, "SAID"), (2, 8, "MORE")], "session int, task_id int, condensed string")
    contexts = spark.createDataFrame([(7, "fix", "")], "task_id int, task_type string, domain string")
    criteria = spark.createDataFrame([(7, 2, "b", "B", 2.0), (7, 1, "a", "A", 1.0)], "task_id int, pos int, name string, description string, weight double")
    got = {r.session: r.prompt for r in prompts.judge_prompts(sessions_, contexts, criteria, "Do.").collect()}
    assert got[1] == "Do.\n\n## Task\n\n- Task type: fix\n\n## Criteria\n\n1. a (1.0): A\n2. b (2.0): B\n\n---\n\n## Session\n\nSAID"
    assert got[2] == "Do.\n\n---\n\n## Session\n\nMORE"


def test_people_below_target(spark):
    assigned = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", 2, "c"), ("k", 9, "d"), ("k", 9, "e")], "key string, person bigint, repo string")
    targets = spark.createDataFrame([("k", 2), ("none", 1), ("zero", 0)], "key string, target bigint")
    got = pool.people_below_target(assigned, targets, spark.range(1, 4).toDF("person")).collect()
    assert sorted((r.key, r.n_people) for r in got) == [("k", 2), ("none", 3)]

"""Ledger files, snapshots, the ledger stream and heads of session files."""

import json
import random

from pyspark.sql import functions as F

from duoscope.operators import ledger as L
from duoscope.sources import ledger_files, session_files
from duoscope.streaming import ledger as S

WRITES = "task_id bigint, stage string, arm string, seq bigint, status string, retry_count int, duration_s double, deleted boolean"


def writes(seed, n=400):
    r = random.Random(seed)
    return [
        (r.randrange(6), r.choice(["run", "score"]), r.choice(["a", "b"]), i, r.choice([None, "done", "failed"]), r.choice([None, 1, 2]),
         r.choice([None, 1.5, 2.5]), r.random() < 0.1) for i in range(n)
    ]


def replayed(rows):
    """The ledger as one writer keeps it."""
    cells = {}
    for task, stage, arm, seq, status, tries, took, gone in sorted(rows, key=lambda r: r[3]):
        key = (task, stage, arm)
        if gone:
            cells.pop(key, None)
            continue
        old = cells.get(key, {})
        new = {k: v for k, v in (("status", status), ("retry_count", tries), ("duration_s", took)) if v is not None}
        if status is not None:
            kept = {"retry_count": old["retry_count"]} if "retry_count" in old and tries is None else {}
            cells[key] = kept | new
        else:
            cells[key] = old | new
        cells[key]["seq"] = seq
    return {k: (v.get("status"), v.get("retry_count"), v.get("duration_s"), v["seq"]) for k, v in cells.items()}


def state(df):
    return {(r.task_id, r.stage, r.arm): (r.status, r.retry_count, r.duration_s, r.seq) for r in df.collect()}


def test_state_is_that_of_one_writer(spark):
    for seed in range(3):
        rows = writes(seed)
        assert state(L.current_state(spark.createDataFrame(rows, WRITES))) == replayed(rows)


def test_state_is_one_aggregation_without_a_join(spark):
    plan = L.current_state(spark.createDataFrame(writes(1, 5), WRITES))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_partial_states_add_up_in_any_order_and_repeatedly(spark):
    rows = writes(4)
    want, r = replayed(rows), random.Random(1)
    for _ in range(2):
        shuffled = rows * 2
        r.shuffle(shuffled)
        cuts = sorted(r.sample(range(len(shuffled)), 3))
        parts = [L.partial_state(spark.createDataFrame(shuffled[a:b], WRITES)) for a, b in zip([0, *cuts], [*cuts, len(shuffled)])]
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        assert state(L.final_state(L.merged_state(both))) == want


def test_stream_follows_late_and_repeated_files_and_restarts(spark, tmp_path):
    rows, land, out = writes(5), str(tmp_path / "land"), str(tmp_path / "state")
    parts = [rows[i::4] for i in range(4)]
    name = f"ledger-{tmp_path.name}"

    def follow():
        landed = spark.readStream.schema(WRITES).option("maxFilesPerTrigger", 1).parquet(land)
        S.follow_ledger(spark, landed, out, name=name)

    for k in (3, 0):
        spark.createDataFrame(parts[k], WRITES).coalesce(1).write.mode("append").parquet(land)
    follow()
    assert state(S.followed_state(spark, out)) == replayed(parts[0] + parts[3])
    for k in (1, 2, 0):
        spark.createDataFrame(parts[k], WRITES).coalesce(1).write.mode("append").parquet(land)
    follow()  # a new query goes on where the last one stopped
    follow()
    assert state(S.followed_state(spark, out)) == replayed(rows)
    assert len(S._versions(out)) == 2


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    out = str(tmp_path)
    S.compact(spark, spark.createDataFrame(writes(6), WRITES), out)
    _, before = S._snapshot(spark, out)
    again = L.merged_state(before.unionByName(L.partial_state(spark.createDataFrame(writes(6), WRITES))))
    assert state(L.final_state(again)) == state(S.followed_state(spark, out)) == replayed(writes(6))


def test_compaction_keeps_the_state(spark, tmp_path):
    rows, out = writes(7), str(tmp_path)
    df = spark.createDataFrame(rows, WRITES)
    assert S.compact(spark, df.filter("seq < 150"), out) == 0 and S.compact(spark, df.filter("seq >= 150 AND seq < 300"), out) == 1
    assert state(S.compacted_state(spark, out, df.filter("seq >= 300"))) == replayed(rows)


def test_reset_by_selection(spark):
    rows = writes(8)
    df = spark.createDataFrame(rows, WRITES)
    selection = spark.createDataFrame([(1, None, None), (None, "run", "b"), (2, "score", "a"), (9, "run", None)], "task_id bigint, stage string, arm string")
    gone = L.reset_writes(L.current_state(df), selection)
    want = {k: v for k, v in replayed(rows).items() if not (k[0] == 1 or k[1:] == ("run", "b") or k == (2, "score", "a"))}
    assert state(L.current_state(df.unionByName(gone.select(*df.columns)))) == want
    every = L.reset_writes(L.current_state(df), selection.limit(0).union(spark.createDataFrame([(None, None, None)], selection.schema)))
    assert L.current_state(df.unionByName(every.select(*df.columns))).count() == 0


def test_ledger_scan_and_quarantine(spark, tmp_path):
    good = {
        "_gen_used_repos": ["x"], "CT-1": {
            "prepare": {"status": "done"},
            "run": {"a": {"status": "partial", "duration_s": 1.5, "expected_turns": 3, "turns_detail": [{"turn": 1, "exit_code": 0, "duration_s": 1.0, "session_id": "s"}, {"turn": 2, "exit_code": 1}]}, "b": 7},
        }, "CT-2": {"finalize": {"retry_count": 2}, "run": {}}, "CT-3": None,
    }
    for name, body in (("good.json", json.dumps(good, indent=2)), ("bad.json", "{"), ("list.json", "[1]"), ("empty.json", " \n")):
        (tmp_path / name).write_text(body)
    ledgers = ledger_files.read_ledgers(spark, str(tmp_path))
    cells = ledger_files.ledger_cells(ledgers)
    assert sorted((r.task, r.stage, r.arm, r.status, r.retry_count) for r in cells.collect()) == [
        ("CT-1", "prepare", None, "done", None), ("CT-1", "run", "a", "partial", None), ("CT-2", "finalize", None, None, 2),
    ]
    turns = [(r.task, r.arm, r.turn, r.exit_code, r.session_id, r.expected_turns) for r in ledger_files.turn_log(cells).orderBy("turn").collect()]
    assert turns == [("CT-1", "a", 1, 0, "s", 3), ("CT-1", "a", 2, 1, "", 3)]
    bad = {r.file.rsplit("/", 1)[1]: r.reason for r in ledger_files.quarantined(ledgers).collect()}
    assert bad == {"bad.json": "not_json", "list.json": "not_an_object", "empty.json": "empty"}
    status = L.run_status(ledger_files.turn_log(cells).withColumnRenamed("task", "task_id")).first()
    assert (status.status, status.n_turns, status.session_id) == ("partial", 2, "s")


def test_ledger_documents_escape_names(spark):
    rows = [("l", 'a"b\\c', "run", 'x"y', "done"), ("l", "t", "prepare", None, None)]
    df = spark.createDataFrame(rows, "ledger string, task string, stage string, arm string, status string")
    doc = json.loads(ledger_files.ledger_documents(df).first().json)
    assert doc == {'a"b\\c': {"run": {'x"y': {"status": "done"}}}, "t": {"prepare": {}}}


def test_heads_are_read_and_tails_are_not(spark, tmp_path):
    folder = tmp_path / "slug"
    folder.mkdir()
    line = lambda s: json.dumps({"sessionId": s, "x": "y" * 100})
    (folder / "a.jsonl").write_text("\n".join([line("s1"), "", "bad", "[1]", line("s1")] + [line("s2")] * 3 + [line("late")] * 100_000))
    (folder / "b.jsonl").write_bytes(b"\xff\xfe\n" * 49 + line("s3").encode() + b"\n" + line("late").encode())
    (folder / "c.jsonl").write_text("")
    (folder / "d.jsonl").write_text(line("s4"))
    files = session_files.session_files(spark, str(tmp_path))
    assert sorted((r.slug, r.stem) for r in files.collect()) == [("slug", s) for s in "abd"]  # an empty file is not listed
    found = session_files.head_sessions(files, 8).collect()
    got = {(r.file[-7], r.session) for r in found}
    assert got == {("a", "s1"), ("a", "s2"), ("b", None), ("d", "s4")}
    assert max(r.read for r in found) <= session_files.STEP
    assert {r.session for r in session_files.head_sessions(files, 50).collect() if r.file[-7] == "b"} == {"s3"}
    known = session_files.known_files(files, 8)
    assert {(r.file[-7], r.session) for r in known.collect()} == {(s, s) for s in "abd"} | {("a", "s1"), ("a", "s2"), ("d", "s4")}
    assert known.filter(F.col("mtime") > 0).count() == known.count()

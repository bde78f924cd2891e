import hashlib
import json

import pytest
from pyspark.sql import functions as F

from wayline.sources import records


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def golden(tmp_path):
    for version, files in {"v1": ["calibration"], "v2": ["calibration", "holdout"], "v10": [], "notes": ["calibration"]}.items():
        (tmp_path / version).mkdir()
        for name in files:
            (tmp_path / version / f"{name}.jsonl").write_text("".join(json.dumps({"golden_id": f"{version}-{name}-{i}"}) + "\n" for i in range(2)))
        (tmp_path / version / "other.jsonl").write_text("not json\n")
    (tmp_path / "v10" / "manifest.json").write_text("{}")
    return str(tmp_path)


def test_frozen_versions(spark, golden):
    assert {r.version for r in records.version_list(spark, golden).collect()} == {1, 2, 10}
    got = {(r.golden_id, r["__split__"]) for r in records.frozen_rows(spark, golden, "v2", "golden_id STRING").collect()}
    assert got == {(f"v2-{s}-{i}", s) for s in ("calibration", "holdout") for i in range(2)}
    assert records.read_strict(spark, f"{golden}/v1/calibration.jsonl", "golden_id STRING").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_strict(spark, f"{golden}/v1/other.jsonl", "golden_id STRING").collect()


def test_side_tables(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.jsonl").write_text('{"archive": "a", "schema_version": "2", "body_key": "k", "lines": ["x"]}\n{"archive": "b", "schema_version": "1", "body_key": "k"}\n')
    assert [tuple(r) for r in records.refinements(spark, str(tmp_path / "r"), "2").collect()] == [("a", "k", ["x"])]
    (tmp_path / "s").mkdir()
    for b in ("positive", "negative", "skip"):
        (tmp_path / "s" / f"{b}.jsonl").write_text('{"sample_id": "%s1"}\n' % b)
    got = {(r.sample_id, r.bucket) for r in records.scout_records(spark, str(tmp_path / "s"), ["positive", "skip"], "sample_id STRING").collect()}
    assert got == {("positive1", "positive"), ("skip1", "skip")}
    probes = frame(spark, [("t", "u", "bad", "2020"), ("t", "u", "good", "2021"), ("t", "v", "x", "2019")], "task_id string, final_url string, outcome string, file string")
    assert {tuple(r) for r in records.media_index(probes).collect()} == {("t", "u", "good"), ("t", "v", "x")}
    plans = frame(spark, [([("t1", "q", True), ("", "q", True), ("t2", " ", True), ("t3", "q", None)],), ([],)], "entries array<struct<task_id string, query string, rewritten boolean>>")
    assert [r.skip_reason for r in records.plan_entries(plans).collect()] == [None, "no_task_id", "no_query", "not_rewritten"]


def test_latest_annotations_and_views(spark):
    one = lambda at, cancelled, verdict: (at, cancelled, "me", verdict, None)
    tasks = frame(spark, [(1, "g1", [one("2", False, "agree"), one("3", True, "x"), one("1", False, "y")]), (2, "g2", [one("1", True, "x")]), (3, "g3", [])], "task int, golden_id string, annotations array<struct<updated_at string, cancelled boolean, annotator string, verdict string, branch string>>")
    assert [(r.golden_id, r.verdict) for r in records.latest_annotations(tasks).collect()] == [("g1", "agree")]
    m, c = frame(spark, [("a", 1), ("b", 2)], "sample_id string, x int"), frame(spark, [("a", 1)], "sample_id string, y int")
    got = {r.sample_id: r.complete for r in records.view_records(m, c, c).collect()}
    assert got == {"a": True, "b": False}


def test_markdown(spark):
    text = "# Rubric\nintro\n## D-4 one\n\nbody a\nline\n## D-5\nbody b\n##none\n"
    got = frame(spark, [(text,)], "t string").select(records.clauses(F.col("t")).alias("c")).first().c
    assert [(x.clause, x.text) for x in got] == [("D-4 one", "body a\nline"), ("D-5", "body b\n##none")]
    lines = [(i, t) for i, t in enumerate(["text", "| version | what |", "|---|:--|", "| 1 | a |", "", "| 2 | b c |"])]
    rows = records.changelog_entries(frame(spark, lines, "at int, line string"), 2)
    assert [(r.at, r.cells) for r in rows.orderBy("at").collect()] == [(3, ["1", "a"]), (5, ["2", "b c"])]
    with pytest.raises(Exception, match="malformed table row at line 6"):
        records.changelog_entries(frame(spark, [*lines, (6, "| 3 |")], "at int, line string"), 2).collect()


def test_archives_are_written_once_and_without_credentials(spark, tmp_path):
    path = str(tmp_path / "pool")
    rows = [("a", "fine"), ("a", "fine"), ("b", "Authorization: secret-value"), ("c", "ok")]
    refused = records.write_archives(frame(spark, rows, "name string, raw string"), path)
    assert [tuple(r) for r in refused.collect()] == [("b", ["authorization"])]
    records.write_archives(frame(spark, [("c", "other"), ("d", "new")], "name string, raw string"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", "fine"), ("c", "ok"), ("d", "new")]


def test_samples_views_and_snapshots(spark, tmp_path):
    samples = frame(spark, [("r1", "delivery", "s1", 1), ("r2", "legacy", "s2", 2)], "run string, pool string, surface string, x int")
    account = frame(spark, [("r3", "untrusted"), ("r4", "untrusted")], "run string, reason string")
    assert records.write_samples(samples, str(tmp_path), account) == {"seen": 2, "out_untrusted": 2}
    records.write_samples(samples.unionByName(samples.withColumn("run", F.lit("r9"))), str(tmp_path))
    assert sorted(r.run for r in spark.read.parquet(f"{tmp_path}/samples").collect()) == ["r1", "r2", "r9"]
    records.write_views({"chat": samples, "meta": account}, str(tmp_path / "views"))
    assert spark.read.parquet(f"{tmp_path}/views/chat").count() == spark.read.parquet(f"{tmp_path}/views/meta").count() == 2
    texts = []
    for k in range(2):
        records.write_snapshot(samples.orderBy(F.rand(k)).repartition(3), str(tmp_path / f"snap{k}"), ["run"])
        texts.append("".join(p.read_text() for p in sorted((tmp_path / f"snap{k}").glob("part-*.json"))))
    assert texts[0] == texts[1] and [json.loads(x)["run"] for x in texts[0].splitlines()] == ["r1", "r2"]


def test_sessions_as_parts_and_tuning_rows(spark, tmp_path):
    files = frame(spark, [("s", "b.json", "é"), ("s", "a.json", "x")], "session string, file string, content string")
    [row] = records.pointers(files).collect()
    assert [(f.file, f.bytes, f.sha256) for f in row.files] == [("a.json", 1, hashlib.sha256(b"x").hexdigest()), ("b.json", 2, hashlib.sha256("é".encode()).hexdigest())]
    messages = frame(spark, [("s", 0, "user", "hi"), ("s", 1, "assistant", "yo"), ("s", 2, "user", "more"), ("s", 3, "assistant", "done")], "session string, at int, role string, content string")
    chat = records.tuning_rows(messages, "chat").collect()
    assert [[(m.role, m.content) for m in r.messages] for r in chat] == [[("user", "hi"), ("assistant", "yo"), ("user", "more"), ("assistant", "done")]]
    got = {(r.prompt, r.completion) for r in records.tuning_rows(messages, "completion").collect()}
    assert got == {("<user> hi", "yo"), ("<user> hi\n<assistant> yo\n<user> more", "done")}
    for form in ("jsonl", "parquet"):
        records.write_tuning(records.tuning_rows(messages, "chat"), str(tmp_path / form), form)
    assert spark.read.json(str(tmp_path / "jsonl")).count() == spark.read.parquet(str(tmp_path / "parquet")).count() == 1
    for bad in (lambda: records.write_tuning(messages, str(tmp_path / "x"), "csv"), lambda: records.tuning_rows(messages, "poem")):
        with pytest.raises(ValueError):
            bad()


def test_migration(spark):
    rows = [("g1", "a", "new"), ("g1", "b", None), ("g2", "c", "old"), ("g2", "d", None), ("g3", "e", None)]
    got = {(r.file, r.pool) for r in records.migrated(frame(spark, rows, "group string, file string, surface string"), ["new"]).collect()}
    assert got == {("a", "delivery"), ("b", "delivery"), ("c", "legacy"), ("d", "legacy"), ("e", "unclassified")}

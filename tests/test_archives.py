import json

import pytest
from pyspark.sql import functions as F

from wayline.operators import assembly
from wayline.sources import archives


def step(tool, page, body, origin=None, **params):
    action = {"tool": tool, "params": params} | ({"origin": origin} if origin else {})
    return {"action": action, "observation": {"url": page, "body_text": body}}


def archive(task="t1", **more):
    return {
        "task_id": task,
        "driver": "d",
        "steps": [step("search", "http://s.example/", "results", q="x")],
        "visits": [
            {"url": "http://a.example/1", "landed_url": "http://a.example/2", "success": True, "steps": [step("goto", "http://a.example/2", "A", url="u"), step("wait", "", "", origin="infrastructure")]},
            {"url": "http://b.example/", "success": False, "steps": [step("goto", "http://b.example/", "B")]},
            {"url": "http://sub.x.example/", "success": False, "steps": []},
        ],
        "outcomes": [
            {"url": "http://a.example/1", "branch": "unresolved"},
            {"url": "http://a.example/1", "branch": None},
            {"url": "http://b.example/", "branch": "paywall"},
            {"url": "http://sub.x.example/", "branch": "blocked"},
        ],
    } | more


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("archives")
    put = lambda name, doc: (root / name).write_bytes(doc if isinstance(doc, bytes) else json.dumps(doc).encode())
    put("t1__r1.json", archive())
    put("t1__r2.json", archive(judgement_trustworthy=False))
    put("t1__r2.reviewed.json", archive(user_prompt=None))
    put("t1__r3.json", archive(search_blocked="captcha"))
    put("t1__r4.json", archive(warnings=["search failed: x"]))
    put("t1__r5.json", b"{broken")
    put("t1__r6.json", b'{"task_id": "\xff"}')
    put("t1__r7.json", archive(task=""))
    put("t1__r8.json", archive(visits=[], outcomes=[]))
    put("notes.json", archive())
    return archives.select_archives(archives.read_files(spark, str(root)))


def test_selection_and_problems(files):
    rows = {r.run: r for r in archives.parse_archives(files).collect()}
    assert set(rows) == {f"r{i}" for i in range(1, 9)}
    assert {k: r.problem for k, r in rows.items() if r.problem} == {"r5": "bad_json", "r6": "not_utf8", "r7": "no_task_id"}
    assert rows["r2"].reviewed and rows["r2"].has_prompt and not rows["r1"].has_prompt


def test_samples_and_account(files):
    samples, account = assembly.samples(files, excluded=["x.example"])
    got = {r.run: r for r in samples.collect()}
    assert set(got) == {"r1", "r2"}
    assert [(s.visit, s.matched, s.outcome, s.branch, s.start, s.end) for s in got["r1"].sites] == [(1, True, 1, None, 0, 2), (2, True, 2, "paywall", 2, 3)]
    assert got["r1"].branch == "paywall"
    reasons = {r.run: r.reason for r in account.collect()}
    assert reasons == {"r3": "search_blocked", "r4": "search_failed", "r5": "bad_json", "r6": "not_utf8", "r7": "no_task_id", "r8": "no_site_left"}


def test_messages_and_their_checks(files):
    good = archives.parse_archives(files).where("run = 'r1'")
    views = assembly.messages(archives.steps_of(good), assembly.closing_text(archives.outcomes_of(good)))
    got = views.first().messages
    assert [m.tool_call.id for m in got if m.tool_call] == ["call_0", "call_0", "call_1", "call_1", "call_2", "call_2"]
    assert json.loads(got[0].tool_call.arguments) == {"q": "x"} and got[3].content == "url: http://a.example/2\n\nA"
    assert got[-1].content == "a.example: unresolved; a.example: success; b.example: paywall; sub.x.example: blocked"
    problems = assembly.view_problems(views, ["search"]).first()
    assert (problems.unanswered, problems.undeclared, problems.bad_arguments) == (False, ["goto"], False)


def test_concatenated_objects(spark):
    raw = '{"a": "}{"} \n{"b": {"c": "\\""}}garbage{"d": 1}{bad}{"e": [1, {}]}'
    rows = archives.split_objects(spark.createDataFrame([("f", raw), ("g", None)], "name string, raw string")).orderBy("seq").collect()
    assert [json.loads(r.event) for r in rows] == [{"a": "}{"}, {"b": {"c": '"'}}, {"d": 1}, {"e": [1, {}]}]


def test_pools(spark):
    lines = spark.createDataFrame([('{"url": "u", "n": 1}',), ("{oops",)], "value string")
    assert [(r.bad, r.row.url if r.row else None) for r in archives.tolerant_pool(lines, "url string, n int").collect()] == [(False, "u"), (True, None)]
    pool = spark.createDataFrame([("a", 1)], "k string, v int")
    assert {r.k for r in archives.append_new(pool, spark.createDataFrame([("a", 2), ("b", 3), ("b", 3)], "k string, v int"), ["k"]).collect()} == {"b"}
    swept = archives.sweep(spark.createDataFrame([("a",), ("z",)], "k string"), pool, "k").collect()
    assert {r.k: r.pool for r in swept} == {"a": "delivery", "z": "quarantine"}
    with pytest.raises(ValueError):
        archives.sweep(pool, pool.where(F.lit(False)), "k")


def test_objects_between_stray_signs():
    text = 'x} {"a": 1}{"b": "}{"} " {broken {"c": {"d": [1, {"e": 2}]}} [1, {"f": 3}] {"g": "unclosed'
    assert [json.loads(x) for x in archives.json_objects(text)] == [{"a": 1}, {"b": "}{"}, {"c": {"d": [1, {"e": 2}]}}, {"f": 3}]
    assert archives.json_objects("") == archives.json_objects("{{{") == []

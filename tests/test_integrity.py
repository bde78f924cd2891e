import json
import random

import pytest

from wayline.operators import integrity
from wayline.plans import archives as plans
from wayline.sources import archives

WHOLE = {"url": "u", "body_text": "text", "video_tag_count": 1}


def good(**more):
    return {
        "task_id": "t1",
        "user_prompt": "find",
        "run_config": {"max_candidates": 5},
        "steps": [{"action": {}}],
        "search_observation": WHOLE,
        "visits": [{"url": "a", "landed_url": "b", "success": True, "steps": [1], "site_obs": WHOLE, "player_obs": WHOLE | {"url": "p"}}],
        "outcomes": [{"url": "a", "branch": "paywall", "evidence": "first"}, {"url": "x", "site_url": "a", "branch": None, "source": "rule"}],
    } | more


def visit(**more):
    return [good()["visits"][0] | more]


CASES = {
    "clean": (good(), set()),
    "no_task": (good(task_id=None), {("missing_task_id", "FATAL", "$.task_id")}),
    "no_steps": (good(steps=[]), {("steps_missing", "DEGRADED", "$.steps")}),
    "no_prompt": ({k: v for k, v in good().items() if k != "user_prompt"}, {("user_prompt_missing", "DEGRADED", "$.user_prompt")}),
    "no_config": (good(run_config={}), {("run_config_missing", "DEGRADED", "$.run_config")}),
    "preview": (good(search_observation={"body_preview": "x"}), {("body_preview_only", "DEGRADED", "$.search_observation")}),
    "no_body": (good(visits=visit(site_obs={"url": "u", "video_tag_count": 1})), {("no_body", "DEGRADED", "$.visits[0].site_obs")}),
    "no_page_at_all": (good(search_observation=None, visits=visit(site_obs={})), set()),
    "no_visit_steps": (good(visits=visit(steps=None)), {("steps_missing", "DEGRADED", "$.visits[0].steps")}),
    "no_outcome": (good(visits=visit(url="q", landed_url="r")), {("outcome_missing", "DEGRADED", "$.visits[0]")}),
    "by_page_of_player": (good(visits=visit(url="q", landed_url="r", player_obs=WHOLE | {"url": "x"})), set()),
    "by_landing": (good(visits=visit(url="q", landed_url="x")), set()),
    "mismatch": (good(visits=visit(success=False)), {("success_branch_mismatch", "DEGRADED", "$.visits[0].success")}),
    "no_media": (
        good(visits=visit(site_obs={"body_text": "t"}, player_obs={"body_text": "t", "video_tag_count": "many"})),
        {("success_without_media", "FATAL", "$.visits[0].player_obs.video_tag_count")},
    ),
    "no_media_by_model": (
        good(visits=visit(site_obs=None, player_obs=None), outcomes=[{"url": "a", "branch": None, "source": "llm"}]),
        {("success_without_media", "INFO", "$.visits[0].player_obs.video_tag_count")},
    ),
    "no_evidence": (
        good(outcomes=[*good()["outcomes"], {"url": "orphan", "branch": "blocked", "evidence": "  "}]),
        {("evidence_empty", "FATAL", "$.outcomes[2].evidence")},
    ),
    "damaged": (
        good(outcomes=[{"url": "a", "branch": None, "evidence": "�"}], user_prompt="��", extra={"deep": [{"x": "�"}]}),
        {("evidence_mojibake", "FATAL", "$.outcomes[0].evidence"), ("mojibake", "DEGRADED", "$.user_prompt"), ("mojibake", "DEGRADED", "$.extra.deep[0].x")},
    ),
    "nothing_in_it": ({"task_id": "t"}, {("steps_missing", "DEGRADED", "$.steps"), ("user_prompt_missing", "DEGRADED", "$.user_prompt"), ("run_config_missing", "DEGRADED", "$.run_config")}),
}


@pytest.fixture(scope="module", params=[True, False], ids=["escaped", "literal"])
def files(spark, tmp_path_factory, request):
    root = tmp_path_factory.mktemp("runs")
    for name, (doc, _) in CASES.items():
        (root / f"t__{name}.json").write_text(json.dumps(doc, ensure_ascii=request.param), encoding="utf-8")
    (root / "t__bytes.json").write_bytes(b'{"task_id": "\xff"}')
    (root / "t__cut.json").write_bytes(b'{"task_id": ')
    return archives.select_archives(archives.read_files(spark, str(root)))


def test_each_rule_at_its_place(files):
    found = {}
    for row in integrity.archive_findings(files).collect():
        found.setdefault(row.run, set()).add(tuple(row)[1:])
    want = {name: told for name, (_, told) in CASES.items() if told}
    assert found == want | {"bytes": {("not_utf8", "FATAL", "$")}, "cut": {("bad_json", "FATAL", "$")}}


def test_pool_and_report(spark, files):
    belonging = integrity.negatives(files.where("run IN ('clean', 'no_evidence')"), ["unresolved"])
    assert {(r.run, r.idx, r.url, r.branch) for r in belonging.collect()} == {("clean", 0, "a", "paywall"), ("no_evidence", 0, "a", "paywall"), ("no_evidence", 2, "orphan", "blocked")}
    out = spark.createDataFrame([("clean", 0)], "run string, idx int")
    assert {r.run for r in integrity.negatives(files.where("run = 'clean'"), [], out).collect()} == set()
    pool = spark.createDataFrame([("t1", "a", "paywall"), ("t9", "x", "blocked"), ("t9", "y", "blocked"), (None, None, None)], "task_id string, url string, branch string")
    none = spark.createDataFrame([], "url string")
    assert [tuple(r) for r in integrity.not_in_pool(belonging, pool, none).collect()] == [("no_evidence", "negative_not_pooled", "DEGRADED", "$.outcomes[2]")]
    assert integrity.not_in_pool(belonging, pool, spark.createDataFrame([("orphan",)], "url string")).count() == 0
    some = files.where("run IN ('clean', 'no_prompt')")
    assert [(r.task_id, r.url, r.n_archives, r.first_run) for r in integrity.contradicted(some, pool, none).collect()] == [("t9", "x", 2, "clean")]
    assert integrity.contradicted(some, pool, pool.select("url")).count() == 0
    told = {r.run: tuple(r)[1:] for r in integrity.report(files, integrity.archive_findings(files), belonging).collect()}
    assert told["clean"] == (1, 2, 1, 0, 0, True) and told["cut"] == (0, 0, 0, 1, 0, False) and told["no_evidence"] == (1, 3, 2, 1, 0, False)


def test_derived_sets_that_differ(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert {tuple(r) for r in integrity.composition(ids("a", "b"), ids("b", "c", "c"), ids("a", "d")).collect()} == {
        ("samples", "views", 1), ("views", "samples", 1), ("samples", "tasks", 1), ("tasks", "samples", 1)}


def test_archives_with_few_and_many_pairs_alike(spark, monkeypatch):
    """Visits matched beside their outcomes meet the same ones as by joins."""
    pick = random.Random(8)
    url = lambda: pick.choice([None, "", " ", *"abcdef"])
    one = lambda: {"url": url(), "landed_url": url(), "success": pick.random() < 0.5, "player_obs": pick.choice([None, {"url": url()}])}
    end = lambda: {"url": url(), "site_url": url(), "branch": pick.choice([None, "blocked"]), "evidence": "x", "source": pick.choice([None, "llm", "rule"])}
    docs = [good(visits=pick.choice([None, [one() for _ in range(pick.randrange(5))]]), outcomes=pick.choice([None, [end() for _ in range(pick.randrange(6))]])) for _ in range(300)]
    files = spark.createDataFrame([(str(i), json.dumps(doc)) for i, doc in enumerate(docs)], "run string, raw string")
    beside = sorted(map(tuple, integrity.archive_findings(files).collect()))
    monkeypatch.setattr(integrity, "PAIRS", -1)
    assert beside == sorted(map(tuple, integrity.archive_findings(files).collect())) and len(beside) > 300


@pytest.mark.parametrize("name", ["q21_findings", "q21_report", "q21_not_pooled", "q21_contradicted"])
def test_archives_are_parsed_once(spark, name):
    """No query writes or parses the archives again for each thing that it asks of them."""
    plan = getattr(plans, name)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "to_json(struct(task_id" not in plan

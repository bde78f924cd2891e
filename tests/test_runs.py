import json

from wayline.sources.runs import read_runs, read_samples

STEP = {"action": {"tool": "goto", "params": {"url": "http://a.example/"}}, "observation": {"url": "http://a.example/", "body_text": "A"}}
RUN = {
    "task_id": "t",
    "steps": [STEP],
    "visits": [{"url": "http://a.example/", "success": True, "steps": [STEP]}],
    "outcomes": [{"url": "http://a.example/", "branch": None}],
}


def test_folders_and_files(spark, tmp_path):
    put = lambda name, doc: (tmp_path / name).write_text(doc if isinstance(doc, str) else json.dumps(doc))
    put("t__r1.json", RUN)
    put("t__r2.json", {k: v for k, v in RUN.items() if k != "user_prompt"})
    put("t__r2.reviewed.json", RUN | {"user_prompt": "second"})
    put("t__r3.json", "{broken")
    put("t__r4.json", RUN | {"visits": [], "outcomes": []})
    put("probe.json", RUN)
    runs = {r.run: r for r in read_runs(spark, str(tmp_path)).collect()}
    assert set(runs) == {"r1", "r2", "r3", "r4"} and runs["r2"].doc.user_prompt == "second" and runs["r3"].problem == "bad_json"
    assert [r.run for r in read_runs(spark, str(tmp_path / "t__r1.json")).collect()] == ["r1"]
    samples, account = read_samples(spark, str(tmp_path))
    assert {r.run: r.has_prompt for r in samples.collect()} == {"r1": False, "r2": False}
    assert {r.run: r.has_prompt for r in read_samples(spark, str(tmp_path), reviewed=True)[0].collect()} == {"r1": False, "r2": True}
    assert {r.run: r.reason for r in account.collect()} == {"r3": "bad_json", "r4": "no_site_left"}
    assert read_samples(spark, str(tmp_path), ["a.example"])[0].count() == 0

import pytest
from pyspark.sql import functions as F

from wayline.operators import relabel

OUTCOMES = "run string, idx int, task_id string, url string, branch string, question string, evidence string, source string"
POOL = "task_id string, url string, branch string, question string, evidence string, source string, run string"
ORIGINS = {"new": ["site", "player"], "old": ["site"], "older": ["player"], "else": ["cast"], "retired": []}


@pytest.fixture(scope="module")
def tables(spark):
    outcomes = [
        ("r1", 0, "t", "u1", "old", "site", "first", "rule"),
        ("r2", 0, "t", "u1", "old", "", "second", "rule"),
        ("r1", 1, "t", "u2", "old", "", "", "llm"),
        ("r1", 2, "t", "u3", "else", "", "no questions in common", "rule"),
        ("r1", 3, "t", "u4", "old", "cast", "of another question", "rule"),
        ("r2", 1, "t", "u5", "older", "player", "b", "rule"),
        ("r2", 2, "t", "u5", "old", "site", "a", "rule"),
        ("r2", 3, "t", "u6", "old", "site", "there already", "rule"),
        ("r2", 4, "t", "u7", "unresolved", "site", "no sample", "rule"),
        ("r3", 0, None, "u8", None, None, None, "rule"),
        ("r3", 1, "t", "u6", "new", "site", "right", "rule"),
        ("r4", 0, "t", "u9", "retired", "site", "of a label no longer in use", "rule"),
    ]
    pool = [("t", "u1", "old", "", "pooled", "rule", "r1"), ("t", "u2", "old", "site", "from the pool", "rule", "r1"), ("t", "u5", "old", "", "a", "rule", "r2"), ("t", "u5", "older", "", "b", "rule", "r2"), ("t", "u6", "old", "", "x", "rule", "r2"), ("t", "u6", "new", "", "y", "rule", "r3"), (None, None, None, None, "a broken row", None, None)]
    return spark.createDataFrame(outcomes, OUTCOMES), spark.createDataFrame(pool, POOL)


def planned(outcomes, pool, **more):
    return relabel.relabel_plan(relabel.candidates(outcomes, pool, ["unresolved"]), "new", "seen by hand", ORIGINS, ["unresolved", "blocked"], **more)


def shown(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_where_each_candidate_goes(tables):
    plan = {(r.url, r.branch): r for r in planned(*tables).collect()}
    states = {key: (r.state, r.why) for key, r in plan.items()}
    assert states == {
        ("u1", "old"): ("accepted", None),
        ("u2", "old"): ("accepted", None),
        ("u3", "else"): ("rejected", "belongs to other questions"),
        ("u4", "old"): ("rejected", "belongs to other questions"),
        ("u5", "old"): ("accepted", None),
        ("u5", "older"): ("merged", "another takes the new key"),
        ("u6", "old"): ("merged", "the pool has the new key"),
        ("u6", "new"): ("skipped", "has this branch"),
        ("u9", "retired"): ("accepted", None),
    }
    first = plan["u1", "old"]
    assert (first.questions, first.evidence, first.n_outcomes, first.runs, first.in_pool) == (["site"], "first", 2, 2, True)
    assert plan["u2", "old"].evidence == "from the pool" and plan["u2", "old"].questions == ["site"]
    assert {r.url for r in planned(*tables, select=F.col("url").isin("u1", None)).collect()} == {"u1"}


@pytest.mark.parametrize(("branch", "reason"), [("", "x"), ("gone", "x"), ("retired", "x"), ("blocked", "x"), ("new", " "), ("new", "Bearer abcdefghijklmnop1234")])
def test_changes_that_are_refused(tables, branch, reason):
    with pytest.raises(ValueError):
        relabel.relabel_plan(relabel.candidates(*tables, ["unresolved"]), branch, reason, ORIGINS | {"blocked": ["site"]}, ["unresolved", "blocked"])


def applied(outcomes, pool, plan):
    return relabel.relabelled_outcomes(outcomes, plan, "new", "seen by hand"), relabel.relabelled_pool(pool, plan, "new", "seen by hand")


def test_what_a_change_does_to_each_table(tables):
    outcomes, pool = applied(*tables, planned(*tables))
    assert outcomes.count() == tables[0].count()
    rows = {(r.run, r.idx): r for r in outcomes.collect()}
    one = rows["r1", 0]
    assert (one.branch, one.branch_before_relabel, one.source, one.evidence) == ("new", "old", "human", "first\n\n[改判 old → new] seen by hand")
    assert rows["r1", 3].branch == "old" and rows["r1", 3].branch_before_relabel is None and rows["r1", 3].source == "rule"
    assert shown(pool, "url", "branch", "evidence") == sorted([("u1", "new", "pooled\n\n[改判 old → new] seen by hand"), ("u2", "new", "from the pool\n\n[改判 old → new] seen by hand"), ("u5", "new", "a\n\n[改判 old → new] seen by hand"), ("u6", "new", "y"), (None, None, "a broken row")], key=str)
    assert shown(relabel.ledger(outcomes).where("run = 'r2'"), "branch", "n") == [("new", 4), ("unresolved", 1)]


def test_a_rerun_finishes_what_a_crash_left(tables):
    outcomes, pool = tables
    done = applied(outcomes, pool, planned(outcomes, pool))
    # a second change of a finished one does nothing
    again = planned(*done)
    assert {r.state for r in again.collect()} <= {"skipped", "rejected"}
    keys = lambda frame: shown(frame, "task_id", "url", "branch")
    for half in ((done[0], pool), (outcomes, done[1])):
        repaired = applied(*half, planned(*half))
        assert [keys(x) for x in repaired] == [keys(x) for x in done]
        assert shown(relabel.ledger(repaired[0]), "run", "branch", "n") == shown(relabel.ledger(done[0]), "run", "branch", "n")


def test_a_later_change_keeps_the_first_label(tables):
    done = applied(*tables, planned(*tables))
    found = relabel.candidates(*done, ["unresolved"])
    plan = relabel.relabel_plan(found, "old", "back again", ORIGINS, [], F.col("url") == "u1")
    row = relabel.relabelled_outcomes(done[0], plan, "old", "back again").where("run = 'r1' AND idx = 0").first()
    assert (row.branch, row.branch_before_relabel) == ("old", "old") and row.evidence.count("[改判") == 2


def test_a_run_goes_everywhere(spark, tables):
    archives = spark.createDataFrame([("r1", "t__r1.json"), ("r1", "t__r1.reviewed.json"), ("r2", "t__r2.json"), (None, "x")], "run string, name string")
    kept, pool, account = relabel.purge(archives, tables[1], [" r1 ", "r9"])
    assert shown(kept, "name") == [("t__r2.json",), ("x",)]
    assert "r1" not in {r.run for r in pool.collect()} and pool.count() == 5
    assert shown(account, "run", "archives", "pool_rows") == [("r1", 2, 2)]
    for bad in ([], ["r1", " "]):
        with pytest.raises(ValueError):
            relabel.purge(archives, tables[1], bad)

import random

import pytest
from pyspark.sql import functions as F

from wayline.operators import freezing

ROWS = "golden_id string, golden_id_legacy string, split string, url string, label string, code string, surface string"
CANDIDATES = "golden_id string, url string, label string, code string, surface string"
BASE = [("a", None, "calibration", "u1", "success", None, "s1"), ("b", None, "regression", "u2", "blocked", "paywall", None), ("c", "c0", "holdout", None, "unresolved", "blocked", "s1")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(BASE, ROWS)


def prints(frame):
    return {r.split: r.fingerprint for r in freezing.fingerprints(frame).collect()}


def test_fingerprints_tell_contents_and_nothing_else(spark, rows):
    more = [(f"g{i}", None, "holdout", f"u{i}", "success", None, None) for i in range(300)]
    one = spark.createDataFrame(more, ROWS)
    shuffled = spark.createDataFrame(random.Random(1).sample(more, len(more)), ROWS).repartition(7)
    assert prints(one) == prints(shuffled)
    changed = prints(spark.createDataFrame([*more[:-1], (*more[-1][:5], "", None)], ROWS))
    assert changed != prints(one)  # an empty code is not a missing one
    assert prints(rows.unionByName(rows)) != prints(rows)


def test_a_second_freeze_writes_nothing(spark, rows, tmp_path):
    root = f"file://{tmp_path}/golden"
    assert freezing.versions(spark, root) == {}
    assert freezing.freeze(rows, root) == 1
    before = sorted(p for p in tmp_path.rglob("*"))
    assert freezing.freeze(rows.repartition(3), root, parent=1) == 1
    assert sorted(p for p in tmp_path.rglob("*")) == before
    assert sorted(map(tuple, freezing.version_rows(spark, root, 1).collect()), key=str) == sorted(BASE, key=str)
    with pytest.raises(ValueError, match="no version 2"):
        freezing.version_rows(spark, root, 2)
    with pytest.raises(ValueError, match="nothing"):
        freezing.freeze(rows.limit(0), root)


def test_changes_need_leave(spark, rows, tmp_path):
    root = f"file://{tmp_path}/golden"
    freezing.freeze(rows, root)
    changed = spark.createDataFrame([BASE[0], ("b", None, "regression", "u2", "success", "paywall", None), BASE[2]], ROWS)
    with pytest.raises(ValueError, match="1 changes without leave.*'b', 'label', 'blocked', 'success'"):
        freezing.freeze(changed, root, parent=1, refresh=["code"])
    assert list(freezing.versions(spark, root)) == [1]
    assert freezing.freeze(changed, root, parent=1, refresh=["label"]) == 2
    assert freezing.freeze(rows, root, parent=2) == 1


@pytest.mark.parametrize(
    ("change", "want"),
    [
        (lambda r: r[:2], {("c", "row", "c", None)}),
        (lambda r: [r[0], (*r[1][:2], "holdout", *r[1][3:]), r[2]], {("b", "split", "regression", "holdout")}),
        (lambda r: [r[0], r[1], (*r[2][:3], "u9", *r[2][4:])], {("c", "url", None, "u9")}),
        (lambda r: [r[0], r[1], ("z", "c", *r[2][2:])], set()),
        (lambda r: [r[0], r[1], ("z", "c", *r[2][2:5], None, "s1")], {("c", "code", "blocked", None)}),
        (lambda r: [*r, r[0]], {("a", "repeated", "1", "2")}),
        (lambda r: [*r, ("new", None, "holdout", "u", "success", None, None)], set()),
    ],
)
def test_each_guard(spark, rows, change, want):
    assert {tuple(r) for r in freezing.broken_guards(rows, spark.createDataFrame(change(BASE), ROWS)).collect()} == want


def test_tampering_and_crashes_are_found(spark, rows, tmp_path):
    root = f"file://{tmp_path}/golden"
    freezing.freeze(rows, root)
    # a crash after the rows and before the manifest: no version, and the next freeze takes its place
    rows.where("golden_id = 'a'").write.parquet(f"{root}/v2")
    assert list(freezing.versions(spark, root)) == [1]
    other = rows.withColumn("code", F.lit("success"))
    assert freezing.freeze(other, root, parent=1, refresh=["code"]) == 2
    assert freezing.version_rows(spark, root, 2).count() == 3
    rows.withColumn("label", F.lit("success")).write.mode("overwrite").parquet(f"{root}/v1")
    with pytest.raises(ValueError, match="changed after it was frozen.*holdout.*regression"):
        freezing.version_rows(spark, root, 1)
    with pytest.raises(ValueError, match="changed after"):
        freezing.freeze(rows.where("golden_id <> 'c'"), root, parent=1)


def test_what_is_carried_over(spark, rows):
    candidates = spark.createDataFrame([("a", "u8", "blocked", "new", "s9"), ("b2", "u2", None, None, "s2"), ("n", "u3", "success", None, None), ("m", "u4", None, "x", None)], CANDIDATES)
    alias = spark.createDataFrame([("b", "b2"), ("gone", "gone2")], "old string, new string")
    got = {r.golden_id: tuple(r)[1:] for r in freezing.carried(rows, candidates, alias, ["label", "code"], backfill="calibration").collect()}
    assert got == {
        "a": (None, "calibration", "u1", "blocked", "new", "s1", "refreshed"),
        "b2": ("b", "regression", "u2", "blocked", "paywall", None, "carried"),
        "c": ("c0", "holdout", None, "unresolved", "blocked", "s1", "carried"),
        "n": (None, "calibration", "u3", "success", None, None, "backfilled"),
    }
    assert freezing.carried(rows, candidates, alias).where("origin <> 'carried'").count() == 0
    assert freezing.broken_guards(rows, freezing.carried(rows, candidates, alias)).count() == 0
    for bad in (["split"], ["surface", "label"]):
        with pytest.raises(ValueError):
            freezing.carried(rows, candidates, alias, bad)


def test_agreement_and_conflicts(spark, rows):
    got = {r.scope: tuple(r)[1:] for r in freezing.agreement(rows, ["unresolved"]).collect()}
    assert got == {"calibration": (1, 1, 0, 0, 1.0), "regression": (1, 0, 1, 0, 0.0), "holdout": (1, 0, 0, 1, None), "all": (3, 1, 1, 1, 0.5)}
    assert freezing.agreement(rows.limit(0), []).count() == 0
    twice = rows.unionByName(spark.createDataFrame([("d", None, "holdout", "u1", "blocked", None, None), ("e", None, "holdout", "u2", "blocked", None, None)], ROWS))
    assert [tuple(r) for r in freezing.url_conflicts(twice).collect()] == [("u1", ["blocked", "success"], 2)]

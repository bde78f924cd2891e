import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wayline.functions import arrays, text, urls
from wayline.operators import gates, matching, metrics


def value(spark, column, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


def test_rules_and_closed_vocabularies(spark):
    assert value(spark, gates.first_rule([("a", F.lit(None).cast("boolean")), ("b", F.lit(True)), ("c", F.lit(True))])) == "b"
    assert value(spark, gates.known_label(F.lit("x"), {"x": "X"})) == "X" and value(spark, gates.known_label(F.lit(None).cast("string"), {"x": "X"})) is None
    with pytest.raises(PySparkException):
        value(spark, gates.known_label(F.lit("y"), {"x": "X"}))
    assert value(spark, gates.tier_gap(F.lit(1), F.lit(6))) is None and value(spark, gates.tier_gap(F.lit(5), F.lit(2))) == 3
    assert value(spark, gates.hard_agreement(F.lit(None).cast("string"), F.lit("a"))) == "gold_missing"


def test_corrections_happen_once(spark):
    rows = spark.createDataFrame([("r", "u", None, "seen", None), ("r", "v", "paywall", "x", None)], "run string, url string, branch string, evidence string, branch_before string")
    once = gates.downgraded(rows, F.col("url") == "u", "unresolved")
    twice = gates.downgraded(once, F.lit(True), "blocked")
    got = {r.url: (r.branch, r.evidence, r.branch_before) for r in twice.collect()}
    assert got == {"u": ("unresolved", "[was success] seen", "success"), "v": ("blocked", "[was paywall] x", "paywall")}


def test_reviews_that_fit_set_the_branch(spark):
    rows = spark.createDataFrame([("r", "u", "a", "q1", "code"), ("r", "v", "a", "q2", "code"), ("r", "w", None, "q1", "code")], "run string, url string, branch string, question string, source string")
    verdicts = spark.createDataFrame([("r", "u", "b"), ("r", "v", "b")], "run string, url string, verdict string")
    got = {r.url: (r.branch, r.branch_before_review, r.site_verdict, r.source) for r in gates.reviewed(rows, verdicts, {"q1": ["b"]}).collect()}
    assert got == {"u": ("b", "a", None, "human"), "v": ("a", None, "b", "code"), "w": (None, None, None, "code")}


def test_a_gate_fails_closed(spark):
    schema = "name string, value double, line double, enforced boolean"
    passed = lambda rows: gates.gate(spark.createDataFrame(rows, schema)).first()
    assert passed([("a", 0.9, 0.8, True), ("b", 0.1, 0.8, False)]).passed
    out = passed([("a", None, 0.8, True), ("b", 0.1, 0.8, True)])
    assert (out.passed, out.missed, out.not_evaluable) == (False, ["b"], ["a"])
    assert not passed([]).passed


def test_buckets_shares_retests_and_invariance(spark):
    rows = spark.createDataFrame([("x", False, False, 5), (None, True, True, 1), (None, False, False, 2), (None, False, False, 4)], "reason string, undetermined boolean, veto boolean, min_score int")
    assert [r.bucket for r in gates.scout_bucket(rows).collect()] == ["skip", "quarantine", "negative", "positive"]
    a, b = (spark.createDataFrame([(x,) for x in s], "branch string") for s in ("aaab", "aabc"))
    assert {r.branch: r.over for r in gates.dual_run(a, b).collect()} == {"a": True, "b": False, "c": True}
    rounds = spark.createDataFrame([(i, r, "xy"[(i + (r == 2 and i == 0)) % 2]) for i in range(8) for r in (1, 2)], "id int, round int, label string")
    assert gates.retest(rounds).first().kappa == pytest.approx(0.75)
    base = spark.createDataFrame([(1, "c", "p"), (2, "c", "p"), (1, "d", "p")], "id int, clause string, pred string")
    now = spark.createDataFrame([(1, "c", "q"), (2, "c", "p"), (1, "d", "q")], "id int, clause string, pred string")
    assert {r.clause: (r.moved, r.violation) for r in gates.clause_invariance(base, now, ["d"]).collect()} == {"c": (1, True), "d": (1, False)}


def test_undefined_metrics_are_null(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "a")], "x string, y string")
    assert metrics.cohen_kappa(pairs, "x", "y").first().kappa is None
    report = {r.label: (r.precision, r.recall, r.f1) for r in metrics.classification_report(spark.createDataFrame([("a", "b")], "t string, p string"), "t", "p").collect()}
    assert report == {"a": (None, 0.0, 0.0), "b": (0.0, None, 0.0)}
    with pytest.raises(PySparkException):
        matching.require_unique(pairs, ["x"]).collect()
    assert matching.require_unique(pairs.limit(1), ["x"]).count() == 1


def test_expressions(spark):
    assert value(spark, text.strip(F.lit("　 a b  "))) == "a b"
    assert value(spark, text.lines(F.lit("a\r\n\n b\x1cc"))) == ["a", "b", "c"]
    assert value(spark, text.strip_think(F.lit("<think>x\ny</think> z"))) == "z"
    assert value(spark, text.strip_noise(F.lit("--"))) == "" and value(spark, text.as_bool(F.lit("maybe"))) is None
    assert value(spark, text.l0_clean(F.lit("\x1b[31mred\x1b[0m\r\n\n\n\nx\ty"))) == "red\n\nx    y"
    assert value(spark, urls.landed(F.lit(""), F.lit("http://a/"))) and not value(spark, urls.landed(F.lit("http://a/x"), F.lit("http://a/xy")))
    assert value(spark, urls.in_domain(F.lit("notx.com"), F.lit("x.com"))) is False and value(spark, urls.in_domain(F.lit("a.x.com"), F.lit("x.com"))) is True
    assert value(spark, arrays.cosine(F.array(F.lit(1.0)), F.array(F.lit(0.0)))) == 0.0
    assert math.isclose(value(spark, arrays.cosine(F.array(F.lit(1.0), F.lit(1.0)), F.array(F.lit(2.0), F.lit(2.0), F.lit(9.0)))), 1.0)
    elements = F.from_json(F.lit('[{"tag":"a","label":""},{"role":"b","name":"n"}]'), "array<struct<tag:string,label:string,role:string,name:string>>")
    assert value(spark, arrays.project_elements(elements)) == [("a", ""), ("b", "n")] and value(spark, arrays.element_dialect(elements)) == "html"

import pytest
from pyspark.sql import functions as F

from wayline.operators import conclusions

ROWS = f"branch string, evidence string, page {conclusions.PAGE}, before {conclusions.PAGE}, quotes array<string>"
TEXTS = {"no_gate": "shows no gate", "same_page": "led nowhere"}


@pytest.mark.parametrize(
    ("branch", "page", "before", "quotes", "want"),
    [
        ("subscription_wall", ("u", "please pay", 3), None, None, ""),
        ("subscription_wall", ("u", "free", 3), None, ["you must", "pay"], ""),
        ("subscription_wall", ("u", None, 3), None, [None], "no_gate"),
        ("subscription_wall", None, None, None, ""),
        (None, ("u", "free", 3), ("u", "free", 3), None, ""),
        ("component_unverified", ("u", "b", 3), ("u", "b", 3), None, "same_page"),
        ("component_unverified", ("u", "b", None), ("u", "b", 0), None, "same_page"),
        ("component_unverified", ("u", "b", 3), ("u", "b", 4), None, ""),
        ("component_unverified", ("u", "b", 3), ("u", "c", 3), None, ""),
        ("component_unverified", ("u", "b", 3), None, None, ""),
        ("blocked", ("u", "b", 3), ("u", "b", 3), None, ""),
    ],
)
def test_what_a_branch_presupposes(spark, branch, page, before, quotes, want):
    frame = spark.createDataFrame([(branch, "seen", page, before, quotes)], ROWS)
    row = conclusions.guarded(frame, lambda t: F.contains(t, F.lit("pay")), TEXTS).first()
    if want:
        assert (row.branch, row.branch_before_guard, row.evidence) == ("unresolved", branch, f"[{branch}] {TEXTS[want]} seen")
    else:
        assert (row.branch, row.branch_before_guard, row.evidence) == (branch, None, "seen")


CLASSES = {"success": "open", "trailer": "shut", "paywall": "shut", "unresolved": "nothing"}


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([("success", None), ("trailer", "paywall"), ("trailer", "success"), ("unresolved", "paywall"), ("", "paywall"), (None, None)], ("readout", 2, 1, 3, 1 / 3, [])),
        ([], ("untestable", 0, 0, 0, None, [])),
        ([("unresolved", None)], ("untestable", 0, 0, 1, None, [])),
        ([("success", None), ("novel", "odd")], ("untestable", 1, 0, 1, None, ["novel", "odd"])),
    ],
)
def test_how_often_conclusions_are_wrong(spark, rows, want):
    frame = spark.createDataFrame(rows, "label string, branch string")
    assert tuple(conclusions.conclusion_errors(frame, CLASSES, ["nothing"]).first()) == want

import pytest

from wayline.operators import snapshots

ROWS = "golden_id string, split string, label string, branch string, gold_dims map<string,int>, pred_dims map<string,int>, scorer_version string, gold_surface string, pred_surface string"
CLASSES = {"success": "open", "trailer": "shut", "paywall": "shut", "blocked": "barred"}
FACES = {"d2": "code", "d3": "llm"}


def row(label=None, branch=None, gold=None, pred=None, version=None, surfaces=("a", "a"), split="calibration", golden_id="g"):
    return (golden_id, split, label, branch, gold, pred, version, *surfaces)


def entries(spark, *rows, **more):
    return snapshots.snapshot(spark.createDataFrame(list(rows), ROWS), CLASSES, "success", FACES, **more)


@pytest.mark.parametrize(
    ("label", "branch", "want"),
    [
        ("trailer", "trailer", ("agree", None)),
        ("trailer", "paywall", ("detail_mismatch", "label_mismatch")),
        ("trailer", "blocked", ("disagree", "equivalence_class_mismatch")),
        (None, "", ("agree", None)),
        (" ", "blocked", ("disagree", "equivalence_class_mismatch")),
    ],
)
def test_labels(spark, label, branch, want):
    (r,) = entries(spark, row(label, branch)).collect()
    assert (r.dimension, r.verdict, r.delta_kind, r.tier_gap, r.pred_status) == ("d10", want[0], want[1], None, "not_applicable")


def test_a_label_in_no_class_is_an_error(spark):
    with pytest.raises(Exception, match="new_label"):
        entries(spark, row("new_label", "success")).collect()


@pytest.mark.parametrize(
    ("gold", "pred", "want"),
    [
        ({"d2": 3}, {"d2": 4}, {"d2": ("agree", 1)}),
        ({"d2": 1}, {"d2": 4}, {"d2": ("tier_gap", 3)}),
        ({"d2": 3}, {"d3": 4}, {"d2": ("ungraded", None), "d3": ("ungraded", None)}),
        ({"d2": 0}, {"d2": 4}, {"d2": ("ungraded", 4)}),
        ({"zz": 3}, {"zz": 3}, {"zz": ("ungraded", None)}),
        (None, {}, {}),
    ],
)
def test_scores(spark, gold, pred, want):
    found = entries(spark, row(gold=gold, pred=pred)).where("dimension <> 'd10'").collect()
    assert {r.dimension: (r.verdict, r.tier_gap) for r in found} == want


@pytest.mark.parametrize(
    ("version", "provenance", "want"),
    [
        ("x@code:9/llm:4", None, {"d2": ("9", "recorded"), "d3": ("4", "recorded")}),
        ("x@code:9", {"llm": ("reproduced", "5")}, {"d2": ("9", "recorded"), "d3": ("5", "reproduced")}),
        (None, {"llm": ("diverged", "5")}, {"d2": ("unrecorded", "unrecorded"), "d3": ("unrecorded", "diverged")}),
    ],
)
def test_versions_of_faces(spark, version, provenance, want):
    found = entries(spark, row(gold={"d2": 1, "d3": 1}, pred={"d2": 1, "d3": 1}, version=version), provenance=provenance).where("dimension <> 'd10'").collect()
    assert {r.dimension: (r.pred_version, r.pred_status) for r in found} == want


def test_cards_and_accounts(spark):
    far, unknown = ("a", "b"), ("a", None)
    rows = [
        row("trailer", "blocked", surfaces=far, golden_id="account", gold={"d2": 1}, pred={"d2": 5}, version="x@code:9"),
        row("trailer", "blocked", surfaces=unknown, golden_id="unknown"),
        row("blocked", "trailer", surfaces=far, golden_id="site"),
        row("trailer", "blocked", surfaces=far, split="holdout", golden_id="side"),
        row("trailer", "trailer", golden_id="same", gold={"d3": 1}, pred={"d3": 4}, version="x@code:9/llm:4"),
    ]
    found = entries(spark, *rows)
    cards = {r.disagreement_id: r.comparability for r in snapshots.cards(found, 6, ["blocked"], {"code": "9", "llm": "5"}).collect()}
    assert cards == {"v6:account:d2": "same", "v6:unknown:d10": "undetermined", "v6:site:d10": "undetermined", "v6:same:d3": "other"}
    assert [tuple(r) for r in snapshots.accounts(found, 6, ["blocked"]).collect()] == [("v6:account:collection", "account", "calibration", "a", "b", ["d10"], "evidence_missing")]
    assert snapshots.cards(found.limit(0), 1, [], {}).count() == 0


def test_each_row_gives_its_label_and_the_union_of_its_dimensions(spark):
    found = entries(spark, row(gold={"d2": 1}, pred={"d3": 1, "zz": 1}), row(golden_id="h", split=None))
    assert sorted((r.golden_id, r.dimension) for r in found.collect()) == [("g", "d10"), ("g", "d2"), ("g", "d3"), ("g", "zz"), ("h", "d10")]
    assert {r.split for r in found.where("golden_id = 'h'").collect()} == {""}

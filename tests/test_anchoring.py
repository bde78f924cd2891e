import random

import duckdb
import pytest
from pyspark.sql import functions as F

from wayline.functions.python import shared_phrases, text_anchor
from wayline.operators import anchoring
from wayline.plans.anchoring import f17_anchored_phrases
from wayline.plans.catalog import ORACLES


def phrases(evidence, text):
    """Every stretch of four and more characters of the evidence that the text has and that no longer one holds."""
    n = len(evidence)
    held = {(i, j) for i in range(n) for j in range(i + 4, n + 1) if evidence[i:j] in text}
    whole = sorted((i, j) for i, j in held if not {(i - 1, j), (i, j + 1)} & held)
    return list(dict.fromkeys(evidence[i:j] for i, j in whole))


def anchor(text, evidence):
    for i in range(len(text) - 3):
        fits = [n for n in range(4, 41) if i + n <= len(text) and text[i : i + n] in evidence]
        if fits:
            return text[i : i + max(fits)]
    return ""


def test_shared_phrases_and_anchors_are_those_of_brute_force(spark):
    pick = random.Random(2)
    text = lambda: "".join(pick.choice("aab é") for _ in range(pick.randrange(60)))
    rows = [(text(), text()) for _ in range(300)] + [("x" * 100, "x" * 70), ("abcd", "abcd"), ("abc", "abc"), ("", "abcd"), ("abcdabcd", "abcd")]
    frame = spark.createDataFrame(rows, "e string, t string").select("e", "t", shared_phrases("e", "t").alias("p"), text_anchor("t", "e").alias("a"))
    for r in frame.collect():
        assert r.p == phrases(r.e, r.t) and r.a == anchor(r.t, r.e)
    missing = spark.createDataFrame([(None, "x"), ("x", None)], "e string, t string").select(shared_phrases("e", "t").alias("p"), text_anchor("t", "e").alias("a"))
    assert [(r.p, r.a) for r in missing.collect()] == [([], None)] * 2


def test_long_texts_take_linear_time(spark):
    frame = spark.createDataFrame([("ab" * 100_000, "ba" * 100_000)], "e string, t string")
    assert len(frame.select(shared_phrases("e", "t").alias("p")).first().p[0]) == 199_999


def seen(body="", labels=(), media=0, frames=0, truncated=False, total=0):
    return (body, list(labels), media, frames, truncated, total)


def test_what_evidence_names(spark):
    rows = [
        ("the gate was closed, 3 players and Play", [seen("a gate was shut", [" Play ", "x", "closed"], 3, 0), seen("no", ["Play"], 0, 3)]),
        ("", [seen("gate", ["Play"])]),
        (None, [seen("gate")]),
        ("12", [seen("", [], 1, 12)]),
        ("words", None),
        ("words", []),
    ]
    frame = spark.createDataFrame(rows, f"e string, o array<{anchoring.OBSERVATION}>")
    got = [r.a for r in frame.select(anchoring.anchored(F.col("e"), F.col("o")).alias("a")).collect()]
    assert got == [[" gate was ", "元素名「Play」", "元素名「closed」", "计数 3"], [], [], ["计数 1", "计数 12"], [], []]


VISITS = f"run string, visit int, url string, branch string, evidence string, errors array<string>, observations array<{anchoring.OBSERVATION}>"
WHOLE = seen("the page is closed", ["Play"])


@pytest.mark.parametrize(
    ("visit", "next_url", "want"),
    [
        (("a", "blocked", "page is closed", [], [WHOLE]), "b", []),
        (("a", "paywall", "nothing", [], [WHOLE]), "a", None),
        (("a", None, "nothing", [], [WHOLE]), "b", None),
        (("a", " ", "page is closed", ["timeout"], [WHOLE]), "b", ["unrecorded"]),
        (("a", None, "", [], [seen(" ", [])]), "b", ["unrecorded", "no_anchor_incomplete"]),
        (("a", "unresolved", "page is closed", [], [WHOLE]), "b", ["unknown_branch"]),
        (("a", "blocked", "page is closed", [], [WHOLE]), "a", ["same_url_next"]),
        (("", "blocked", "page is closed", [], [WHOLE]), "", []),
        (("a", "blocked", "said timeout 30", ["timeout 30 s"], []), "b", []),
        (("a", "blocked", "feels wrong", ["timeout 30 s", None, " "], None), "b", ["no_anchor_unobserved"]),
        (("a", "blocked", "feels wrong", [], [WHOLE]), "b", ["no_anchor"]),
        (("a", "blocked", "feels wrong", [], [seen("body", truncated=True)]), "b", ["no_anchor_incomplete"]),
        (("a", "blocked", "feels wrong", [], [seen("body", ["Play"], total=2)]), None, ["no_anchor_incomplete"]),
    ],
)
def test_visits_that_went_wrong(spark, visit, next_url, want):
    rows = [("r", 1, *visit), ("r", 2, next_url, "paywall", "", [], [WHOLE]), ("s", 1, "a", "paywall", "", [], [WHOLE])]
    got = anchoring.handling(spark.createDataFrame(rows, VISITS), ["blocked", "paywall"]).collect()
    assert [r.problems for r in got] == ([] if want is None else [want])


def test_rate(spark):
    rows = [("r", 1, "a", "blocked", "page is closed", [], [WHOLE]), ("r", 2, "b", "blocked", "", [], [])]
    frame = spark.createDataFrame(rows, VISITS)
    assert tuple(anchoring.handling_rate(anchoring.handling(frame, ["blocked"])).first()) == (2, 1, 0.5, 1, 0)
    assert tuple(anchoring.handling_rate(anchoring.handling(frame.limit(0), ["blocked"])).first()) == (0, 0, None, 0, 0)


def test_phrases_of_turns_as_by_sql(spark, tmp_path):
    """Repeated sentences are named as often as they are there, without wide blanks at their ends; a turn of null comes last."""
    rows = [(1, 0, "u", "Of. Many. Of.\u3000Wide\xa0.Of"), (1, 1, "a", "Of Many Wide 1"), (1, None, "u", "Many Wide"), (2, 3, "u", None), (2, 4, "a", "Of 4"), (3, 1, "u", "Of"), (3, 2, "a", None)]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    key = lambda r: (r[0], str(r[1]))
    assert sorted(map(tuple, f17_anchored_phrases(spark, str(tmp_path)).collect()), key=key) == sorted(duck.execute(ORACLES["f17_anchored_phrases"]).fetchall(), key=key)

import random

import pytest
from pyspark.sql import functions as F

from wayline.operators import matching, prefixes

ROWS = "group string, path string, first long, asked boolean"


def meets(a, b):
    a, b = a or "/", b or "/"
    return a == b if "/" in (a, b) else a.startswith(b) or b.startswith(a)


def brute(rows):
    out = {}
    for g, p, _, asked in rows:
        firsts = [f for h, q, f, _ in rows if asked and h == g and f is not None and meets(p, q)]
        if firsts:
            out[g, p or "/"] = min(firsts)
    return out


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_meetings_are_those_of_a_nested_loop(spark, partitions):
    pick = random.Random(partitions)
    rows = [(pick.choice("gh"), "/" + "".join(pick.choice("ab/é") for _ in range(pick.randrange(7))), pick.choice([None, pick.randrange(99)]), pick.random() < 0.6) for _ in range(400)]
    rows += [("g", "", 3, True), ("x", "/", 1, False), ("x", "/a", None, True), ("y", "/q", None, True)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        frame = spark.createDataFrame(rows, ROWS)
        assert {(r["group"], r["path"]): r["first"] for r in prefixes.prefix_meetings(frame).collect()} == brute(rows)
        side = lambda keep: [(g, p) for g, p, f, asked in rows if keep(f, asked)]
        sides = side(lambda f, asked: asked), side(lambda f, asked: f is not None)
        got = matching.prefix_pairs(*(spark.createDataFrame(s, "host string, path string") for s in sides))
        want = {(g, p or "/", q or "/") for g, p in sides[0] for h, q in sides[1] if g == h and meets(p, q)}
        assert sorted(map(tuple, got.collect())) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_long_path_is_no_square(spark):
    rows = spark.range(50).select(F.lit("g").alias("group"), F.concat(F.lit("/" + "x" * 20_000), "id").alias("path"), F.col("id").alias("first"), F.lit(True).alias("asked"))
    got = {r["path"][20_001:]: r["first"] for r in prefixes.prefix_meetings(rows).collect()}
    assert len(got) == 50 and got["4"] == 4 and got["44"] == 4


def test_gotos_that_nothing_explains(spark):
    anchors = spark.createDataFrame([("r", 0, "http://a.example/x/?q=1"), ("r", 5, "http://b.example/page/one"), ("r", 0, " "), ("r", 0, None), ("r", 0, "no url"), ("s", 0, "http://b.example/")], "run string, at long, url string")
    cases = [
        (1, "http://a.example/x/?q=1", None, True),
        (2, "http://A.example:80/x?q=1", None, True),
        (3, "http://a.example/x?q=2", "", False),
        (3, "http://a.example/x?q=2", "http://a.example/x/deep", True),
        (4, "http://b.example/page/one", None, False),
        (6, "http://b.example/page/one", None, True),
        (7, "http://c.example/", "http://b.example/pag", True),
        (8, "http://c.example/", "http://b.example/", False),
        (9, "", "http://a.example/x", None),
        (10, "no url", None, True),
        (11, None, None, None),
    ]
    gotos = spark.createDataFrame([("r", at, url, landed) for at, url, landed, _ in cases] + [("s", 1, "http://z.example/", "http://b.example")], "run string, at long, url string, landed string")
    told = prefixes.untraced_gotos(anchors, gotos)
    got = sorted(((r.at, r.url or "", r.landed or "", r.traced) for r in told.where("run = 'r'").collect()), key=str)
    assert got == sorted(((at, url or "", landed or "", want) for at, url, landed, want in cases), key=str)
    assert {tuple(r) for r in prefixes.trace_account(told).collect()} == {("r", 9, 6, 2, 3), ("s", 1, 1, 0, 0)}
    assert prefixes.untraced_gotos(anchors.limit(0), gotos).where("traced").count() == 0

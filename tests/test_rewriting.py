import json
import random

import pytest
from pyspark.sql import functions as F

from wayline.functions.pseudonyms import without_local_paths
from wayline.operators import drawing, tiers

ENTRIES = "n int, entries array<struct<tier:int,type:string,message:int,content:string>>, budget int"


def walk(entries, budget):
    """The text of an archive by its rules, one line after the other."""
    used, parts = 0, []
    for tier, head in enumerate(tiers.HEADS):
        lines, whole = [], True
        for t, kind, message, content in entries:
            if t != tier or not whole:
                continue
            line = f"- [{kind}@{message}] {content}"
            if budget is not None and used + len(line) > budget:
                whole = False
            else:
                used += len(line)
                lines.append(line)
        if whole and lines:
            parts.append("\n".join([f"## {head}", *lines]))
    return "\n\n".join(parts)


def test_archives_within_any_budget(spark):
    pick = random.Random(9)
    rows = []
    for n in range(120):
        entries = [(pick.randrange(5), pick.choice(["text", "call"]), pick.randrange(30), "é" * pick.randrange(12)) for _ in range(pick.randrange(9))]
        rows.append((n, entries, pick.choice([None, 0, 20, 50, 90, 1000])))
    frame = spark.createDataFrame(rows, ENTRIES)
    got = {r.n: r.text for r in frame.select("n", tiers.rendered(F.col("entries"), F.col("budget")).alias("text")).collect()}
    assert got == {n: walk(entries, budget) for n, entries, budget in rows}
    for n, _, budget in rows:
        shown = [line for line in got[n].split("\n") if line.startswith("- ")]
        assert budget is None or sum(map(len, shown)) <= budget


def test_odd_entries(spark):
    frame = spark.createDataFrame([(0, [(0, None, None, None), (9, "text", 1, "never"), (-1, "text", 1, "never")], None), (1, None, 5), (2, [], 5)], ENTRIES)
    got = [r[0] for r in frame.orderBy("n").select(tiers.rendered(F.col("entries"))).collect()]
    assert got == [f"## {tiers.HEADS[0]}\n- [@0] ", "", ""]


USERS, SPACES = [f"user{i}" for i in range(50)], ["one", "two"]


def rewritten(spark, rows):
    frame = spark.createDataFrame(rows, "n int, document string, session string")
    return [r[0] for r in frame.orderBy("n").select(without_local_paths(F.col("document"), F.col("session"), USERS, SPACES)).collect()]


def test_one_name_at_any_depth(spark):
    root = "C:\\Users\\Bob"
    inner = json.dumps({"cwd": root + "\\a"})
    document = {"a": root, root: [{"b": ["x " + root.lower() + "/y", inner, json.dumps(inner)]}, 1, None, True, "d:\\users\\bob"], "w": "workspaces\\default\\x workspaces\\\\defaults"}
    raw = json.dumps(document, ensure_ascii=False)
    first, same, other, text, missing, alone = rewritten(spark, [(0, raw, "s"), (1, json.dumps({"z": root}), "s"), (2, raw, "t"), (3, "no JSON " + root, "s"), (4, None, "s"), (5, raw, None)])
    value = json.loads(first)
    name = value["a"].removeprefix("C:\\Users\\")
    assert name in USERS and json.loads(same)["z"] == f"C:\\Users\\{name}" and text == f"no JSON C:\\Users\\{name}"
    deep = value[root][0]["b"]
    assert deep[0] == f"x c:\\Users\\{name}/y" and json.loads(deep[1]) == {"cwd": f"C:\\Users\\{name}\\a"} and json.loads(json.loads(deep[2])) == {"cwd": f"C:\\Users\\{name}\\a"}
    assert value[root][1:4] == [1, None, True] and value["w"].split("\\")[1] in SPACES and value["w"].endswith("workspaces\\\\defaults")
    assert missing is None and other != first and "ob\\" not in alone.replace(json.dumps(root)[1:-1] + '":', "").lower()


P, K = "persona int, genre string, nation int", "skeleton int, mode string, size int"


def test_the_same_draw_however_the_tables_lie(spark):
    personas = [(i, "ab"[i % 2], i % 7) for i in range(100)]
    skeletons = [(i, "xy"[i % 2], i % 5) for i in range(37)]
    draws = []
    for parts in (1, 3, 11):
        frames = [spark.createDataFrame(random.Random(parts).sample(rows, len(rows)), schema).repartition(parts) for rows, schema in ((personas, P), (skeletons, K))]
        drawn = drawing.drawn_pairs(*frames, 200, "seed", F.col("nation") == F.col("size"), attempts=6)
        draws.append(sorted(map(tuple, drawn.collect()), key=str))
    assert draws[0] == draws[1] == draws[2]
    rows = draws[0]
    assert [r[0] for r in sorted(rows)] == list(range(200)) and all(r[4] == r[7] for r in rows if r[2] is not None)
    left = sum(r[2] is None for r in rows)
    assert 0 < left < 200 and all(r[1] == 6 for r in rows if r[2] is None)
    other = drawing.drawn_pairs(*frames, 200, "another", F.col("nation") == F.col("size"), attempts=6)
    assert sorted(map(tuple, other.collect()), key=str) != rows
    report = {r.genre: r for r in drawing.drawing_report(drawn, ["genre"]).collect()}
    assert report[None].requested == left and report[None].produced == 0 and sum(r.produced for r in report.values()) == 200 - left
    assert sum(r.refused for r in report.values()) == sum(r[1] for r in rows)


def test_numbers_and_empty_tables(spark):
    frame = spark.range(1000).select((F.col("id") * 3).alias("key")).repartition(7)
    assert sorted((r["key"], r["i"]) for r in drawing.numbered(frame, "key", "i").collect()) == [(3 * i, i) for i in range(1000)]
    none, some = spark.createDataFrame([], P), spark.createDataFrame([(1, "x", 1)], K)
    assert drawing.drawn_pairs(none, some, 3, "s", F.lit(True)).where("persona IS NULL").count() == 3
    assert drawing.drawn_pairs(none, some, 0, "s", F.lit(True)).count() == 0
    with pytest.raises(ValueError):
        drawing.drawn_pairs(none, some, -1, "s", F.lit(True))


def test_strata_take_turns(spark):
    rows = spark.createDataFrame([(i, "a" if i < 5 else "b") for i in range(7)], "key int, s string")
    turns = [(r.s, r.turn) for r in drawing.round_robin(rows, ["s"], "x", "key").orderBy("turn", "s").collect()]
    assert turns == [("a", 1), ("b", 1), ("a", 2), ("b", 2), ("a", 3), ("a", 4), ("a", 5)]

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wayline.llm.tries import prefix_trie, ranked

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = {}
    tie = lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", tie(role or "", text or ""), text or ""))
    convs = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(convs.get(c - c % 5, [])[:h] + convs[c][h:])
    nodes = {}
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            nodes.setdefault(rebuilt[c][:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [q for q in nodes if q[: len(path)] == path]
        leaves = sum(not any(len(o) > len(q) and o[: len(q)] == q for o in below) for q in below)
        saved = sum((len(nodes[q]) - 1) * (len(q[-1][1].encode()) if q else 0) for q in below)
        ends = ",".join(str(c) for c in members if len(rebuilt[c]) == len(path))
        children = sum(len(q) == len(path) + 1 for q in below)
        parent = nodes[path[:-1]][0] if path else None
        out.append((members[0], len(path), parent, len(members), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, TURNS).withColumn("band", F.lit(1)).withColumn("depth", F.lit("x")).repartition(3)
    got = prefix_trie(frame, **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def test_shared_beginnings_and_odd_rows(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", f"t{t}") for c in (0, 3, 4, 5, 7, 12, 20, 40) for t in range(6)]
    rows += [(8, t, "user", f"other {t}") for t in range(12)] + [(13, 0, "user", "short")] + [(14, 0, None, None), (14, None, None, ""), (14, None, "a", None)]
    rows += [(None, 1, "user", "nobody"), (-7, 1, "user", "é"), (-10, 0, "user", "base"), (-10, 1, "user", "base 2")]
    rows += [(21, 3, "user", "tie b"), (21, 3, "user", "tie a"), (21, 3, "aide", "tie c"), (21, 3, "user", "tie a")] * 3
    got = found(spark, rows)
    assert got == brute(rows)
    assert sum(r[1] == 0 for r in got) == 1 and any(r[3] > 3 for r in got)


def test_long_conversations_in_bands(spark):
    rows = [(c, t, "user", f"t{t}" if c != 7 or t < 40 else f"own {t}") for c in (5, 6, 7, 8, 10, 11, 30) for t in range(45 + (c == 8))]
    assert found(spark, rows, segment=9) == brute(rows)
    assert found(spark, rows) == brute(rows)


def test_random_conversations(spark):
    pick = random.Random(3)
    rows = [(c, t, pick.choice("ab"), pick.choice("xy")) for c in range(-20, 60) for t in range(pick.randrange(14))]
    assert found(spark, rows, segment=10) == brute(rows)


def test_no_rows(spark):
    assert found(spark, [(None, 1, "user", "x")]) == []
    with pytest.raises(ValueError):
        prefix_trie(spark.createDataFrame([], TURNS), segment=3)


def test_one_conversation_holds_most_turns_whatever_their_numbers(spark):
    rows = spark.range(3000).select(F.lit(5).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("same").alias("text"))
    assert sorted(r["rank"] for r in ranked(rows.repartition(4)).collect()) == list(range(1, 3001))
    got = prefix_trie(rows, segment=100).agg(F.count("*"), F.max("depth"), F.max("n_leaves"), F.sum("n_convs")).first()
    assert tuple(got) == (3001, 3000, 1, 3001)


def test_very_long_texts(spark):
    rows = [(c, 0, "user", "long " * 100_000) for c in (1, 2, 5, 6)]
    assert found(spark, rows) == brute(rows)

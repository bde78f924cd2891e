"""Report queries that have no SQL, against plain Python."""

from difflib import SequenceMatcher
from itertools import groupby

from wayline.plans import registry


def longest(messages):
    best = now = 1
    for (_, _, role, text), (_, _, next_role, next_text) in zip(messages, messages[1:], strict=False):
        a, b = (" ".join((t or "").casefold().split()) for t in (text, next_text))
        same = a == b or bool(a and b) and SequenceMatcher(None, a, b).ratio() > 0.9
        now = now + 1 if role == next_role and same else 1
        best = max(best, now)
    return best


def test_similar_runs_compare_whole_texts(spark, tmp_path):
    head = " ".join(f"word{i}" for i in range(40))
    end, other = " ".join(f"end{i * i}" for i in range(60)), " ".join(f"OTHER-{i * 7}?" for i in range(60))
    texts = {
        1: [head + " " + end, head + " " + other, head + " " + end],
        2: ["Straße  One\n two", "STRASSE one two", "strasse\tone two", "three"],
        3: [head + end, head + end + "!", (head + end)[:-3] + "xyz", head],
        4: [None, "", " \n", "a"],
        5: ["alone"],
    }
    rows = [(conv, turn, "user", text) for conv, said in texts.items() for turn, text in enumerate(said)]
    rows += [(6, turn, role, "same") for turn, role in enumerate(["user", "user", "assistant", "assistant", "assistant", None, None])]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = dict(map(tuple, registry.QUERIES["w9_similar_runs"](spark, str(tmp_path)).collect()))
    want = {conv: longest(list(said)) for conv, said in groupby(rows[:-7], key=lambda r: r[0])} | {6: 3}
    assert got == want
    assert got[1] == 1 and got[2] == 3

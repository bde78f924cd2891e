import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayline.llm import repeats
from wayline.llm.suffixes import repeated_windows, suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(codes):
    assert suffix_array(codes) == sorted(range(len(codes)), key=lambda i: codes[i:])


def test_suffix_array_of_regular_strings():
    for codes in ([1] * 300, [1, 2] * 150, [2, 1, 1] * 100, list(range(200)), list(range(200, 0, -1)), [0, 1, 0, 2] * 60):
        assert suffix_array(codes) == sorted(range(len(codes)), key=lambda i: codes[i:])


def test_repeated_windows():
    assert repeated_windows([b"xabcy", b"zabcw", b"abab"], 3) == [[(1, 2)], [(1, 2)], []]


def brute(rows, length):
    seen = defaultdict(int)
    texts = [(t or "").encode() for _, t in rows]
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] += 1
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans, i = [], 0
        while i < len(t):
            if gone[i]:
                j = i
                while j < len(t) and gone[j]:
                    j += 1
                spans.append((i, j))
                i = j
            else:
                i += 1
        out.append((doc, len(t), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return sorted(out)


def corpus():
    draw = random.Random(11)
    words = ["alpha", "Bé", "ga mma", "漢字", "delta", "x", "42", "zeta\n"]
    say = lambda n: " ".join(draw.choice(words) + str(draw.randint(0, 50)) for _ in range(n))
    passages = [say(n) for n in (8, 20, 40, 60, 90)]
    rows = []
    for _ in range(150):
        rows.append("".join(draw.choice([say(draw.randint(1, 80)), draw.choice(passages)]) for _ in range(draw.randint(1, 4))))
    base = say(120)
    for i in range(70):  # different stretches around one passage, more than a group takes
        rows.append(say(30) + passages[3][:120] + base[200 + i : 260 + i] + passages[4] + say(10))
        rows.append(base[: 300 + 3 * i] + "#" + base[300 + 3 * i :])
    rows += [None, "", "a" * 700, "ab" * 300, "short", rows[3], rows[3], "a" * 200, "b" * 200]
    return list(enumerate(rows))


@pytest.mark.parametrize("length,batch,group", [(200, 1 << 19, 48), (64, 300, 4)])
def test_same_as_brute_force(spark, length, batch, group):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, hash int")
    got = repeats.remove_repeats(docs, length, group, batch).collect()
    assert sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got) == brute(rows, length)


def test_parts_of_a_long_text_meet():
    data = random.Random(2).randbytes(5000)
    import numpy as np

    whole = repeats.stretches(data, np.array([0, len(data)]), 200)
    assert sum(whole[3] - whole[2] + 1) == len(data) - 199


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "q" * 10 + "r" * 250), (1, "q" * 10 + "r" * 250)], "doc_id long, text string")
    assert [len(r.kept) for r in repeats.remove_repeats(docs).collect()] == [0, 0]
    assert repeats.remove_repeats(docs.where("false")).count() == 0


@pytest.mark.parametrize("length,batch,group", [(200, 1 << 19, 48), (64, 300, 4)])
def test_null_and_repeated_ids_same_as_brute_force(spark, length, batch, group):
    rows = corpus()
    rows += [(len(rows), "only here " + rows[5][1][:400]), (len(rows) + 1, rows[160][1])]
    name = lambda i: None if i % 3 == 0 else i % 5 if i % 3 == 1 else i
    docs = spark.createDataFrame([(name(i), text) for i, text in rows], "doc_id long, text string")
    got = repeats.remove_repeats(docs, length, group, batch).collect()
    want = [(name(i), *rest) for i, *rest in brute(rows, length)]
    assert sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got), key=str) == sorted(want, key=str)


def test_null_ids_meet_each_other_and_others(spark):
    shared = "".join(chr(97 + i * i % 23 + i % 3) for i in range(300))
    docs = spark.createDataFrame([(None, "p" + shared), (None, "q" + shared), (7, "r" + shared), (None, "p" + shared)], "doc_id long, text string")
    assert sorted(bytes(r.kept) for r in repeats.remove_repeats(docs).collect()) == [b"", b"", b"q", b"r"]

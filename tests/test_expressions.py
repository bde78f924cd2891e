"""Expressions without SQL against plain Python."""

import json
import re
import unicodedata
import zlib

import pytest
from pyspark.sql import functions as F

from wayline.functions import checks, python, tasks, urls

TEXTS = ["", "abc", "Ab12--C", "one two  three", "éÉ漢字9", "ｆｕｌｌ Width", None, "abcd x abcdefgh", "x abcdefgh y"]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_rotation_is_by_checksum(spark):
    words, seeds = ["a", "b", "c"], [t for t in TEXTS if t is not None]
    got = [r.w for r in frame(spark, [(t,) for t in seeds], "t string").select(urls.rotated(F.col("t"), words).alias("w")).collect()]
    assert got == [words[zlib.crc32(t.encode()) % 3] for t in seeds]


def test_match_key_and_run_shape(spark):
    rows = frame(spark, [(t,) for t in TEXTS], "t string").select("t", python.match_key(F.col("t")).alias("key"), python.run_shape(F.col("t")).alias("shape")).collect()
    for r in rows:
        assert r["key"] == (None if r.t is None else re.sub(r"\s+", "", unicodedata.normalize("NFKC", r.t)).lower())
        if r.t is None:
            assert r["shape"] is None
        else:
            want, last, n = "", "", 0
            for kind in [("A" if c.isupper() else "a") if c.isalpha() else "9" if c.isdigit() else "X" for c in r.t] + [""]:
                if kind != last:
                    want, last, n = want + last + (str(n) if n > 1 else ""), kind, 0
                n += 1
            assert r["shape"] == want


def test_common_length(spark):
    pairs = [(a, b) for a in TEXTS for b in TEXTS]
    rows = frame(spark, pairs, "a string, b string").select("a", "b", python.common_length(F.col("a"), F.col("b")).alias("n")).collect()
    for r in rows:
        if r.a is None or r.b is None:
            assert r.n is None
        else:
            assert r.n == max((j - i for i in range(len(r.a)) for j in range(i, len(r.a) + 1) if r.a[i:j] in r.b), default=0)


@pytest.mark.parametrize("text,evidence,want", [("abcdefgh", "abcd x abcdefgh", "abcdefgh"), ("xx one two", "..one two", "one two"), ("abc", "abc", ""), ("q" * 60, "q" * 60, "q" * 40), ("", "x", ""), (None, "x", None)])
def test_text_anchor(spark, text, evidence, want):
    assert frame(spark, [(text, evidence)], "t string, e string").select(python.text_anchor(F.col("t"), F.col("e"))).first()[0] == want


def test_json_in_one_spelling_with_its_strings(spark):
    texts = ['{"b": [1, {"c": "x"}], "a": "é"}', "no json", "", None, '"s"', "[[\"deep\"]]"]
    rows = frame(spark, [(t,) for t in texts], "t string").select("t", python.canonical_json(F.col("t")).alias("c"), python.string_leaves(F.col("t")).alias("l")).collect()
    assert [r.c for r in rows] == ['{"a":"é","b":[1,{"c":"x"}]}', None, None, None, '"s"', '[["deep"]]']
    assert [[(x.path, x.value) for x in r.l] for r in rows] == [[("$.b[1].c", "x"), ("$.a", "é")], [], [], [], [("$", "s")], [("$[0][0]", "deep")]]


def test_first_object_in_prose(spark):
    texts = ['a {"k": 1} b', "{x} {\"k\": {\"z\": 2}}", "{ { {\"q\": []}", "none", None, '{"open": "}"', "{}"]
    got = [r[0] for r in frame(spark, [(t,) for t in texts], "t string").select(python.first_json_object(F.col("t"))).collect()]
    assert got == ['{"k":1}', '{"k":{"z":2}}', '{"q":[]}', None, None, None, "{}"]
    assert json.loads(got[1]) == {"k": {"z": 2}}


def test_every_credential_pattern_is_found(spark):
    planted = {
        "authorization": "Authorization: x",
        "bearer": "bearer " + "a" * 16,
        "signed_token": "eyJ" + "a" * 10 + "." + "b" * 10,
        "model_key": "sk-ant-" + "a" * 16,
        "service_key": "sk-" + "a" * 16,
        "cloud_key": "AKIA" + "A" * 16,
        "api_key": "AIza" + "a" * 35,
        "password_in_url": "https://me:pw@host",
        "cookie": "Set-Cookie : a",
        "private_key": "-----BEGIN RSA PRIVATE KEY-----",
        "code_host_token": "ghp_" + "a" * 36,
    }
    rows = frame(spark, list(planted.items()), "name string, t string").select("name", checks.credential_patterns(F.col("t")).alias("found")).collect()
    assert all(r.found == [r.name] for r in rows)
    assert frame(spark, [("task-" + "a" * 20,)], "t string").select(checks.credential_patterns(F.col("t"))).first()[0] == []


def test_claims_and_tables(spark):
    text = "see https://a.b/c). and http://x.y/z;\n- one\n  * two \n3) three\n4.no"
    got = [(c.kind, c.value) for c in frame(spark, [(text,)], "t string").select(tasks.claims(F.col("t"))).first()[0]]
    assert got == [("url", "https://a.b/c"), ("url", "http://x.y/z"), ("list_item", "one"), ("list_item", "two"), ("list_item", "three")]
    shapes = {"| a | b |\n|---|:---|\n| 1 | 2 |": (2, 1), "a|b\n--|--\n1|2": None, "a|b\n---|---": None, "no": None, "x|y\n---|---\n1|2\n\n3|4": (2, 2), "x|y\n---|---\n1": (2, 0)}
    rows = frame(spark, [(t,) for t in shapes], "t string").select("t", tasks.markdown_table(F.col("t")).alias("m")).collect()
    for r in rows:
        want = shapes[r.t]
        assert (tuple(r.m) if r.m else None) == (want if want and want[1] else None), r.t


def test_three_alike_calls(spark):
    from wayline.operators.session import thrice_alike

    long = "the same words again and again " * 3
    calls = [(1, k, "a", long + str(k)) for k in range(3)] + [(2, k, "ab"[k % 2], long) for k in range(5)] + [(3, 0, "a", "x"), (3, 1, "a", "completely other"), (3, 2, "a", "x")]
    got = {r.s: r.loop for r in thrice_alike(frame(spark, calls, "s int, at int, name string, input string"), "s", python.alike).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_absolute_urls(spark):
    from urllib.parse import urljoin

    pairs = [("https://a.b/c/d", "../x?y#z"), ("https://a.b", "//c.d/e"), ("", "x"), (None, "x"), ("https://a.b/", "http://[bad")]
    got = [r[0] for r in frame(spark, pairs, "b string, h string").select(python.absolute_url(F.col("b"), F.col("h"))).collect()]
    assert got[:4] == [urljoin(b, h) if b is not None else None for b, h in pairs[:4]] and got[4] is None


def test_media_links(spark):
    from wayline.operators.contracts import media_links

    html = """<video class=x src="/a.mp4"><source src='b.webm'></video><iframe src="https://f/e"></iframe><a href="c.MP4?x">c</a><a href="d.html">d</a><a href="/a.mp4">a</a><img src="no.mp4">"""
    got = frame(spark, [(html,)], "h string").select(media_links(F.col("h"), ["mp4", "webm"]).alias("m")).first()[0]
    assert got.media == ["/a.mp4", "b.webm", "c.MP4?x"] and got.frames == ["https://f/e"]

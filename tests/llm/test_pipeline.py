"""The pipeline against plain Python, stage by stage."""

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_mixing import shares
from tests.llm.test_secrets import brute as secret_spans
from pyspark.sql import functions as F

from wayline.llm.common import written
from wayline.llm.secrets import MARK


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw, rows, labels = random.Random(8), [], []
    words = ["river", "stone", "window", "garden", "market", "winter", "letter", "bridge", "motor", "cloud", "paper", "forest"]
    for i in range(600):
        text = " ".join(draw.choice(words) + draw.choice("abcdefgh") for _ in range(draw.randint(30, 90)))
        toxic = i % 7 == 0
        rows.append([i, text + (" idiot scum" if toxic else "") + (" password = hunter22" if i % 5 == 0 else ""), "en", f"s{i % 4}", 0])
        labels.append((i, 1, int(toxic)))
    for i in range(1, 40):  # near and exact copies of clean documents
        rows.append([1000 + i, rows[i][1] + (" tail" if i % 2 else ""), "en", "s9", 0])
    rows += [[2000, None, None, None, None], [2001, "", "en", "s0", 0]]
    root = tmp_path_factory.mktemp("tables")
    for r in rows:
        r[4] = len(r[1]) if r[1] else 0
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_each_stage_does_its_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before, results = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder))
        results.append(docs.collect())
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == before
    clean, distinct, blanked, mixed, encoded = results
    toxic = {i for i in range(600) if i % 7 == 0} | {1000 + i for i in range(1, 40) if i % 7 == 0}
    everything = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r.doc_id for r in clean} == everything - toxic
    assert {r.doc_id for r in distinct} == {r.doc_id for r in clean} - {1000 + i for i in range(1, 40)}
    texts = {r.doc_id: r.text for r in distinct}
    for r in blanked:
        text, want, at = texts[r.doc_id], "", 0
        for s, _, e in secret_spans(text or ""):
            want, at = want + text[at:s] + MARK, e
        assert r.text == (want + text[at:] if text else text)
    size, source, taken = {}, {}, Counter()
    for r in blanked:
        size[r.doc_id], source[r.doc_id] = len((r.text or "").split()), r.source
    times = Counter(r.doc_id for r in mixed)
    totals = Counter()
    for doc, n in size.items():
        totals[source[doc]] += n
        taken[source[doc]] += n * times[doc]
    assert max(times.values()) <= 3
    for name, target in shares(dict(totals), (1, 2, 3), 3).items():
        assert abs(taken[name] - target) <= max(60, 0.02 * target)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in mixed:
        ids = enc.encode_ordinary(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(map(tuple, encoded)) == sorted(want)


def test_run_is_the_stages_in_turn(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 300


def test_decisions_take_effect_row_by_row(spark, folder):
    """Null and repeated ids with different texts."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    word = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = [(None, "river stone idiot scum"), (None, "garden market paper"), (0, "only window letter"), (0, "motor idiot scum")]
    docs = docs.unionByName(spark.createDataFrame([(*r, "en", "s0", 1) for r in more], schema))
    clean = {(r.doc_id, r.text) for r in corpus_pipeline.clean(spark, docs, folder).collect()}
    assert set(more) & clean == {more[1], more[2]}

    rows = [(3, word("a")), (7, word("b")), (7, word("a") + " end"), (8, word("c")), (8, word("c") + " end"), (8, word("c")), (None, word("d")), (None, word("d") + " end")]
    rows += [(None, word("a") + " fin"), (None, word("e")), (None, word("e")), (None, ""), (None, ""), (None, None), (4, ""), (4, "  ")]
    found = corpus_pipeline.distinct(spark, spark.createDataFrame([(*r, "en", "s0", 1) for r in rows], schema), folder).collect()
    kept = [(r.doc_id, r.text) for r in found]
    assert [x for x in kept if x[0] is not None and x[1].strip() and x[0] != 8] in ([rows[0], rows[1]], [rows[1], rows[0]])
    assert len([x for x in kept if x[0] == 8]) == 1
    assert sorted(x[1][:1] for x in kept if x[0] is None and x[1]) == ["d", "e"]
    assert sorted(x[1] for x in kept if x[0] == 4) == ["", "  "] and len([x for x in kept if x[0] is None and not x[1]]) == 1


def test_stages_with_clashing_columns_ties_and_no_rows(spark, folder):
    """Columns with the names the stages use inside, equal rows, and a table without rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["_doc", "_row", "_n", "_key", "_hash", "_spans", "_copies", "_copy"]
    more = docs.where("doc_id < 60").unionByName(docs.where("doc_id < 20"))
    for name in names:
        more = more.withColumn(name, F.lit(name))
    more = written(more)
    plain = more.drop(*names)
    for name, stage in corpus_pipeline.STAGES:
        got, want = written(stage(spark, more, folder)), stage(spark, plain, folder)
        assert sorted(map(str, got.drop(*names).collect())) == sorted(map(str, want.collect())), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == more.columns and {tuple(r) for r in got.select(*names).collect()} == {tuple(names)}
        assert stage(spark, plain.where("false"), folder).count() == 0, name

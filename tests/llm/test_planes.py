import random
import uuid
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayline.llm import pieces, planes
from wayline.llm.pieces import Encoder
from wayline.llm.planes import FOOTER, MARK, Shard, documents, ids_between, join_planes, read_ids, split_planes, write_ids
from wayline.llm.q_planes import op12_bit_planes

VOCABULARY = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
LIBRARY = Tokenizer.from_str(VOCABULARY)
ENCODER = Encoder(VOCABULARY)
ODD = [
    "", " ", "  ", " a", "a ", "a  b", "\n a", "don't 'S x's", "<|endoftext|>", "a<|endoftext|>b c", "é à ñandú d'été l'x", "1,000 a1 b2c", "\x00\x1c a\x1cb \x1c",
    "日本 語 text", "a  b", "tab\t x", "x\n\ny", "a . b", "😀 a😀 b", "a\r\n b\n", "end \n", "ªº a²", "a b  c",
]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def same(texts):
    ids, sizes = ENCODER.encode(texts)
    ends = np.cumsum(sizes)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)] == list(map(library, texts))


def test_odd_texts_are_encoded_as_the_library_does():
    same(ODD)
    same([])


@given(st.lists(st.text(st.sampled_from("abZ'sétl1.,  \n\t|<>世\x1c\x85²ʼ́$"), max_size=40), max_size=5))
def test_any_text_is_encoded_as_the_library_does(texts):
    same(texts)


def test_long_texts_in_parts_and_a_small_memory(monkeypatch):
    monkeypatch.setattr(pieces, "LONG", 50)
    monkeypatch.setattr(pieces, "REMEMBERED", 1000)
    pick = random.Random(5)
    same(["".join(pick.choice("ab c. \n'st") for _ in range(pick.randrange(400))) for _ in range(60)] + ["x" * 3000, "word " * 2000])


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_come_back(kind, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32).astype("<u4")
    found = split_planes(ids, kind)
    assert len(found) == planes.PLANES[kind]
    assert join_planes(found, n, kind).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["byte", "bit"])
@given(sizes=st.lists(st.integers(0, 50), max_size=12), block=st.integers(1, 40))
def test_shards_come_back(kind, sizes, block):
    every = np.random.default_rng(1).integers(0, 50257, sum(sizes), dtype=np.uint32).astype("<u4")
    ids = [None if i == 0 else i * 1000 - 3 for i in range(len(sizes))]
    shard, data, half = Shard(3, kind, block), b"", len(sizes) // 2
    for some, part, flat in ((ids[:half], sizes[:half], every[: sum(sizes[:half])]), (ids[half:], sizes[half:], every[sum(sizes[:half]) :])):
        data += b"".join(x + MARK for x in shard.add(some, np.array(part, dtype=np.int64), flat))
    data += b"".join(x + MARK for x in shard.close())
    found = list(documents(data))
    assert [(s, d, len(x)) for s, d, _, x in found] == [(3, d, n) for d, n in zip(ids, sizes, strict=True)]
    assert [i for *_, x in found for i in x.tolist()] == every.tolist()
    first, end = len(every) // 3, len(every) // 2 + 1
    assert ids_between(data, first, end).tolist() == every[first:end].tolist()
    assert ids_between(data, len(every), len(every) + 5).tolist() == []


def test_damage_is_found():
    shard = Shard(0)
    data = b"".join(x + MARK for x in [*shard.add([1], np.array([3]), np.array([5, 6, 7], "<u4")), *shard.close()])
    with pytest.raises(ValueError, match="not a shard"):
        planes.read_index(data[:-1])
    index = planes.read_index(data)
    assert len(data) > FOOTER.size and index.total == 3
    with pytest.raises(ValueError, match="damaged"):
        planes.read_chunk(data, index._replace(sums=index.sums + 1), 0)


DOCS = [(5, "five"), (3, "three  three"), (None, "nobody"), (3, "another three"), (3, "three  three"), (1, None), (2, ""), (-4, "minus\n four"), (9, "<|endoftext|> " * 3), (8, "long é " * 3000)]


def expected(rows):
    by_id = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(doc, len(library(text or "")) + 1) for doc, text in by_id]


@pytest.mark.parametrize(("kind", "block"), [("byte", 1 << 16), ("bit", 100)])
def test_documents_come_back_in_order(spark, tmp_path, kind, block):
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    write_ids(spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("part", F.lit(1)).repartition(3), folder, VOCABULARY, kind=kind, block=block)
    rows = sorted(read_ids(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [d for d, _ in expected(DOCS)]
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]
    texts = sorted((d is not None, d or 0, library(t or "") + [0]) for d, t in DOCS)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in rows) == texts
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    files = [p.read_bytes() for p in sorted(Path(tmp_path).rglob("part-*"))]
    assert files and all(f.endswith(MARK) for f in files)


def test_no_rows_and_no_end(spark, tmp_path):
    write_ids(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/none", VOCABULARY)
    assert read_ids(spark, f"file://{tmp_path}/none").count() == 0
    write_ids(spark.createDataFrame(DOCS[:1], "doc_id long, text string"), f"file://{tmp_path}/one", VOCABULARY, end_id=None)
    assert [r.ids for r in read_ids(spark, f"file://{tmp_path}/one").collect()] == [library("five")]
    with pytest.raises(ValueError):
        write_ids(spark.createDataFrame(DOCS, "doc_id long, text string"), f"file://{tmp_path}/odd", VOCABULARY, kind="word")


def test_the_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op12_bit_planes(spark, folder).collect()}
    want, start = {}, 0
    for row in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect():
        ids = library(row.text or "") + [0]
        want[row.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want

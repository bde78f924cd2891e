import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

from wayline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    draw = random.Random(3)
    alphabet = ["a", "the ", " ", "\n", "é", "漢", "1", "!", "'s", "\t", "ing", " ", "😀", "x", "\x1c", "\r\n"]
    out = [None, "", " ", "a" * 5000, " " * 3000, "it's 12 o'clock"]
    return out + ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 2500))) for _ in range(40)]


def test_same_ids_as_the_library_and_exact_round_trip(spark):
    enc, rows = library(), list(enumerate(texts()))
    rows += [rows[7], rows[8], rows[8]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranks = bpe.read_ranks(PATH)
    for chunk, overlap in ((64, 16), (1000, 100), (bpe.CHUNK, bpe.OVERLAP)):
        out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, chunk, overlap), ranks).collect()
        got = sorted((r.doc_id, r.ids, bytes(r.bytes)) for r in out)
        want = sorted((i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
        assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, ids string, key int")
    assert bpe.encode(docs, {b"a": 0}, public_tokenizers.PATTERN).count() == 0


def test_null_ids_texts_that_look_like_others_and_the_bytes(spark):
    """A long text of a row without an id that reads like another row's id and text."""
    enc, ranks = library(), bpe.read_ranks(PATH)
    long = "word and number 12 " * 300
    rows = [(None, "5:" + long), (5, long), (None, long), (None, None), (6, "none:" + long)]
    docs = spark.createDataFrame([(*r, "k", b"b") for r in rows], "doc_id long, text string, key string, bytes binary")
    out = bpe.encode(docs, ranks, public_tokenizers.PATTERN, 512, 64, decoded=True).collect()
    want = [(i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(((r.doc_id, r.ids, bytes(r.bytes)) for r in out), key=str) == sorted(want, key=str)


def test_portions_hold_every_row_once():
    sizes = [0, bpe.BYTES + 1, 5, 5, bpe.BYTES, 1] + [1] * 600
    got = list(bpe.portions(sizes))
    assert [a for a, _ in got] == [0, *(b for _, b in got[:-1])] and got[-1][1] == len(sizes)
    assert all(b - a == 1 or b - a <= bpe.ROWS and sum(sizes[a:b]) <= bpe.BYTES for a, b in got)
    assert list(bpe.portions([])) == []


def test_words_are_merged_many_at_a_time(monkeypatch):
    """Only tokens and long runs are looked at one by one."""
    enc, ranks, merge = library(), bpe.read_ranks(PATH), bpe.merge
    shared = type("Shared", (), {"value": (ranks, bpe.Pairs(ranks))})
    rows = ["" if t is None else t for t in texts()] + ["xqzj" * 20 + " qqzzxj Ênßgñ 😀😁 漢字漢字"] * 2
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(rows)), "text": rows})
    singly = []
    monkeypatch.setattr(bpe, "merge", lambda piece, ranks: singly.append(piece) or merge(piece, ranks))
    [out] = bpe.encoder(public_tokenizers.PATTERN, shared, True)(iter([batch]))
    assert out.column(1).to_pylist() == [enc.encode_ordinary(t) for t in rows]
    assert out.column(2).to_pylist() == [t.encode() for t in rows]
    assert all(piece in ranks or len(piece) > bpe.SHORT for piece in singly)


def test_pairs_merge_as_single_words_do():
    draw, ranks = random.Random(5), bpe.read_ranks(PATH)
    words = {"".join(draw.choice("aabeth  nningéß漢😀19!?") for _ in range(draw.randint(1, 40))).encode() for _ in range(3000)}
    words = sorted(word for word in words if word not in ranks)
    got = bpe.Pairs(ranks).merge(words)
    assert [np.frombuffer(ids, dtype=np.int32).tolist() for ids in got] == [bpe.merge(word, ranks) for word in words]
    assert bpe.Pairs(ranks).merge([]) == []
    few = {bytes([a]): a for a in range(256)}  # no pair merges
    assert bpe.Pairs(few).merge([b"ab", b"c"]) == [np.array([97, 98], dtype=np.int32).tobytes(), np.array([99], dtype=np.int32).tobytes()]


def test_memory_that_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 1)
    ranks = bpe.read_ranks(PATH)
    known = bpe.Encoded(ranks, bpe.Pairs(ranks))
    for words in ({"qzxj", "the"}, {"qzxj", "xqx"}, set()):
        known.learn(words)
        assert words == known.keys()

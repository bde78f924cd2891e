"""Toxicity by noisy-channel deobfuscation.

A character language model is counted over all documents. Tokens that hide their letters (leetspeak, letters
spaced out, separators inside, long repetitions) become lattices of the letters they may stand for, and a
Viterbi search finds the likeliest reading under the model. The restored words are scored by a lexicon of word
beginnings that labelled documents show to be significantly more frequent in toxic ones: a document is as toxic
as its most toxic word, and logistic regression turns that word's weight into a probability.

The lexicon and the regression are fitted on up to SAMPLE labelled rows, those of the smallest hashes of
doc_id; everything else covers all rows. Rows whose crc32(doc_id as text) mod 5 is 0 are never fitted on, and
doc_id, lang, source and labels are no inputs of a score.

Cases: null, empty and blank texts have no evidence and get the score of that; repeated rows get equal scores;
a document with several labels counts as toxic if one says so; null labels and null doc_ids are not fitted on, nor held out;
without labels of both kinds every score is the share of toxic labels (0 without labels); other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import row_key, whole_text, written

#: Labelled rows that the lexicon and the regression are fitted on at most.
SAMPLE = 20_000
#: Nats of evidence against chance that a word beginning needs.
EVIDENCE = 16.0
#: Letters of the shortest and the longest beginning of a word.
SHORTEST, LONGEST = 4, 6
#: Distinct tokens a worker remembers; beyond it the memory starts anew.
REMEMBERED = 100_000

# Signs that stand for letters.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}

LETTERS = 27
_CODES = np.zeros(256, dtype=np.int32)
for _k in range(26):
    _CODES[ord("a") + _k] = _CODES[ord("A") + _k] = _k + 1

SPACED = re.compile(r"(?<!\S)(?:\S[ .\-_*]){3,}\S(?!\S)")
REPEATED = re.compile(r"(.)\1\1")
RUN = re.compile(r"(.)\1*", re.S)
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¡¿"


def letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: texts as bytes -> counts of letter triples, everything else one more letter."""
    total = np.zeros(LETTERS**3, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            codes = _CODES[np.frombuffer(b"  " + text + b" ", dtype=np.uint8)]
            total += np.bincount((codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:], minlength=LETTERS**3)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["triple", "n"])


def language_model(texts: DataFrame) -> np.ndarray:
    """Log-probabilities of a letter after two others, from all texts; the alphabet bounds its size."""
    counts = texts.select(F.col("text").cast("binary")).mapInArrow(letter_counts, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    table = np.zeros(LETTERS**3)
    for row in counts.collect():
        table[row.triple] = row.n
    table = table.reshape(LETTERS, LETTERS, LETTERS)
    pairs = table.sum(axis=0)
    single = (pairs.sum(axis=0) + 1) / (pairs.sum() + LETTERS)
    second = (pairs + 20 * single) / (pairs.sum(axis=1, keepdims=True) + 20)
    third = (table + 20 * second[None]) / (table.sum(axis=2, keepdims=True) + 20)
    return np.log(third)


def lattice(token: str) -> list[list[str]]:
    """For every run of one sign, what it may stand for: a letter once, twice or not at all."""
    out = []
    for m in RUN.finditer(token):
        sign, size = m[1], len(m[0])
        if sign in SIGNS:
            letters = SIGNS[sign]
        elif sign.isalpha():
            letters = sign
        else:
            continue
        out.append([c * k for c in letters for k in ((1, 2) if size > 1 else (1,))])
    return out


class Reader(dict):
    """Token -> the word it stands for; None where it has no letters."""

    def __init__(self, model: np.ndarray):
        super().__init__()
        self.model = model
        #: What a letter costs on average, so that readings of different lengths compare.
        self.mean = -float((np.exp(model) * model).sum(axis=2).mean())

    def __missing__(self, token: str) -> str | None:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = word = self.read(token)
        return word

    def read(self, token: str) -> str | None:
        core = token.strip(EDGES)
        if core.isalpha() and not REPEATED.search(core):
            return core
        if not any(c.isalpha() for c in token):
            return None
        if not any(c.isalpha() for c in core):
            core = token
        return self.restore(core)

    def restore(self, token: str) -> str:
        code = lambda c: ord(c) - 96 if "a" <= c <= "z" else 0
        best = {(0, 0): (0.0, None)}
        for choices in lattice(token):
            step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (p, path) in best.items():
                for choice in choices:
                    x, y, q = a, b, p
                    for c in choice:
                        z = code(c)
                        q += self.model[x, y, z] + self.mean
                        x, y = y, z
                    if (x, y) not in step or q > step[x, y][0]:
                        step[x, y] = q, (path, choice)
            best = step
        if not best:
            return ""
        (_, path) = max((p + self.model[a, b, 0], path) for (a, b), (p, path) in best.items()) if len(best) > 1 else next(iter(best.values()))
        parts = []
        while path is not None:
            path, choice = path
            parts.append(choice)
        return "".join(reversed(parts))

    def words(self, text: str) -> set[str]:
        """The restored words of a text."""
        low = text.lower()
        found = {self[t] for t in set(low.split())}
        for m in SPACED.finditer(low):
            letters = self.restore("".join(c for c in m[0] if c not in " .-_*"))
            # a word may start at any of them, and no more than its beginning is read
            found.update(letters[i : i + LONGEST] for i in range(len(letters) - 3))
        found.discard(None)
        return found


def beginnings(word: str) -> tuple[str, ...]:
    return tuple(word[:n] for n in range(SHORTEST, LONGEST + 1))[: max(1, min(LONGEST - SHORTEST + 1, len(word) - SHORTEST + 1))]


def counted(model):
    """For mapInArrow: (text, toxic) -> in how many texts word beginnings are, by label."""

    def out(counts: dict[str, list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([v[k] for v in counts.values()], pa.int64()) for k in (0, 1))], ["start", "clean", "toxic"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts = Reader(model.value), {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for start in {s for word in reader.words(text) for s in beginnings(word)}:
                    counts.setdefault(start, [0, 0])[toxic] += 1
            if len(counts) > REMEMBERED:
                yield out(counts)
                counts = {}
        yield out(counts)

    return run


def evidence(model, lexicon):
    """For mapInArrow: (..., text) -> the greatest weight of the lexicon's word beginnings in the text, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = lexicon.value

        class Weights(dict):
            """Word -> the greatest weight of its beginnings."""

            def __missing__(self, word: str) -> float:
                if len(self) >= REMEMBERED:
                    self.clear()
                self[word] = weight = max((weights.get(s, 0.0) for s in beginnings(word)), default=0.0)
                return weight

        reader, known = Reader(model.value), Weights()
        for batch in batches:
            out = [max(map(known.__getitem__, reader.words(text)), default=0.0) for text in batch.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], [*batch.schema.names[:-1], "evidence"])

    return run


def regression(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic regression on (evidence, clean, toxic) counts, with a weak prior."""
    x = np.array([p[0] for p in points])
    clean, toxic = (np.array([p[k] for p in points], dtype=float) for k in (1, 2))
    n, design = clean + toxic, np.stack([x, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -30, 30)))
        gradient = design @ (toxic - n * p) - 0.01 * beta
        step = np.linalg.solve((design * (n * p * (1 - p))) @ design.T + 0.01 * np.eye(2), gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of docs(doc_id, text), from labels(doc_id, toxic)."""
    return scored(docs, labels).select("doc_id", "score")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, row, score) of every row of docs(doc_id, text), row being its row_key."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", row_key().alias("row"), whole_text().alias("text"))
    told = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    told = told.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # SAMPLE rows of two numbers: a bound that does not grow
    sample = told.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    labelled = written(rows.join(F.broadcast(sample), "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic")).distinct())
    sizes = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        share = toxic / max(1, clean + toxic)
        return rows.select("doc_id", "row", F.lit(float(share)).alias("score"))
    model = spark.sparkContext.broadcast(language_model(rows))
    counts = labelled.mapInArrow(counted(model), "start string, clean long, toxic long").groupBy("start").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share, here = F.lit(toxic / (clean + toxic)), F.col("toxic") / (F.col("clean") + F.col("toxic"))
    against = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - here) / (1 - share))).otherwise(0.0)
    shown = counts.where(here > share).withColumn("evidence", F.col("toxic") * F.log(here / share) + against).where(F.col("evidence") > EVIDENCE)
    shown = shown.collect()  # what SAMPLE texts show with that much evidence
    weights = {r.start: math.log((r.toxic + 0.5) / (toxic + 1)) - math.log((r.clean + 0.5) / (clean + 1)) for r in shown}
    lexicon = spark.sparkContext.broadcast(weights)
    read = evidence(model, lexicon)
    seen = labelled.select("toxic", "text").mapInArrow(read, "toxic int, evidence double")
    bins: dict[float, Counter] = {}
    for r in seen.groupBy("toxic", F.round("evidence", 1).alias("x")).agg(F.count("*").alias("n")).collect():  # a weight is at most log(2 * SAMPLE)
        bins.setdefault(r.x, Counter())[r.toxic] = r.n
    slope, offset = regression([(x, n[0], n[1]) for x, n in sorted(bins.items())])
    out = rows.mapInArrow(read, "doc_id long, row long, evidence double")
    return out.select("doc_id", "row", (1 / (1 + F.exp(-(F.col("evidence") * slope + offset)))).alias("score"))

"""Ids of a Hugging Face byte-level BPE vocabulary, a batch of texts at a time.

The tokenizers library encodes; what is here only saves it from encoding a word twice. A text is cut where its
pre-tokeniser has a boundary whatever stands around: before a space that follows ink, and between a Latin letter and an
ASCII character that is no letter. (All branches of the pre-tokeniser's pattern take a space as their first character
only, and end a run of letters at the first other character.) The words of a batch are told apart by Arrow; the
library sees each distinct one once, and a worker remembers the latest ones.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of words and their ids in each of the two generations that a worker remembers.
REMEMBERED = 48 << 20
#: What an entry of that memory takes besides.
ENTRY = 200
#: Characters after which a long text is cut.
LONG = 1 << 22

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
INK = "!-~¡-ᙿ"
LATIN_WORD = rf"^ ?[{LETTERS}]+$"
#: Where a text is cut; a zero byte comes between. Texts that hold one are not cut.
CUTS = [(rf"([{INK}]) ", "\\1\0 "), (rf"([{LETTERS}])([\x01-\x1f!-@\[-`{{-\x7f])", "\\1\0\\2")]
SPACE_BOUNDARY = re.compile(rf"(?<=[{INK}])(?= )")


def byte_characters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it prints, else one from 256 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printing]
    return {b: b for b in printing} | {b: 256 + i for i, b in enumerate(others)}


class Encoder:
    """Encodes texts as Tokenizer.encode(text, add_special_tokens=False) does, special strings in texts included."""

    def __init__(self, vocabulary: str):
        """vocabulary: the JSON text of a byte-level BPE tokenizer."""
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added]
        self.characters = byte_characters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def _new(self, words: list[str]) -> None:
        """Encodes words that are not remembered."""
        latin = pc.match_substring_regex(pa.array(words, pa.string()), LATIN_WORD).to_pylist()
        rest = []
        for word, simple in zip(words, latin, strict=True):
            if simple:  # one pre-token: the model alone
                shown = word.encode().decode("latin-1").translate(self.characters)
                self._remember(word, [token.id for token in self.tokenizer.model.tokenize(shown)])
            else:
                rest.append(word)
        for word, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self._remember(word, found.ids)

    def _remember(self, word: str, ids: list[int]) -> None:
        self.young[word] = array("I", ids).tobytes()
        self.size += ENTRY + len(word) + 4 * len(ids)

    def _encoded(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as bytes."""
        young, old, new = self.young, self.old, []
        for word in set(words) - young.keys():
            ids = old.get(word)
            if ids is None:
                new.append(word)
            else:
                young[word] = ids
                self.size += ENTRY + len(word) + len(ids)
        self._new(new)
        found = list(map(young.__getitem__, words))
        if self.size > REMEMBERED:
            self.young, self.old, self.size = {}, young, 0
        return found

    def _units(self, texts: list[str]) -> tuple[list[str], list[int]]:
        """The texts, long ones in parts, and the text of each part."""
        units, of = [], []
        for i, text in enumerate(texts):
            at = 0
            while len(text) - at > LONG and not self._whole(text) and (cut := SPACE_BOUNDARY.search(text, at + LONG)):
                units.append(text[at : cut.start()])
                of.append(i)
                at = cut.start()
            units.append(text[at:] if at else text)
            of.append(i)
        return units, of

    def _whole(self, text: str) -> bool:
        """Whether no cut is safe: special strings may hold boundaries."""
        return any(name in text for name in self.special)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        units, of = self._units(texts)
        column = pa.array(units, pa.large_string())
        whole = np.array(["\0" in unit or self._whole(unit) for unit in units], dtype=bool)
        cut = pc.if_else(pa.array(whole), "", column)
        for pattern, between in CUTS:
            cut = pc.replace_substring_regex(cut, pattern, between)
        words = pc.split_pattern(cut, "\0")
        coded = words.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().copy()
        offsets = words.offsets.to_numpy()
        distinct = coded.dictionary.to_pylist()
        codes[offsets[:-1][whole]] = len(distinct) + np.arange(int(whole.sum()))
        found = self._encoded(distinct + [units[i] for i in np.flatnonzero(whole)])
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        begins = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = lengths[codes]
        ends = np.cumsum(sizes)
        shifts = (begins[codes] - (ends - sizes)).astype(np.int32)  # a batch has fewer than 2**31 ids
        places = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        places += np.repeat(shifts, sizes)
        ids = flat[places]
        before = np.concatenate([[0], ends])
        per_text = np.zeros(len(texts), dtype=np.int64)
        np.add.at(per_text, of, np.diff(before[offsets]))
        return ids, per_text


@lru_cache(maxsize=1)
def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder of that vocabulary."""
    return Encoder(vocabulary)

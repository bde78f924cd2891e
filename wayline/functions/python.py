"""The few expressions Spark has no function for, as Arrow-batched pandas UDFs."""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import groupby
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING, _BOOLEAN, _INT = T.StringType(), T.BooleanType(), T.IntegerType()
_LEAVES = T.ArrayType(T.StructType([T.StructField("path", _STRING), T.StructField("value", _STRING)]))

_SPACE = re.compile(r"\s+")
#: The shortest and the longest quotation that anchors a text.
_GRAM, _LONGEST = 4, 40


@F.pandas_udf(_STRING)
def match_key(text: pd.Series) -> pd.Series:
    """Compatibility forms folded, white space gone, lower case."""
    return text.map(lambda t: None if t is None else _SPACE.sub("", unicodedata.normalize("NFKC", t)).lower())


@F.pandas_udf(_STRING)
def absolute_url(base: pd.Series, href: pd.Series) -> pd.Series:
    def join(b, h):
        try:
            return urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([None if b is None or h is None else join(b, h) for b, h in zip(base, href, strict=True)])


@F.pandas_udf(_BOOLEAN)
def alike(left: pd.Series, right: pd.Series) -> pd.Series:
    """Whether whole texts are equal or have a ratio of matching blocks above 0.9, whatever their case and white space."""

    def same(a: str | None, b: str | None) -> bool:
        if a is None or b is None:
            return False
        a, b = (" ".join(t.casefold().split()) for t in (a, b))
        if a == b or not a or not b:
            return a == b
        if 2 * min(len(a), len(b)) / (len(a) + len(b)) <= 0.9:
            return False
        matcher = SequenceMatcher(None, a, b)
        return matcher.quick_ratio() > 0.9 and matcher.ratio() > 0.9

    return pd.Series([same(a, b) for a, b in zip(left, right, strict=True)], dtype=bool)


def _anchor(text: str, evidence: str) -> str:
    """From the first place of the text whose four characters the evidence has, as far as the evidence goes on, to at most forty; '' for none.

    What begins at an earlier place would hold an earlier four, so nothing is gained to the left.
    """
    known = {evidence[i : i + _GRAM] for i in range(len(evidence) - _GRAM + 1)}
    for at in range(len(text) - _GRAM + 1):
        if text[at : at + _GRAM] in known:
            longer = range(_GRAM + 1, min(_LONGEST, len(text) - at) + 1)
            return text[at : at + _GRAM + bisect_left(longer, True, key=lambda n: text[at : at + n] not in evidence)]
    return ""


@F.pandas_udf(_STRING)
def text_anchor(text: pd.Series, evidence: pd.Series) -> pd.Series:
    """The part of the text that the evidence quotes first, see _anchor()."""
    return pd.Series([None if t is None or e is None else _anchor(t, e) for t, e in zip(text, evidence, strict=True)])


@F.pandas_udf(T.ArrayType(_STRING))
def text_anchors(texts: pd.Series, evidence: pd.Series) -> pd.Series:
    """text_anchor() of each of several texts; '' for null ones and for null evidence."""
    return pd.Series([[_anchor(t or "", e or "") for t in (() if several is None else several)] for several, e in zip(texts, evidence, strict=True)])


class _Substrings:
    """All substrings of a text, as the states of a suffix automaton."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in text:
            new = self._state({}, self.length[last] + 1)
            at, last = last, new
            while at >= 0 and c not in self.next[at]:
                self.next[at][c] = new
                at = self.link[at]
            if at < 0:
                self.link[new] = 0
                continue
            old = self.next[at][c]
            if self.length[old] == self.length[at] + 1:
                self.link[new] = old
                continue
            copy = self._state(dict(self.next[old]), self.length[at] + 1)
            self.link[copy] = self.link[old]
            self.link[old] = self.link[new] = copy
            while at >= 0 and self.next[at].get(c) == old:
                self.next[at][c] = copy
                at = self.link[at]

    def _state(self, following: dict[str, int], length: int) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def ending(self, text: str) -> list[int]:
        """For each place of another text, how many characters before and with it this text has in a row."""
        state = size = 0
        out = []
        for c in text:
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                size += 1
            out.append(size)
        return out


@F.pandas_udf(T.ArrayType(_STRING))
def shared_phrases(evidence: pd.Series, text: pd.Series) -> pd.Series:
    """The strings of four and more characters that the text has too and that reach no further to either side in the evidence,
    in order of their places there, each once."""

    def phrases(e: str | None, t: str | None) -> list[str]:
        if not e or not t:
            return []
        sizes = _Substrings(t).ending(e)
        ends = [i for i, n in enumerate(sizes) if n >= _GRAM and (i + 1 == len(sizes) or sizes[i + 1] != n + 1)]
        return list(dict.fromkeys(e[i + 1 - sizes[i] : i + 1] for i in ends))

    return pd.Series([phrases(e, t) for e, t in zip(evidence, text, strict=True)])


@F.pandas_udf(_INT)
def common_length(left: pd.Series, right: pd.Series) -> pd.Series:
    """How long the longest string is that both texts have."""

    def longest(a: str | None, b: str | None) -> int | None:
        if a is None or b is None:
            return None
        return SequenceMatcher(None, a, b, autojunk=False).find_longest_match().size

    return pd.Series([longest(a, b) for a, b in zip(left, right, strict=True)], dtype="Int32")


@F.pandas_udf(_STRING)
def run_shape(text: pd.Series) -> pd.Series:
    """The kinds of characters in turn, A capital, a other letter, 9 digit, X other, with how many stand in a row."""

    def kind(c: str) -> str:
        return ("A" if c.isupper() else "a") if c.isalpha() else "9" if c.isdigit() else "X"

    def shape(t: str) -> str:
        runs = [(k, len(list(g))) for k, g in groupby(t, key=kind)]
        return "".join(k if n == 1 else f"{k}{n}" for k, n in runs)

    return text.map(lambda t: None if t is None else shape(t))


@F.pandas_udf(_STRING)
def first_json_object(text: pd.Series) -> pd.Series:
    """The first JSON object in a text, with sorted keys; null for none. Braces that begin none are passed over."""
    decoder = json.JSONDecoder()

    def find(t: str | None) -> str | None:
        at = (t or "").find("{")
        while at >= 0:
            try:
                value, _ = decoder.raw_decode(t, at)
                return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            except ValueError:
                at = t.find("{", at + 1)
        return None

    return text.map(find)


@F.pandas_udf(_STRING)
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON with sorted keys and no blanks at any depth; null where it is none."""

    def canon(t: str | None) -> str | None:
        try:
            return None if t is None else json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except ValueError:
            return None

    return text.map(canon)


def _walk(x, path: str) -> Iterator[tuple[str, str]]:
    if isinstance(x, str):
        yield path, x
    elif isinstance(x, dict):
        for k, v in x.items():
            yield from _walk(v, f"{path}.{k}")
    elif isinstance(x, list):
        for k, v in enumerate(x):
            yield from _walk(v, f"{path}[{k}]")


def _leaves(text: str | None) -> list[tuple[str, str]]:
    try:
        return list(_walk(json.loads(text), "$")) if text else []
    except ValueError:
        return []


@F.pandas_udf(_LEAVES)
def string_leaves(text: pd.Series) -> pd.Series:
    """Every string in a JSON value with its path."""

    return text.map(lambda t: [{"path": path, "value": value} for path, value in _leaves(t)])


@F.pandas_udf(T.ArrayType(_STRING))
def paths_of_leaves(text: pd.Series, part: pd.Series) -> pd.Series:
    """The paths of the strings in a JSON value that hold a part."""
    return pd.Series([[path for path, value in _leaves(t) if p in value] for t, p in zip(text, part, strict=True)])

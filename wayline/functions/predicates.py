"""Page predicates with vocabularies as parameters: walls, gates, trailers, play controls."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayline.functions.text import contains_any


@dataclass(frozen=True)
class Walls:
    """Phrases of pages that let nobody in. Kinds are tried in order, and order is meaning."""

    gate: Sequence[str] = ("subscribe to continue", "members only", "unlock this")
    action: Sequence[str] = ("subscribe", "buy", "join")
    context: Sequence[str] = ("to watch", "to continue", "full access")
    login: Sequence[str] = ("log in to", "sign in to")
    price: str = r"(?:[$€£]\s?[0-9]+(?:[.,][0-9]{2})?|[0-9]+(?:[.,][0-9]{2})?\s?(?:eur|usd))"
    kinds: Sequence[tuple[str, Sequence[str]]] = (("challenge", ("checking your browser", "are you a robot")), ("not_found", ("page not found", "404")), ("forbidden", ("access denied", "403")), ("region", ("not available in your",)))


def folded(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"\s+", " "))


def access_kind(text: Column, walls: Walls) -> Column:
    """The first kind whose phrase the text holds; null without."""
    low, out = folded(text), F.lit(None).cast("string")
    for name, phrases in reversed(list(walls.kinds)):
        out = F.when(contains_any(low, phrases), name).otherwise(out)
    return out


def has_price(text: Column, walls: Walls) -> Column:
    return folded(text).rlike(walls.price)


def paywall_tier(text: Column, walls: Walls) -> Column:
    """1 for a gate's phrase, 2 for a call to action and its context in one sentence, else null.

    The context must stand outside the call, so it is looked for in what is left without the call.
    """
    low = folded(text)
    sentences = F.split(low, r"[.!?]+\s*")
    pattern = r"\b(?:" + "|".join(walls.action) + r")\b"
    both = F.exists(sentences, lambda s: s.rlike(pattern) & contains_any(F.regexp_replace(s, pattern, " "), walls.context))
    return F.when(contains_any(low, walls.gate), 1).when(both, 2)


def price_gate(text: Column, walls: Walls) -> Column:
    """A price with a call to action where the page is no login wall."""
    low = folded(text)
    return has_price(text, walls) & contains_any(low, walls.action) & ~contains_any(low, walls.login)


def trailer_kind(text: Column, words: Sequence[str], full: str) -> Column:
    """only, if nothing but trailers is there; suspect, if trailers and the whole thing are; else none."""
    low = folded(text)
    rest = low
    for word in words:
        rest = F.regexp_replace(rest, rf"[^.]*\b{word}\b[^.]*[.]?", "")
    has = contains_any(low, words)
    return F.when(has & ~rest.rlike(full), "only").when(has, "suspect").otherwise("none")


def is_play_control(label: Column, never: Sequence[str], words: Sequence[str], episode: str) -> Column:
    """Words that are never one decide first, then words, then the shape of an episode's name."""
    low = folded(label)
    return F.when(contains_any(low, never), False).when(contains_any(low, words), True).otherwise(low.rlike(episode))


def prices(text: Column) -> Column:
    """The first price of a text: amount and currency."""
    amount = F.regexp_extract(text, r"([$€£])\s?([0-9]+(?:[.,][0-9]{1,2})?)", 2)
    sign = F.regexp_extract(text, r"([$€£])\s?([0-9]+(?:[.,][0-9]{1,2})?)", 1)
    return F.struct(F.when(amount != "", F.replace(amount, F.lit(","), F.lit(".")).cast("double")).alias("amount"), F.nullif(sign, F.lit("")).alias("currency"))


def phrase_spans(text: Column, phrases: Sequence[str]) -> Column:
    """The phrases that occur, by place, each once."""
    found = F.filter(F.array(*(F.struct(F.instr(text, p).alias("at"), F.lit(p).alias("phrase")) for p in phrases)), lambda x: x["at"] > 0)
    return F.transform(F.array_sort(found), lambda x: x["phrase"])


def has_certain_tone(text: Column, certain: Sequence[str], doubt: Sequence[str]) -> Column:
    low = folded(text)
    return contains_any(low, certain) & ~contains_any(low, doubt)

"""Text expressions: lines, noise, scores, clean-up. All are Column in, Column out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace as Unicode has it; trim() knows the blank only.
STRIP = r"(?U)^\s+|\s+$"
URL = r"https?://[^\s\"'<>]+"
REPLACEMENT = "�"


@dataclass(frozen=True)
class Noise:
    """What makes a line noise: words that are the whole line, a pattern, and a pattern that counts in short lines only."""

    words: Sequence[str]
    pattern: str
    short_pattern: str
    short: int = 40


def strip(text: Column) -> Column:
    return F.regexp_replace(text, STRIP, "")


def lines(text: Column) -> Column:
    """Stripped lines that are not empty, in order."""
    return F.filter(F.transform(F.split(text, r"\R|[\x1c-\x1e]"), strip), lambda line: line != "")


def is_noise(line: Column, noise: Noise) -> Column:
    return line.isin(*noise.words) | line.rlike(noise.pattern) | (line.rlike(noise.short_pattern) & (F.length(line) < noise.short))


def candidate_lines(text: Column, noise: Noise) -> Column:
    """The lines that are no noise, the first of equal ones."""
    return F.array_distinct(F.filter(lines(text), lambda line: ~is_noise(line, noise)))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def line_score(line: Column, keep: Sequence[str], focus: Column, keywords: Sequence[str]) -> Column:
    """4 where a line must stay, 3 where it meets the focus, 2 for a keyword, 1 for six characters, else 0."""
    return (
        F.when(contains_any(line, keep), 4).when(focus_hit(line, focus), 3).when(contains_any(line, keywords), 2).when(F.length(line) >= 6, 1).otherwise(0)
    )


def focus_hit(text: Column, focus: Column, common: int = 3) -> Column:
    """Whether text holds the focus or shares a run of `common` characters with it."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(focus) - common + 1, F.lit(1))), lambda i: F.substring(focus, i, F.lit(common)))
    shared = (F.length(focus) >= common) & F.exists(grams, lambda gram: F.contains(text, gram))
    return (F.length(focus) > 0) & (F.contains(text, focus) | shared)


def clean_body(html: Column) -> Column:
    """Text of markup: paired, then unclosed style and script blocks go, then tags, then control characters."""
    text = F.regexp_replace(html, r"(?is)<script\b[^>]*>.*?</script\s*>", " ")
    text = F.regexp_replace(text, r"(?is)<style\b[^>]*>.*?</style\s*>", " ")
    text = F.regexp_replace(text, r"(?is)<(?:script|style)\b[^>]*>[^<]*", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    return normal_space(F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""))


def normal_space(text: Column) -> Column:
    """Horizontal runs become one blank, lines lose their ends, three and more line ends become two."""
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r" ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"^[ \n]+|[ \n]+$", "")


def title(html: Column) -> Column:
    return strip(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def is_mojibake(text: Column, threshold: int = 3) -> Column:
    return F.regexp_count(text, F.lit(REPLACEMENT)) >= threshold


def count_urls(text: Column) -> Column:
    return F.regexp_count(text, F.lit(URL))


def entities(text: Column) -> Column:
    """URLs and quoted phrases, each once, in the order of their kinds."""
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(g)) for p, g in ((URL, 0), (r'"([^"\n]{2,80})"', 1), (r"\b((?:[a-z0-9-]+\.)+(?:com|org|net))\b", 1))]
    return F.array_distinct(F.concat(*found))


def strip_noise(text: Column) -> Column:
    """Without private-use characters; empty where nothing but punctuation is left."""
    out = F.regexp_replace(text, r"[\x{E000}-\x{F8FF}]", "")
    return F.when(out.rlike(r"[\p{L}\p{N}]"), out).otherwise("")


def base_evidence(text: Column) -> Column:
    """The first paragraph, without the prefix that an earlier verdict left."""
    return F.split_part(F.regexp_replace(text, r"^\[was [^\]]*\]\s*", ""), F.lit("\n"), F.lit(1))


def strip_think(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?is)<think>.*?</think>", ""))


def as_bool(text: Column) -> Column:
    """true and false in their usual spellings, null for all else."""
    low = F.lower(strip(text))
    return F.when(low.isin("true", "yes", "1", "y"), True).when(low.isin("false", "no", "0", "n"), False)


def incomplete_reason(text: Column) -> Column:
    """Why a last answer looks cut off; null where it does not."""
    bare = F.regexp_replace(text, r"\s+$", "")
    return (
        F.when(bare == "", "empty")
        .when(bare.rlike(r"(\.\.\.|…)$"), "ellipsis")
        .when(bare.rlike(r"[:,;(\[{-]$"), "open")
        .when(F.length(F.regexp_replace(bare, r"[^(]", "")) > F.length(F.regexp_replace(bare, r"[^)]", "")), "bracket")
        .when(~bare.rlike(r"[.!?)\]}\"']$"), "no_end")
    )


def script_class(text: Column) -> Column:
    """A coarse class of the letters in a text, the rarest script first."""
    return (
        F.when(text.rlike(r"[\x{3040}-\x{30ff}]"), "kana")
        .when(text.rlike(r"[\x{ac00}-\x{d7a3}]"), "hangul")
        .when(text.rlike(r"[\x{4e00}-\x{9fff}]"), "han")
        .when(text.rlike(r"[\x{00df}-\x{00ff}]"), "latin_accented")
        .otherwise("latin")
    )


def l0_clean(text: Column) -> Column:
    """Tool output without colour codes, carriage returns, tabs and symbol or format characters; blank runs collapse."""
    out = F.regexp_replace(text, r"\x1b\[[0-9;]*[A-Za-z]", "")
    out = F.regexp_replace(F.regexp_replace(out, r"\r\n?", "\n"), r"\t", "    ")
    out = F.regexp_replace(out, r"[\p{So}\p{Cf}\p{Co}]", "")
    return F.regexp_replace(out, r"\n{3,}", "\n\n")

"""What a task's wording asks for, and how decisions and claims are read, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted_title(text: Column, patterns: Sequence[str], stop_words: Sequence[str], referring: str) -> Column:
    """The first group of the first pattern whose match is a title: not empty, no stop word, no referring phrase."""
    found = []
    for pattern in patterns:
        title = F.trim(F.regexp_extract(text, pattern, 1))
        found.append(F.when((title != "") & ~F.lower(title).isin(list(stop_words)) & ~title.rlike(referring), title))
    return F.coalesce(*found)


def retrieval_mode(title: Column, text: Column, markers: Sequence[str]) -> Column:
    """single_title where a title is given, unknown_title where the wording looks for one, else aggregate."""
    unknown = F.lit(False)
    for marker in markers:
        unknown = unknown | F.contains(text, F.lit(marker))
    return F.when(F.coalesce(title, F.lit("")) != "", "single_title").when(unknown, "unknown_title").otherwise("aggregate")


def _first_probe(text: Column, probes: Sequence[str]) -> Column:
    low = F.lower(text)
    return F.coalesce(*(F.when(F.contains(low, F.lit(p.lower())), F.lit(p)) for p in probes))


def constraints(text: Column, probes: dict[str, list[str]]) -> Column:
    """The constraints whose probes are in the text, as key:probe with the first probe found, in the order of probes."""
    each = [F.when(_first_probe(text, words).isNotNull(), F.concat(F.lit(f"{key}:"), _first_probe(text, words))) for key, words in probes.items()]
    return F.array_compact(F.array(*each))


def lost_constraints(text: Column, wanted: Column, probes: dict[str, list[str]]) -> Column:
    """The keys of wanted (key:probe) that no probe in the text keeps; keys without probes are never lost."""
    lost = [F.when(_first_probe(text, words).isNull(), F.lit(key)) for key, words in probes.items()]
    keys = F.transform(wanted, lambda x: F.substring_index(x, ":", 1))
    return F.array_intersect(keys, F.array_compact(F.array(*lost)))


def decision_branch(answer: Column, question: Column, access: Column, paywall: Column, access_branches: dict[str, str], negative: dict[str, str], deprecated: Sequence[str]) -> Column:
    """The branch of a decision: '' for yes; for no what its payload tells, else what its question means by no.

    access: the kind of defect in the payload; paywall: the kind of paywall in it, '' or null for none. Questions without
    a branch, and deprecated branches, are unresolved, as is no answer.
    """
    pick = lambda of, table: F.coalesce(*(F.when(of == k, v) for k, v in table.items()))
    fallback = pick(question, negative)
    return (
        F.when(answer, "")
        .when(answer.isNull(), "unresolved")
        .otherwise(
            F.coalesce(
                pick(access, access_branches),
                F.when(paywall.isin("preview", "trial"), "partial_free"),
                F.when(F.coalesce(paywall, F.lit("")) != "", "pay_wall"),
                F.when(~fallback.isin(list(deprecated)), fallback),
                F.lit("unresolved"),
            )
        )
    )


def factor_tier(state: Column, factor: Column, table: dict[str, dict[str, int]]) -> Column:
    """The tier of a factor within a state; null where the state or the factor is not in the table."""
    return F.coalesce(*(F.when((state == s) & (factor == f), F.lit(tier)) for s, tiers in table.items() for f, tier in tiers.items()))


def claims(text: Column) -> Column:
    """What a text claims: its urls without punctuation at their ends, then its list items, as (kind, value)."""
    urls = F.transform(F.regexp_extract_all(text, F.lit(r"https?://[^\s<>()]+"), F.lit(0)), lambda u: F.regexp_replace(u, "[.,;:]+$", ""))
    items = F.transform(F.regexp_extract_all(text, F.lit(r"(?m)^[ \t]*(?:[-*+][ \t]+|[0-9]+[.)][ \t]+)(.+)$"), F.lit(1)), lambda x: F.trim(x))
    as_kind = lambda kind: lambda value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    return F.concat(F.transform(urls, as_kind("url")), F.transform(items, as_kind("list_item")))


def meta_tags_stripped(text: Column, opening: str = "⟦", closing: str = "⟧") -> Column:
    """The text without tags in the given brackets, and then without runs of empty lines; other texts stay as they are."""
    cut = F.regexp_replace(F.regexp_replace(text, f"{opening}[^{closing}]*{closing}", ""), "\n{3,}", "\n\n")
    cut = F.when(F.endswith(cut, F.lit("\n\n")), F.concat(F.regexp_replace(cut, r"\s+$", ""), F.lit("\n"))).otherwise(cut)
    return F.when(F.contains(text, F.lit(opening)), cut).otherwise(text)


def says_any(text: Column, phrases: Sequence[str]) -> Column:
    """Whether the text holds one of the phrases in any case: rate limits, honest limitations."""
    low, found = F.lower(F.coalesce(text, F.lit(""))), F.lit(False)
    for phrase in phrases:
        found = found | F.contains(low, F.lit(phrase))
    return found


def markdown_table(text: Column) -> Column:
    """(columns, rows) of the first markdown table all of whose rows are as wide as its head; null for none.

    Lines with a bar are the table's, wherever they stand.
    """
    lines = F.transform(F.filter(F.split(text, "\n"), lambda line: F.contains(line, F.lit("|"))), lambda line: F.trim(line))
    width = lambda line: F.size(F.split(F.trim(line, F.lit("|")), "[|]"))
    rule = lambda line: F.trim(line, F.lit("|")).rlike(r"^\s*:?-{3,}:?\s*([|]\s*:?-{3,}:?\s*)*$")
    at = F.array_min(F.filter(F.sequence(F.lit(2), F.greatest(F.size(lines) - 1, F.lit(2))), lambda i: rule(F.get(lines, i - 1)) & (F.size(lines) > 2)))
    body = F.slice(lines, at + 1, F.size(lines))
    head = F.get(lines, at - 2)
    fits = F.forall(body, lambda line: width(line) == width(head))
    return F.when(at.isNotNull() & fits, F.struct(width(head).alias("columns"), F.size(body).alias("rows")))

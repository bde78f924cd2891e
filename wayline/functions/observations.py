"""What an observation of a page lacks, and what it says about the page, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayline.functions.checks import block_kind


def _has(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def missing_marker(present: Column, body: Column, preview: Column) -> Column:
    """What is missing of an observation: null where a body is there or no observation is."""
    empty = F.coalesce(body == "", F.lit(True))
    return F.when(F.coalesce(present, F.lit(False)) & empty, F.when(F.coalesce(preview != "", F.lit(False)), "body_preview_only").otherwise("no_body"))


def shortfall(present: Column, degraded: Column, truncated: Column, elements: Column, total: Column, body: Column) -> Column:
    """The first reason for which an observation may lack what was on the page, '' for none.

    degraded: its list of markers; elements: how many were kept; total: how many there were, null or 0 if not told.
    """
    return (
        F.when(~F.coalesce(present, F.lit(False)), "none")
        .when(F.coalesce(F.size(degraded) > 0, F.lit(False)), "degraded")
        .when(F.coalesce(truncated, F.lit(False)), "truncated")
        .when(F.coalesce(F.nullif(total, F.lit(0)), elements) > elements, "elements_cropped")
        .when(~_has(body) & (elements == 0), "empty")
        .otherwise("")
    )


def same_page(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Whether two observations, each given by url, number of elements and body, are of one page; nulls are never equal."""
    same = [F.coalesce(a == b, F.lit(False)) for a, b in zip(left, right, strict=True)]
    return same[0] & same[1] & same[2]


def blocks_candidates(markers: Column, blocks: dict[str, str]) -> Column:
    """Whether links or navigation are degraded, so that no candidates can be drawn from the page.

    blocks: the block of a page that each marker of degradation is about; markers without one are about other things.
    """
    closing = [marker for marker, block in blocks.items() if block in ("links", "nav")]
    return F.coalesce(F.arrays_overlap(markers, F.array(*map(F.lit, closing))), F.lit(False))


def page_verdict(present: Column, url: Column, title: Column, body: Column, dead_loop: Column, login_wall: Column, paywall: Column, degraded: Column, vocabulary: dict[str, list[str]]) -> Column:
    """One of seven verdicts on a page, the first that holds.

    vocabulary: what tells a challenge in urls (urls), in titles (titles), a rate limit in bodies (limits), and a challenge
    of an edge network in titles (edge).
    """
    kind = block_kind(url, title, body, vocabulary["urls"], vocabulary["titles"], vocabulary["limits"])
    low = F.lower(F.coalesce(title, F.lit("")))
    edge = F.lit(False)
    for marker in vocabulary["edge"]:
        edge = edge | F.contains(low, F.lit(marker))
    yes = lambda flag: F.coalesce(flag, F.lit(False))
    return (
        F.when(~yes(present), "normal")
        .when(yes(kind == "captcha"), F.when(edge, "blocked_edge").otherwise("captcha"))
        .when(yes(kind == "rate_limit"), "blocked_edge")
        .when(yes(dead_loop), "dead_loop")
        .when(yes(login_wall), "login_wall")
        .when(yes(paywall), "paywall")
        .when(yes(F.size(degraded) > 0), "degraded")
        .otherwise("normal")
    )


def searchable(url: Column, title: Column, body: Column, labels: Column, links: Column) -> Column:
    """All text of an observation in one, a line for each part."""
    return F.concat_ws("\n", url, title, body, F.array_join(labels, "\n"), F.array_join(links, "\n"))

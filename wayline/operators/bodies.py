"""The body of a page as a training sample shows it: by rules, or by lines that a model picked, within a budget. All are Column in, Column out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayline.functions import text as T

#: Lines of this score and above stay whatever they cost.
FORCED = 4


def scored_lines(lines: Column, keep: Sequence[str], focus: Column, keywords: Sequence[str]) -> Column:
    """Lines as array<struct<idx,line,score>>, idx their place."""
    return F.transform(lines, lambda x, k: F.struct(k.alias("idx"), x.alias("line"), T.line_score(x, keep, focus, keywords).alias("score")))


def within_budget(scored: Column, limit: int, last_end: bool = True) -> Column:
    """(text, kept, truncated) of array<struct<idx,line,score>>.

    Forced lines stay. The others follow by score, then place; the first that does not fit is cut, and none after it
    is taken. What is taken is put back in order of place. A line costs its end too. Where only the end of the last line taken
    does not fit, nothing of the text is lost: that counts as truncated unless last_end is false.
    """
    forced = F.transform(F.filter(scored, lambda x: x["score"] >= FORCED), lambda x: F.struct(x["idx"].alias("idx"), x["line"].alias("line")))
    rest = F.array_sort(F.transform(F.filter(scored, lambda x: x["score"] < FORCED), lambda x: F.struct((-x["score"]).alias("order"), x["idx"].alias("idx"), x["line"].alias("line"))))
    left = F.lit(limit) - F.aggregate(forced, F.lit(0), lambda n, x: n + F.length(x["line"]) + 1)
    none = F.slice(forced, 1, 0)

    def take(acc: Column, x: Column) -> Column:
        cost = F.length(x["line"]) + 1
        fits = cost <= acc["left"]
        part = lambda line: F.concat(acc["took"], F.array(F.struct(x["idx"].alias("idx"), line.alias("line"))))
        # at most limit / 2 + 1 lines are taken, so the array stays short whatever the page
        took = F.when(acc["full"], acc["took"]).when(fits, part(x["line"])).when(acc["left"] > 0, part(F.left(x["line"], acc["left"]))).otherwise(acc["took"])
        over = acc["full"] | ~fits
        lost = over if last_end else acc["lost"] | acc["full"] | (F.length(x["line"]) > acc["left"])
        return F.struct(F.when(over, acc["left"]).otherwise(acc["left"] - cost).alias("left"), over.alias("full"), lost.alias("lost"), took.alias("took"))

    filled = F.aggregate(rest, F.struct(left.alias("left"), F.lit(False).alias("full"), F.lit(False).alias("lost"), none.alias("took")), take)

    def told(acc: Column) -> Column:
        chosen = F.array_sort(F.concat(forced, acc["took"]))
        whole = F.array_join(F.transform(chosen, lambda x: x["line"]), "\n")
        return F.struct(whole.alias("text"), F.size(chosen).alias("kept"), (acc["lost"] | (F.length(whole) > limit)).alias("truncated"))

    return F.get(F.transform(F.array(filled), told), F.lit(0))


def digest(body: Column, noise: T.Noise, keep: Sequence[str], focus: Column, keywords: Sequence[str], limit: int, last_end: bool = True) -> Column:
    """(text, kept, truncated) of a body by rules: its lines without noise and repeats, within the budget."""
    return within_budget(scored_lines(T.candidate_lines(body, noise), keep, focus, keywords), limit, last_end)


def refined(body: Column, picked: Column, noise: T.Noise, keep: Sequence[str], focus: Column, keywords: Sequence[str], limit: int, last_end: bool = True) -> Column:
    """(text, kept, truncated) of a body by picked lines; null where they cannot be used, and then none of them is.

    Every picked line, without blanks at its ends, must stand in the body as it is; empty and repeated ones do not count, and one at
    least must be left. Forced lines that were not picked come back. All are put in the order of the page and pass the rules of digest().
    """
    lines = T.lines(body)
    wanted = F.array_distinct(F.filter(F.transform(picked, lambda x: T.strip(x)), lambda x: x != ""))
    usable = (F.size(wanted) > 0) & (F.size(F.array_except(wanted, lines)) == 0)
    forced = F.filter(T.candidate_lines(body, noise), lambda x: T.line_score(x, keep, focus, keywords) >= FORCED)
    ordered = F.array_intersect(lines, F.array_union(wanted, forced))  # in the order of the page, each once
    return F.when(usable, digest(F.array_join(ordered, "\n"), noise, keep, focus, keywords, limit, last_end))


def view(body: Column, picked: Column, noise: T.Noise, keep: Sequence[str], focus: Column, keywords: Sequence[str], limit: int, last_end: bool = True) -> Column:
    """(text, kept, dropped, truncated, source): refined() where it can be used, else digest(); dropped counts candidate lines that are not kept."""
    by_pick = refined(body, picked, noise, keep, focus, keywords, limit, last_end)
    by_rule = digest(body, noise, keep, focus, keywords, limit, last_end)
    total = F.size(T.candidate_lines(body, noise))

    def told(x: Column) -> Column:
        return F.struct(x["shown"]["text"].alias("text"), x["shown"]["kept"].alias("kept"), F.greatest(total - x["shown"]["kept"], F.lit(0)).alias("dropped"), x["shown"]["truncated"].alias("truncated"), x["source"].alias("source"))

    # computed once each: the pick decides
    choice = F.transform(F.array(by_pick), lambda p: F.struct(F.coalesce(p, by_rule).alias("shown"), F.when(p.isNotNull(), "refined").otherwise("rules").alias("source")))
    return F.get(F.transform(choice, told), F.lit(0))

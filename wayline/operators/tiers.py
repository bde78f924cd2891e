"""Archives of blocks in tiers, rendered within a budget. Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The heads of the tiers, the most important first; later tiers are never shown.
HEADS = ("T0 关键 (原文)", "T1 重要 (详述)", "T2 常规 (简述)", "T3 指针")


def rendered(entries: Column, budget: Column | None = None) -> Column:
    """The text of array<struct<tier:int,type:string,message:int,content:string>>, tiers in order, entries in theirs.

    A tier is shown whole or not at all: it is left out with the first of its lines that goes beyond the budget. The lines before that
    one still count, so what follows never goes beyond it either. Heads do not count. Without a budget all is shown.
    """
    kept = F.filter(entries, lambda e: (e["tier"] >= 0) & (e["tier"] < len(HEADS)))
    lines = F.transform(
        kept,
        lambda e, k: F.struct(
            e["tier"].cast("int").alias("tier"),
            k.alias("place"),
            F.format_string("- [%s@%d] %s", F.coalesce(e["type"], F.lit("")), F.coalesce(e["message"], F.lit(0)), F.coalesce(e["content"], F.lit(""))).alias("line"),
        ),
    )
    most = F.lit(1 << 30) if budget is None else F.coalesce(budget.cast("int"), F.lit(1 << 30))

    def take(acc: Column, x: Column) -> Column:
        size = F.length(x["line"])
        fits = acc["used"] + size <= most
        over = acc["closed"] == x["tier"]
        closed = F.when(~over & ~fits, x["tier"]).otherwise(acc["closed"])
        gone = F.when(~over & ~fits, F.array_union(acc["gone"], F.array(x["tier"]))).otherwise(acc["gone"])
        return F.struct(F.when(over | ~fits, acc["used"]).otherwise(acc["used"] + size).alias("used"), closed.alias("closed"), gone.alias("gone"))

    ordered = F.array_sort(lines)
    walked = F.aggregate(ordered, F.struct(F.lit(0).alias("used"), F.lit(-1).alias("closed"), F.array().cast("array<int>").alias("gone")), take, lambda acc: acc["gone"])

    def told(gone: Column) -> Column:
        of = lambda tier: F.transform(F.filter(ordered, lambda x: (x["tier"] == tier) & ~F.array_contains(gone, x["tier"])), lambda x: x["line"])
        parts = [F.when(F.size(of(k)) > 0, F.concat(F.lit(f"## {head}\n"), F.array_join(of(k), "\n"))) for k, head in enumerate(HEADS)]
        return F.array_join(F.array_compact(F.array(*parts)), "\n\n")

    return F.coalesce(F.get(F.transform(F.array(walked), told), F.lit(0)), F.lit(""))

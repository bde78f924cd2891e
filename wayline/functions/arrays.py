"""Array, element and vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def project_elements(elements: Column) -> Column:
    """Elements of either dialect, (tag, label) or (role, name), as (role, name); what is there counts, even if empty."""
    return F.transform(elements, lambda e: F.struct(F.coalesce(e["role"], e["tag"]).alias("role"), F.coalesce(e["name"], e["label"]).alias("name")))


def element_dialect(elements: Column) -> Column:
    """The first element decides; null without elements."""
    first = F.try_element_at(elements, F.lit(1))
    return F.when(first["role"].isNotNull() | first["name"].isNotNull(), "aria").when(first["tag"].isNotNull() | first["label"].isNotNull(), "html")


def dot(a: Column, b: Column) -> Column:
    """Inner product over the shorter length."""
    n = F.least(F.size(a), F.size(b))
    pairs = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine in [-1, 1] over the shorter length; 0 for a zero vector."""
    n = F.least(F.size(a), F.size(b))
    a, b = F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n)
    norms = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norms == 0, 0.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / norms)))


def needs_refine(lines: Column, limit: int) -> Column:
    """Whether lines with their ends pass a limit of characters."""
    return F.aggregate(lines, F.lit(0), lambda s, line: s + F.length(line) + 1) > limit


def line_budget(lines: Column, limit: int, low: int = 3, high: int = 40) -> Column:
    """How many lines of average length fit, within bounds."""
    total = F.aggregate(lines, F.lit(0), lambda s, line: s + F.length(line))
    mean = F.greatest(F.lit(1), F.floor(total / F.greatest(F.size(lines), F.lit(1))))
    return F.greatest(F.lit(low), F.least(F.lit(high), F.floor(F.lit(limit) / mean))).cast("int")


def strict_split(splits: Column) -> Column:
    """The split a row of several counts for: holdout before regression before calibration."""
    out = F.lit(None).cast("string")
    for name in ("calibration", "regression", "holdout"):
        out = F.when(F.array_contains(splits, name), name).otherwise(out)
    return out


def splits_within(splits: Column, allowed: list[str]) -> Column:
    """Whether a row has splits and all are allowed."""
    return (F.size(splits) > 0) & (F.size(F.array_except(splits, F.array(*map(F.lit, allowed)))) == 0)

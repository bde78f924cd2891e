"""Units of a run that a declared platform excludes, and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def host_suffixes(host: Column) -> Column:
    """A host and all its parent domains: a key for joins with roots."""
    parts = F.split(host, "[.]")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def excluded_units(places: DataFrame, declared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, unit, platform) of the units that touch a platform their run has declared.

    places(*keys, unit, place, host): the urls of a unit's actions and observations in order, actions first; declared(*keys,
    platform). The first place that is on one counts; units keep their numbers.
    """
    hosts = places.select(*keys, "unit", "place", F.explode(host_suffixes(F.col("host"))).alias("platform"))
    hit = hosts.join(declared, [*keys, "platform"])
    return hit.groupBy(*keys, "unit").agg(F.min(F.struct("place", "platform")).getField("platform").alias("platform"))


def excluded_outcomes(matched: DataFrame, units: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, outcome) that visits of excluded units were matched with; matched(*keys, unit, outcome), null for none."""
    return matched.where("outcome is not null").join(units.select(*keys, "unit"), [*keys, "unit"], "left_semi").select(*keys, "outcome").distinct()


def pool_members(outcomes: DataFrame, excluded: DataFrame, keys: Sequence[str], non_samples: Sequence[str]) -> DataFrame:
    """(*keys, url, branch), each once, of outcomes(*keys, outcome, url, branch) that belong into the pool: a branch that is a
    sample and collected, and neither it nor another outcome of the same url and branch is excluded(*keys, outcome)."""
    wanted = outcomes.where(F.col("branch").isNotNull() & ~F.col("branch").isin(list(non_samples)))
    wanted = wanted.select(*keys, "outcome", F.coalesce("url", F.lit("")).alias("url"), "branch")
    gone = wanted.join(excluded, [*keys, "outcome"], "left_semi").select(*keys, "url", "branch").distinct()
    return wanted.select(*keys, "url", "branch").distinct().join(gone, [*keys, "url", "branch"], "left_anti")

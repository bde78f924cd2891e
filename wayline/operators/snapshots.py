"""Snapshots of gold against predictions, row by row and dimension by dimension, and what follows from them: cards to triage, and accounts of
collections that were blocked."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayline.functions.checks import face
from wayline.operators.gates import known_label

# The dimension of the label, verdicts that differ, and the splits that give no cards.
HARD = "d10"
DIFFERENT = ("disagree", "detail_mismatch", "tier_gap")
SIDE_SPLITS = ("regression", "holdout")


def _surfaces(gold: str, pred: str) -> Column:
    """Whether both sides saw the same surface; null where one does not tell."""
    told = (F.coalesce(gold, F.lit("")) != "") & (F.coalesce(pred, F.lit("")) != "")
    return F.when(told, F.col(gold) == F.col(pred))


def snapshot(
    rows: DataFrame,
    classes: Mapping[str, str],
    success: str,
    faces: Mapping[str, str],
    tolerance: int = 1,
    provenance: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Entries (golden_id, split, dimension, gold_value, pred_value, verdict, delta_kind, tier_gap, pred_face, pred_version, pred_status,
    gold_surface, pred_surface, surface_comparable): for each row its label, and each dimension that either side scored.

    rows(golden_id, split, label, branch, gold_dims map<string,int>, pred_dims map<string,int>, scorer_version, gold_surface, pred_surface). Empty labels and branches are
    successes. Labels agree if they are the same, detail_mismatch if only their class is, else disagree. Scores agree within the tolerance,
    else tier_gap; they are ungraded where one is missing or not from 1 to 5, or the dimension has no face. What face scored a
    dimension, and in which version, is told by the row's scorer_version, else by the provenance of the face: (status, version),
    status reproduced or diverged; else unrecorded.
    """
    label, branch = (F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(success)) for c in ("label", "branch"))
    same = known_label(label, dict(classes)) == known_label(branch, dict(classes))
    verdict = F.when(same & (label == branch), "agree").when(same, "detail_mismatch").otherwise("disagree")
    delta = F.when(same & (label != branch), "label_mismatch").when(~same, "equivalence_class_mismatch")
    none = F.lit(None)
    hard = F.struct(
        F.lit(HARD).alias("dimension"),
        label.alias("gold_value"),
        branch.alias("pred_value"),
        verdict.alias("verdict"),
        delta.alias("delta_kind"),
        none.cast("int").alias("tier_gap"),
        F.lit("collection").alias("pred_face"),
        F.lit("unrecorded").alias("pred_version"),
        F.lit("not_applicable").alias("pred_status"),
    )
    empty = F.create_map().cast("map<string,int>")
    gold_of, pred_of = F.coalesce("gold_dims", empty), F.coalesce("pred_dims", empty)
    known = F.create_map(*[F.lit(x) for pair in faces.items() for x in pair]) if faces else F.create_map().cast("map<string,string>")
    told = {name: (status, version) for name, (status, version) in (provenance or {}).items()}

    def soft(dimension: Column) -> Column:
        gold, pred = gold_of[dimension], pred_of[dimension]
        gap = F.abs(gold - pred)
        graded = known[dimension].isNotNull() & gold.between(1, 5) & pred.between(1, 5)
        scored = F.when(~F.coalesce(graded, F.lit(False)), "ungraded").when(gap <= tolerance, "agree").otherwise("tier_gap")
        by = F.coalesce(known[dimension], F.lit(""))
        recorded = F.lit("")
        status, version = F.lit("unrecorded"), F.lit("unrecorded")
        for name in sorted(set(faces.values())):
            recorded = F.when(by == name, face(F.coalesce("scorer_version", F.lit("")), name)).otherwise(recorded)
            if name in told:
                status = F.when(by == name, told[name][0]).otherwise(status)
                version = F.when((by == name) & F.lit(told[name][0] == "reproduced"), told[name][1]).otherwise(version)
        return F.struct(
            dimension.alias("dimension"),
            gold.cast("string").alias("gold_value"),
            pred.cast("string").alias("pred_value"),
            scored.alias("verdict"),
            F.when(scored == "tier_gap", "tier_gap").alias("delta_kind"),
            F.when(known[dimension].isNotNull(), gap).alias("tier_gap"),
            by.alias("pred_face"),
            F.when(recorded != "", recorded).otherwise(version).alias("pred_version"),
            F.when(recorded != "", "recorded").otherwise(status).alias("pred_status"),
        )

    dimensions = F.array_union(F.map_keys(gold_of), F.map_keys(pred_of))
    entries = F.concat(F.array(hard), F.transform(dimensions, soft))
    sides = ["gold_surface", "pred_surface"]
    out = rows.select("golden_id", F.coalesce("split", F.lit("")).alias("split"), *sides, _surfaces(*sides).alias("surface_comparable"), F.explode(entries).alias("e"))
    return out.select("golden_id", "split", "e.*", *sides, "surface_comparable")


def _differing(entries: DataFrame, collection_side: Collection[str]) -> DataFrame:
    """Entries that differ, outside the side splits, with `blocked`: seen on different surfaces, and the prediction's was blocked."""
    blocked = F.coalesce(~F.col("surface_comparable"), F.lit(False)) & F.coalesce(F.col("pred_value").isin(*collection_side), F.lit(False))
    return entries.where(F.col("verdict").isin(*DIFFERENT) & ~F.col("split").isin(*SIDE_SPLITS)).withColumn("blocked", blocked)


def cards(entries: DataFrame, version: int, collection_side: Collection[str], current: Mapping[str, str]) -> DataFrame:
    """(disagreement_id, status, comparability, *entry) of what is to be triaged. current: the version of each face now; comparability is
    same, other, or undetermined where the entry's or the face's version is not known."""
    rows = _differing(entries, collection_side).where(~F.col("blocked")).drop("blocked")
    now = F.lit(None).cast("string")
    for name, value in current.items():
        now = F.when(F.col("pred_face") == name, F.lit(value)).otherwise(now)
    known = ~F.col("pred_version").isin("", "unrecorded") & (F.coalesce(now, F.lit("")) != "")
    comparability = F.when(F.col("pred_status") == "diverged", "other").when(~known, "undetermined").when(F.col("pred_version") == now, "same").otherwise("other")
    name = F.concat(F.lit(f"v{version}:"), "golden_id", F.lit(":"), "dimension")
    return rows.select(name.alias("disagreement_id"), F.lit("open").alias("status"), comparability.alias("comparability"), *entries.columns)


def accounts(entries: DataFrame, version: int, collection_side: Collection[str]) -> DataFrame:
    """(account_id, golden_id, split, gold_surface, pred_surface, dimensions, bucket) of rows whose collection was blocked on another surface:
    one a row, no matter for triage but to be collected anew."""
    rows = _differing(entries, collection_side).where("blocked")
    name = F.concat(F.lit(f"v{version}:"), "golden_id", F.lit(":collection"))
    return rows.groupBy("golden_id", "split", "gold_surface", "pred_surface").agg(F.array_sort(F.collect_set("dimension")).alias("dimensions")).select(
        name.alias("account_id"), "golden_id", "split", "gold_surface", "pred_surface", "dimensions", F.lit("evidence_missing").alias("bucket")
    )

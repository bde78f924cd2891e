"""Golden versions: carried over from one to the next, guarded, told by fingerprints, and read back only if nothing changed.

A version is a folder of rows, and a line of the manifest that is written after it. What the manifest does not list is no
version, so a crash between the two leaves nothing that is read; the next freeze writes that folder anew. Rows are
(golden_id, golden_id_legacy, split, url, label, code, surface).
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ("label", "code", "surface")
COLUMNS = ["golden_id", "golden_id_legacy", "split", "url", *FIELDS]
MANIFEST = "version INT, parent INT, split STRING, n BIGINT, fingerprint STRING"


def _row_digest() -> Column:
    """A digest of a row by what it says; null differs from every text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in COLUMNS]))


def fingerprints(rows: DataFrame) -> DataFrame:
    """(split, n, fingerprint) of each split: equal for equal rows in any order, partitioned in any way."""
    lane = lambda at: F.bit_xor(F.conv(F.substring("digest", at, 15), 16, 10).cast("long"))
    told = rows.select("split", _row_digest().alias("digest")).groupBy("split").agg(F.count("*").alias("n"), lane(1).alias("a"), lane(17).alias("b"))
    return told.select("split", "n", F.concat_ws("-", "n", F.lower(F.hex("a")), F.lower(F.hex("b"))).alias("fingerprint"))


def carried(previous: DataFrame, candidates: DataFrame, alias: DataFrame, refresh: Collection[str] = (), backfill: str | None = None) -> DataFrame:
    """The rows of a version after `previous`, with `origin`: carried, refreshed or backfilled.

    Splits are never dealt anew: a row keeps its split, and ids that alias(old, new) lists get their new one, the old one kept as
    legacy. Of the fields in `refresh` the value of the candidate counts where it has one. Candidates that the version lacks, and that
    have a label, join the split `backfill` names, none without one. candidates(golden_id, url, label, code, surface), one row an id.
    """
    if unknown := set(refresh) - set(FIELDS):
        raise ValueError(f"no such fields: {sorted(unknown)}")
    if "surface" in refresh and "label" in refresh:
        raise ValueError("a version changes labels or fills in surfaces, not both")
    names = alias.select(F.col("old").alias("golden_id"), F.col("new").alias("_new"))
    kept = previous.join(names, "golden_id", "left")
    kept = kept.withColumn("golden_id_legacy", F.when(F.col("_new").isNotNull(), F.col("golden_id")).otherwise(F.col("golden_id_legacy"))).withColumn("golden_id", F.coalesce("_new", "golden_id"))
    now = candidates.select("golden_id", F.col("url").alias("_url"), *[F.col(f).alias(f"_{f}") for f in FIELDS])
    met = kept.drop("_new").join(now, "golden_id", "left")
    fields = [F.coalesce(f"_{f}", f).alias(f) if f in refresh else F.col(f) for f in FIELDS]
    changed = F.lit(False)
    for f in refresh:
        changed = changed | (F.col(f"_{f}").isNotNull() & ~F.col(f"_{f}").eqNullSafe(F.col(f)))
    rows = met.select("golden_id", "golden_id_legacy", "split", "url", *fields, F.when(changed, "refreshed").otherwise("carried").alias("origin"))
    if backfill is None:
        return rows
    new = candidates.where("label IS NOT NULL").join(kept.select("golden_id"), "golden_id", "left_anti")
    return rows.unionByName(new.select("golden_id", F.lit(None).cast("string").alias("golden_id_legacy"), F.lit(backfill).alias("split"), "url", *FIELDS, F.lit("backfilled").alias("origin")))


def broken_guards(previous: DataFrame, current: DataFrame, refresh: Collection[str] = ()) -> DataFrame:
    """(golden_id, field, before, after) of what a version changes without leave: a row that is gone, its split or url, or a field that is
    not refreshed; and repeated ids. Rows are met by id, else by their legacy id."""
    text = lambda c: F.col(c).cast("string")
    by_id = current.select("golden_id", *[text(c).alias(f"_{c}") for c in ("split", "url", *FIELDS)], F.lit(True).alias("_met"))
    by_legacy = current.where("golden_id_legacy IS NOT NULL").select(F.col("golden_id_legacy").alias("golden_id"), *[text(c).alias(f"_{c}") for c in ("split", "url", *FIELDS)], F.lit(True).alias("_met"))
    missing = by_legacy.join(by_id.select("golden_id"), "golden_id", "left_anti")
    met = previous.join(by_id.unionByName(missing), "golden_id", "left")
    fixed = ["split", "url", *[f for f in FIELDS if f not in refresh]]
    gone = F.when(F.col("_met").isNull(), F.struct(F.lit("row").alias("field"), F.col("golden_id").cast("string").alias("before"), F.lit(None).cast("string").alias("after")))
    differs = [F.when(F.col("_met") & ~text(c).eqNullSafe(F.col(f"_{c}")), F.struct(F.lit(c).alias("field"), text(c).alias("before"), F.col(f"_{c}").alias("after"))) for c in fixed]
    changed = met.select("golden_id", F.inline(F.array_compact(F.array(gone, *differs))))
    twice = current.groupBy("golden_id").agg(F.count("*").alias("n")).where("n > 1")
    return changed.unionByName(twice.select("golden_id", F.lit("repeated").alias("field"), F.lit("1").alias("before"), F.col("n").cast("string").alias("after")))


def _manifest(spark: SparkSession, root: str) -> list[tuple]:
    """The manifest's lines, one a version and split."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    try:
        lines = found.load(f"{root}/manifest").select(F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("line <> ''")
        return [tuple(r) for r in lines.select(F.from_json("line", MANIFEST).alias("m")).select("m.*").collect()]
    except Exception as e:  # Spark has no test for a folder; anything but a missing one is an error
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []


def versions(spark: SparkSession, root: str) -> dict[int, dict[str, str]]:
    """The fingerprint of each split of each version under root."""
    out: dict[int, dict[str, str]] = {}
    for version, _, split, _, fingerprint in _manifest(spark, root):
        out.setdefault(version, {})[split] = fingerprint
    return out


def freeze(rows: DataFrame, root: str, parent: int | None = None, refresh: Collection[str] = ()) -> int:
    """Writes rows as a new version under root and gives its number; equal rows are the version they are already, and nothing is written.

    With a parent, whatever broken_guards() finds is an error, and so are rows that the parent's folder no longer holds as they were.
    """
    spark = rows.sparkSession
    known = versions(spark, root)
    current = rows.select(*COLUMNS)
    told = {r.split: r for r in fingerprints(current).collect()}  # one row a split
    if not told:
        raise ValueError("nothing to freeze")
    now = {split: r.fingerprint for split, r in told.items()}
    for version, prints in sorted(known.items()):
        if prints == now:
            return version
    if parent is not None:
        broken = broken_guards(version_rows(spark, root, parent), current, refresh)
        first = broken.orderBy("golden_id", "field").limit(5).collect()
        if first:
            raise ValueError(f"{broken.count()} changes without leave, the first of them {[tuple(r) for r in first]}")
    version = max(known, default=0) + 1
    current.write.mode("overwrite").parquet(f"{root}/v{version}")
    lines = [(version, parent, split, r.n, r.fingerprint) for split, r in told.items()]
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifest")
    return version


def version_rows(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The rows of a version; an error where they are not those that were frozen."""
    frozen = versions(spark, root).get(version)
    if frozen is None:
        raise ValueError(f"no version {version}")
    rows = spark.read.parquet(f"{root}/v{version}")
    now = {r.split: r.fingerprint for r in fingerprints(rows).collect()}
    if now != frozen:
        raise ValueError(f"version {version} was changed after it was frozen: {sorted(s for s in {*now, *frozen} if now.get(s) != frozen.get(s))}")
    return rows


def agreement(rows: DataFrame, undetermined: Collection[str]) -> DataFrame:
    """(scope, total, agree, disagree, undetermined, ratio) of labels and codes, by split and over all; null codes are successes.

    Labels or codes that decide nothing are counted apart, and the ratio is of those that decide; null where none does.
    """
    code = F.coalesce("code", F.lit("success"))
    open_ = F.col("label").isNull() | F.col("label").isin(*undetermined) | code.isin(*undetermined)
    kind = F.when(open_, "undetermined").when(F.col("label") == code, "agree").otherwise("disagree")
    count = lambda name: F.count_if(F.col("kind") == name)
    scoped = rows.withColumn("kind", kind).rollup("split").agg(F.grouping("split").alias("whole"), F.count("*").alias("total"), count("agree").alias("agree"), count("disagree").alias("disagree"), count("undetermined").alias("undetermined"))
    decided = F.col("agree") + F.col("disagree")
    return scoped.where("total > 0").select(F.when(F.col("whole") == 1, "all").otherwise(F.col("split")).alias("scope"), "total", "agree", "disagree", "undetermined", F.when(decided > 0, F.col("agree") / decided).alias("ratio"))


def url_conflicts(rows: DataFrame) -> DataFrame:
    """(url, labels, n) of the urls that have several labels."""
    told = rows.where("url IS NOT NULL AND label IS NOT NULL").groupBy("url").agg(F.array_sort(F.collect_set("label")).alias("labels"), F.count("*").alias("n"))
    return told.where(F.size("labels") > 1)

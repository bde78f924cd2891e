"""Secrets in texts: certain ones by pattern, weak ones by the parts they come with.

Certain parts are assignments, access identifiers and long hex runs. Weak parts are tokens that may be an
identifier or a key, and endpoints (URLs and addresses); each means nothing alone. An interval join links a
part to its complements within SCOPE code points of the same text: an identifier or an endpoint needs a secret
there, a key needs an identifier or an endpoint. As the parts of a text are sorted by place, the nearest
complement on either side decides, so no pairs are made. Weak parts on certain ones add nothing.

All of it is DataFrame functions. Places are code points, ends exclusive. Where patterns match, the texts
between matches and the matches give the places by a running sum.

The span of an assignment is that of the secret it gives (group 2 of its pattern), not of the whole match; both end
at one place. Either case means A-Z and a-z.

Cases: null and empty texts have no parts; repeated rows are each returned; a null doc_id is kept; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayline.llm.common import unused, whole_text

SCOPE = 200
MARK = "[SECRET]"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")
ASSIGN = rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LONG = r"[A-Za-z0-9+/=_-]{16,}"
ENDPOINT = r"https?://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+|[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"

#: kind -> pattern, group that is the part. Kinds in order; the first three are certain.
PATTERNS = {"assign": (ASSIGN, 2), "access": (ACCESS, 0), "hex": (HEX, 0), "long": (LONG, 0), "endpoint": (ENDPOINT, 0)}
KINDS = ["assign", "access", "hex", "identifier", "key", "endpoint"]


def found(kind: str) -> Column:
    """For every match of a kind: how long the text before it, the match and its part are; for long tokens, what they may be."""
    pattern, group = PATTERNS[kind]
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    between = F.split("text", pattern, -1)

    def one(x: Column) -> Column:
        token = x["2"]
        what = F.lit(kind)
        if kind == "long":
            mixed = token.rlike("[0-9]") & token.rlike("[A-Z]")
            what = F.when(mixed & token.rlike("^[A-Z0-9]{16,40}$"), "identifier").when(mixed & token.rlike("[a-z]") & (F.length(token) >= 28), "key").otherwise("none")
        return F.struct(what.alias("kind"), F.lit(kind).alias("pattern"), F.length(x["0"]).alias("before"), F.length(x["1"]).alias("whole"), F.length(token).alias("part"))

    rows = F.transform(F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("0"), matches.alias("1"), parts.alias("2")), one)
    rows = F.transform(rows, lambda x, i: x.withField("k", i))
    return F.when(F.col("text").rlike(pattern), rows)


def parts_of(docs: DataFrame) -> DataFrame:
    """Parts (doc_id, hash, n, kind, start, end, valid), n equal rows counted once; a text without parts has a row of nulls."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    empty = F.array().cast("array<struct<kind:string,pattern:string,before:int,whole:int,part:int,k:int>>")
    each = F.concat(*(F.coalesce(found(kind), empty) for kind in PATTERNS))
    once = rows.select("doc_id", F.xxhash64("text").alias("hash"), each.alias("parts")).groupBy("doc_id", "hash").agg(F.count("*").alias("n"), F.first("parts").alias("parts"))
    flat = once.select("doc_id", "hash", "n", F.explode_outer("parts").alias("p")).select("doc_id", "hash", "n", "p.*")
    so_far = F.sum(F.col("before") + F.col("whole")).over(W.partitionBy("doc_id", "hash", "pattern").orderBy("k").rowsBetween(W.unboundedPreceding, 0)).cast("int")
    valid = F.when(F.col("kind") == "assign", F.col("part") >= 6).otherwise(F.col("kind") != "none")
    return flat.select("doc_id", "hash", "n", "kind", (so_far - F.col("part")).alias("start"), so_far.alias("end"), F.coalesce(valid, F.lit(False)).alias("valid"))


def linked(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, hash, n, base, spans): certain parts, and these with the weak ones that have complements in scope.

    Both are arrays of (start, kind number, kind, end) in that order.
    """
    parts = parts_of(docs).withColumn("rank", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int"))
    certain = F.col("valid") & (F.col("rank") <= 3)
    text = W.partitionBy("doc_id", "hash").orderBy("start", "rank", "end")
    # the rows after one are the rows before it in descending order: a frame that only grows is worked out once
    backwards = W.partitionBy("doc_id", "hash").orderBy(F.desc("start"), F.desc("rank"), F.desc("end"))
    before, after = (w.rowsBetween(W.unboundedPreceding, -1) for w in (text, backwards))
    start, end = F.col("start"), F.col("end")

    def near(*kinds: str) -> Column:
        here = F.col("valid") & F.col("kind").isin(*kinds)
        left, right = F.max(F.when(here, end)).over(before), F.min(F.when(here, start)).over(after)
        return F.coalesce(start - left <= scope, F.lit(False)) | F.coalesce(right - end <= scope, F.lit(False))

    on_certain = F.coalesce(F.max(F.when(certain, end)).over(before) > start, F.lit(False)) | F.coalesce(F.min(F.when(certain, start)).over(after) < end, F.lit(False))
    secret, name, place = near("assign", "hex", "key"), near("access", "identifier"), near("endpoint")
    joined = F.when(F.col("kind") == "key", name | place).when(F.col("kind").isin("identifier", "endpoint"), secret).otherwise(True)
    parts = parts.withColumn("certain", certain).withColumn("told", F.col("valid") & (certain | joined & ~on_certain))
    span = F.struct("start", "rank", "kind", "end")
    listed = lambda flag: F.array_sort(F.collect_list(F.when(F.col(flag), span)))
    return parts.groupBy("doc_id", "hash").agg(F.first("n").alias("n"), listed("certain").alias("base"), listed("told").alias("spans"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, base, spans) of every row of docs(doc_id, text)."""
    return linked(docs, scope).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("doc_id", "base", "spans")


def redacted(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """docs with every span of its texts replaced by MARK and n_chars made to fit; other rows and columns stay."""
    doc, hashed, key, spans = unused(docs, "_doc", "_hash", "_key", "_spans")
    found = linked(docs, scope).where(F.size("spans") > 0).select(F.col("doc_id").alias(doc), F.col("hash").alias(hashed), F.col("spans").alias(spans))
    out = docs.withColumn(key, F.xxhash64(whole_text())).join(found, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(hashed)), "left")
    nothing = F.lit(0)
    start = F.struct(nothing.alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at, s, e = acc["at"], x["start"], x["end"]
        new = F.concat(acc["out"], F.substring(F.col("text"), at + 1, s - at), F.lit(MARK))
        return F.struct(F.greatest(at, e).alias("at"), F.when(s >= at, new).otherwise(acc["out"]).alias("out"))

    text = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    changed = out.withColumn("text", F.when(F.col(spans).isNotNull(), text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col(spans).isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)

"""Chat formatting: every dialogue once from the view of each participant.

For every speaker of a conversation all its messages are rendered in order, with that speaker as the assistant
and the others as named users; system messages stay what they are. The assistant's texts and their end marks
are what a model is trained on. A row is one message in one view, with its place in the rendered dialogue, so
the dialogue is the rows' texts in order of `start`, and (mask_start, mask_end) are the trained code points, none
in the other messages.

All of it is DataFrame functions. Conversations are dealt out in buckets of turns, so a conversation of any
length is spread: places are sums within a bucket plus the buckets before.

Cases: null texts are empty; null and empty roles speak as "unknown"; null conversations are one of their own;
turns are ordered nulls last and ties by name, then text; repeated rows are repeated messages; a conversation of
system messages alone has no view; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Turns of a conversation that one task may hold together.
BUCKET = 64
END = "<|end|>\n"


def perspectives(messages: DataFrame) -> DataFrame:
    """(conv_id, speaker, turn, name, role, rendered, start, mask_start, mask_end) for messages(conv_id, turn, role, text)."""
    name = F.coalesce(F.nullif(F.regexp_replace("role", "[^A-Za-z0-9_-]", "_"), F.lit("")), F.lit("unknown"))
    rows = messages.select(
        "conv_id",
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.coalesce(F.floor(F.col("turn") / BUCKET), F.lit((1 << 62))).alias("bucket"),
        "turn",
        name.alias("name"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    speakers = rows.where("name <> 'system'").select("key", F.col("name").alias("speaker")).distinct()
    views = rows.select("key", "bucket").distinct().join(speakers, "key")
    role = F.when(F.col("name") == "system", "system").when(F.col("name") == F.col("speaker"), "assistant").otherwise("user")
    head = F.concat(F.lit("<|"), F.col("role"), F.when(F.col("role") == "user", F.concat(F.lit(" name="), F.col("name"))).otherwise(""), F.lit("|>\n"))
    shown = rows.join(views, ["key", "bucket"]).withColumn("role", role).withColumn("head", head)
    shown = shown.withColumn("rendered", F.concat("head", "text", F.lit(END)))
    size = F.length("rendered")
    ordered = W.partitionBy("key", "bucket", "speaker").orderBy(F.col("turn").asc_nulls_last(), "name", "text")
    inside = F.sum(size).over(ordered.rowsBetween(W.unboundedPreceding, 0)) - size
    shown = shown.withColumn("inside", inside)
    sums = shown.groupBy("key", "bucket", "speaker").agg(F.sum(size).alias("size"))
    earlier = F.sum("size").over(W.partitionBy("key", "speaker").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select("key", "bucket", "speaker", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    start = F.col("earlier") + F.col("inside")
    trained = F.col("role") == "assistant"
    return shown.join(sums, ["key", "bucket", "speaker"]).select(
        "conv_id",
        "speaker",
        "turn",
        "name",
        "role",
        "rendered",
        start.alias("start"),
        F.when(trained, start + F.length("head")).otherwise(start).alias("mask_start"),
        F.when(trained, start + size).otherwise(start).alias("mask_end"),
    )

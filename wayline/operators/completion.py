"""Whether a session's events tell that its task was brought to an end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Events that end a run, and those of them that break it off.
TERMINAL, ABORTED = ("final_reply", "error", "cancel"), ("error", "cancel")
#: Characters of thought without a text from which a last message counts as thought only.
THOUGHT = 200


def completion(events: DataFrame, incomplete: Callable[[Column], Column], closes: Callable[[Column], Column], thought: int = THOUGHT) -> DataFrame:
    """(session, status, reasons, last_event, last_block, final_text, retryable) of each session.

    events(session, seq, event_type, blocks array<struct<type,id,text>>, call_id): model_response events bring blocks, tool_execution ones a
    result of a call; a terminal event ends the message its blocks make. aborted: the last event is an error or a cancel.
    incomplete, with reasons in order: no_terminal_event; last_block_is_call; calls_without_result, more calls than results over the whole
    session and no text that closes; last_text_incomplete; thinking_only. Else complete. Sessions without events are in no row; final_text
    is the last text of the last message that has blocks, empty where it has none.
    """
    order = W.partitionBy("session").orderBy("seq")
    ends = F.coalesce(F.col("event_type").isin(*TERMINAL), F.lit(False))
    rows = events.withColumn("kind", F.coalesce("event_type", F.lit(""))).withColumn("ends", ends)
    rows = rows.withColumn("message", F.count_if("ends").over(order.rowsBetween(W.unboundedPreceding, -1)))
    told = rows.groupBy("session").agg(F.max_by("kind", "seq").alias("last_event"), F.count_if("ends").alias("ended"), F.count_if((F.col("kind") == "tool_execution") & (F.col("call_id") != "")).alias("results"))
    # blocks after the last end belong to no message
    said = rows.where("kind = 'model_response'").join(told.select("session", "ended"), "session").where("message < ended")
    said = said.select("session", "message", "seq", F.posexplode("blocks").alias("place", "b")).select("session", "message", F.struct("seq", "place").alias("at"), "b.*")
    call = F.col("type").isin("toolcall", "tool_call")
    calls = said.groupBy("session").agg(F.count_if(call & (F.col("id") != "")).alias("calls"), F.max("message").alias("message"))
    text = F.col("type") == "text"
    last = said.join(calls.select("session", "message"), ["session", "message"]).groupBy("session").agg(
        F.coalesce(F.max_by("type", "at"), F.lit("")).alias("last_block"),
        F.count_if(text).alias("texts"),
        F.coalesce(F.max_by(F.when(text, F.coalesce("text", F.lit(""))), F.when(text, F.col("at"))), F.lit("")).alias("final_text"),
        F.coalesce(F.sum(F.when(F.col("type") == "thinking", F.length(F.coalesce("text", F.lit(""))))), F.lit(0)).alias("thoughts"),
    )
    met = told.join(calls.select("session", "calls"), "session", "left").join(last, "session", "left")
    met = met.select("session", "last_event", "results", F.coalesce("calls", F.lit(0)).alias("calls"), F.coalesce("last_block", F.lit("")).alias("last_block"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("final_text", F.lit("")).alias("final_text"), F.coalesce("thoughts", F.lit(0)).alias("thoughts"))
    final = F.col("final_text")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("last_block").isin("toolcall", "tool_call"), "last_block_is_call"),
            F.when((F.col("calls") > F.col("results")) & ~F.coalesce(closes(final), F.lit(False)), "calls_without_result"),
            F.when((F.col("last_block") == "text") & (final != "") & F.coalesce(incomplete(final), F.lit(False)), "last_text_incomplete"),
            F.when((F.col("last_block") == "thinking") & (F.col("texts") == 0) & (F.col("thoughts") >= thought), "thinking_only"),
        )
    )
    open_ = ~F.col("last_event").isin(*TERMINAL)
    broken = F.col("last_event").isin(*ABORTED)
    reasons = F.when(broken, F.array(F.concat(F.lit("terminal_event:"), "last_event"))).when(open_, F.array(F.lit("no_terminal_event"))).otherwise(reasons)
    out = met.withColumn("reasons", reasons)
    status = F.when(broken, "aborted").when(F.size("reasons") > 0, "incomplete").otherwise("complete")
    # of a session without an end no message is told
    blank = lambda name: F.when(open_ | broken, "").otherwise(F.col(name)).alias(name)
    return out.select("session", status.alias("status"), "reasons", "last_event", blank("last_block"), blank("final_text"), (status == "incomplete").alias("retryable"))

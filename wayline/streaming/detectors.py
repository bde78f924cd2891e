"""Detectors and sinks over live event streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wayline.sources.records import append_missing

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def dead_loops(events: DataFrame, width: int = 3, memory: int = 8) -> DataFrame:
    """(user_id, event_id) wherever the last `width` steps of a user are of one type.

    The state of a user is its last `memory` types; steps of a batch are put in order of event_id first.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = list(state.get[0]) if state.exists else []
        found = []
        rows = pd.concat(list(batches)).sort_values("event_id")
        for event, kind in zip(rows["event_id"], rows["event_type"], strict=True):
            last = [*last, kind][-memory:]
            if len(last) >= width and len(set(last[-width:])) == 1:
                found.append((key[0], event))
        state.update((last,))
        yield pd.DataFrame(found, columns=["user_id", "event_id"])

    return events.groupBy("user_id").applyInPandasWithState(run, "user_id long, event_id long", "last array<string>", "append", GroupStateTimeout.NoTimeout)


def circuit_breaks(calls: DataFrame, threshold: int = 3) -> DataFrame:
    """(user_id, event_id) of the calls at which `threshold` failures in a row open the circuit; a success resets it."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures = state.get[0] if state.exists else 0
        found = []
        rows = pd.concat(list(batches)).sort_values("event_id")
        for event, kind in zip(rows["event_id"], rows["event_type"], strict=True):
            failures = failures + 1 if kind == "error" else 0
            if failures == threshold:
                found.append((key[0], event))
        state.update((failures,))
        yield pd.DataFrame(found, columns=["user_id", "event_id"])

    return calls.groupBy("user_id").applyInPandasWithState(run, "user_id long, event_id long", "failures int", "append", GroupStateTimeout.NoTimeout)


def page_loops(steps: DataFrame, repeats: int = 3, empty: int = 3, memory: int = 8) -> DataFrame:
    """(run, at, reason) wherever the last steps of steps(run, at, host, action, body_len) go round in a circle: repeat_action
    where the last `repeats` are one action on one host, else empty_body where the last `empty` saw no body.

    The state of a run is its last `memory` steps; a step without an action repeats none.
    """

    def reason(last: list[str]) -> str:
        rows = [x.split("\t") for x in last]
        tail = rows[-repeats:]
        if len(tail) == repeats and tail[0][1] and len({(host, action) for host, action, _ in tail}) == 1:
            return "repeat_action"
        tail = rows[-empty:]
        return "empty_body" if len(tail) == empty and all(int(n) <= 0 for _, _, n in tail) else ""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, found = list(state.get[0]) if state.exists else [], []
        rows = pd.concat(list(batches)).sort_values("at")
        for at, host, action, n in zip(rows["at"], rows["host"], rows["action"], rows["body_len"], strict=True):
            host, action, n = ("" if pd.isna(host) else host.lower()), ("" if pd.isna(action) else action), (0 if pd.isna(n) else int(n))
            last = [*last, f"{host}\t{action}\t{n}"][-memory:]
            if why := reason(last):
                found.append((key[0], at, why))
        state.update((last,))
        yield pd.DataFrame(found, columns=["run", "at", "reason"])

    kinds = dict(steps.dtypes)
    return steps.groupBy("run").applyInPandasWithState(run, f"run {kinds['run']}, at {kinds['at']}, reason string", "last array<string>", "append", GroupStateTimeout.NoTimeout)


def status_breaks(calls: DataFrame, threshold: int = 3, harmless: Sequence[int] = ()) -> DataFrame:
    """(run, at, status) of the calls(run, at, status) at which `threshold` statuses of 4xx without a success between them have
    opened the circuit of a run. Harmless ones and other failures neither count nor reset."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, found = state.get[0] if state.exists else 0, []
        rows = pd.concat(list(batches)).sort_values("at")
        for at, status in zip(rows["at"], rows["status"], strict=True):
            if 200 <= status < 300:
                count = 0
            elif 400 <= status < 500 and status not in harmless:
                count += 1
                if count == threshold:
                    found.append((key[0], at, status))
        state.update((count,))
        yield pd.DataFrame(found, columns=["run", "at", "status"])

    kinds = dict(calls.dtypes)
    return calls.groupBy("run").applyInPandasWithState(run, f"run {kinds['run']}, at {kinds['at']}, status int", "count int", "append", GroupStateTimeout.NoTimeout)


def windows(events: DataFrame, late: str = "10 minutes", size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts and sums by window and type; rows later than `late` are dropped."""
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", size, slide), "event_type")
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, late: str = "10 minutes", gap: str = "30 minutes") -> DataFrame:
    """Sessions of each user, ended by a gap."""
    grouped = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id")
    return grouped.agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")


def deduplicated(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def append_to_pool(path: str, keys: list[str]):
    """For foreachBatch: appends rows whose key the pool at path lacks; a batch that is run again adds nothing."""

    def run(batch: DataFrame, _: int) -> None:
        append_missing(batch, path, keys)

    return run

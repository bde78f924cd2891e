import json
import os

import pytest

from wayline.streaming import detectors


@pytest.fixture()
def stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [(1, "a"), (2, "a"), (3, "error"), (4, "a"), (5, "a"), (6, "a"), (7, "error"), (8, "error"), (9, "error"), (10, "error"), (6, "a")]
    for k, part in enumerate((rows[:5], rows[5:])):
        lines = [json.dumps({"event_id": i, "ts": f"2024-01-01T00:{i:02}:00Z", "user_id": 1, "event_type": t, "value": 1.0, "props": "{}"}) for i, t in part]
        (source / f"{k}.json").write_text("\n".join(lines))
        os.utime(source / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))  # files are read in order of their times
    return spark.readStream.schema(detectors.EVENTS).option("maxFilesPerTrigger", 1).json(str(source))


def drained(df, name, tmp_path, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
    query.processAllAvailable()
    query.stop()
    return df.sparkSession.table(name).collect()


def test_loops_and_breaks(stream, tmp_path):
    assert sorted(r.event_id for r in drained(detectors.dead_loops(stream), "loops", tmp_path)) == [6, 6, 9, 10]
    assert [r.event_id for r in drained(detectors.circuit_breaks(stream), "breaks", tmp_path)] == [9]


def test_windows_and_duplicates(stream, tmp_path):
    rows = drained(detectors.windows(stream, size="5 minutes"), "windows", tmp_path, "complete")
    assert sum(r.n for r in rows) == 11
    assert len(drained(detectors.deduplicated(stream, ["event_id"]), "once", tmp_path)) == 10
    assert len(drained(detectors.sessions(stream), "sessions", tmp_path, "complete")) == 1


def test_pool_takes_each_key_once(spark, stream, tmp_path):
    pool = str(tmp_path / "pool")
    for k in range(2):  # the second run sees all files again
        query = stream.writeStream.foreachBatch(detectors.append_to_pool(pool, ["event_id"])).option("checkpointLocation", str(tmp_path / f"c{k}")).start()
        query.processAllAvailable()
        query.stop()
    assert sorted(r.event_id for r in spark.read.parquet(pool).collect()) == list(range(1, 11))


def arriving(spark, tmp_path, parts, schema):
    source = tmp_path / "arriving"
    source.mkdir()
    names = [x.split()[0] for x in schema.split(", ")]
    for k, part in enumerate(parts):
        (source / f"{k}.json").write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in part))
        os.utime(source / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))


def test_page_loops_over_batches(spark, tmp_path):
    """Three equal actions on one host, three empty bodies; another host or no action is no repeat."""
    first = [(1, 1, "A.x", "click", 5), (1, 2, "a.x", "click", 5), (2, 1, "a.x", "", 0), (2, 2, "b.x", "", 0), (3, 1, "a.x", "click", 1), (3, 2, "b.x", "click", 1)]
    second = [(1, 3, "a.x", "click", 5), (1, 4, "a.x", "scroll", 5), (2, 3, "c.x", None, None), (3, 3, "a.x", "click", 1)]
    steps = arriving(spark, tmp_path, [first, second], "run int, at int, host string, action string, body_len int")
    got = sorted(map(tuple, drained(detectors.page_loops(steps), "pages_loop", tmp_path)))
    assert got == [(1, 3, "repeat_action"), (2, 3, "empty_body")]


def test_breaks_by_status(spark, tmp_path):
    """Harmless statuses and failures of the server neither count nor reset; a success resets."""
    first = [(1, 1, 401), (1, 2, 429), (1, 3, 500), (1, 4, 403), (2, 1, 401), (2, 2, 401), (2, 3, 200)]
    second = [(1, 5, 401), (1, 6, 401), (2, 4, 401), (2, 5, 401)]
    calls = arriving(spark, tmp_path, [first, second], "run int, at int, status int")
    assert [tuple(r) for r in drained(detectors.status_breaks(calls, harmless=[429]), "by_status", tmp_path)] == [(1, 5, 401)]

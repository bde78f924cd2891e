"""Queries over archives in tiers and local paths: users are sessions, their events entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions.pseudonyms import without_local_paths
from wayline.operators import tiers
from wayline.plans.catalog import query
from wayline.session import table

USERS, WORKSPACES = ("ada", "ben", "cleo", "dan", "eva", "finn", "gus"), ("main", "ws01", "agent")


def _tier(k):
    """DuckDB: what a tier takes of the budget that the ones before it left, and whether it is shown."""
    before = f"coalesce((SELECT used FROM t{k - 1} b WHERE b.session = s.session), 0)" if k else "0"
    return f"""t{k} AS (
      SELECT session, {before} + coalesce((SELECT max(run) FROM runs r WHERE r.session = s.session AND r.tier = {k} AND r.run + {before} <= s.budget), 0) AS used,
        coalesce((SELECT max(run) FROM runs r WHERE r.session = s.session AND r.tier = {k}), 0) + {before} <= s.budget AS shown FROM sessions s)"""


@query(f"""
WITH entries AS (
  SELECT user_id AS session, event_id AS place, list_position(['purchase', 'signup', 'error', 'view', 'click'], event_type) - 1 AS tier, '- [' || event_type || '@' || day(ts) || '] ' || props AS line FROM events),
sessions AS (SELECT session, sum(length(line)) // 2 AS budget FROM entries WHERE tier < 4 GROUP BY session),
runs AS (SELECT *, sum(length(line)) OVER (PARTITION BY session, tier ORDER BY place) AS run FROM entries WHERE tier < 4),
{", ".join(_tier(k) for k in range(4))},
parts AS ({" UNION ALL ".join(f"SELECT r.session, {k} AS tier, '## {head}' || chr(10) || string_agg(line, chr(10) ORDER BY place) AS part FROM runs r JOIN t{k} USING (session) WHERE tier = {k} AND shown GROUP BY r.session" for k, head in enumerate(tiers.HEADS))})
SELECT session, coalesce((SELECT string_agg(part, chr(10) || chr(10) ORDER BY tier) FROM parts p WHERE p.session = s.session), '') AS text FROM sessions s
""")
def t9_tiered_archive(spark, sf_dir):
    """Each user's events in tiers by kind, within half of what all of them take."""
    kinds = ("purchase", "signup", "error", "view", "click")
    tier = F.array_position(F.array(*map(F.lit, kinds)), F.col("event_type")) - 1
    entry = F.struct("event_id", tier.cast("int").alias("tier"), F.col("event_type").alias("type"), F.dayofmonth("ts").alias("message"), F.col("props").alias("content"))
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("session")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    line = lambda e: F.length(F.format_string("- [%s@%d] %s", e["type"], e["message"], e["content"]))
    total = F.aggregate(F.filter("entries", lambda e: e["tier"] < 4), F.lit(0), lambda n, e: n + line(e))
    return rows.select("session", tiers.rendered(F.col("entries"), F.floor(total / 2)).alias("text"))


def _name(session, drive, name, names):
    """DuckDB: the name that stands for a user or, without drive and name, for a workspace."""
    seed = f"concat_ws('|', {session}, {drive}, {name})" if drive else session
    return f"[{', '.join(repr(n) for n in names)}][1 + CAST(('0x' || left(md5({seed}), 8)) AS BIGINT) % {len(names)}]"


@query(rf"""
WITH e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS s, event_type AS who, left(json_extract_string(props, '$.k'), 1) AS k FROM events)
SELECT event_id, '{{"path": "C:\\Users\\' || {_name("s", "'c:'", "who", USERS)} || '\\x", "deep": [{{"text": "see d:\\\\users\\\\' || {_name("s", "'d:'", "'u' || k", USERS)} || ' and C:\\users\\'
  || {_name("s", "'c:'", "who", USERS)} || '"}}, ' || k || ', null], "C:\\Users\\key": "workspaces\\' || {_name("s", None, None, WORKSPACES)} || '\\y"}}' AS document
FROM e
""".replace(r"d:\\\\users\\\\", r"d:\\\\Users\\\\").replace(r"C:\\users\\", r"C:\\Users\\"))
def f45_local_paths(spark, sf_dir):
    """Paths of each event's actor at several depths: one name a session and path."""
    who, k = F.col("event_type"), F.left(F.get_json_object("props", "$.k"), F.lit(1))
    parts = [
        F.lit('{"path": "C:\\\\Users\\\\'), who, F.lit('\\\\x", "deep": [{"text": "see d:\\\\\\\\users\\\\\\\\U'), k, F.lit(" and C:\\\\users\\\\"), F.upper(who),
        F.lit('"}, '), k, F.lit(', null], "C:\\\\Users\\\\key": "workspaces\\\\default\\\\y"}'),
    ]
    document = without_local_paths(F.concat(*parts), F.col("user_id"), USERS, WORKSPACES)
    return table(spark, sf_dir, "events").select("event_id", document.alias("document"))

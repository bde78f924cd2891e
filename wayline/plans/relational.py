"""Plain relational queries over the star schema: every join kind, rollup, cube, set operations, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayline.plans.catalog import query
from wayline.session import table


@query("""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, sum(l_extendedprice * (1 - l_discount)) AS revenue, avg(l_discount) AS avg_disc, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def r_pricing_summary(spark, sf_dir):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.sum(price).alias("revenue"), F.avg("l_discount").alias("avg_disc"), F.count("*").alias("n"))


@query("""
SELECT n_name, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def r_revenue_by_nation(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def r_anti_join(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def r_semi_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    return table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def r_outer_join(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def r_rollup(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, l_linestatus, max(l_quantity) AS most FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def r_cube(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.max("l_quantity").alias("most"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def r_intersect(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def r_except(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")).subtract(table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@query("SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 2")
def r_top_per_group(spark, sf_dir):
    rank = F.row_number().over(W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", rank.cast("long").alias("rn")).where("rn <= 2")


@query("SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY user_id")
def r_pivot(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", ["click", "view"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2")
def st_tumbling(spark, sf_dir):
    """The batch form of the tumbling window that streaming.windows computes."""
    rows = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("window.start").alias("hour"), "event_type", "n", "total")


@query("""
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k
""")
def st_sessions(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("s")).agg(F.count("*").alias("n"))
    return rows.select("user_id", F.col("s.start").alias("start"), "n")

"""Plan graphs, jobs of SQL files, and the log of written parts, over tables derived from the inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwell.fixtures import fixture
from layerwell.functions.columns import day_shift
from layerwell.plans.graph import CUSTOMER_PLAN, SALES_PLAN, SEGMENT_PLAN, land, plan, run_graph
from layerwell.plans.paths import DAY, HISTORY, PathJob, path_job
from layerwell.session import scratch_path
from layerwell.sinks.part_log import PartLog, logged_overwrite
from layerwell.sinks.tables import write_path
from registry import aggregates
from registry.common import D, oracle, plain
from registry.tables import new_house

BEFORE = day_shift(D, -1)
CUSTOMER_TABLES = ["dwd_dim_customer", "dwd_fact_order", "dws_customer_summary"]


def _run(spark, sf, label, nodes, sources, targets, concurrent=False):
    """Land the sources, bring the targets up to date for the run date."""
    house, log = new_house(spark, label), PartLog(spark, scratch_path(spark, f"{label}-log"))
    for name in sources:
        rows = fixture(spark, sf, name)
        land(house, name, rows if "dt" in rows.columns else rows.withColumn("dt", F.lit(D)))
    results = run_graph(house, log, nodes, D, targets, concurrent)
    failed = [r for r in results if not r.ok]
    if failed:
        raise RuntimeError(str(failed))
    return house, log


def _table(house, name):
    layer = {"dws": "dws_customer_summary", "dwd": "dwd_dim_customer"}[name[:3]]
    return house.spark.table(f"{house.specs[layer].database}.{name}").where(F.col("dt") == D)


def _facts(spark, sf):
    house, _ = _run(spark, sf, "facts", plan(CUSTOMER_PLAN), ["ods_customer", "ods_order"], ["dws_customer_summary"])
    return plain(_table(house, "dws_customer_summary").drop("etl_create_time", "etl_update_time", "etl_batch_id"))


def _segments(spark, sf):
    house, _ = _run(spark, sf, "segments", plan(SEGMENT_PLAN), ["crm_customers", "crm_orders"], None, concurrent=True)
    return plain(_table(house, "dws_customer_behavior").drop("dt"))


def _reports(spark, sf):
    house, _ = _run(spark, sf, "reports", plan(SALES_PLAN), ["customer_info", "order_info", "product_info"], ["dws_customer_stats", "dws_product_stats"])
    return plain(_table(house, "dws_customer_stats").drop("dt"))


CLEAN_USERS = """
SELECT user_id, lower(trim(email)) AS email, coalesce(trim(first_name), 'unknown') AS first_name
FROM users_view WHERE email IS NOT NULL AND email LIKE '%@%'
"""
FACT_ORDERS = """
SELECT order_id, user_id, order_amount, CAST(order_timestamp AS TIMESTAMP) AS order_ts, lower(trim(coalesce(order_status, 'pending'))) AS order_status
FROM orders_view WHERE order_quantity > 0
"""
USER_SUMMARY = """
SELECT u.user_id, u.email, count(o.order_id) AS order_rows, sum(o.order_amount) AS spent, max(o.order_ts) AS last_order,
       count(CASE WHEN CAST(o.order_ts AS DATE) = CAST(:load_date AS DATE) THEN 1 END) AS rows_today
FROM users_view u LEFT JOIN orders_view o ON u.user_id = o.user_id AND o.order_status <> 'cancelled'
GROUP BY u.user_id, u.email
"""


def _path_job(spark, sf):
    """Users of the day and orders of two load days through three scripts, each read from a file."""
    place = {n: scratch_path(spark, n) for n in ("raw-users", "raw-orders", "users", "orders", "summary", "sql")}
    by_day = "etl_batch_date"
    write_path(fixture(spark, sf, "users_raw").withColumn(by_day, F.lit(D)), place["raw-users"], partition_by=(by_day,))
    orders = fixture(spark, sf, "orders_raw").withColumn(by_day, F.when(F.col("order_id") % 2 == 0, D).otherwise(BEFORE))
    write_path(orders, place["raw-orders"], partition_by=(by_day,))
    spark.createDataFrame([(USER_SUMMARY,)], "value string").coalesce(1).write.text(place["sql"])
    script = spark.read.text(f"{place['sql']}/part-*", wholetext=True).first()[0]
    path_job(spark, PathJob(CLEAN_USERS, {"users_view": (place["raw-users"], DAY)}, place["users"]), D)
    for dt in (BEFORE, D):
        path_job(spark, PathJob(FACT_ORDERS, {"orders_view": (place["raw-orders"], DAY)}, place["orders"]), dt)
    views = {"users_view": (place["users"], DAY), "orders_view": (place["orders"], HISTORY)}
    return plain(path_job(spark, PathJob(script, views, place["summary"]), D))


def _logged(spark, sf, label):
    """Landed and built customer tables, every write logged."""
    house, log = new_house(spark, label), PartLog(spark, scratch_path(spark, f"{label}-log"))
    for name in ("ods_customer", "ods_order"):
        for dt in (BEFORE, D):
            logged_overwrite(log, fixture(spark, sf, name).where(F.col("dt") == dt), house.specs[name], dt, fill_missing=True)
    run_graph(house, log, plan(CUSTOMER_PLAN), D, ["dwd_fact_order"])
    return log


def _log_fresh(spark, sf):
    log = _logged(spark, sf, "logfresh")
    rows = [(t, dt, log.is_fresh(t, dt)) for t in ("ods_order", "dwd_fact_order") for dt in (D, day_shift(D, 1))]
    return spark.createDataFrame(rows, "table_name string, expected string, fresh boolean")


def _log_ready(spark, sf):
    log = _logged(spark, sf, "logready")
    return log.layer_ready("dwd", D, ["ods_customer", "ods_order"]).unionByName(log.layer_ready("dws", D, CUSTOMER_TABLES))


def _log_counts(spark, sf):
    log = _logged(spark, sf, "logcounts")
    both = [log.counts(["ods_customer", "ods_order", "dws_customer_summary"], dt).withColumn("dt", F.lit(dt)) for dt in (BEFORE, D)]
    return both[0].unionByName(both[1])


QUERIES = {
    "run_day_facts": _facts,
    "run_day_segments": _segments,
    "run_day_reports": _reports,
    "path_job": _path_job,
    "log_fresh": _log_fresh,
    "log_ready": _log_ready,
    "log_counts": _log_counts,
    "log_stats": lambda s, d: plain(_logged(s, d, "logstats").stats("dwd_fact_order", D)),
}


def _count(table: str, dt: str = D) -> str:
    return f"(SELECT COUNT(*) FROM {table} WHERE dt = '{dt}')"


ORACLES = {
    "run_day_facts": aggregates.ORACLES["customer_summary"],
    "run_day_segments": aggregates.ORACLES["customer_behavior"],
    "run_day_reports": aggregates.ORACLES["customer_stats"],
    "path_job": oracle(f"""
WITH bought AS (SELECT user_id, order_id, order_amount, CAST(order_timestamp AS TIMESTAMP) AS order_ts FROM orders_raw
  WHERE order_quantity > 0 AND lower(trim(coalesce(order_status, 'pending'))) <> 'cancelled'),
people AS (SELECT user_id, lower(trim(email)) AS email FROM users_raw WHERE email LIKE '%@%')
SELECT p.user_id, p.email, COUNT(b.order_id) AS order_rows, CAST(SUM(b.order_amount) AS DOUBLE) AS spent,
  CAST(MAX(b.order_ts) AS VARCHAR) AS last_order, COUNT(*) FILTER (WHERE CAST(b.order_ts AS DATE) = DATE '{D}') AS rows_today,
  '{D}' AS etl_batch_date
FROM people p LEFT JOIN bought b ON p.user_id = b.user_id GROUP BY p.user_id, p.email"""),
    "log_fresh": oracle(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{dt}' AS expected, '{dt}' = '{D}' AND {_count('ods_order')} > 0 AS fresh"
            for t in ("ods_order", "dwd_fact_order")
            for dt in (D, day_shift(D, 1))
        )
    ),
    "log_ready": oracle(
        f"SELECT 'ods_customer' AS table_name, {_count('ods_customer')} AS row_count, TRUE AS ready "
        f"UNION ALL SELECT 'ods_order', {_count('ods_order')}, TRUE UNION ALL SELECT 'dwd_dim_customer', {_count('ods_customer')}, TRUE "
        f"UNION ALL SELECT 'dwd_fact_order', {_count('ods_order')}, TRUE UNION ALL SELECT 'dws_customer_summary', 0, FALSE"
    ),
    "log_counts": oracle(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {_count(t, dt) if t.startswith('ods') else 'CAST(0 AS BIGINT)'} AS row_count, '{dt}' AS dt"
            for t in ("ods_customer", "ods_order", "dws_customer_summary")
            for dt in (BEFORE, D)
        )
    ),
    "log_stats": oracle(
        f"SELECT 'dwd_fact_order' AS table_name, '{D}' AS partition_date, COUNT(*) AS total_records, COUNT(DISTINCT order_id) AS unique_keys, "
        f"'2024-02-15 03:00:00' AS min_create_time, '2024-02-15 03:00:00' AS max_create_time FROM ods_order WHERE dt = '{D}'"
    ),
}

"""Layer inputs derived from the TPC-H-style base tables.

Each view is one SQL text that Spark and DuckDB read alike; ``{name}`` marks an
input table. ``fixture`` gives the Spark frame, ``oracle_views`` the same views
as common table expressions for an oracle query.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DATE = "2024-02-14"
FIRST_DATE = "2024-01-01"

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


VIEWS = {
    "ods_user_info": """
SELECT c.c_custkey AS user_id,
  CASE WHEN c.c_custkey % 11 = 0 THEN '  ' ELSE concat(' ', c.c_name, ' ') END AS username,
  CASE WHEN c.c_custkey % 7 = 0 THEN 'not-an-email' ELSE concat('u', CAST(c.c_custkey AS STRING), '@example.com') END AS email,
  CASE WHEN c.c_custkey % 5 = 0 THEN '12345' ELSE CAST(13800000000 + c.c_custkey AS STRING) END AS phone,
  CASE c.c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'female' WHEN 2 THEN 'Male' ELSE 'x' END AS gender,
  CAST(c.c_custkey % 131 AS INT) AS age,
  CASE WHEN c.c_custkey % 13 = 0 THEN '' ELSE n.n_name END AS city, r.r_name AS province,
  CASE WHEN c.c_custkey % 17 = 0 THEN 'bad-ts' ELSE '2023-06-01 08:00:00' END AS registration_time,
  '2024-02-01 09:30:00' AS last_login_time,
  CASE c.c_custkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'active' WHEN 2 THEN '0' ELSE '9' END AS user_status,
  c.c_mktsegment AS customer_type, CAST(c.c_acctbal AS DECIMAL(12,2)) AS acctbal, '2024-02-14' AS dt
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
""",
    "ods_order_info": """
SELECT CAST(o.o_orderkey AS STRING) AS order_id, o.o_custkey AS user_id, CAST(l.l_partkey AS STRING) AS product_id,
  p.p_name AS product_name, CAST(p.p_size AS BIGINT) AS category_id, p.p_type AS category_name,
  p.p_partkey % 25 AS brand_id, CASE WHEN p.p_partkey % 19 = 0 THEN ' ' ELSE p.p_brand END AS brand_name,
  concat(CAST(DATE '2024-01-01' + CAST(o.o_orderkey % 45 AS INT) AS STRING), ' 10:00:00') AS order_time,
  CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE concat(CAST(DATE '2024-01-01' + CAST(o.o_orderkey % 45 AS INT) AS STRING), ' 10:05:00') END AS pay_time,
  CASE WHEN o.o_orderkey % 50 = 0 THEN 'bad-ts' WHEN o.o_orderstatus = 'F' THEN '2024-02-14 23:00:00' ELSE NULL END AS finish_time,
  CASE o.o_orderstatus WHEN 'F' THEN '4' WHEN 'P' THEN '2' ELSE '5' END AS order_status,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'Alipay' WHEN 1 THEN 'WECHAT' WHEN 2 THEN 'unionpay' WHEN 3 THEN 'cash' ELSE 'card' END AS payment_method,
  CAST(l.l_quantity AS INT) AS quantity, CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS total_amount,
  CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS discount_amount,
  CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS final_amount,
  r.r_name AS province, n.n_name AS city,
  CAST(DATE '2024-01-01' + CAST(o.o_orderkey % 45 AS INT) AS STRING) AS dt
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
""",
    "ods_product_info": """
SELECT CAST(p_partkey AS STRING) AS product_id, p_name AS product_name, CAST(p_size AS BIGINT) AS category_id, p_type AS category_name,
  p_partkey % 25 AS brand_id, p_brand AS brand_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS cost,
  CAST(CAST(p_size AS DECIMAL(8,2)) / 10 AS DECIMAL(8,2)) AS weight,
  concat(CAST(p_size AS STRING), 'x1x1') AS dimensions, p_name AS description,
  CASE p_partkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE 'x' END AS product_status, '2024-02-14' AS dt
FROM {part}
""",
    "ods_events": """
SELECT CAST(event_id AS STRING) AS event_id, CAST(user_id AS STRING) AS user_id,
  concat('s', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS session_id,
  event_type, CAST(ts AS TIMESTAMP) AS event_time, CAST(event_id % 200 AS STRING) AS product_id, value AS amount,
  (event_id * 7919) % 4294967296 AS ip_num, 'agent' AS user_agent, props AS properties
FROM {events}
""",
    "ods_order_lines": """
SELECT concat(order_id, '-', CAST(ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY product_id NULLS FIRST, quantity NULLS FIRST,
    total_amount NULLS FIRST, discount_amount NULLS FIRST, final_amount NULLS FIRST, unit_price NULLS FIRST, order_status NULLS FIRST,
    order_time NULLS FIRST, pay_time NULLS FIRST, finish_time NULLS FIRST) AS STRING)) AS order_id,
  user_id, product_id, product_name, category_id, category_name, brand_id, brand_name, order_time, pay_time, finish_time, order_status,
  payment_method, quantity, unit_price, total_amount, discount_amount, final_amount, province, city, dt
FROM {ods_order_info}
""",
    "ods_customer": """
SELECT c_custkey AS customer_id, concat('C', CAST(c_custkey AS STRING)) AS customer_code, c_name AS customer_name, c_mktsegment AS customer_type,
  DATE '2020-01-01' + CAST(c_custkey % 1400 AS INT) AS registration_date, CASE WHEN c_custkey % 6 = 0 THEN 'I' ELSE 'A' END AS status,
  CAST(13800000000 + c_custkey AS STRING) AS phone, concat('u', CAST(c_custkey AS STRING), '@example.com') AS email,
  concat('street ', CAST(c_nationkey AS STRING)) AS address, CASE c_custkey % 7 WHEN 3 THEN '2024-02-13' ELSE '2024-02-14' END AS dt
FROM {customer}
""",
    "ods_order": """
SELECT o_orderkey AS order_id, concat('NO', CAST(o_orderkey AS STRING)) AS order_no, o_custkey AS customer_id,
  DATE '2024-01-01' + CAST(o_orderkey % 45 AS INT) AS order_date, CAST(o_totalprice AS DECIMAL(15,2)) AS order_amount,
  CASE WHEN o_orderkey % 3 = 0 THEN 'CNY' ELSE 'USD' END AS currency, o_orderstatus AS order_status,
  CASE o_orderkey % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'cash' ELSE 'transfer' END AS payment_method, CASE o_orderkey % 7 WHEN 3 THEN '2024-02-13' WHEN 5 THEN '2024-02-15' ELSE '2024-02-14' END AS dt
FROM {orders}
""",
    "crm_customers": """
SELECT c.c_custkey AS customer_id, CASE WHEN c.c_custkey % 23 = 0 THEN NULL WHEN c.c_custkey % 29 = 0 THEN 'x' ELSE c.c_name END AS customer_name,
  CASE WHEN c.c_custkey % 31 = 0 THEN NULL ELSE CAST(c.c_custkey % 131 AS INT) END AS age,
  CASE WHEN c.c_custkey % 7 = 0 THEN 'not-an-email' ELSE concat('u', CAST(c.c_custkey AS STRING), '@example.com') END AS email,
  CASE WHEN c.c_custkey % 5 = 0 THEN '0123' ELSE CAST(13800000000 + c.c_custkey AS STRING) END AS phone,
  'street 1' AS address, n.n_name AS city, r.r_name AS state,
  CASE c.c_custkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'I' ELSE 'Z' END AS customer_status,
  DATE '2020-01-01' + CAST(c.c_custkey % 1400 AS INT) AS registration_date,
  DATE '2024-02-14' - CAST(c.c_custkey % 60 AS INT) AS last_login_date, CASE c.c_custkey % 7 WHEN 3 THEN '2024-02-13' ELSE '2024-02-14' END AS dt
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
""",
    "crm_orders": """
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer_id,
  DATE '2024-01-01' + CAST(o_orderkey % 45 AS INT) AS order_date,
  CASE WHEN o_orderkey % 89 = 0 THEN CAST(0 AS DECIMAL(15,2)) ELSE CAST(o_orderkey % 1200 AS DECIMAL(15,2)) END AS order_amount,
  o_orderstatus AS order_status, CASE WHEN o_orderkey % 2 = 0 THEN 'card' ELSE 'cash' END AS payment_method, CASE o_orderkey % 7 WHEN 3 THEN '2024-02-13' WHEN 5 THEN '2024-02-15' ELSE '2024-02-14' END AS dt
FROM {orders}
""",
    "users_raw": """
SELECT CAST(c_custkey AS STRING) AS user_id, concat(' ', c_name) AS username, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE ' Ann' END AS first_name,
  c_mktsegment AS last_name, CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'bad' ELSE concat(' U', CAST(c_custkey AS STRING), '@Example.com') END AS email,
  CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'F' WHEN 2 THEN 'female' ELSE 'n/a' END AS gender,
  '2023-06-01 08:00:00' AS registration_ts, '2023-06-01' AS registration_date,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey % 3 = 0 END AS is_active
FROM {customer}
""",
    "orders_raw": """
SELECT o.o_orderkey AS order_id, CAST(o.o_custkey AS STRING) AS user_id, l.l_partkey AS product_id,
  CASE WHEN l.l_orderkey % 41 = 0 THEN 0 ELSE CAST(l.l_quantity AS INT) END AS order_quantity, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS order_amount,
  concat(CAST(DATE '2024-01-01' + CAST(o.o_orderkey % 45 AS INT) AS STRING), ' 10:00:00') AS order_timestamp,
  CASE o.o_orderstatus WHEN 'F' THEN ' Completed' WHEN 'P' THEN 'CANCELLED' ELSE NULL END AS order_status
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
""",
    "customer_info": """
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, concat('u', CAST(c.c_custkey AS STRING), '@', lower(c.c_mktsegment), '.com') AS email,
  CASE WHEN c.c_custkey % 12 = 0 THEN NULL ELSE CAST(13800000000 + c.c_custkey AS STRING) END AS phone, 'street 1' AS address,
  n.n_name AS city, r.r_name AS state, 'X' AS country, DATE '2020-01-01' + CAST(c.c_custkey % 1400 AS INT) AS registration_date,
  CAST(CASE c.c_custkey % 5 WHEN 0 THEN '2024-02-13 23:59:59' WHEN 1 THEN '2024-02-15 00:00:00' ELSE '2024-02-14 12:00:00' END AS TIMESTAMP) AS last_update_time, CASE WHEN c.c_custkey % 8 = 0 THEN 0 ELSE 1 END AS is_active
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
""",
    "order_info": """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
  DATE '2024-01-01' + CAST(o.o_orderkey % 45 AS INT) AS order_date, CAST(l.l_quantity AS INT) AS quantity,
  CAST(l.l_extendedprice AS DECIMAL(12,2)) AS total_amount, CASE WHEN o.o_orderstatus = 'P' THEN 'CANCELLED' ELSE 'DONE' END AS order_status,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'card' ELSE 'cash' END AS payment_method,
  CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price, CAST('2024-02-14 12:00:00' AS TIMESTAMP) AS created_time
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey JOIN {orders} o ON l.l_orderkey = o.o_orderkey
""",
    "product_info": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, CAST(p_size AS STRING) AS subcategory, p_brand AS brand,
  CAST(p_partkey % 300 AS DECIMAL(10,2)) AS price, CAST(p_partkey % 200 AS DECIMAL(10,2)) AS cost, p_partkey % 10 AS supplier_id,
  CAST(CASE p_partkey % 4 WHEN 0 THEN '2024-02-13 23:59:59' WHEN 1 THEN '2024-02-14 00:00:00' ELSE '2024-02-14 12:00:00' END AS TIMESTAMP) AS last_update_time
FROM {part}
""",
    "user_profiles": """
SELECT CAST(c_custkey AS STRING) AS user_id, c_mktsegment AS user_segment, concat('+86 (', CAST(c_custkey AS STRING), ') 55-66') AS phone,
  CASE WHEN c_custkey % 14 = 0 THEN 'bad' ELSE CAST(DATE '1960-01-01' + CAST((c_custkey * 37) % 16000 AS INT) AS STRING) END AS birth_date
FROM {customer}
""",
    "product_catalog": """
SELECT CAST(p_partkey AS STRING) AS product_id, p_type AS category FROM {part}
""",
    "ip_ranges": """
SELECT r_regionkey * CAST(800000000 AS BIGINT) AS ip_from, r_regionkey * CAST(800000000 AS BIGINT) + 799999999 AS ip_to, r_name AS region FROM {region}
""",
}



def inputs_of(sql: str) -> list[str]:
    """Names marked ``{name}`` in a view text, each once."""
    return list(dict.fromkeys(re.findall(r"{(\w+)}", sql)))


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark frame of a derived view or a base table."""
    if name in BASE_TABLES:
        return base_table(spark, sf_dir, name)
    sql = VIEWS[name]
    return spark.sql(sql, **{table: fixture(spark, sf_dir, table) for table in inputs_of(sql)})


# The joins of the view ``ods_order_info`` in another order: lines do not travel by customer, and parts come last.
ORDER_JOINS = """
FROM {lineitem} l JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""


def dealt_order_info(spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of the view ``ods_order_info``, their ``o_orderkey`` and what ``deal`` adds, where it puts them.

    ``deal`` gets the joined base columns and the day. The view's other columns, mostly text made of a key or a code, are the
    view's own expressions over what it returns, so they do not travel.
    """
    columns, day = VIEWS["ods_order_info"].split("\nFROM ", 1)[0].rsplit("\n", 1)
    base = dict.fromkeys(re.findall(r"\b[a-z]\.(\w+)", columns))
    joins = f"SELECT {', '.join(base)}, {day.strip()} {ORDER_JOINS}"
    dealt = deal(spark.sql(joins, **{table: fixture(spark, sf_dir, table) for table in inputs_of(joins)}))
    others = ", ".join(["dt", "o_orderkey", *(c for c in dealt.columns if c != "dt" and c not in base)])
    return spark.sql(re.sub(r"\b[a-z]\.(?=\w)", "", columns) + f" {others} FROM {{dealt}}", dealt=dealt)


def oracle_views(*names: str) -> list[tuple[str, str]]:
    """(name, SQL) of the views and of those they read, inputs first."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done or name not in VIEWS:
            return
        for table in inputs_of(VIEWS[name]):
            add(table)
        done[name] = VIEWS[name].format(**{t: t for t in inputs_of(VIEWS[name])}).strip()

    for name in names:
        add(name)
    return list(done.items())

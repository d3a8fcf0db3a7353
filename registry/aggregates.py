"""Summaries and wide tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwell.fixtures import fixture
from layerwell.operators import clean, summary, wide
from registry.cleaning import (
    crm_clean,
    crm_fact,
    dim_customers,
    dwd_orders,
    dwd_products,
    dwd_users,
    margin_products,
    profit_orders,
    tenure_customers,
    usd_orders,
)
from registry.common import D, D7, D30, half_up, mean2, oracle, plain

WINDOW_STARTS = {"1d": D, "7d": D7, "30d": D30}


def _category_facts(spark, sf):
    """Order rows and products in the shape the category report reads."""
    facts = dwd_orders(spark, sf).select(
        F.to_date("order_time").alias("order_date"), "order_id", "product_id",
        F.col("final_amount").alias("order_amount"), F.lit(D).alias("dt"),
    )
    goods = fixture(spark, sf, "ods_product_info").select(
        "product_id", F.col("category_name").alias("product_category"), "dt"
    )
    return facts, goods


def _script_orders(spark, sf):
    return clean.transform_orders(fixture(spark, sf, "orders_raw"), D)


def _behavior(spark, sf):
    return plain(summary.customer_behavior(crm_fact(spark, sf), crm_clean(spark, sf), D))


def _rounded(df, *columns):
    return plain(df).withColumns({c: F.round(c, 2) for c in columns})


QUERIES = {
    "customer_summary": lambda s, d: plain(summary.customer_summary(usd_orders(s, d), dim_customers(s, d), D)),
    "segment_summary": lambda s, d: plain(summary.segment_summary(crm_clean(s, d), D)),
    "daily_order_stats": lambda s, d: _rounded(summary.daily_order_stats(crm_fact(s, d), D), "stddev_order_value"),
    "customer_behavior": _behavior,
    "customer_behavior_exact": lambda s, d: plain(summary.customer_behavior_exact(crm_fact(s, d), crm_clean(s, d), D)),
    "user_wide": lambda s, d: plain(wide.user_wide(dwd_users(s, d), dwd_orders(s, d), D)),
    "user_preference": lambda s, d: wide.user_preference(dwd_orders(s, d), D),
    "product_wide_v1": lambda s, d: plain(wide.product_wide_v1(dwd_products(s, d), dwd_orders(s, d), D)),
    "product_wide": lambda s, d: plain(wide.product_wide(dwd_products(s, d), dwd_orders(s, d), D)),
    "region_wide_v1": lambda s, d: plain(wide.region_wide_v1(dwd_orders(s, d), D)),
    "region_wide": lambda s, d: plain(wide.region_wide(dwd_orders(s, d), D)),
    "region_users": lambda s, d: wide.region_users(dwd_orders(s, d), D),
    "daily_sales": lambda s, d: _rounded(summary.daily_sales(profit_orders(s, d), D), "order_value_std"),
    "customer_stats": lambda s, d: plain(summary.customer_stats(profit_orders(s, d), tenure_customers(s, d), D)),
    "product_stats": lambda s, d: plain(summary.product_stats(profit_orders(s, d), margin_products(s, d), D)),
    "monthly_trends": lambda s, d: plain(summary.monthly_trends(profit_orders(s, d), D)),
    "sales_by_category": lambda s, d: plain(summary.sales_by_category(*_category_facts(s, d), D)),
    "daily_sales_valid": lambda s, d: plain(summary.daily_sales_valid(_script_orders(s, d), D)),
    "user_lifetime": lambda s, d: plain(
        summary.user_lifetime(clean.transform_users(fixture(s, d, "users_raw"), D), _script_orders(s, d), D)
    ),
}


def windows_sql(keys: str, counted: dict[str, str], quantity: str, amount: str, source: str) -> tuple[str, str]:
    """One subquery per window, and the select list that joins their columns."""
    subqueries, columns = [], []
    for name, first in WINDOW_STARTS.items():
        counts = ", ".join(f"COUNT(DISTINCT {col}) AS {label}_count" for label, col in counted.items())
        subqueries.append(
            f"w{name} AS (SELECT {keys}, {counts}, CAST(SUM(quantity) AS BIGINT) AS quantity, SUM(final_amount) AS amount, "
            f"{mean2('final_amount')} AS average, MIN(order_time) AS first_time, MAX(order_time) AS last_time "
            f"FROM {source} WHERE dt >= '{first}' AND dt <= '{D}' AND order_status = 'completed' GROUP BY {keys})"
        )
        columns += [f"coalesce(w{name}.{label}_count, 0) AS {label}_count_{name}" for label in counted]
        columns += [
            f"coalesce(w{name}.quantity, 0) AS {quantity}_{name}",
            f"CAST(coalesce(w{name}.amount, 0) AS DOUBLE) AS {amount}_{name}",
            f"coalesce(w{name}.average, 0) AS avg_order_amount_{name}",
        ]
    return ",\n".join(subqueries), ",\n".join(columns)


WINDOW_DAYS = {"1d": 1, "7d": 7, "30d": 30}


def ranged_windows_sql(keys: str, counted: dict[str, str], quantity: str, amount: str, source: str, start: str) -> tuple[str, str]:
    """As ``windows_sql`` for every run day from ``start`` on: each day joined to the orders it looks back on."""
    _, columns = windows_sql(keys, counted, quantity, amount, source)
    counts = ", ".join(f"COUNT(DISTINCT {col}) AS {label}_count" for label, col in counted.items())
    subqueries = [f"days AS (SELECT CAST(CAST(unnest(generate_series(DATE '{start}', DATE '{D}', INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS day)"]
    for name, days in WINDOW_DAYS.items():
        subqueries.append(
            f"w{name} AS (SELECT day, {keys}, {counts}, CAST(SUM(quantity) AS BIGINT) AS quantity, SUM(final_amount) AS amount, "
            f"{mean2('final_amount')} AS average, MIN(order_time) AS first_time, MAX(order_time) AS last_time "
            f"FROM days JOIN {source} ON CAST(dt AS DATE) BETWEEN CAST(day AS DATE) - {days - 1} AND CAST(day AS DATE) "
            f"WHERE order_status = 'completed' GROUP BY day, {keys})"
        )
    return ",\n".join(subqueries), columns


def user_range_sql(source: str, start: str) -> str:
    subqueries, columns = ranged_windows_sql(
        "user_id", {"order": "order_id", "product": "product_id"}, "quantity", "order_amount", source, start
    )
    points = _steps("w30d.amount", [(1000, 30), (500, 20), (100, 10)], 0)
    return oracle(f"""WITH {subqueries},
choices AS (SELECT day, user_id, category_name, brand_name, payment_method, COUNT(*) AS n FROM days
  JOIN {source} ON CAST(dt AS DATE) BETWEEN CAST(day AS DATE) - 29 AND CAST(day AS DATE) WHERE order_status = 'completed' GROUP BY ALL),
pref AS (SELECT * FROM choices QUALIFY ROW_NUMBER() OVER (
  PARTITION BY day, user_id ORDER BY n DESC, category_name, brand_name, payment_method) = 1)
SELECT u.user_id, username, email, phone, gender, age, city, province,
  CAST(registration_time AS VARCHAR) AS registration_time, CAST(last_login_time AS VARCHAR) AS last_login_time, user_status,
  {columns}, {_times("first_order_time_30d", "last_order_time_30d")},
  pref.category_name AS prefer_category_name, pref.brand_name AS prefer_brand_name, pref.payment_method AS prefer_payment_method,
  {_steps("w30d.order_count", [(10, "high_frequency"), (3, "medium_frequency"), (1, "low_frequency")], "inactive")} AS frequency_label,
  {_steps("w30d.amount", [(5000, "high_value"), (1000, "medium_value"), (100, "low_value")], "no_purchase")} AS value_label,
  least(coalesce(w30d.order_count, 0) * 10 + {points} + coalesce(w30d.product_count, 0) * 2, 100) AS activity_score,
  u.day AS dt
FROM (SELECT * FROM dwd_users, days) u
{" ".join(f"LEFT JOIN {w} ON {w}.day = u.day AND {w}.user_id = u.user_id" for w in ("w1d", "w7d", "w30d", "pref"))}""")


def region_range_sql(source: str, start: str) -> str:
    counted = {"order": "order_id", "user": "user_id", "product": "product_id"}
    subqueries, columns = ranged_windows_sql("province, city", counted, "sales_quantity", "sales_amount", source, start)
    return oracle(f"""WITH {subqueries},
people AS (SELECT day, province, city, user_id, COUNT(order_id) AS n, MIN(order_time) AS first_time FROM days
  JOIN {source} ON CAST(dt AS DATE) BETWEEN CAST(day AS DATE) - 29 AND CAST(day AS DATE) WHERE order_status = 'completed' GROUP BY ALL),
users AS (SELECT day, province, city, COUNT(*) AS total_user_count, COUNT(*) FILTER (WHERE n >= 5) AS active_user_count,
  COUNT(*) FILTER (WHERE first_time >= CAST(day AS DATE) - 29) AS new_user_count FROM people GROUP BY ALL)
SELECT w30d.province, w30d.city, {columns}, {_times("first_order_time_30d", "last_order_time_30d")},
{REGION_USER_COLUMNS} {REGION_LABELS}, w30d.day AS dt FROM w30d
{" ".join(f"LEFT JOIN {w} ON {w}.day = w30d.day AND {w}.province = w30d.province AND {w}.city = w30d.city" for w in ("w1d", "w7d", "users"))}""")


def _times(first: str, last: str) -> str:
    return f"CAST(w30d.first_time AS VARCHAR) AS {first}, CAST(w30d.last_time AS VARCHAR) AS {last}"


def _steps(value: str, steps: list, default) -> str:
    def lit(x):
        return f"'{x}'" if isinstance(x, str) else str(x)

    whens = " ".join(f"WHEN {value} >= {bound} THEN {lit(label)}" for bound, label in steps)
    return f"CASE {whens} ELSE {lit(default)} END"


PREFERENCE = f"""SELECT user_id, category_name AS prefer_category_name, brand_name AS prefer_brand_name,
    payment_method AS prefer_payment_method
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, category_name, brand_name, payment_method) AS rn
    FROM (SELECT user_id, category_name, brand_name, payment_method, COUNT(*) AS n FROM dwd_orders
      WHERE dt >= '{D30}' AND dt <= '{D}' AND order_status = 'completed' GROUP BY ALL) c) r
  WHERE rn = 1"""


def user_wide_sql(source: str = "dwd_orders") -> str:
    subqueries, columns = windows_sql(
        "user_id", {"order": "order_id", "product": "product_id"}, "quantity", "order_amount", source
    )
    points = _steps("w30d.amount", [(1000, 30), (500, 20), (100, 10)], 0)
    return oracle(f"""WITH {subqueries},
pref AS ({PREFERENCE.replace("dwd_orders", source)})
SELECT u.user_id, username, email, phone, gender, age, city, province,
  CAST(registration_time AS VARCHAR) AS registration_time, CAST(last_login_time AS VARCHAR) AS last_login_time, user_status,
  {columns}, {_times("first_order_time_30d", "last_order_time_30d")},
  prefer_category_name, prefer_brand_name, prefer_payment_method,
  {_steps("w30d.order_count", [(10, "high_frequency"), (3, "medium_frequency"), (1, "low_frequency")], "inactive")} AS frequency_label,
  {_steps("w30d.amount", [(5000, "high_value"), (1000, "medium_value"), (100, "low_value")], "no_purchase")} AS value_label,
  least(coalesce(w30d.order_count, 0) * 10 + {points} + coalesce(w30d.product_count, 0) * 2, 100) AS activity_score,
  '{D}' AS dt
FROM (SELECT * FROM dwd_users WHERE dt = '{D}') u LEFT JOIN w1d ON u.user_id = w1d.user_id LEFT JOIN w7d ON u.user_id = w7d.user_id
LEFT JOIN w30d ON u.user_id = w30d.user_id LEFT JOIN pref ON u.user_id = pref.user_id""")


def product_wide_sql(labels: str, source: str = "dwd_orders") -> str:
    subqueries, columns = windows_sql(
        "product_id", {"order": "order_id", "user": "user_id"}, "sales_quantity", "sales_amount", source
    )
    return oracle(f"""WITH {subqueries}
SELECT p.product_id, product_name, category_id, category_name, brand_id, brand_name, CAST(price AS DOUBLE) AS price,
  CAST(cost AS DOUBLE) AS cost, CAST(weight AS DOUBLE) AS weight, product_status,
  {columns}, {_times("first_sale_time_30d", "last_sale_time_30d")}, {labels}, '{D}' AS dt
FROM (SELECT * FROM dwd_products WHERE dt = '{D}') p LEFT JOIN w1d ON p.product_id = w1d.product_id
LEFT JOIN w7d ON p.product_id = w7d.product_id LEFT JOIN w30d ON p.product_id = w30d.product_id""")


_QTY, _USERS = "coalesce(w30d.quantity, 0)", "coalesce(w30d.user_count, 0)"
PRODUCT_LABELS_V1 = (
    _steps("w30d.quantity", [(100, "hot"), (10, "normal"), (1, "slow")], "no_sale")
    + f" AS sales_label, least({_QTY} + {_USERS} * 2 + "
    + _steps("w30d.amount", [(10000, 30), (5000, 20), (1000, 10)], 0)
    + ", 100) AS popularity_score"
)
PRODUCT_LABELS = (
    _steps(
        "w30d.quantity",
        [(100, "hot_product"), (50, "popular_product"), (10, "normal_product"), (1, "slow_moving")],
        "no_sales",
    )
    + " AS sales_level, "
    + _steps(
        "w30d.amount", [(10000, "high_revenue"), (5000, "medium_revenue"), (1000, "low_revenue")], "minimal_revenue"
    )
    + f" AS revenue_level, least(CAST({_QTY} AS DOUBLE) * CAST(0.5 AS DOUBLE) + {_USERS} * 2 + "
    + _steps("w30d.amount", [(5000, 30), (1000, 20), (500, 10)], 0)
    + ", CAST(100 AS DOUBLE)) AS popularity_score, CASE WHEN price > 0 THEN "
    + half_up("CAST((price - cost) * 10000 AS BIGINT)", "CAST(price * 100 AS BIGINT)")
    + " ELSE 0 END AS profit_margin"
)


def region_wide_sql(labels: str, user_columns: str = "", source: str = "dwd_orders") -> str:
    counted = {"order": "order_id", "user": "user_id", "product": "product_id"}
    subqueries, columns = windows_sql("province, city", counted, "sales_quantity", "sales_amount", source)
    joins = " ".join(
        f"LEFT JOIN {w} ON {w}.province = w30d.province AND {w}.city = w30d.city"
        for w in (["w1d", "w7d"] + (["users"] if user_columns else []))
    )
    users = f", users AS ({REGION_USERS.replace('dwd_orders', source)})" if user_columns else ""
    return oracle(f"""WITH {subqueries}{users}
SELECT w30d.province, w30d.city, {columns}, {_times("first_order_time_30d", "last_order_time_30d")},
{user_columns} {labels}, '{D}' AS dt FROM w30d {joins}""")


REGION_USERS = f"""SELECT province, city, COUNT(DISTINCT user_id) AS total_user_count,
    COUNT(DISTINCT CASE WHEN n >= 5 THEN user_id END) AS active_user_count,
    COUNT(DISTINCT CASE WHEN first_time >= DATE '{D30}' THEN user_id END) AS new_user_count
  FROM (SELECT province, city, user_id, COUNT(order_id) AS n, MIN(order_time) AS first_time FROM dwd_orders
    WHERE dt >= '{D30}' AND dt <= '{D}' AND order_status = 'completed' GROUP BY province, city, user_id) t
  GROUP BY province, city"""
REGION_LABELS_V1 = (
    _steps("w30d.amount", [(100000, "tier1"), (50000, "tier2"), (10000, "tier3")], "tier4")
    + " AS region_tier, least(CAST(w30d.user_count AS DOUBLE) * CAST(0.5 AS DOUBLE) + "
    + "CAST(w30d.order_count AS DOUBLE) * CAST(0.3 AS DOUBLE) + "
    + _steps("w30d.amount", [(50000, 40), (20000, 30), (5000, 20)], 10)
    + ", CAST(100 AS DOUBLE)) AS activity_score"
)
REGION_LABELS = (
    _steps("w30d.amount", [(100000, "tier_1"), (50000, "tier_2"), (10000, "tier_3"), (1000, "tier_4")], "tier_5")
    + f" AS region_tier, {half_up('active_user_count * 100', 'total_user_count')} AS user_activity_rate, "
    + f"{half_up('new_user_count * 100', 'total_user_count')} AS new_user_rate, "
    + f"{half_up('CAST(w30d.amount * 100 AS BIGINT)', '100 * w30d.user_count')} AS avg_user_consumption"
)
REGION_USER_COLUMNS = "users.total_user_count, users.active_user_count, users.new_user_count,"


def _sum(column: str, alias: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE) AS {alias}"


def _int(column: str, alias: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT) AS {alias}"


ORACLES = {
    "customer_summary": oracle(f"""
SELECT c.customer_id, c.customer_name, c.customer_type, COUNT(DISTINCT o.order_id) AS total_orders,
  {_sum("o.order_amount_usd", "total_amount_usd")}, {mean2("o.order_amount_usd")} AS avg_order_amount,
  CAST(MAX(o.order_date) AS VARCHAR) AS last_order_date, CAST(MIN(o.order_date) AS VARCHAR) AS first_order_date,
  '{D}' AS stat_date, {_steps("SUM(o.order_amount_usd)", [(10000, "VIP"), (1000, "Premium")], "Regular")} AS customer_level, '{D}' AS dt
FROM usd_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
WHERE o.dt = '{D}' AND c.dt = '{D}' GROUP BY c.customer_id, c.customer_name, c.customer_type"""),
    "segment_summary": oracle(f"""
SELECT age_group, customer_status_desc, customer_count, active_last_30_days,
  {half_up("active_last_30_days * 100", "customer_count")} AS active_rate_pct, '{D}' AS summary_date
FROM (SELECT age_group, customer_status_desc, COUNT(*) AS customer_count,
    COUNT(CASE WHEN last_login_date >= DATE '{D}' - 30 THEN 1 END) AS active_last_30_days
  FROM crm_clean WHERE dt = '{D}' GROUP BY age_group, customer_status_desc) t"""),
    "daily_order_stats": oracle(f"""
SELECT CAST(order_date AS VARCHAR) AS order_date, COUNT(*) AS total_orders, {_sum("order_amount", "total_revenue")},
  {mean2("order_amount")} AS avg_order_value, CAST(MIN(order_amount) AS DOUBLE) AS min_order_value,
  CAST(MAX(order_amount) AS DOUBLE) AS max_order_value, ROUND(STDDEV_SAMP(CAST(order_amount AS DOUBLE)), 2) AS stddev_order_value,
  COUNT(DISTINCT customer_id) AS unique_customers
FROM crm_fact WHERE dt = '{D}' GROUP BY order_date"""),
    "customer_behavior": oracle(f"""
SELECT c.age_group, o.order_size_category, COUNT(*) AS order_count, {_sum("o.order_amount", "total_spent")},
  {mean2("o.order_amount")} AS avg_order_amount, CAST(quantile_disc(o.order_amount, 0.5) AS DOUBLE) AS median_order_amount,
  CAST(quantile_disc(o.order_amount, 0.9) AS DOUBLE) AS p90_order_amount, '{D}' AS analysis_date
FROM crm_fact o JOIN crm_clean c ON o.customer_id = c.customer_id AND o.dt = c.dt WHERE o.dt = '{D}' GROUP BY c.age_group, o.order_size_category"""),
    "user_wide": user_wide_sql(),
    "user_preference": oracle(PREFERENCE),
    "product_wide_v1": product_wide_sql(PRODUCT_LABELS_V1),
    "product_wide": product_wide_sql(PRODUCT_LABELS),
    "region_wide_v1": region_wide_sql(REGION_LABELS_V1),
    "region_wide": region_wide_sql(REGION_LABELS, REGION_USER_COLUMNS),
    "region_users": oracle(REGION_USERS),
    "daily_sales": oracle(f"""
SELECT '{D}' AS report_date, COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers,
  {_sum("total_amount", "total_revenue")}, {mean2("total_amount")} AS avg_order_value, {_int("quantity", "total_quantity")},
  {_sum("profit", "total_profit")}, {mean2("profit")} AS avg_profit_per_order, CAST(MAX(total_amount) AS DOUBLE) AS max_order_value,
  CAST(MIN(total_amount) AS DOUBLE) AS min_order_value, ROUND(STDDEV_SAMP(CAST(total_amount AS DOUBLE)), 2) AS order_value_std
FROM fact_order_t WHERE order_date = DATE '{D}'"""),
    "customer_stats": oracle(f"""
SELECT '{D}' AS report_date, dc.customer_age_group, dc.state, COUNT(DISTINCT fo.customer_id) AS customer_count,
  COUNT(fo.order_id) AS total_orders, {_sum("fo.total_amount", "total_spending")}, {mean2("fo.total_amount")} AS avg_order_value,
  {_sum("fo.profit", "total_profit_contribution")}
FROM fact_order_t fo JOIN dim_customer_t dc ON fo.customer_id = dc.customer_id
WHERE fo.order_date = DATE '{D}' GROUP BY dc.customer_age_group, dc.state"""),
    "product_stats": oracle(f"""
SELECT '{D}' AS report_date, dp.category, dp.brand, dp.price_category, COUNT(DISTINCT fo.product_id) AS products_sold,
  {_int("fo.quantity", "total_quantity_sold")}, {_sum("fo.total_amount", "total_revenue")},
  {mean2("fo.total_amount")} AS avg_revenue_per_product, {_sum("fo.profit", "total_profit")},
  CASE WHEN COUNT(dp.profit_margin) > 0 THEN {half_up("SUM(CAST(ROUND(dp.profit_margin * 100) AS BIGINT))", "100 * COUNT(dp.profit_margin)")} END AS avg_profit_margin
FROM fact_order_t fo JOIN dim_product_t dp ON fo.product_id = dp.product_id
WHERE fo.order_date = DATE '{D}' GROUP BY dp.category, dp.brand, dp.price_category"""),
    "monthly_trends": oracle(f"""
SELECT order_year, order_month, order_quarter, COUNT(DISTINCT order_id) AS monthly_orders,
  COUNT(DISTINCT customer_id) AS monthly_customers, {_sum("total_amount", "monthly_revenue")}, {_sum("profit", "monthly_profit")},
  {mean2("total_amount")} AS avg_monthly_order_value,
  {half_up("SUM(CAST(profit * 100 AS BIGINT)) * 100", "SUM(CAST(total_amount * 100 AS BIGINT))", 6)} AS profit_margin_pct
FROM fact_order_t WHERE order_year = 2024 AND order_month = 2 GROUP BY order_year, order_month, order_quarter"""),
    "sales_by_category": oracle(f"""
SELECT CAST(CAST(o.order_time AS DATE) AS VARCHAR) AS order_date, p.category_name AS product_category,
  {_sum("o.final_amount", "total_sales_amount")}, COUNT(DISTINCT o.order_id) AS total_orders, '{D}' AS dt
FROM dwd_orders o JOIN ods_product_info p ON o.product_id = p.product_id GROUP BY CAST(o.order_time AS DATE), p.category_name"""),
    "daily_sales_valid": oracle(f"""
SELECT CAST(CAST(order_ts AS DATE) AS VARCHAR) AS sales_date, {_sum("order_amount", "total_sales_amount")},
  COUNT(DISTINCT order_id) AS total_orders_count, {_int("order_quantity", "total_items_sold")},
  {mean2("order_amount")} AS average_order_value, '{D}' AS dt
FROM script_orders WHERE order_status NOT IN ('cancelled', 'returned_full') GROUP BY CAST(order_ts AS DATE)"""),
    "user_lifetime": oracle(f"""
SELECT u.user_id, u.first_name, u.last_name, u.email, u.gender, CAST(u.registration_date AS VARCHAR) AS registration_date,
  CAST(MAX(o.order_ts) AS VARCHAR) AS last_order_timestamp, {_sum("o.order_amount", "total_lifetime_spend")},
  COUNT(DISTINCT o.order_id) AS total_lifetime_orders, '{D}' AS dt
FROM script_users u LEFT JOIN script_orders o ON u.user_id = o.user_id AND o.dt <= '{D}'
WHERE u.dt = '{D}' GROUP BY u.user_id, u.first_name, u.last_name, u.email, u.gender, u.registration_date"""),
}

ORACLES["customer_behavior_exact"] = ORACLES["customer_behavior"]

"""Data-quality queries that read frames; those on tables are in ``registry.tables``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from layerwell.fixtures import fixture
from layerwell.functions.columns import day_shift
from layerwell.operators import clean, profiles, quality
from layerwell.session import materialize, scratch_path
from registry.cleaning import EMAIL, dim_customers, dwd_products, usd_orders
from registry.common import D, oracle, plain

NOW = datetime(2024, 2, 15, 3, 30, 0)
TODAY = "2024-02-01"
GATE_DATES = ("pay_time", "finish_time")

ODS_CUSTOMER = (
    "customer_id customer_code customer_name customer_type registration_date status phone email address dt".split()
)
CRM_ORDERS = "order_id customer_id order_date order_amount order_status payment_method dt".split()
USER_INFO = (
    "user_id username email phone gender age city province registration_time last_login_time user_status "
    "customer_type acctbal dt"
).split()
USER_TEXT = set(USER_INFO) - {"user_id", "age", "acctbal"}
CUSTOMER_INFO = (
    "customer_id customer_name email phone address city state country registration_date last_update_time is_active"
).split()
CUSTOMER_TEXT = set("customer_name email phone address city state country".split())
ORDER_HEAD = (
    "order_id user_id product_id product_name category_id category_name brand_id brand_name order_time pay_time "
    "finish_time order_status payment_method quantity unit_price total_amount discount_amount final_amount "
    "province city dt"
).split()
ORDER_HEAD_TEXT = set(
    "order_id product_id product_name category_name brand_name order_status payment_method province city dt".split()
)
PRODUCT_NUMBERS = "category_id brand_id price cost weight".split()


def _heads(spark, sf):
    return clean.clean_orders(fixture(spark, sf, "ods_order_lines"))


def _report(spark, sf):
    report = quality.quality_report(fixture(spark, sf, "customer_info"), "customer_info", NOW)
    return plain(report.withColumn("null_counts", F.to_json("null_counts")))


def _counts(spark, sf):
    tables = {
        "ods_customer": fixture(spark, sf, "ods_customer"),
        "ods_order": fixture(spark, sf, "ods_order"),
        "dwd_dim_customer": dim_customers(spark, sf),
        "dwd_fact_order": usd_orders(spark, sf),
    }
    return quality.layer_counts(tables, D)


PROFILED = ["order_id", "user_id", "category_name", "quantity", "final_amount", "pay_time"]
PROFILE_FROM = day_shift(D, -20)


def _profile_range(spark, sf):
    """Stored sketches of all days, merged over three weeks, next to what the rows say exactly."""
    # Joined once; the sketches and the exact figures read the few columns they need from it.
    lines = materialize(fixture(spark, sf, "ods_order_info").select(*PROFILED, "dt"), "profiled")
    path = scratch_path(spark, "profiles")
    profiles.store_profiles(lines, path)
    merged = profiles.profile_range(spark, path, PROFILE_FROM, D)
    kept = lines.where(F.col("dt").between(PROFILE_FROM, D))
    exact = quality.column_profile(kept.drop("dt")).select("column_name", F.col("distinct_count").alias("exact"))
    below = kept.agg(*(F.count(F.col(c)).alias(f"{c}_n") for c in ("quantity", "final_amount"))).first()
    close = F.abs(F.col("distinct_estimate") - (F.col("exact") - (F.col("null_count") > 0).cast("long"))) <= F.greatest(
        F.lit(1), profiles.DISTINCT_ERROR * F.col("exact")
    )
    got = merged.join(exact, "column_name")
    medians = {r.column_name: r.quantiles[0] for r in got.where("quantiles IS NOT NULL").select("column_name", "quantiles").collect()}
    ranks = kept.agg(
        *(F.count_if(F.col(c) <= F.lit(medians[c])).alias(f"{c}_le") for c in ("quantity", "final_amount")),
        *(F.count_if(F.col(c) < F.lit(medians[c])).alias(f"{c}_lt") for c in ("quantity", "final_amount")),
    ).first()
    inside = [
        c
        for c in ("quantity", "final_amount")
        if ranks[f"{c}_lt"] / below[f"{c}_n"] - profiles.RANK_ERROR <= 0.5 <= ranks[f"{c}_le"] / below[f"{c}_n"] + profiles.RANK_ERROR
    ]
    good = F.when(F.col("column_name").isin("quantity", "final_amount"), F.col("column_name").isin(*inside))
    return got.select("column_name", "row_count", "null_count", "exact", close.alias("distinct_close"), good.alias("median_close"))


QUERIES = {
    "profile_range": _profile_range,
    "null_profile": lambda s, d: quality.null_profile(fixture(s, d, "ods_customer")),
    "score_customers": lambda s, d: plain(quality.score_customers(fixture(s, d, "crm_customers"))),
    "score_orders": lambda s, d: plain(quality.score_orders(fixture(s, d, "crm_orders"), TODAY)),
    "generic_quality": lambda s, d: quality.generic_quality(fixture(s, d, "crm_orders")),
    "quality_rollup": lambda s, d: quality.quality_rollup(
        quality.score_customers(fixture(s, d, "crm_customers"), min_score=0.0)
    ).withColumn("avg_score", F.round("avg_score", 6)),
    "quality_gate": lambda s, d: quality.quality_gate(
        _heads(s, d), "dwd_order_info", ["order_id"], nullable_dates=GATE_DATES
    ),
    "quality_gate_failing": lambda s, d: quality.quality_gate(
        clean.clean_orders(fixture(s, d, "ods_order_info")), "dwd_order_info", ["order_id"], nullable_dates=("pay_time",)
    ),
    "range_profile": lambda s, d: quality.range_profile(dwd_products(s, d)).withColumn(
        "avg_value", F.round("avg_value", 2)
    ),
    "column_profile": lambda s, d: quality.column_profile(fixture(s, d, "ods_user_info")),
    "quality_report": _report,
    "order_rules": lambda s, d: quality.order_rules(fixture(s, d, "order_info"), TODAY),
    "customer_rules": lambda s, d: quality.customer_rules(fixture(s, d, "customer_info")),
    "product_rules": lambda s, d: quality.product_rules(fixture(s, d, "product_info")),
    "layer_counts": _counts,
    "key_issues": lambda s, d: quality.key_issues(fixture(s, d, "ods_order_info"), ["order_id"]),
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _blank(column: str, text: set, texts: str = "''") -> str:
    return f"({column} IS NULL OR {column} IN ({texts}))" if column in text else f"({column} IS NULL)"


def _null_cells(columns, text) -> str:
    terms = [f"CAST(CASE WHEN {_blank(c, text, chr(39) * 2 + ', ' + repr('null'))} THEN 1 ELSE 0 END AS BIGINT)" for c in columns]
    return "CAST(SUM(" + " + ".join(terms) + ") AS BIGINT)"


def _gate(source: str, dates: list[str]) -> str:
    null_dates = "".join(f", COUNT(*) - COUNT({d}) AS null_{d}" for d in dates)
    texts = ", ".join(
        [
            "CASE WHEN null_cells / CAST(n * 21 AS DOUBLE) > 0.05 THEN 'null ratio above limit' END",
            "CASE WHEN n > k THEN 'duplicate rows: ' || CAST(n - k AS VARCHAR) END",
            *(f"CASE WHEN null_{d} > 0 THEN 'null dates in {d}: ' || CAST(null_{d} AS VARCHAR) END" for d in dates),
        ]
    )
    return oracle(f"""
SELECT 'dwd_order_info' AS table_name, n AS total_rows, null_cells, null_cells / CAST(n * 21 AS DOUBLE) AS null_ratio,
  n - k AS duplicate_rows, (n - k) / CAST(n AS DOUBLE) AS duplicate_ratio, concat_ws(';', {texts}) = '' AS passed,
  concat_ws(';', {texts}) AS issues
FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT order_id) AS k, {_null_cells(ORDER_HEAD, ORDER_HEAD_TEXT)} AS null_cells{null_dates}
  FROM {source}) t""")


_SCORE = {
    "customer_id": "customer_id IS NOT NULL",
    "customer_name": "customer_name IS NOT NULL AND length(trim(customer_name)) >= 2",
    "email": f"coalesce(regexp_matches(email, '{EMAIL}'), FALSE)",
    "phone": "coalesce(regexp_matches(phone, '^\\+?[1-9]\\d{1,14}$'), FALSE)",
    "age": "coalesce(age BETWEEN 0 AND 120, FALSE)",
}
_ORDER_SCORE = {
    "order_id": "order_id IS NOT NULL",
    "customer_id": "customer_id IS NOT NULL",
    "order_amount": "order_amount IS NOT NULL AND order_amount > 0",
    "order_date": f"order_date IS NOT NULL AND order_date >= DATE '2020-01-01' AND order_date <= DATE '{TODAY}'",
}


def _scored(source: str, checks: dict[str, str], dates: str, doubles: str = "") -> str:
    flags = ", ".join(f"({test}) AS dq_{name}_valid" for name, test in checks.items())
    total = " + ".join(f"CAST(dq_{name}_valid AS INT)" for name in checks)
    casts = ", ".join(
        [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()] + [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split()]
    )
    return (
        f"SELECT * REPLACE ({casts}), ({total}) / CAST({len(checks)} AS DOUBLE) AS dq_score "
        f"FROM (SELECT *, {flags} FROM {source}) f"
    )


def _grades(inner: str, good: float, fair: float, least: float) -> str:
    return oracle(
        f"SELECT *, CASE WHEN dq_score >= {good} THEN 'GOOD' WHEN dq_score >= {fair} THEN 'FAIR' ELSE 'POOR' END AS dq_status "
        f"FROM ({inner}) s WHERE dq_score >= {least}"
    )


_CUSTOMER_SCORES = _scored("crm_customers", _SCORE, "registration_date last_login_date")

ORACLES = {
    "profile_range": oracle(
        _union(
            [
                f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, "
                f"COUNT(DISTINCT {c}) + CAST(COUNT(*) > COUNT({c}) AS INT) AS exact, TRUE AS distinct_close, "
                f"{'TRUE' if c in ('quantity', 'final_amount') else 'CAST(NULL AS BOOLEAN)'} AS median_close "
                f"FROM ods_order_info WHERE dt BETWEEN '{PROFILE_FROM}' AND '{D}'"
                for c in PROFILED
            ]
        )
    ),
    "null_profile": oracle(
        _union(
            [
                f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, COUNT(*) AS row_count, COUNT(*) > 0 AS passed "
                "FROM ods_customer"
                for c in ODS_CUSTOMER
            ]
        )
    ),
    "score_customers": _grades(_CUSTOMER_SCORES, 0.8, 0.6, 0.6),
    "score_orders": _grades(_scored("crm_orders", _ORDER_SCORE, "order_date", "order_amount"), 0.75, 0.5, 0.5),
    "generic_quality": oracle(
        _union(
            [
                f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
                f"(COUNT(*) - COUNT({c})) * CAST(100 AS DOUBLE) / COUNT(*) AS null_pct, COUNT(*) AS total_records, "
                "(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM crm_orders) u) AS unique_records, "
                "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM crm_orders) u) AS duplicate_records FROM crm_orders"
                for c in CRM_ORDERS
            ]
        )
    ),
    "quality_rollup": oracle(
        "SELECT dq_status, COUNT(*) AS record_count, ROUND(AVG(dq_score), 6) AS avg_score FROM (SELECT *, "
        "CASE WHEN dq_score >= 0.8 THEN 'GOOD' WHEN dq_score >= 0.6 THEN 'FAIR' ELSE 'POOR' END AS dq_status "
        f"FROM ({_CUSTOMER_SCORES}) s) g GROUP BY dq_status"
    ),
    "quality_gate": _gate("dwd_order_lines", ["order_time"]),
    "quality_gate_failing": _gate("dwd_orders", ["order_time", "finish_time"]),
    "range_profile": oracle(
        _union(
            [
                f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value, "
                f"ROUND(AVG(CAST({c} AS DOUBLE)), 2) AS avg_value FROM dwd_products"
                for c in PRODUCT_NUMBERS
            ]
        )
    ),
    "column_profile": oracle(
        _union(
            [
                f"SELECT '{c}' AS column_name, n AS total_count, z AS null_count, k AS distinct_count, "
                "z * CAST(100 AS DOUBLE) / n AS null_percentage, k / CAST(n AS DOUBLE) AS uniqueness_ratio FROM "
                f"(SELECT COUNT(*) AS n, COUNT(CASE WHEN {_blank(c, USER_TEXT)} THEN 1 END) AS z, "
                f"COUNT(DISTINCT {c}) + CASE WHEN COUNT({c}) < COUNT(*) THEN 1 ELSE 0 END AS k FROM ods_user_info) t"
                for c in USER_INFO
            ]
        )
    ),
    "quality_report": oracle(
        "SELECT 'customer_info' AS table_name, n AS total_records, 11 AS total_columns, '{' || "
        + " || ',' || ".join(f"'\"{c}\":' || CAST(z_{c} AS VARCHAR)" for c in CUSTOMER_INFO)
        + " || '}' AS null_counts, n - u AS duplicate_count, latest AS latest_timestamp, "
        "CAST(floor(date_diff('second', CAST(latest AS TIMESTAMP), TIMESTAMP '2024-02-15 03:30:00') / 3600) AS BIGINT) AS hours_old, "
        "greatest(CAST(0 AS DOUBLE), CAST(100 AS DOUBLE) - (("
        + " + ".join(f"z_{c}" for c in CUSTOMER_INFO)
        + ") / CAST(n * 11 AS DOUBLE) * 30 + (n - u) / CAST(n AS DOUBLE) * 20)) AS quality_score FROM (SELECT COUNT(*) AS n, "
        "(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM customer_info) q) AS u, "
        "strftime(CAST(MAX(registration_date) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS latest, "
        + ", ".join(
            f"COUNT(CASE WHEN {_blank(c, CUSTOMER_TEXT, repr('') + ', ' + repr('null'))} THEN 1 END) AS z_{c}"
            for c in CUSTOMER_INFO
        )
        + " FROM customer_info) t"
    ),
    "order_rules": oracle(f"""
SELECT 'ORDER_001' AS rule, COUNT(CASE WHEN total_amount <= 0 THEN 1 END) AS violations FROM order_info
UNION ALL SELECT 'ORDER_002', COUNT(CASE WHEN quantity <= 0 THEN 1 END) FROM order_info
UNION ALL SELECT 'ORDER_003', COUNT(CASE WHEN order_date > DATE '{TODAY}' THEN 1 END) FROM order_info"""),
    "customer_rules": oracle(r"""
SELECT 'CUSTOMER_001' AS rule, COUNT(CASE WHEN NOT regexp_matches(email, '^[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') THEN 1 END) AS violations
FROM customer_info
UNION ALL SELECT 'CUSTOMER_002', COUNT(CASE WHEN is_active = 1 AND phone IS NULL THEN 1 END) FROM customer_info"""),
    "product_rules": oracle("""
SELECT 'PRODUCT_001' AS rule, COUNT(CASE WHEN price <= cost THEN 1 END) AS violations FROM product_info
UNION ALL SELECT 'PRODUCT_002', COUNT(CASE WHEN price <= 0 THEN 1 END) FROM product_info"""),
    "layer_counts": oracle(f"""
SELECT 'ods_customer' AS table_name, COUNT(*) AS row_count FROM ods_customer WHERE dt = '{D}'
UNION ALL SELECT 'ods_order', COUNT(*) FROM ods_order WHERE dt = '{D}'
UNION ALL SELECT 'dwd_dim_customer', COUNT(*) FROM dim_customers WHERE dt = '{D}'
UNION ALL SELECT 'dwd_fact_order', COUNT(*) FROM usd_orders WHERE dt = '{D}'"""),
    "key_issues": oracle("""
SELECT 'NULL_KEYS' AS issue, COUNT(CASE WHEN order_id IS NULL THEN 1 END) AS issue_count FROM ods_order_info
UNION ALL SELECT 'DUPLICATE_KEYS', COUNT(*) FROM (SELECT order_id FROM ods_order_info GROUP BY order_id HAVING COUNT(*) > 1) t"""),
}

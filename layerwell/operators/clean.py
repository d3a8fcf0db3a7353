"""ODS to DWD: cleaning of users, orders, products and customers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwell.functions.columns import (
    EMAIL_PATTERN,
    MOBILE_PATTERN,
    matching,
    non_blank,
    non_negative_money,
    parse_time,
    recode,
)
from layerwell.operators.shape import stamp

# Raw codes per cleaned label.
GENDER_CODES = {"M": ["M", "MALE"], "F": ["F", "FEMALE"]}
USER_STATUS_CODES = {"active": ["1", "ACTIVE"], "inactive": ["0", "INACTIVE"]}
ORDER_STATUS_CODES = {"created": ["1"], "paid": ["2"], "shipped": ["3"], "completed": ["4"], "cancelled": ["5"]}
PAYMENT_CODES = {"alipay": ["ALIPAY"], "wechat": ["WECHAT"], "unionpay": ["UNIONPAY"], "cash": ["CASH"]}
PRODUCT_STATUS_CODES = {"active": ["1"], "inactive": ["0"]}
CUSTOMER_STATUS_CODES = {"Active": ["A"], "Inactive": ["I"]}
SCRIPT_GENDER_CODES = {"M": ["Male", "male", "M"], "F": ["Female", "female", "F"]}

MONEY = "decimal(10,2)"


def clean_users(ods_user_info: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Trim names and places, null out malformed contact data, normalise gender and status."""
    c = F.col
    cleaned = ods_user_info.select(
        c("user_id").cast("bigint").alias("user_id"),
        non_blank(c("username"), "unknown_user").alias("username"),
        matching(c("email"), EMAIL_PATTERN).alias("email"),
        matching(c("phone"), MOBILE_PATTERN).alias("phone"),
        recode(F.upper("gender"), GENDER_CODES, "U").alias("gender"),
        F.when(c("age").between(0, 120), c("age")).alias("age"),
        non_blank(c("city"), "unknown").alias("city"),
        non_blank(c("province"), "unknown").alias("province"),
        parse_time(c("registration_time")).alias("registration_time"),
        parse_time(c("last_login_time")).alias("last_login_time"),
        recode(F.upper("user_status"), USER_STATUS_CODES, "unknown").alias("user_status"),
        F.lit(1).alias("version"),
        F.lit(True).alias("is_active"),
        c("dt"),
    )
    return stamp(cleaned, loaded_at, "dwd_create_time", "dwd_update_time")


def clean_orders(ods_order_info: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Normalise names, codes and amounts of order rows; rows without a key are dropped."""
    c = F.col
    cleaned = ods_order_info.where(
        c("order_id").isNotNull() & c("user_id").isNotNull() & c("product_id").isNotNull()
    ).select(
        c("order_id").cast("string").alias("order_id"),
        c("user_id").cast("bigint").alias("user_id"),
        c("product_id").cast("string").alias("product_id"),
        *_names(),
        parse_time(c("order_time")).alias("order_time"),
        parse_time(c("pay_time")).alias("pay_time"),
        parse_time(c("finish_time")).alias("finish_time"),
        recode(c("order_status"), ORDER_STATUS_CODES, "unknown").alias("order_status"),
        recode(F.upper("payment_method"), PAYMENT_CODES, "other").alias("payment_method"),
        F.when(c("quantity") > 0, c("quantity")).otherwise(0).cast("int").alias("quantity"),
        *(
            non_negative_money(c(name), MONEY).alias(name)
            for name in ("unit_price", "total_amount", "discount_amount", "final_amount")
        ),
        non_blank(c("province"), "unknown").alias("province"),
        non_blank(c("city"), "unknown").alias("city"),
        c("dt"),
    )
    return stamp(cleaned, loaded_at, "dwd_create_time", "dwd_update_time")


def clean_products(ods_product_info: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Normalise names, prices, weight and status of products."""
    c = F.col
    cleaned = ods_product_info.select(
        c("product_id").cast("string").alias("product_id"),
        *_names(),
        non_negative_money(c("price"), MONEY).alias("price"),
        non_negative_money(c("cost"), MONEY).alias("cost"),
        c("weight").try_cast("decimal(8,2)").alias("weight"),
        c("dimensions"),
        c("description"),
        recode(c("product_status"), PRODUCT_STATUS_CODES, "unknown").alias("product_status"),
        c("dt"),
    )
    return stamp(cleaned, loaded_at, "dwd_create_time", "dwd_update_time")


def _names():
    """Product, category and brand columns, which orders and products clean alike."""
    yield non_blank(F.col("product_name"), "unknown_product").alias("product_name")
    for level in ("category", "brand"):
        yield F.col(f"{level}_id").cast("bigint").alias(f"{level}_id")
        yield non_blank(F.col(f"{level}_name"), f"unknown_{level}").alias(f"{level}_name")


def customer_clean(crm_customers: DataFrame) -> DataFrame:
    """Age band and status text of the customers that have an id and a name."""
    age = F.col("age")
    return crm_customers.where(F.col("customer_id").isNotNull() & F.col("customer_name").isNotNull()).select(
        "customer_id",
        "customer_name",
        F.when(age < 18, "Minor")
        .when(age.between(18, 35), "Young Adult")
        .when(age.between(36, 50), "Middle Age")
        .otherwise("Senior")
        .alias("age_group"),
        "email",
        "phone",
        "address",
        "city",
        "state",
        recode(F.col("customer_status"), CUSTOMER_STATUS_CODES, "Unknown").alias("customer_status_desc"),
        "registration_date",
        "last_login_date",
        "dt",
    )


def transform_users_basic(users_raw: DataFrame, dt: str) -> DataFrame:
    """Users with a lower-case name and an email that contains ``@``."""
    email = F.col("email")
    return users_raw.where(F.col("user_id").isNotNull() & email.contains("@")).select(
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.coalesce(F.lower(F.trim("username")), F.lit("unknown")).alias("username"),
        F.lower(F.trim(email)).alias("email"),
        recode(F.col("gender"), SCRIPT_GENDER_CODES, "U").alias("gender"),
        F.col("registration_date").try_cast("date").alias("registration_date"),
        F.coalesce(F.col("is_active"), F.lit(False)).alias("is_active"),
        F.lit(dt).alias("dt"),
    )


def transform_users(users_raw: DataFrame, dt: str) -> DataFrame:
    """Users with first and last name; any non-null email is kept."""
    return users_raw.where(F.col("user_id").isNotNull() & F.col("email").isNotNull()).select(
        F.col("user_id").try_cast("bigint").alias("user_id"),
        *(F.trim(F.coalesce(F.col(name), F.lit(""))).alias(name) for name in ("first_name", "last_name")),
        F.lower(F.trim("email")).alias("email"),
        recode(F.col("gender"), SCRIPT_GENDER_CODES, "U").alias("gender"),
        F.col("registration_ts").try_cast("date").alias("registration_date"),
        F.coalesce(F.col("is_active"), F.lit(False)).alias("is_active"),
        F.lit(dt).alias("dt"),
    )


def transform_orders(orders_raw: DataFrame, dt: str | None = None) -> DataFrame:
    """Typed orders with positive quantity, non-negative amount and all keys.

    Without ``dt`` the rows keep the ``dt`` column they came with.
    """
    c = F.col
    present = [c(k).isNotNull() for k in ("order_id", "user_id", "product_id", "order_timestamp")]
    quantity, amount = c("order_quantity").try_cast("int"), c("order_amount").try_cast("decimal(18,2)")
    # Text is typed before it is compared: what is no number becomes null and is left out, whatever the cast mode.
    keep = (c("order_quantity").try_cast("double") > 0) & (amount >= 0)
    for term in present:
        keep = keep & term
    return orders_raw.where(keep).select(
        c("order_id").cast("string").alias("order_id"),
        c("user_id").try_cast("bigint").alias("user_id"),
        c("product_id").cast("string").alias("product_id"),
        F.coalesce(quantity, c("order_quantity").try_cast("double").try_cast("int")).alias("order_quantity"),
        amount.alias("order_amount"),
        c("order_timestamp").try_cast("timestamp").alias("order_ts"),
        F.coalesce(F.lower(F.trim("order_status")), F.lit("unknown")).alias("order_status"),
        (c("dt") if dt is None else F.lit(dt)).alias("dt"),
    )

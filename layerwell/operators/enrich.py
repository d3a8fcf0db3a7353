"""ODS to DWD: dimensions and facts that join or derive attributes.

A fact is left-joined to a dimension on its key and on the day. Only the needed
dimension columns enter the join; Spark broadcasts the dimension when its size
is below the session's threshold and splits hot keys of the fact otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwell.functions.columns import EMAIL_DOMAIN_PATTERN, day_shift, ratio
from layerwell.operators.shape import add_surrogate_key

# Fixed values.
CNY_PER_USD = 7
OPEN_END = "9999-12-31"
CUSTOMER_SOURCE = "ODS_CUSTOMER"


def customer_dim(ods_customer: DataFrame) -> DataFrame:
    """Current customer rows with a surrogate key and a validity period from the load day."""
    keyed = add_surrogate_key(ods_customer, ["customer_id"], "customer_sk")
    return keyed.select(
        "customer_sk",
        "customer_id",
        "customer_code",
        "customer_name",
        "customer_type",
        "registration_date",
        "status",
        "phone",
        "email",
        "address",
        F.col("dt").cast("date").alias("effective_date"),
        F.lit(OPEN_END).cast("date").alias("expiry_date"),
        F.lit(1).alias("is_current"),
        F.lit(CUSTOMER_SOURCE).alias("data_source"),
        "dt",
    )


def order_fact(ods_order: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Orders with the customer's surrogate key of the same day and the amount in USD."""
    keys = customer_dim.select("customer_id", "dt", "customer_sk")
    amount = F.col("order_amount")
    usd = F.when(F.col("currency") == "CNY", amount / CNY_PER_USD).otherwise(amount)
    return (
        add_surrogate_key(ods_order, ["order_id"], "order_sk")
        .join(keys, ["customer_id", "dt"], "left")
        .select(
            "order_sk",
            "order_id",
            "order_no",
            "customer_sk",
            "customer_id",
            "order_date",
            "order_amount",
            usd.cast("decimal(15,2)").alias("order_amount_usd"),
            "currency",
            "order_status",
            "payment_method",
            "dt",
        )
    )


def order_enriched(crm_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Valid orders with customer name and age band, a size band and date parts."""
    amount, day = F.col("order_amount"), F.col("order_date")
    valid = F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & (amount > 0)
    people = dim_customer.select("customer_id", "dt", "customer_name", "age_group")
    return (
        crm_orders.where(valid)
        .join(people, ["customer_id", "dt"], "left")
        .select(
            "order_id",
            "customer_id",
            "order_date",
            "order_amount",
            "order_status",
            "payment_method",
            "customer_name",
            "age_group",
            F.when(amount < 100, "Small")
            .when(amount <= 500, "Medium")
            .when(amount <= 1000, "Large")
            .otherwise("XLarge")
            .alias("order_size_category"),
            F.year(day).alias("order_year"),
            F.month(day).alias("order_month"),
            F.dayofweek(day).alias("order_day_of_week"),
            "dt",
        )
    )


def _on_day(column: str, day: str):
    """Half-open range on the raw column, which scans can prune (a formatted column cannot)."""
    c = F.col(column)
    return (c >= F.lit(day).cast("date")) & (c < F.lit(day_shift(day, 1)).cast("date"))


def daily_customers(customer_info: DataFrame, day: str) -> DataFrame:
    """Active customers changed on the day."""
    return customer_info.where((F.col("is_active") == 1) & _on_day("last_update_time", day))


def daily_orders(order_info: DataFrame, day: str) -> DataFrame:
    """Orders of the day that were not cancelled."""
    return order_info.where(_on_day("order_date", day) & (F.col("order_status") != "CANCELLED"))


def daily_products(product_info: DataFrame, day: str) -> DataFrame:
    """Products changed on the day."""
    return product_info.where(_on_day("last_update_time", day))


def enrich_customers(customers: DataFrame, as_of: str) -> DataFrame:
    """Tenure band and email domain."""
    tenure = F.datediff(F.lit(as_of).cast("date"), "registration_date")
    return customers.withColumns(
        {
            "customer_age_group": F.when(tenure < 365, "New").when(tenure < 1095, "Regular").otherwise("Loyal"),
            "email_domain": F.regexp_extract("email", EMAIL_DOMAIN_PATTERN, 1),
            "process_date": F.lit(as_of),
        }
    )


def enrich_orders(orders: DataFrame, customers: DataFrame, products: DataFrame, process_date: str) -> DataFrame:
    """Order fact with customer place, product attributes, profit and date parts."""
    places = customers.select("customer_id", "customer_name", "city", "state")
    goods = products.select("product_id", "product_name", "category", "brand", "cost")
    profit = F.col("total_amount") - F.col("quantity") * F.col("cost")
    day = F.col("order_date")
    return (
        orders.join(places, "customer_id", "left")
        .join(goods, "product_id", "left")
        .withColumns(
            {
                "profit": profit.cast("decimal(18,2)"),
                "order_year": F.year(day),
                "order_month": F.month(day),
                "order_quarter": F.quarter(day),
                "process_date": F.lit(process_date),
            }
        )
        .drop("cost")
    )


def enrich_products(products: DataFrame, process_date: str) -> DataFrame:
    """Margin in percent and price band."""
    price = F.col("price")
    return products.withColumns(
        {
            "profit_margin": F.round(ratio(price - F.col("cost"), price, 100), 2),
            "price_category": F.when(price < 50, "Low").when(price < 200, "Medium").otherwise("High"),
            "process_date": F.lit(process_date),
        }
    )

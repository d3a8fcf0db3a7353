"""DWD to DWS: customer, order, product and sales summaries.

Facts are aggregated to one row per join key before they meet a dimension, so a
key with very many rows is combined inside the map tasks and the join only sees
distinct keys. ``count_distinct`` shuffles on (group, value) first and on the
group second, which spreads large groups too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwell.functions.columns import band, day_shift, ratio
from layerwell.operators.quantiles import exact_quantiles
from layerwell.session import materialize

# Fixed values.
LEVEL_STEPS = [(10000, "VIP"), (1000, "Premium")]
ACTIVE_DAYS = 30
UNSOLD_STATUSES = ("cancelled", "returned_full")
# Rank error of at most 1 / 100,000 of a group; one sketch serves both percentiles.
PERCENTILE_ACCURACY = 100_000

MONEY = "decimal(15,2)"
WIDE_MONEY = "decimal(18,2)"


def _mean(total, rows, decimal: str = MONEY):
    """Average of decimals as an exact quotient, rounded once."""
    return ratio(total, rows).cast(decimal)


def customer_summary(order_fact: DataFrame, customer_dim: DataFrame, dt: str) -> DataFrame:
    """Order count, spend, first and last order and level per customer of the day."""
    usd = F.col("order_amount_usd")
    spend = (
        order_fact.where(F.col("dt") == dt)
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum(usd).alias("total"),
            F.count(usd).alias("rows"),
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
        )
    )
    people = customer_dim.where(F.col("dt") == dt).select("customer_id", "customer_name", "customer_type")
    return people.join(spend, "customer_id").select(
        *people.columns,
        "total_orders",
        F.col("total").cast(MONEY).alias("total_amount_usd"),
        _mean(F.col("total"), F.col("rows")).alias("avg_order_amount"),
        "last_order_date",
        "first_order_date",
        F.lit(dt).alias("stat_date"),
        band(F.col("total"), LEVEL_STEPS, "Regular").alias("customer_level"),
        F.lit(dt).alias("dt"),
    )


def segment_summary(dim_customer: DataFrame, dt: str) -> DataFrame:
    """Customers and 30-day active rate per age band and status."""
    active = F.col("last_login_date") >= F.lit(day_shift(dt, -ACTIVE_DAYS)).cast("date")
    grouped = (
        dim_customer.where(F.col("dt") == dt)
        .groupBy("age_group", "customer_status_desc")
        .agg(F.count("*").alias("customer_count"), F.count_if(active).alias("active_last_30_days"))
    )
    rate = F.col("active_last_30_days").cast("decimal(20,0)") * 100 / F.col("customer_count")
    return grouped.withColumns({"active_rate_pct": F.round(rate, 2), "summary_date": F.lit(dt)})


def daily_order_stats(fact_order: DataFrame, dt: str) -> DataFrame:
    """Count, sum, mean, extremes, deviation and distinct customers per order date."""
    amount = F.col("order_amount")
    return (
        fact_order.where(F.col("dt") == dt)
        .groupBy("order_date")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum(amount).alias("total_revenue"),
            _mean(F.sum(amount), F.count(amount)).alias("avg_order_value"),
            F.min(amount).alias("min_order_value"),
            F.max(amount).alias("max_order_value"),
            F.stddev_samp(amount).alias("stddev_order_value"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )


def customer_behavior(fact_order: DataFrame, dim_customer: DataFrame, dt: str) -> DataFrame:
    """Spend per age band and order size, with approximate median and 90th percentile.

    Joined before grouping because the percentiles need every order; hot
    customers are left to the runtime skew split (the grouping keys differ from
    the join key, so the split costs no extra shuffle).
    """
    amount = F.col("order_amount")
    people = dim_customer.where(F.col("dt") == dt).select("customer_id", "age_group")
    facts = fact_order.where(F.col("dt") == dt).select("customer_id", "order_size_category", "order_amount")
    return (
        facts.join(people, "customer_id")
        .groupBy("age_group", "order_size_category")
        .agg(
            F.count("*").alias("order_count"),
            F.sum(amount).alias("total_spent"),
            _mean(F.sum(amount), F.count(amount)).alias("avg_order_amount"),
            F.percentile_approx(amount, [0.5, 0.9], PERCENTILE_ACCURACY).alias("percentiles"),
        )
        .select(
            *("age_group", "order_size_category", "order_count", "total_spent", "avg_order_amount"),
            F.col("percentiles")[0].alias("median_order_amount"),
            F.col("percentiles")[1].alias("p90_order_amount"),
            F.lit(dt).alias("analysis_date"),
        )
    )


def customer_behavior_exact(fact_order: DataFrame, dim_customer: DataFrame, dt: str) -> DataFrame:
    """As ``customer_behavior`` with the exact median and 90th percentile."""
    keys = ["age_group", "order_size_category"]
    people = dim_customer.where(F.col("dt") == dt).select("customer_id", "age_group")
    facts = fact_order.where(F.col("dt") == dt).select("customer_id", "order_size_category", "order_amount")
    spent = materialize(facts.join(people, "customer_id").select(*keys, "order_amount"), "spent")
    amount = F.col("order_amount")
    totals = spent.groupBy(*keys).agg(
        F.count("*").alias("order_count"), F.sum(amount).alias("total_spent"), _mean(F.sum(amount), F.count(amount)).alias("avg_order_amount")
    )
    cents = (amount * 100).cast("long")
    exact = exact_quantiles(spent.select(*keys, cents.alias("cents")), keys, "cents", {"median": "0.5", "p90": "0.9"})
    kind = spent.schema["order_amount"].dataType
    money = lambda name: (F.col(name).cast("decimal(19,0)") / 100).cast(kind).alias(f"{name}_order_amount")
    exact = exact.select(*(F.col(k).alias(f"_{k}") for k in keys), money("median"), money("p90"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = totals.join(exact, same, "left").drop(*(f"_{k}" for k in keys))
    return joined.withColumn("analysis_date", F.lit(dt))


def daily_sales(fact_order: DataFrame, day: str) -> DataFrame:
    """One row of totals for the orders of a day."""
    amount, profit = F.col("total_amount"), F.col("profit")
    return (
        fact_order.where(F.col("order_date") == F.lit(day).cast("date"))
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum(amount).alias("total_revenue"),
            _mean(F.sum(amount), F.count(amount)).alias("avg_order_value"),
            F.sum("quantity").alias("total_quantity"),
            F.sum(profit).alias("total_profit"),
            _mean(F.sum(profit), F.count(profit)).alias("avg_profit_per_order"),
            F.max(amount).alias("max_order_value"),
            F.min(amount).alias("min_order_value"),
            F.stddev_samp(amount).alias("order_value_std"),
        )
        .select(F.lit(day).alias("report_date"), "*")
    )


def _per_key(fact_order: DataFrame, day: str, key: str) -> DataFrame:
    """Additive totals of one day per join key."""
    return (
        fact_order.where(F.col("order_date") == F.lit(day).cast("date"))
        .groupBy(key)
        .agg(
            F.count("*").alias("rows"),
            F.count("order_id").alias("orders"),
            F.count("total_amount").alias("amounts"),
            F.sum("total_amount").alias("amount"),
            F.sum("quantity").alias("quantity"),
            F.sum("profit").alias("profit"),
        )
    )


def customer_stats(fact_order: DataFrame, dim_customer: DataFrame, day: str) -> DataFrame:
    """Customers, orders, spend and profit per tenure band and state."""
    people = dim_customer.where(F.col("process_date") == day).select("customer_id", "customer_age_group", "state")
    return (
        _per_key(fact_order, day, "customer_id")
        .join(people, "customer_id")
        .groupBy("customer_age_group", "state")
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            F.sum("orders").alias("total_orders"),
            F.sum("amount").alias("total_spending"),
            _mean(F.sum("amount"), F.sum("amounts")).alias("avg_order_value"),
            F.sum("profit").alias("total_profit_contribution"),
        )
        .select(F.lit(day).alias("report_date"), "*")
    )


def product_stats(fact_order: DataFrame, dim_product: DataFrame, day: str) -> DataFrame:
    """Products sold, quantity, revenue, profit and margin per category, brand and price band.

    The average margin is taken over order rows, so each product's margin is
    weighted with its number of rows.
    """
    goods = dim_product.where(F.col("process_date") == day).select(
        "product_id", "category", "brand", "price_category", "profit_margin"
    )
    margin, rows = F.col("profit_margin"), F.col("rows")
    return (
        _per_key(fact_order, day, "product_id")
        .join(goods, "product_id")
        .groupBy("category", "brand", "price_category")
        .agg(
            F.count_distinct("product_id").alias("products_sold"),
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("amount").alias("total_revenue"),
            _mean(F.sum("amount"), F.sum("amounts")).alias("avg_revenue_per_product"),
            F.sum("profit").alias("total_profit"),
            _mean(F.sum(margin * rows), F.sum(F.when(margin.isNotNull(), rows))).alias("avg_profit_margin"),
        )
        .select(F.lit(day).alias("report_date"), "*")
    )


def monthly_trends(fact_order: DataFrame, day: str) -> DataFrame:
    """Orders, customers, revenue, profit and margin of the month the day lies in."""
    year, month = int(day[:4]), int(day[5:7])
    amount, profit = F.sum("total_amount"), F.sum("profit")
    return (
        fact_order.where((F.col("order_year") == year) & (F.col("order_month") == month))
        .groupBy("order_year", "order_month", "order_quarter")
        .agg(
            F.count_distinct("order_id").alias("monthly_orders"),
            F.count_distinct("customer_id").alias("monthly_customers"),
            amount.alias("monthly_revenue"),
            profit.alias("monthly_profit"),
            _mean(amount, F.count("total_amount")).alias("avg_monthly_order_value"),
            ratio(profit, amount, 100).cast("decimal(18,6)").alias("profit_margin_pct"),
        )
    )


def sales_by_category(fact_orders: DataFrame, dim_products: DataFrame, dt: str) -> DataFrame:
    """Sales amount and distinct orders per order date and product category."""
    goods = dim_products.where(F.col("dt") == dt).select("product_id", "product_category")
    facts = fact_orders.where(F.col("dt") == dt).select("order_date", "order_id", "product_id", "order_amount")
    return (
        facts.join(goods, "product_id")
        .groupBy("order_date", "product_category")
        .agg(
            F.sum("order_amount").alias("total_sales_amount"),
            F.count_distinct("order_id").alias("total_orders"),
        )
        .withColumn("dt", F.lit(dt))
    )


def daily_sales_valid(fact_orders: DataFrame, dt: str) -> DataFrame:
    """Sales per day without cancelled and returned orders."""
    amount = F.col("order_amount")
    return (
        fact_orders.where((F.col("dt") == dt) & ~F.col("order_status").isin(*UNSOLD_STATUSES))
        .groupBy(F.to_date("order_ts").alias("sales_date"))
        .agg(
            F.sum(amount).alias("total_sales_amount"),
            F.count_distinct("order_id").alias("total_orders_count"),
            F.sum("order_quantity").alias("total_items_sold"),
            _mean(F.sum(amount), F.count(amount), WIDE_MONEY).alias("average_order_value"),
        )
        .withColumn("dt", F.lit(dt))
    )


def user_lifetime(users: DataFrame, fact_orders: DataFrame, dt: str) -> DataFrame:
    """Last order, spend and distinct orders up to the day, for every user of the day."""
    lifetime = (
        fact_orders.where(F.col("dt") <= dt)
        .groupBy("user_id")
        .agg(
            F.max("order_ts").alias("last_order_timestamp"),
            F.sum("order_amount").alias("total_lifetime_spend"),
            F.count_distinct("order_id").alias("orders"),
        )
    )
    people = users.where(F.col("dt") == dt).select(
        "user_id", "first_name", "last_name", "email", "gender", "registration_date"
    )
    return people.join(lifetime, "user_id", "left").select(
        *people.columns,
        "last_order_timestamp",
        "total_lifetime_spend",
        F.coalesce("orders", F.lit(0)).alias("total_lifetime_orders"),
        F.lit(dt).alias("dt"),
    )

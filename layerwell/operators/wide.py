"""DWD to DWS: subject wide tables over 1-, 7- and 30-day windows.

All three windows are computed together. Sums are combined in the map tasks to
one row per subject. For the distinct counts, rows are first grouped by
(subject, counted id), one grouping set per counted id, keeping the shortest
window the id occurs in; the second grouping then only counts ids. Both
groupings combine before their shuffle, so a subject holding a large share of
all rows is spread by its ids first and reaches the second shuffle as one row
per task. No set of ids is ever held, and the wide sums never travel with the
ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwell.functions.columns import band, day_shift, ratio

# Days per window and thresholds of the labels.
WINDOWS = {"1d": 1, "7d": 7, "30d": 30}
COMPLETED = "completed"
FREQUENCY_STEPS = [(10, "high_frequency"), (3, "medium_frequency"), (1, "low_frequency")]
VALUE_STEPS = [(5000, "high_value"), (1000, "medium_value"), (100, "low_value")]
USER_SPEND_POINTS = [(1000, 30), (500, 20), (100, 10)]
SALES_LABEL_STEPS = [(100, "hot"), (10, "normal"), (1, "slow")]
SALES_LEVEL_STEPS = [(100, "hot_product"), (50, "popular_product"), (10, "normal_product"), (1, "slow_moving")]
REVENUE_STEPS = [(10000, "high_revenue"), (5000, "medium_revenue"), (1000, "low_revenue")]
PRODUCT_POINTS_V1 = [(10000, 30), (5000, 20), (1000, 10)]
PRODUCT_POINTS = [(5000, 30), (1000, 20), (500, 10)]
REGION_TIER_STEPS_V1 = [(100000, "tier1"), (50000, "tier2"), (10000, "tier3")]
REGION_TIER_STEPS = [(100000, "tier_1"), (50000, "tier_2"), (10000, "tier_3"), (1000, "tier_4")]
REGION_POINTS = [(50000, 40), (20000, 30), (5000, 20)]
ACTIVE_USER_ORDERS = 5
MAX_SCORE = 100

AMOUNT = "decimal(15,2)"
AVERAGE = "decimal(10,2)"
PERCENT = "decimal(5,2)"


def completed_orders(orders: DataFrame, dt: str) -> DataFrame:
    """Completed order rows of the 30 days up to ``dt``; the string bounds prune partitions."""
    return orders.where(
        (F.col("dt") >= day_shift(dt, 1 - WINDOWS["30d"])) & (F.col("dt") <= dt) & (F.col("order_status") == COMPLETED)
    )


def _window_stats(orders: DataFrame, dt: str, keys: list[str], counted: dict[str, str], with_users: bool = False):
    """One row per key: distinct counts, sums and averages per window, first and last order time.

    ``counted`` maps a name to the id column whose distinct values are counted.
    ``with_users`` adds the region user counts, read off the per-user groups.
    Keys must not be null.
    """
    # Number of the shortest window a row is in; all longer ones hold it too.
    nearest = F
    for number, days in enumerate(list(WINDOWS.values())[:-1]):
        nearest = nearest.when(F.col("dt") >= day_shift(dt, 1 - days), number)
    rows = completed_orders(orders, dt).withColumn("nearest", nearest.otherwise(len(WINDOWS) - 1))
    return _totals(rows, keys).join(_distinct_counts(rows, dt, keys, counted, with_users), keys)


def _totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums, row counts and order times per window; combined in the map tasks to one row per key."""
    out = []
    for number, name in enumerate(WINDOWS):
        # The scan already keeps the longest window, so its sums need no test.
        inside = (F.col("nearest") <= number) if number < len(WINDOWS) - 1 else F.lit(True)
        out += [
            F.sum(F.when(inside, F.col("cents"))).alias(f"cents_{name}"),
            F.count(F.when(inside, F.col("cents"))).alias(f"rows_{name}"),
            F.sum(F.when(inside, F.col("quantity"))).alias(f"quantity_{name}"),
        ]
    totals = (
        rows.select(*keys, "nearest", "quantity", "order_time", _cents(F.col("final_amount")).alias("cents"))
        .groupBy(*keys)
        .agg(*out, F.min("order_time").alias("first_time_30d"), F.max("order_time").alias("last_time_30d"))
    )
    amounts = {f"amount_{w}": (F.col(f"cents_{w}").cast("decimal(19,0)") / 100).cast(AMOUNT) for w in WINDOWS}
    return totals.withColumns(amounts)


def _distinct_counts(
    rows: DataFrame, dt: str, keys: list[str], counted: dict[str, str], with_users: bool
) -> DataFrame:
    """Distinct ids per key and window; only keys, ids and the window number are shuffled."""
    ids = list(counted.values())
    per_user = [F.count("order_id").alias("order_rows"), F.min("order_time").alias("first_time")] if with_users else []
    per_id = (
        rows.select(*keys, *ids, "nearest", *(["order_time"] if with_users else []))
        .groupingSets([[*keys, i] for i in ids], *keys, *ids)
        .agg(F.grouping_id().alias("set_id"), F.min("nearest").alias("nearest"), *per_user)
    )
    # grouping_id has a 0 bit for the id column that is grouped by, 1 for the other ones.
    width = len(ids)
    set_of = {col: (1 << width) - 1 - (1 << (width - 1 - pos)) for pos, col in enumerate(ids)}
    out = []
    for number, name in enumerate(WINDOWS):
        for label, col in counted.items():
            hit = (F.col("set_id") == set_of[col]) & F.col(col).isNotNull() & (F.col("nearest") <= number)
            out.append(F.count_if(hit).alias(f"{label}_count_{name}"))
    if with_users:
        user_group = (F.col("set_id") == set_of["user_id"]) & F.col("user_id").isNotNull()
        active, new = _user_tests(dt, F.col("order_rows"), F.col("first_time"))
        out += [
            F.count_if(user_group).alias("total_user_count"),
            F.count_if(user_group & active).alias("active_user_count"),
            F.count_if(user_group & new).alias("new_user_count"),
        ]
    return per_id.groupBy(*keys).agg(*out)


def _cents(amount: Column) -> Column:
    """A two-place amount of up to 15 digits as an exact bigint, which sums without big decimals.

    The nearest double is off by far less than half a cent. A sum of cents that
    overflows would not fit the decimal(15,2) result either and raises an error.
    """
    return F.rint(amount.cast("double") * 100).cast("bigint")


def _user_tests(dt: str, order_rows: Column, first_time: Column) -> tuple[Column, Column]:
    """Active: enough order rows. New: first order not before the 30-day window."""
    window_start = F.lit(day_shift(dt, 1 - WINDOWS["30d"])).cast("date")
    return order_rows >= ACTIVE_USER_ORDERS, first_time >= window_start


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def _window_columns(counted: dict[str, str], quantity: str, amount: str) -> list[Column]:
    """Output columns of every window: missing values as 0, sums and averages as decimals."""
    out = []
    for name in WINDOWS:
        average = ratio(F.col(f"amount_{name}"), F.col(f"rows_{name}"))
        out += [_zero(f"{label}_count_{name}").alias(f"{label}_count_{name}") for label in counted]
        out += [
            _zero(f"quantity_{name}").alias(f"{quantity}_{name}"),
            _zero(f"amount_{name}").cast(AMOUNT).alias(f"{amount}_{name}"),
            F.coalesce(average, F.lit(0)).cast(AVERAGE).alias(f"avg_order_amount_{name}"),
        ]
    return out


def _score(*points: Column) -> Column:
    """Sum of the points, at most 100."""
    return F.least(reduce(Column.__add__, points), F.lit(MAX_SCORE))


def user_preference(orders: DataFrame, dt: str) -> DataFrame:
    """Most frequent (category, brand, payment) of each user in 30 days; ties go to the smallest names.

    The rank filter is applied by Spark before the shuffle as well, so each task
    sends one candidate per user.
    """
    choice = ["category_name", "brand_name", "payment_method"]
    counts = completed_orders(orders, dt).groupBy("user_id", *choice).count()
    best_first = Window.partitionBy("user_id").orderBy(F.desc("count"), *choice)
    return (
        counts.withColumn("rank", F.row_number().over(best_first))
        .where("rank = 1")
        .select("user_id", *(F.col(c).alias(f"prefer_{c}") for c in choice))
    )


USER_COUNTED = {"order": "order_id", "product": "product_id"}
USER_COLUMNS = [
    "user_id", "username", "email", "phone", "gender", "age", "city", "province",
    "registration_time", "last_login_time", "user_status",
]


def user_wide(users: DataFrame, orders: DataFrame, dt: str) -> DataFrame:
    """One row per user of the day: window statistics, preference, labels, activity score."""
    people = users.where(F.col("dt") == dt).select(*USER_COLUMNS)
    stats = _window_stats(orders, dt, ["user_id"], USER_COUNTED)
    return user_rows(people, stats, user_preference(orders, dt), ["user_id"], F.lit(dt))


def user_rows(people: DataFrame, stats: DataFrame, preference: DataFrame, on: list[str], day: Column) -> DataFrame:
    """Users with their statistics and preference, joined on ``on``."""
    amount, count = F.col("amount_30d"), F.col("order_count_30d")
    return (
        people.join(stats, on, "left")
        .join(preference, on, "left")
        .select(
            *USER_COLUMNS,
            *_window_columns(USER_COUNTED, "quantity", "order_amount"),
            F.col("first_time_30d").alias("first_order_time_30d"),
            F.col("last_time_30d").alias("last_order_time_30d"),
            "prefer_category_name",
            "prefer_brand_name",
            "prefer_payment_method",
            band(count, FREQUENCY_STEPS, "inactive").alias("frequency_label"),
            band(amount, VALUE_STEPS, "no_purchase").alias("value_label"),
            _score(
                _zero("order_count_30d") * 10,
                band(amount, USER_SPEND_POINTS, 0),
                _zero("product_count_30d") * 2,
            ).alias("activity_score"),
            day.alias("dt"),
        )
    )


PRODUCT_COUNTED = {"order": "order_id", "user": "user_id"}
PRODUCT_COLUMNS = [
    "product_id", "product_name", "category_id", "category_name", "brand_id", "brand_name",
    "price", "cost", "weight", "product_status",
]


def _product_output() -> list:
    return [
        *PRODUCT_COLUMNS,
        *_window_columns(PRODUCT_COUNTED, "sales_quantity", "sales_amount"),
        F.col("first_time_30d").alias("first_sale_time_30d"),
        F.col("last_time_30d").alias("last_sale_time_30d"),
    ]


def _product_rows(products: DataFrame, orders: DataFrame, dt: str) -> DataFrame:
    base = products.where(F.col("dt") == dt).select(*PRODUCT_COLUMNS)
    return base.join(_window_stats(orders, dt, ["product_id"], PRODUCT_COUNTED), "product_id", "left")


def product_wide_v1(products: DataFrame, orders: DataFrame, dt: str) -> DataFrame:
    """One row per product of the day with a sales label and a popularity score."""
    return _product_rows(products, orders, dt).select(
        *_product_output(),
        band(F.col("quantity_30d"), SALES_LABEL_STEPS, "no_sale").alias("sales_label"),
        _score(
            _zero("quantity_30d"), _zero("user_count_30d") * 2, band(F.col("amount_30d"), PRODUCT_POINTS_V1, 0)
        ).alias("popularity_score"),
        F.lit(dt).alias("dt"),
    )


def product_wide(products: DataFrame, orders: DataFrame, dt: str) -> DataFrame:
    """One row per product of the day with sales and revenue levels, popularity and margin."""
    return product_rows(_product_rows(products, orders, dt), F.lit(dt))


def product_rows(joined: DataFrame, day: Column) -> DataFrame:
    """Products with their statistics, labelled."""
    price = F.col("price")
    margin = F.when(price > 0, ratio(price - F.col("cost"), price, 100)).otherwise(0)
    return joined.select(
        *_product_output(),
        band(F.col("quantity_30d"), SALES_LEVEL_STEPS, "no_sales").alias("sales_level"),
        band(F.col("amount_30d"), REVENUE_STEPS, "minimal_revenue").alias("revenue_level"),
        _score(
            _zero("quantity_30d") * F.lit(0.5),
            _zero("user_count_30d") * 2,
            band(F.col("amount_30d"), PRODUCT_POINTS, 0),
        ).alias("popularity_score"),
        margin.try_cast(PERCENT).alias("profit_margin"),
        day.alias("dt"),
    )


REGION = ["province", "city"]
REGION_COUNTED = {"order": "order_id", "user": "user_id", "product": "product_id"}


def _place(orders: DataFrame, missing: str) -> DataFrame:
    return orders.withColumns({c: F.coalesce(F.col(c), F.lit(missing)) for c in REGION})


def _region_columns() -> list:
    return [
        *REGION,
        *_window_columns(REGION_COUNTED, "sales_quantity", "sales_amount"),
        F.col("first_time_30d").alias("first_order_time_30d"),
        F.col("last_time_30d").alias("last_order_time_30d"),
    ]


def region_wide_v1(orders: DataFrame, dt: str) -> DataFrame:
    """One row per (province, city) with orders in the 30 days: four tiers and an activity score."""
    stats = _window_stats(_place(orders, "unknown"), dt, REGION, REGION_COUNTED)
    return stats.select(
        *_region_columns(),
        band(F.col("amount_30d"), REGION_TIER_STEPS_V1, "tier4").alias("region_tier"),
        _score(
            F.col("user_count_30d") * F.lit(0.5),
            F.col("order_count_30d") * F.lit(0.3),
            band(F.col("amount_30d"), REGION_POINTS, 10),
        ).alias("activity_score"),
        F.lit(dt).alias("dt"),
    )


def region_wide(orders: DataFrame, dt: str) -> DataFrame:
    """One row per (province, city): five tiers, user counts, activity and new-user rates, spend per user."""
    return region_rows(_window_stats(_place(orders, "Unknown"), dt, REGION, REGION_COUNTED, with_users=True), F.lit(dt))


def region_rows(stats: DataFrame, day: Column) -> DataFrame:
    """Regions with their statistics and user counts, labelled."""

    def share(part: str) -> Column:
        return F.coalesce(ratio(F.col(part), F.col("total_user_count"), 100), F.lit(0)).cast(PERCENT)

    spend = F.coalesce(ratio(F.col("amount_30d"), F.col("user_count_30d")), F.lit(0))
    return stats.select(
        *_region_columns(),
        "total_user_count",
        "active_user_count",
        "new_user_count",
        band(F.col("amount_30d"), REGION_TIER_STEPS, "tier_5").alias("region_tier"),
        share("active_user_count").alias("user_activity_rate"),
        share("new_user_count").alias("new_user_rate"),
        spend.cast(AVERAGE).alias("avg_user_consumption"),
        day.alias("dt"),
    )


def region_users(orders: DataFrame, dt: str) -> DataFrame:
    """Users of each region in 30 days: all, active (five order rows or more) and new.

    A user is new if the first order is not before the window; with order times
    inside their own day this holds for every user.
    """
    per_user = (
        completed_orders(orders, dt)
        .groupBy(*REGION, "user_id")
        .agg(F.count("order_id").alias("order_rows"), F.min("order_time").alias("first_time"))
    )
    active, new = _user_tests(dt, F.col("order_rows"), F.col("first_time"))
    return per_user.groupBy(*REGION).agg(
        F.count("user_id").alias("total_user_count"),
        F.count(F.when(active, F.col("user_id"))).alias("active_user_count"),
        F.count(F.when(new, F.col("user_id"))).alias("new_user_count"),
    )

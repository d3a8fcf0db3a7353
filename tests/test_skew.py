"""One key holds a third of all rows: results stay whole and the work is split."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerwell.operators import enrich, summary, wide
from layerwell.operators.sequence import session_sequence
from layerwell.session import scratch_path

D = "2024-02-14"
N = 30_000


@pytest.fixture(scope="module")
def orders(spark):
    """A third of the rows belongs to user 1, product p1 and one city."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(N).select(
        (n % 9000).cast("string").alias("order_id"),
        F.when(hot, 1).otherwise(n % 500).cast("long").alias("user_id"),
        F.when(hot, "p1").otherwise(F.concat(F.lit("p"), n % 700)).alias("product_id"),
        F.when(hot, "c1").otherwise(F.concat(F.lit("c"), n % 40)).alias("category_name"),
        F.lit("b").alias("brand_name"),
        F.lit("cash").alias("payment_method"),
        F.lit(datetime(2024, 2, 1)).alias("order_time"),
        F.lit("completed").alias("order_status"),
        (n % 5).cast("int").alias("quantity"),
        (n % 10_000).cast("decimal(10,2)").alias("final_amount"),
        F.lit("P").alias("province"),
        F.when(hot, "X").otherwise("Y").alias("city"),
        F.date_format(F.date_add(F.lit("2024-01-10").cast("date"), (n % 36).cast("int")), "yyyy-MM-dd").alias("dt"),
    ).cache()


def test_wide_statistics_of_a_hot_key(spark, orders):
    stats = wide._window_stats(orders, D, ["user_id"], {"order": "order_id", "product": "product_id"})
    got = {r.user_id: r for r in stats.collect()}
    for name, first in (("1d", D), ("7d", "2024-02-08"), ("30d", "2024-01-16")):
        plain = orders.where((F.col("dt") >= first) & (F.col("dt") <= D)).groupBy("user_id").agg(
            F.count_distinct("order_id").alias("o"), F.count_distinct("product_id").alias("p"),
            F.sum("final_amount").alias("a"), F.sum("quantity").alias("q"),
        )
        for r in plain.collect():
            mine = got[r.user_id]
            assert (mine[f"order_count_{name}"], mine[f"product_count_{name}"]) == (r.o, r.p)
            assert (mine[f"amount_{name}"], mine[f"quantity_{name}"]) == (r.a, r.q)


def test_hot_key_is_spread_before_it_is_combined(orders):
    """Ids are shuffled by (user, counted id); what is shuffled by user alone is combined before."""
    stats = wide._window_stats(orders, D, ["user_id"], {"order": "order_id", "product": "product_id"})
    plan = stats._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    by_id = [i for i in exchanges if "order_id" in lines[i] and "product_id" in lines[i]]
    assert len(exchanges) == 3 and len(by_id) == 1
    assert all("HashAggregate" in lines[i + 1] and "partial_" in lines[i + 1] for i in exchanges)
    assert "SortAggregate" not in plan and "collect_" not in plan


def test_preference_ranks_before_the_shuffle(orders):
    plan = wide.user_preference(orders, D)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_session_is_numbered_in_slices(spark):
    n = F.col("id")
    events = spark.range(N).select(
        F.when(n % 3 == 0, "hot").otherwise((n % 50).cast("string")).alias("user_id"),
        F.when(n % 3 == 0, "s").otherwise((n % 4).cast("string")).alias("session_id"),
        n.cast("string").alias("event_id"),
        (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(secs=(n * 7919) % 4000)).alias("event_time"),
    )
    got = session_sequence(events, slices=16)
    w = Window.partitionBy("user_id", "session_id").orderBy("event_time", "event_id")
    want = events.withColumns({"seq": F.row_number().over(w).cast("bigint"), "prev_time": F.lag("event_time").over(w)})
    assert got.count() == N
    assert got.exceptAll(want).isEmpty()
    ranged = events.repartitionByRange(16, "user_id", "session_id", "event_time", "event_id")
    slices = ranged.where("user_id = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert slices > 3


@pytest.fixture()
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_fact_join_splits_a_hot_customer(spark, small_skew_limits):
    n = F.col("id")
    orders = spark.range(N).select(
        n.alias("order_id"), n.cast("string").alias("order_no"),
        F.when(n % 3 == 0, 1).otherwise(n % 5000).alias("customer_id"),
        F.lit(D).cast("date").alias("order_date"), n.cast("decimal(15,2)").alias("order_amount"),
        F.lit("USD").alias("currency"), F.uuid().alias("order_status"), F.uuid().alias("payment_method"), F.lit(D).alias("dt"),
    )
    stored = scratch_path(spark, "skew")
    orders.write.parquet(stored)
    dim = spark.range(5000).select(n.alias("customer_id"), n.alias("customer_sk"), F.lit(D).alias("dt"))
    fact = enrich.order_fact(spark.read.parquet(stored), dim)
    out = scratch_path(spark, f"skew-{uuid.uuid4().hex}")
    fact.collect()
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "skew=true" in plan
    fact.write.parquet(out)
    assert spark.read.parquet(out).where("customer_sk IS NULL").isEmpty()
    assert spark.read.parquet(out).count() == N


def test_summary_combines_orders_before_the_join(spark):
    n = F.col("id")
    fact = spark.range(N).select(
        (n % 7).alias("customer_id"), n.alias("order_id"), n.cast("decimal(15,2)").alias("order_amount_usd"),
        F.lit(D).cast("date").alias("order_date"), F.lit(D).alias("dt"),
    )
    dim = spark.range(7).select(
        n.alias("customer_id"), F.lit("n").alias("customer_name"), F.lit("t").alias("customer_type"), F.lit(D).alias("dt")
    )
    plan = summary.customer_summary(fact, dim, D)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join Inner" in line)
    assert not any("Aggregate" in line for line in plan[:join])
    assert any("Aggregate" in line for line in plan[join:])

"""Time the headline queries on layer tables built from ``$BENCH_SF_DIR``.

The layer tables are written first, untimed, as a daily run finds them. Each query
runs ``$BENCH_RUNS`` times in the warm session and the best time counts. Prints one
JSON line. With ``BENCH_COMPARE=1`` the same results are also computed the usual
way (one scan per window, one job per column) and a second JSON line gives those
times.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from layerwell.fixtures import RUN_DATE, fixture  # noqa: E402
from layerwell.functions.columns import day_shift  # noqa: E402
from layerwell.operators import clean, enrich, quality, summary, wide  # noqa: E402
from layerwell.operators.sequence import session_sequence  # noqa: E402
from layerwell.session import scratch_path  # noqa: E402
from layerwell.streaming.layers import enrich_events, user_metrics  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
D = RUN_DATE


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def best(make) -> float:
    """Best of the warm runs; the first run also compiles the plan."""
    return round(min(timed(lambda: consume(make())) for _ in range(RUNS)), 3)


def cleaning(spark: SparkSession) -> dict:
    fix = lambda name: fixture(spark, SF_DIR, name)
    return {
        "clean_orders": lambda: clean.clean_orders(fix("ods_order_info")),
        "clean_users": lambda: clean.clean_users(fix("ods_user_info")),
        "clean_products": lambda: clean.clean_products(fix("ods_product_info")),
    }


def prepare(spark: SparkSession, folder: str) -> None:
    """Write the tables the other queries read."""
    steps = {
        **cleaning(spark),
        "dim_customer": lambda: enrich.customer_dim(fixture(spark, SF_DIR, "ods_customer")),
        "events": lambda: fixture(spark, SF_DIR, "ods_events"),
    }
    for name, make in steps.items():
        make().write.parquet(f"{folder}/{name}")


def headline(spark: SparkSession, folder: str) -> dict:
    table = lambda name: spark.read.parquet(f"{folder}/{name}")
    orders, users, products = (lambda n=n: table(n) for n in ("clean_orders", "clean_users", "clean_products"))
    fix = lambda name: fixture(spark, SF_DIR, name)
    statics = lambda: [fix(n) for n in ("user_profiles", "product_catalog", "ip_ranges")]
    octets = [F.shiftright("ip_num", shift).bitwiseAND(255).cast("string") for shift in (24, 16, 8, 0)]
    events = lambda: table("events").withColumn("ip_address", F.concat_ws(".", *octets))
    enriched = lambda: enrich_events(events(), *statics(), D)
    return {
        "user_wide": lambda: wide.user_wide(users(), orders(), D),
        "user_preference": lambda: wide.user_preference(orders(), D),
        "product_wide": lambda: wide.product_wide(products(), orders(), D),
        "region_wide": lambda: wide.region_wide(orders(), D),
        "region_users": lambda: wide.region_users(orders(), D),
        "quality_gate": lambda: quality.quality_gate(orders(), "dwd_order_info", ["order_id", "product_id"]),
        "column_profile": lambda: quality.column_profile(users()),
        "customer_summary": lambda: summary.customer_summary(
            enrich.order_fact(fix("ods_order"), table("dim_customer")), table("dim_customer"), D
        ),
        "user_metrics": lambda: user_metrics(enriched()),
        "session_sequence": lambda: session_sequence(
            table("events").select("event_id", "user_id", "session_id", "event_time")
        ),
    }


def usual_way(spark: SparkSession, folder: str) -> dict:
    """The same results with one aggregate per window and one count per column."""
    table = lambda name: spark.read.parquet(f"{folder}/{name}")

    def windows(keys, distinct):
        out = None
        for days in (1, 7, 30):
            rows = table("clean_orders").where(
                (F.col("dt") >= day_shift(D, 1 - days)) & (F.col("dt") <= D) & (F.col("order_status") == "completed")
            )
            stats = rows.groupBy(*keys).agg(
                *(F.count_distinct(c).alias(f"{c}_{days}d") for c in distinct),
                F.sum("final_amount").alias(f"amount_{days}d"),
                F.avg("final_amount").alias(f"average_{days}d"),
                F.sum("quantity").alias(f"quantity_{days}d"),
                F.min("order_time").alias(f"first_{days}d"),
                F.max("order_time").alias(f"last_{days}d"),
            )
            out = stats if out is None else out.join(stats, keys, "full_outer")
        return out

    def gate():
        df = table("clean_orders")
        counts = [
            df.where(F.col(c).isNull() | (F.col(c).cast("string").isin("", "null"))).agg(F.count("*").alias("n"))
            for c in df.columns
        ]
        counts.append(df.dropDuplicates(["order_id", "product_id"]).agg(F.count("*").alias("n")))
        return reduce(DataFrame.unionByName, counts)

    def profile():
        df = table("clean_users")
        return reduce(
            DataFrame.unionByName, [df.select(c).distinct().agg(F.count("*").alias("n")) for c in df.columns]
        )

    return {
        "user_wide": lambda: table("clean_users")
        .join(windows(["user_id"], ["order_id", "product_id"]), "user_id", "left")
        .join(wide.user_preference(table("clean_orders"), D), "user_id", "left"),
        "product_wide": lambda: table("clean_products").join(
            windows(["product_id"], ["order_id", "user_id"]), "product_id", "left"
        ),
        "region_wide": lambda: windows(["province", "city"], ["order_id", "user_id", "product_id"]).join(
            wide.region_users(table("clean_orders"), D), ["province", "city"], "left"
        ),
        "quality_gate": gate,
        "column_profile": profile,
    }


def main() -> None:
    spark = session()
    folder = scratch_path(spark, "bench")
    prepare(spark, folder)
    others = usual_way(spark, folder) if os.environ.get("BENCH_COMPARE") else {}
    seconds, usual = {}, {}
    for name, make in {**cleaning(spark), **headline(spark, folder)}.items():
        seconds[name] = best(make)
        if name in others:
            usual[name] = best(others[name])
    report = {
        "metric": "headline queries, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    print(json.dumps(report))
    if usual:
        print(json.dumps({"metric": "same results, one scan per window and column", "unit": "sec", "queries": usual}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Bronze, silver and gold steps. Each works on a batch frame and on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerwell.functions import age_years, clean_phone, ip_number, ip_region
from layerwell.operators.sequence import SESSION_KEYS, session_sequence
from layerwell.sources.events import decode_events
from layerwell.streaming.writers import Sink, Trigger, fan_out, replace_rows, start_append

# Watermark, window and triggers.
WATERMARK = "10 minutes"
WINDOW = "5 minutes"
RECENCY = "1 hour"
BRONZE_TRIGGER: Trigger = {"processingTime": "30 seconds"}
MINUTE_TRIGGER: Trigger = {"processingTime": "1 minute"}
BRONZE_PARTITIONS = ("event_date",)
SILVER_PARTITIONS = ("date", "user_segment")
GOLD_PARTITIONS = ("window_date",)
GOLD_MATCH = ("window_start", "user_id", "user_region")


def clean_events(df: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Events with id, user and time and a non-negative or missing amount, each id once.

    On a stream, repeats are recognised within the watermark, which bounds the state.
    """
    valid = (
        F.col("event_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("event_time").isNotNull()
        & (F.col("amount").isNull() | (F.col("amount") >= 0))
    )
    rows = df.where(valid)
    if not df.isStreaming:
        # Of rows with one id the earliest stays, then the smallest, so a rerun keeps the same one.
        order = ["event_time", *(c for c, kind in df.dtypes if c != "event_time" and not kind.startswith("map"))]
        row = F.struct(*df.columns)
        return rows.groupBy("event_id").agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")
    return rows.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_id"])


def ingest_bronze(raw: DataFrame, path: str, checkpoint: str, trigger: Trigger = BRONZE_TRIGGER) -> StreamingQuery:
    """Decode, clean and append broker records by day of the event."""
    events = clean_events(decode_events(raw)).withColumn("event_date", F.date_format("event_time", "yyyy-MM-dd"))
    return start_append(events, path, checkpoint, trigger, BRONZE_PARTITIONS)


def recent(df: DataFrame, as_of: str, span: str = RECENCY) -> DataFrame:
    """Events not older than the span before a point in time; the bound is a constant the scan can use."""
    bound = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {span}")
    return df.where(F.col("event_time") >= bound)


def enrich_events(
    events: DataFrame, profiles: DataFrame, catalog: DataFrame, ip_ranges: DataFrame, as_of: str
) -> DataFrame:
    """Left join user profile, product category and the region of the IP address; all three are static.

    Spark broadcasts a static side that is below the session's size threshold
    and shuffles it otherwise.
    """
    people = profiles.select(
        "user_id",
        "user_segment",
        clean_phone(F.col("phone")).alias("clean_phone"),
        age_years(F.col("birth_date"), F.lit(as_of).cast("date")).alias("user_age"),
    )
    goods = catalog.select("product_id", F.col("category").alias("product_category"))
    joined = events.join(people, "user_id", "left").join(goods, "product_id", "left")
    joined = joined.withColumn("_ip", ip_number(F.col("ip_address")))
    return ip_region(joined, ip_ranges, "_ip").drop("_ip").withColumn("date", F.date_format("event_time", "yyyy-MM-dd"))


def write_silver(df: DataFrame, path: str, checkpoint: str, trigger: Trigger = MINUTE_TRIGGER) -> StreamingQuery:
    """Append enriched events by date and user segment."""
    return start_append(df, path, checkpoint, trigger, SILVER_PARTITIONS)


def write_sequenced_silver(
    stream: DataFrame,
    bronze,
    path: str,
    checkpoint: str,
    trigger: Trigger = MINUTE_TRIGGER,
    keys: Sequence[str] = SESSION_KEYS,
) -> StreamingQuery:
    """Silver with event numbers per session.

    Numbers depend on all events of a session, late ones included, so each
    micro-batch recomputes the sessions it touches from bronze and replaces
    their rows. ``bronze`` is a function giving the enriched bronze events as a
    batch frame.
    """

    def rebuild(batch: DataFrame, name: str) -> None:
        touched = batch.select(*keys).distinct()
        sessions = bronze().join(touched, list(keys), "left_semi")
        replace_rows(session_sequence(sessions, tuple(keys)), path, keys, SILVER_PARTITIONS, name)

    return fan_out(stream, [rebuild], checkpoint, trigger)


def user_metrics(events: DataFrame, window: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """Events and purchase revenue per user, region and tumbling window."""
    if events.isStreaming:
        events = events.withWatermark("event_time", watermark)
    revenue = F.when(F.col("event_type") == "purchase", F.col("amount")).otherwise(0.0)
    return events.groupBy("user_id", "user_region", F.window("event_time", window).alias("time_win")).agg(
        F.count("*").alias("event_count"), F.sum(revenue).alias("total_revenue")
    )


def flat_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics with plain window columns, partitioned by the window's day."""
    return metrics.select(
        "user_id",
        "user_region",
        F.col("time_win.start").alias("window_start"),
        F.col("time_win.end").alias("window_end"),
        "event_count",
        "total_revenue",
        F.date_format("time_win.start", "yyyy-MM-dd").alias("window_date"),
    )


def gold_table_sink(path: str) -> Sink:
    """Sink that keeps one row per window, user and region."""

    def put(batch: DataFrame, name: str) -> None:
        replace_rows(flat_metrics(batch), path, GOLD_MATCH, GOLD_PARTITIONS, name)

    return put


def write_gold(
    metrics: DataFrame, sinks: Sequence[Sink], checkpoint: str, trigger: Trigger = MINUTE_TRIGGER
) -> StreamingQuery:
    """Send changed windows to all sinks."""
    return fan_out(metrics, sinks, checkpoint, trigger, "update")

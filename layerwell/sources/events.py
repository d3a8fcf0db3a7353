"""Event streams: Kafka JSON and table directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed schema of the JSON events.
EVENT_SCHEMA = (
    T.StructType()
    .add("event_id", "string")
    .add("user_id", "string")
    .add("session_id", "string")
    .add("event_type", "string")
    .add("event_time", "timestamp")
    .add("product_id", "string")
    .add("amount", "double")
    .add("ip_address", "string")
    .add("user_agent", "string")
    .add("properties", T.MapType(T.StringType(), T.StringType()))
)


def kafka_events(
    spark: SparkSession, servers: str, topic: str, offsets: str = "earliest", max_per_trigger: int | None = None
) -> DataFrame:
    """Typed events of a topic; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return decode_events(reader.load())


def decode_events(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Decode ``value`` as a JSON event and keep the broker ``timestamp``; malformed JSON gives null fields."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return raw.select(parsed.alias("data"), F.col("timestamp").alias("kafka_timestamp")).select(
        "data.*", "kafka_timestamp"
    )


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Stream the files added to a table directory (Delta too where its connector exists)."""
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)

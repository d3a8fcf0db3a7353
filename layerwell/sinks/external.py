"""Writes to stores outside the warehouse: JDBC, a sampled index feed, key-value pairs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
METRICS_SUFFIX = "metrics"
SAMPLE_SHARE = 0.1
HOT_REVENUE = 1000
SAMPLE_BUCKETS = 10_000
BATCH_COLUMN = "batch_name"


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace struct columns by their fields, which relational stores can hold."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            columns += [F.col(f"{f.name}.{sub}").alias(f"{f.name}_{sub}") for sub in f.dataType.names]
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def append_jdbc(
    df: DataFrame, url: str, table: str, options: dict[str, str] | None = None, batch: str | None = None
) -> bool:
    """Append to a relational table; only tables named ``*metrics`` are written.

    With a batch name the rows carry it in ``batch_name``, and rows of an earlier
    attempt are deleted first, so a repeated batch does not double them.
    """
    if not table.endswith(METRICS_SUFFIX):
        return False
    rows = flatten_window(df)
    if batch is not None:
        delete_batch(df.sparkSession, url, table, batch, options)
        rows = rows.withColumn(BATCH_COLUMN, F.lit(batch))
    rows.write.format("jdbc").options(url=url, dbtable=table, **(options or {})).mode("append").save()
    return True


def delete_statement(table: str) -> str:
    """Parameterised statement that removes the rows of one batch; the table name is checked, not quoted."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_.]*", table):
        raise ValueError(f"not a table name: {table}")
    return f"DELETE FROM {table} WHERE {BATCH_COLUMN} = ?"


def delete_batch(spark: SparkSession, url: str, table: str, batch: str, options: dict[str, str] | None = None) -> None:
    """Delete a batch's rows, if the table exists, over one connection of the driver."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for name, value in (options or {}).items():
        settings.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        if connection.getMetaData().getTables(None, None, table.rpartition(".")[2], None).next():
            statement = connection.prepareStatement(delete_statement(table))
            statement.setString(1, batch)
            statement.executeUpdate()
    finally:
        connection.close()


def sample_rows(df: DataFrame, key: list[str], fraction: float = SAMPLE_SHARE) -> DataFrame:
    """Rows whose key hash falls in the fraction; a key is always in or always out."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key)))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SAMPLE_BUCKETS
    return df.where(bucket < int(fraction * SAMPLE_BUCKETS))


def sample_to(
    df: DataFrame, key: list[str], writer: Callable[[DataFrame], None], fraction: float = SAMPLE_SHARE
) -> None:
    """Send the sample to any writer, for example a search index."""
    writer(sample_rows(df, key, fraction))


def hot_users(df: DataFrame, threshold: float = HOT_REVENUE) -> DataFrame:
    """Users of the metrics whose revenue exceeds the threshold."""
    return df.where(F.col("total_revenue") > threshold).select("user_id", "total_revenue")


def export_kv(df: DataFrame, put_all: Callable[[Iterable[tuple[str, str]]], None]) -> None:
    """Hand each partition's (key, value) pairs to one writer call, which opens one client."""
    key, value = df.columns[:2]
    pairs = df.select(F.col(key).cast("string"), F.col(value).cast("string"))
    pairs.foreachPartition(lambda rows: put_all((r[0], r[1]) for r in rows))

"""Columns every layer adds: audit times, load metadata, surrogate keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_etl_columns(df: DataFrame, batch_id: str, at: datetime) -> DataFrame:
    """Creation time, update time and batch id. Both are arguments, so a rerun repeats its rows."""
    return df.withColumns(
        {"etl_create_time": F.lit(at), "etl_update_time": F.lit(at), "etl_batch_id": F.lit(batch_id)}
    )


def add_load_metadata(df: DataFrame, dt: str, at: datetime, source: str) -> DataFrame:
    """Load day, load time and name of the source system."""
    return df.withColumns({"etl_date": F.lit(dt), "etl_timestamp": F.lit(at), "data_source": F.lit(source)})


def add_surrogate_key(df: DataFrame, key_cols: list[str], name: str) -> DataFrame:
    """64-bit key computed from the business key, equal in every run and partition.

    One bigint key column maps one-to-one; text or several columns may collide
    with the odds of a 64-bit hash.
    """
    return df.withColumn(name, F.xxhash64(*key_cols))


def stamp(df: DataFrame, loaded_at: datetime | None, *names: str) -> DataFrame:
    """Set load-time columns; none are added without a time."""
    if loaded_at is None:
        return df
    return df.withColumns({name: F.lit(loaded_at) for name in names})

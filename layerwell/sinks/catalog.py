"""Databases, tables, statistics and partition maintenance."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwell.functions.columns import day_shift
from layerwell.specs import TableSpec

# Fixed value: days a partition is kept.
RETENTION_DAYS = 90


def create_databases(spark: SparkSession, names: Iterable[str], location: str | None = None) -> None:
    """Create databases, optionally each below a given folder."""
    for name in names:
        at = f" LOCATION '{location.rstrip('/')}/{name}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")


def create_tables(spark: SparkSession, specs: Iterable[TableSpec]) -> None:
    """Create partitioned Parquet tables from their specs.

    The overwrite mode is an option of the table: an insert then replaces only the
    partitions it brings, whatever the session says, and concurrent inserts cannot
    disturb each other through a session setting.
    """
    for spec in specs:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {spec.qualified} ({columns}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({', '.join(spec.partition_by)})"
        )


def replaces_partitions_only(spark: SparkSession, table: str) -> bool:
    """Does the table carry the overwrite option its specs are created with?"""
    stored = describe_table(spark, table).where("col_name = 'Storage Properties'").first()
    return stored is not None and "partitionoverwritemode=dynamic" in stored.data_type.lower()


def analyze_table(spark: SparkSession, table: str) -> None:
    """Compute table and column statistics for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def repair_table(spark: SparkSession, table: str) -> None:
    """Register partitions found on storage."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {table}")


def partitions(spark: SparkSession, table: str, column: str = "dt") -> list[str]:
    """Values of the first partition column, ascending. One entry per day, so the list stays small."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    prefix = f"{column}="
    values = {part[len(prefix):] for r in rows for part in r.partition.split("/") if part.startswith(prefix)}
    return sorted(values)


def compact_partition(spark: SparkSession, spec: TableSpec, dt: str, files: int | None = None) -> tuple[int, int]:
    """Rewrite the small files of one day through a staging table; returns files before and after.

    The day is replaced only after the staged copy has the same number of rows,
    and the staging table is dropped only after the replaced day has it too.
    """
    from layerwell.sinks.tables import overwrite_partition

    day = spark.table(spec.qualified).where(F.col("dt") == dt)
    staging = TableSpec(**{**spec.__dict__, "name": f"{spec.name}_compact_{dt.replace('-', '')}"})
    rows_before, files_before = _rows_and_files(day)
    spark.sql(f"DROP TABLE IF EXISTS {staging.qualified}")
    overwrite_partition(day.hint("rebalance") if files is None else day.repartition(files), staging, dt)
    staged = spark.table(staging.qualified).where(F.col("dt") == dt)
    if staged.count() != rows_before:
        raise RuntimeError(f"{spec.qualified} {dt}: staged copy differs, partition left as it was")
    overwrite_partition(staged, spec, dt)
    rows_after, files_after = _rows_and_files(spark.table(spec.qualified).where(F.col("dt") == dt))
    if rows_after != rows_before:
        raise RuntimeError(f"{spec.qualified} {dt}: row count changed, copy kept in {staging.qualified}")
    spark.sql(f"DROP TABLE {staging.qualified}")
    return files_before, files_after


def _rows_and_files(df: DataFrame) -> tuple[int, int]:
    per_file = df.select(F.input_file_name().alias("file")).groupBy("file").agg(F.count("*").alias("n"))
    row = per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("f")).first()
    return row.n, row.f


def clear_layers(spark: SparkSession, layers: Iterable[str], specs: dict[str, TableSpec]) -> list[str]:
    """Drop the tables of the chosen layers."""
    wanted = set(layers)
    dropped = [spec.qualified for spec in specs.values() if spec.layer in wanted]
    for table in dropped:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return dropped


def drop_expired(spark: SparkSession, table: str, today: str, keep_days: int = RETENTION_DAYS) -> list[str]:
    """Drop day partitions older than the retention; returns the dropped days."""
    oldest = day_shift(today, -keep_days)
    expired = [dt for dt in partitions(spark, table) if dt < oldest]
    for dt in expired:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (dt = '{dt}')")
    return expired

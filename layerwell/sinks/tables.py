"""Writes to layer tables and path tables. A write never touches other partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from layerwell.sinks.catalog import create_tables, replaces_partitions_only
from layerwell.specs import TableSpec


def conform(df: DataFrame, spec: TableSpec, fill_missing: bool = False) -> DataFrame:
    """Project a frame to the table's schema; a missing column or other type is an error.

    ``fill_missing`` writes nulls for columns the source does not deliver.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in spec.schema.fields:
        if f.name not in have:
            if not fill_missing:
                raise ValueError(f"{spec.qualified}: column {f.name} is missing")
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        if have[f.name].simpleString() != f.dataType.simpleString():
            raise ValueError(
                f"{spec.qualified}.{f.name}: {have[f.name].simpleString()} is not {f.dataType.simpleString()}"
            )
        columns.append(F.col(f.name))
    return df.select(*columns)


def overwrite_partition(df: DataFrame, spec: TableSpec, dt: str, fill_missing: bool = False) -> int:
    """Replace the rows of one date, also by nothing, and return their number.

    Rows of another date are an error. New files are staged and swapped in when
    the job is complete, so a failed job leaves the old rows in place.
    """
    if spec.partition_by != ("dt",):
        raise ValueError("use overwrite_partitions for other partition columns")
    day = F.lit(dt)
    if "dt" in df.columns:
        outside = F.concat(F.lit(f"{spec.qualified}: row outside partition {dt}: "), F.coalesce("dt", F.lit("null")))
        day = F.when(F.col("dt") == dt, F.col("dt")).otherwise(F.raise_error(outside))
    rows = _insert(conform(df.withColumn("dt", day), spec, fill_missing), spec)
    if rows == 0:
        # Without rows the insert does not see the partition.
        df.sparkSession.sql(f"ALTER TABLE {spec.qualified} DROP IF EXISTS PARTITION (dt = '{dt}')")
    return rows


def overwrite_partitions(df: DataFrame, spec: TableSpec, fill_missing: bool = False, gather: bool = True) -> int:
    """Replace every partition that occurs in the frame, keep all others; returns the rows written.

    Rows are gathered by partition first, so a task writes few files; Spark
    splits partitions that are large. Without ``gather`` rows are written by the tasks they are in,
    for frames whose tasks hold few partitions each: rows read by partition, or shuffled by it already.
    """
    rows = conform(df, spec, fill_missing)
    return _insert(rows.hint("rebalance", *spec.partition_by) if gather else rows, spec)


def _insert(rows: DataFrame, spec: TableSpec) -> int:
    spark = rows.sparkSession
    create_tables(spark, [spec])
    if not replaces_partitions_only(spark, spec.qualified):
        raise ValueError(f"{spec.qualified} was created elsewhere; an overwrite would drop its other partitions")
    written = Observation()
    rows.observe(written, F.count(F.lit(1)).alias("rows")).write.insertInto(spec.qualified, overwrite=True)
    return written.get["rows"]


def write_path(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: tuple[str, ...] = (),
    rebalance: bool = True,
) -> None:
    """Write to a directory in a chosen format; overwriting keeps partitions not in the frame.

    Without ``rebalance`` rows are written by the tasks they are in.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode.lower())
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def land_ods(df: DataFrame, spec: TableSpec, dt: str, max_files: int | None = None) -> int:
    """Land raw rows of a day, filling columns the source lacks with nulls.

    Each read task writes one file, without a shuffle. ``max_files`` bounds the
    number of files; the read keeps its own tasks.
    """
    return overwrite_partition(df if max_files is None else df.repartition(max_files), spec, dt, fill_missing=True)


def append_quality_result(gate_rows: DataFrame, spec: TableSpec, check_date: str | None = None) -> None:
    """Add gate results to the audit table; results per day bring their ``check_date``."""
    create_tables(gate_rows.sparkSession, [spec])
    rows = conform(gate_rows if check_date is None else gate_rows.withColumn("check_date", F.lit(check_date)), spec)
    rows.write.insertInto(spec.qualified)

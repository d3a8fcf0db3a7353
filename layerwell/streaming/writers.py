"""Streaming writes: append to a table directory, fan-out, replacing rows of a path table."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerwell.session import materialize, scratch_path
from layerwell.sinks.tables import write_path

Trigger = dict[str, object]
Sink = Callable[[DataFrame, str], None]

AVAILABLE_NOW: Trigger = {"availableNow": True}
TASKS_PER_PARTITION = 16


def start_append(
    df: DataFrame, path: str, checkpoint: str, trigger: Trigger, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to a table directory, exactly once per checkpoint."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**trigger).start(path)


def fan_out(
    df: DataFrame, sinks: Sequence[Sink], checkpoint: str, trigger: Trigger, output_mode: str = "append"
) -> StreamingQuery:
    """Send each micro-batch to several sinks; the batch is computed once.

    A sink gets the batch and its name, ``<query id>/<batch id>``. A failed batch runs
    again under the same name, so sinks must replace what they wrote for it. The query
    id belongs to the checkpoint: a fresh checkpoint, or another query on the same
    target, counts its batches under another name.
    """
    spark = df.sparkSession
    query: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not query:
            query.append(query_id(spark, checkpoint))
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, f"{query[0]}/{batch_id}")
        finally:
            batch.unpersist()

    return (
        df.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that owns a checkpoint; written before its first batch."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def append_evolving(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Append rows that may bring new columns. With a batch name a repeated batch replaces itself."""
    if batch is None:
        df.write.mode("append").parquet(path)
    else:
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch.replace('/', '-')}")


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read with the union of all columns written so far."""
    return spark.read.option("mergeSchema", True).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def replace_rows(
    rows: DataFrame, path: str, match: Sequence[str], partition_by: Sequence[str], version: str | None = None
) -> None:
    """Replace the rows of a path table that agree with the new rows on the match columns.

    The first partition column must follow from the match columns and the rows themselves
    (a day of the event time), so its range in the new rows bounds the read. Further
    partition columns may change for a key: old rows are looked for in all of them,
    leave the partition they were in, and a partition left without rows is removed.

    The merged rows are staged completely before they are published; with a
    ``version`` (a batch name) a restart finds the finished stage and publishes it
    again instead of merging into half-written partitions. Stages of the same query's
    earlier batches are removed afterwards.
    """
    spark = rows.sparkSession
    base = f"{path.rstrip('/')}__staging"
    staging = scratch_path(spark, "replace") if version is None else f"{base}/{version}"
    if not path_exists(spark, f"{staging}/rows/_SUCCESS"):
        merged, touched = rows, rows.select(*partition_by).distinct()
        if path_exists(spark, path):
            # Used several times below; computed once.
            rows = materialize(rows, "replace")
            # The table's schema is the rows' schema; partition values keep their own type.
            lead = F.col(partition_by[0])
            lowest, highest = rows.agg(F.min(lead), F.max(lead)).first()
            existing = spark.read.schema(rows.schema).parquet(path)
            # Constant bounds prune the listing; the semi-joins then pick the exact partitions.
            existing = existing.where(lead.between(lowest, highest) | lead.isNull())
            fresh = rows.select(*match).distinct()
            stale = _null_safe(existing, fresh, match, "left_semi").select(*partition_by)
            touched = materialize(rows.select(*partition_by).union(stale).distinct(), "touched")
            kept = _null_safe(existing, touched, partition_by, "left_semi")
            kept = _null_safe(kept, fresh, match, "left_anti")
            merged = kept.select(*rows.columns).unionByName(rows)
        # One partition goes to several tasks, also where adaptive execution is off (stateful streams).
        part = F.pmod(F.xxhash64(*match), F.lit(TASKS_PER_PARTITION))
        touched.write.mode("overwrite").parquet(f"{staging}/touched")
        merged.repartition(*partition_by, part).write.mode("overwrite").parquet(f"{staging}/rows")
    staged = spark.read.schema(rows.schema).parquet(f"{staging}/rows")
    write_path(staged, path, partition_by=tuple(partition_by), rebalance=False)
    touched = spark.read.schema(rows.select(*partition_by).schema).parquet(f"{staging}/touched")
    emptied = _null_safe(touched, staged.select(*partition_by).distinct(), partition_by, "left_anti")
    for partition in emptied.collect():  # partitions of one batch only
        _delete(spark, partition_path(spark, path, partition.asDict()))
    if version is not None:
        _clear_stages(spark, f"{base}/{version.rpartition('/')[0]}".rstrip("/"), version.rpartition("/")[2])


def partition_path(spark: SparkSession, path: str, values: dict[str, object]) -> str:
    """Directory of a partition, with values escaped as Spark's writer escapes them."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([path.rstrip("/"), *(escape(k, None if v is None else str(v)) for k, v in values.items())])


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _clear_stages(spark: SparkSession, folder: str, current: str) -> None:
    """Remove the stages of a query but for its current batch."""
    parent = spark._jvm.org.apache.hadoop.fs.Path(folder)
    for found in parent.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(parent):
        if found.getPath().getName() != current:
            _delete(spark, found.getPath().toString())


def _null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which null equals null."""
    other = right.select(*(F.col(c).alias(f"_other_{c}") for c in columns))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_other_{c}"))
    return left.join(other, same, how)

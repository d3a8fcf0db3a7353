"""Session helpers: shared scratch space and lineage cuts.

Nothing here starts a session or changes its settings; operators run in
whatever session the caller owns. ``settings_for`` only computes values to start
one with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

TASK_BYTES = 128 * 1024**2


def settings_for(largest_shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for a job whose largest shuffle has the given size.

    Shuffle partitions start at about 128 MB each, so a task's share fits in
    memory; the adaptive planner merges those that turn out small and splits hot
    ones, also where the split costs another shuffle.
    """
    partitions = max(cores, -(-largest_shuffle_bytes // TASK_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Where that setting is absent, a folder below the warehouse, which is shared by
    construction.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/layerwell/{label}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left on the executors' disks.

    Shuffle files are dropped when the driver has collected the plans that wrote them. A driver with a large heap may not
    collect for hours, so steps that leave large shuffles ask for it. Python lets go of a plan about a second after its last
    use, so what the job just before left may stay until the next call.
    """
    spark.sparkContext._jvm.java.lang.System.gc()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts lineage and pins values that must not change between two uses (range
    boundaries, partition ids). Survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

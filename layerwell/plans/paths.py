"""Jobs of a SQL file over path tables: read partitions, run the script, replace a partition of the output."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwell.sinks.tables import write_path
from layerwell.sources.batch import read_path_partition, run_sql_script


@dataclass(frozen=True)
class PathJob:
    """A script, the views it reads (path, and whether the load day or the whole history), and where its rows go."""

    script: str
    views: Mapping[str, tuple[str, str]]
    output: str
    partition: str = "etl_batch_date"
    fmt: str = "parquet"
    mode: str = "overwrite"


DAY, HISTORY = "day", "history"


def read_script(spark: SparkSession, path: str) -> str:
    """Text of a SQL file on any file system the session reads."""
    return spark.read.text(path, wholetext=True).first()[0]


def path_job(spark: SparkSession, job: PathJob, load_date: str, read=None) -> DataFrame | None:
    """Run a job for a day; the script names the day ``:load_date``. Returns the written partition.

    History is read up to the load day. Without rows in one of the views nothing is written and the result is None. ``read`` may
    replace how a path is read: (spark, path, day or None) to a frame.
    """
    read = read or (lambda s, path, day: read_path_partition(s, path, day, job.partition))
    views = {}
    for name, (path, span) in job.views.items():
        if span not in (DAY, HISTORY):
            raise ValueError(f"{name}: read the {DAY} or the {HISTORY}, not {span}")
        frame = read(spark, path, load_date if span == DAY else None)
        views[name] = frame if span == DAY or job.partition not in frame.columns else frame.where(F.col(job.partition) <= load_date)
    rows = run_sql_script(spark, views, job.script, {"load_date": load_date})
    if rows is None:
        return None
    write_path(rows.withColumn(job.partition, F.lit(load_date)), job.output, job.fmt, job.mode, (job.partition,))
    return read_path_partition(spark, job.output, load_date, job.partition)

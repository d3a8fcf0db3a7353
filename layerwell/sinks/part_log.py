"""What was written to every table and day: rows, keys, write times, and the version of what it was made from.

An entry is recorded by the write itself, while the rows pass through (``Observation``), so freshness, readiness, counts and
statistics read one small table and no data. The log is a Parquet folder with one file per table and day; a day that is written
again replaces its entry, and an entry is complete or absent.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerwell.operators.quality import UPSTREAM
from layerwell.sinks.tables import overwrite_partition
from layerwell.specs import TableSpec
from layerwell.streaming.writers import path_exists

ENTRY = "version string, row_count long, unique_keys long, first_write timestamp, last_write timestamp"
SCHEMA = f"{ENTRY}, table_name string, dt string"


class PartLog:
    """Entries of written parts below one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _part(self, table: str, dt: str) -> str:
        return f"{self.path}/table_name={table}/dt={dt}"

    def record(self, table: str, dt: str, rows: int, version=None, keys=None, first=None, last=None) -> None:
        entry = self.spark.createDataFrame([(version, rows, keys, first, last)], ENTRY)
        entry.coalesce(1).write.mode("overwrite").parquet(self._part(table, dt))

    def version(self, table: str, dt: str) -> str | None:
        """Version of a written part; looks at its own folder only."""
        if not path_exists(self.spark, f"{self._part(table, dt)}/_SUCCESS"):
            return None
        return self.spark.read.schema(ENTRY).parquet(self._part(table, dt)).first().version

    def entries(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def days(self, table: str) -> DataFrame:
        return self.entries().where(F.col("table_name") == table)

    def is_fresh(self, table: str, dt: str) -> bool:
        """Is the newest day with rows the expected one."""
        return self.days(table).where("row_count > 0").agg(F.max("dt")).first()[0] == dt

    def counts(self, tables: Sequence[str], dt: str) -> DataFrame:
        """Rows of a day in each table; none where nothing was written."""
        asked = self.spark.createDataFrame([(t,) for t in tables], "table_name string")
        day = self.entries().where(F.col("dt") == dt).select("table_name", "row_count")
        return asked.join(day, "table_name", "left").na.fill(0, ["row_count"])

    def layer_ready(self, layer: str, dt: str, tables: Sequence[str] | None = None) -> DataFrame:
        """Rows of the day in each table that the layer needs, and whether there are any."""
        return self.counts(tables or UPSTREAM.get(layer, ()), dt).withColumn("ready", F.col("row_count") > 0)

    def stats(self, table: str, dt: str) -> DataFrame:
        """Rows, distinct keys, first and last write time of a table's day."""
        return self.days(table).where(F.col("dt") == dt).select(
            "table_name", F.col("dt").alias("partition_date"), F.col("row_count").alias("total_records"), "unique_keys",
            F.col("first_write").alias("min_create_time"), F.col("last_write").alias("max_create_time"),
        )


def logged_overwrite(
    log: PartLog, df: DataFrame, spec: TableSpec, dt: str, version: str | None = None, keys: int | None = None, fill_missing: bool = False
) -> int:
    """Replace the rows of one day and record what was written; ``keys`` is the number of distinct keys, if known."""
    seen = Observation()
    written = F.col(spec.time_column) if spec.time_column in df.columns else F.lit(None).cast("timestamp")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.min(written).alias("first"), F.max(written).alias("last"))
    rows = overwrite_partition(counted, spec, dt, fill_missing)
    log.record(spec.name, dt, rows, version, keys, seen.get["first"], seen.get["last"])
    return rows


def backfill_log(log: PartLog, spec: TableSpec, days: Iterable[str]) -> None:
    """Entries for days that were written before the log was kept: one read of those days, grouped by key first."""
    written = F.col(spec.time_column) if spec.time_column else F.lit(None).cast("timestamp")
    chosen = list(days)
    table = log.spark.table(spec.qualified).where(F.col("dt").isin(chosen))
    keyed = table.groupBy("dt", *spec.keys).agg(F.count("*").alias("n"), F.min(written).alias("first"), F.max(written).alias("last"))
    found = keyed.groupBy("dt").agg(F.sum("n").alias("n"), F.count("*").alias("keys"), F.min("first").alias("first"), F.max("last").alias("last"))
    for r in found.collect():  # one row per day
        log.record(spec.name, r.dt, r.n, None, r["keys"], r.first, r.last)

"""Batch reads: files, layer tables, path tables, SQL scripts."""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwell.specs import TableSpec

_NAMES = threading.Lock()  # scripts of one process take turns with their view names
FILE_KINDS = ("csv", "json", "parquet")


def import_files(
    spark: SparkSession, kind: str, path: str, dt: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Read CSV (with header), JSON or Parquet from any file system and add the load day.

    Without a schema CSV and JSON are inferred, which reads the files twice;
    give one for large inputs.
    """
    kind = kind.lower()
    if kind not in FILE_KINDS:
        raise ValueError(f"unsupported file type: {kind}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        # Quotes inside a quoted value are doubled, as the format's standard has it.
        reader = reader.option("header", True).option("inferSchema", schema is None).option("escape", '"')
    return reader.format(kind).load(path).withColumn("dt", F.lit(dt))


def read_partition(spark: SparkSession, spec: TableSpec, dt: str) -> DataFrame:
    """Rows of one day of a layer table; only that partition is listed and read."""
    return spark.table(spec.qualified).where(F.col("dt") == dt)


def read_days(spark: SparkSession, spec: TableSpec, first: str, last: str) -> DataFrame:
    """Rows of a closed range of days."""
    return spark.table(spec.qualified).where(F.col("dt").between(first, last))


def read_path_partition(spark: SparkSession, path: str, dt: str | None = None, column: str = "dt") -> DataFrame:
    """One partition directory of a path table, or its whole history; the partition column stays a string."""
    if dt is not None:
        # Only this directory is listed, however long the history is.
        day = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{column}={dt}")
        return day.withColumn(column, F.lit(dt))
    return spark.read.option("basePath", path).parquet(path).withColumn(column, F.col(column).cast("string"))


def run_sql_script(
    spark: SparkSession, views: Mapping[str, DataFrame], sql: str, params: Mapping[str, object]
) -> DataFrame | None:
    """Run a script over named views with named parameters (``:load_date``).

    An empty script is an error; an empty input skips the run and returns None.
    """
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise ValueError("empty SQL script")
    if any(df.isEmpty() for df in views.values()):
        return None
    with _NAMES:
        # Views of the caller with these names come back afterwards.
        taken = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
        held = {name: spark.table(name) for name in views if name.lower() in taken}
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        try:
            # The result is analyzed here and no longer needs the names.
            return spark.sql(text, args=dict(params))
        finally:
            for name in views:
                if name in held:
                    held[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)

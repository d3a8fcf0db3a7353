"""Relational reads. The options are built apart from the read, so they can be checked without a database."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwell.functions.columns import day_shift

# Fixed value: rows fetched per round trip.
FETCH_SIZE = 10_000


def table_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a table read. Parallel reads need the column and both bounds; they only set
    the stride, rows outside still arrive."""
    options = {"url": url, "dbtable": table, "fetchsize": str(FETCH_SIZE), **extra}
    if partition_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partition column needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def increment_options(url: str, table: str, date_col: str, day: str, **extra: str) -> dict[str, str]:
    """Options that let the database filter one day, as a half-open range its index can serve."""
    query = (
        f"SELECT * FROM {table} WHERE {date_col} >= DATE '{day_shift(day, 0)}' AND {date_col} < DATE '{day_shift(day, 1)}'"
    )
    return {"url": url, "query": query, "fetchsize": str(FETCH_SIZE), **extra}


def read_jdbc(spark: SparkSession, url: str, table: str, dt: str | None = None, **options) -> DataFrame:
    """Read a table, optionally in parallel, and add the load day."""
    df = spark.read.format("jdbc").options(**table_options(url, table, **options)).load()
    return df if dt is None else df.withColumn("dt", F.lit(dt))


def read_jdbc_increment(spark: SparkSession, url: str, table: str, date_col: str, day: str, **extra: str) -> DataFrame:
    """Read the rows of one day."""
    return spark.read.format("jdbc").options(**increment_options(url, table, date_col, day, **extra)).load()


def increment_predicates(date_col: str, first: str, last: str, parts_per_day: int = 1) -> list[str]:
    """Half-open time ranges that cover the days from ``first`` to ``last``, each without overlap or gap.

    One predicate is one task and one query, which an index on the column can serve.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_.]*", date_col):
        raise ValueError(f"not a column name: {date_col}")
    if parts_per_day < 1:
        raise ValueError("a day has at least one part")
    start, end = datetime.fromisoformat(day_shift(first, 0)), datetime.fromisoformat(day_shift(last, 1))
    step = timedelta(days=1) / parts_per_day
    count = (end - start).days * parts_per_day
    edges = [start + step * i for i in range(count)] + [end]
    return [f"{date_col} >= TIMESTAMP '{a}' AND {date_col} < TIMESTAMP '{b}'" for a, b in zip(edges[:-1], edges[1:])]


def read_jdbc_increments(
    spark: SparkSession, url: str, table: str, date_col: str, first: str, last: str, parts_per_day: int = 1, **extra: str
) -> DataFrame:
    """Read the rows of a range of days, a task per time range."""
    predicates = increment_predicates(date_col, first, last, parts_per_day)
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(FETCH_SIZE), **extra})

"""Column profiles of any range of days from stored sketches: no day is read again.

Each day keeps one row per column: exact counts of rows and nulls, smallest and largest value, a HyperLogLog sketch for distinct
values and, for numbers, a KLL sketch for quantiles. Sketches merge, so a range is a union of small rows. All columns of a day
are sketched in one pass that combines in the map tasks; what is shuffled is sketches, so a hot day or value costs nothing.

With the sizes below an estimated distinct count is off by more than ``DISTINCT_ERROR``, or a quantile's rank by more than
``RANK_ERROR`` of the rows, for about one column in a hundred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwell.sinks.tables import write_path

HLL_BITS, KLL_SIZE = 13, 400
DISTINCT_ERROR, RANK_ERROR = 0.03, 0.015
_TEXT = (T.StringType, T.VarcharType, T.CharType)


def _cell(df: DataFrame, name: str) -> Column:
    """A value that the distinct sketch takes; equal cells give equal values."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.IntegerType, T.LongType, *_TEXT)):
        return F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (F.col(name) + F.lit(0.0)).cast("string")
    if isinstance(kind, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(F.struct(F.array_sort(F.map_entries(name)) if isinstance(kind, T.MapType) else F.col(name)))
    return F.col(name).cast("string")


def day_profiles(df: DataFrame, by: str = "dt") -> DataFrame:
    """One row per day and column: dt, column_name, row_count, null_count, low, high, distinct_sketch, value_sketch."""
    names = [c for c in df.columns if c != by]
    aggregates, entries = [], []
    for i, name in enumerate(names):
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        number = F.col(name).cast("double")
        aggregates += [
            F.count_if(F.col(name).isNull()).alias(f"n{i}"),
            F.hll_sketch_agg(_cell(df, name), HLL_BITS).alias(f"h{i}"),
            (F.min(number) if numeric else F.lit(None).cast("double")).alias(f"l{i}"),
            (F.max(number) if numeric else F.lit(None).cast("double")).alias(f"u{i}"),
            (F.kll_sketch_agg_double(number, KLL_SIZE) if numeric else F.lit(None).cast("binary")).alias(f"k{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"n{i}").alias("null_count"),
                F.col(f"l{i}").alias("low"), F.col(f"u{i}").alias("high"), F.col(f"h{i}").alias("distinct_sketch"),
                F.when(F.col(f"n{i}") < F.col("_rows"), F.col(f"k{i}")).alias("value_sketch"),
            )
        )
    days = df.groupBy(F.col(by).cast("string").alias("dt")).agg(F.count("*").alias("_rows"), *aggregates)
    return days.select("dt", F.inline(F.array(*entries)))


def store_profiles(df: DataFrame, path: str, by: str = "dt") -> None:
    """Profile the days of a frame and keep them; days that are there already are replaced, others stay."""
    write_path(day_profiles(df, by), path, partition_by=("dt",))


STORED = (
    "column_name string, row_count long, null_count long, low double, high double, distinct_sketch binary, value_sketch binary, dt string"
)


def profile_range(spark: SparkSession, path: str, first: str, last: str, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """Per column of a closed range of days: row_count, null_count, low, high, distinct_estimate, quantiles (of numbers)."""
    days = spark.read.schema(STORED).parquet(path).where(F.col("dt").between(first, last))
    merged = days.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
        F.kll_merge_agg_double("value_sketch").alias("values"),
    )
    asked = F.array(*(F.kll_sketch_get_quantile_double("values", F.lit(q)) for q in quantiles))
    return merged.withColumn("quantiles", F.when(F.col("low").isNotNull(), asked)).drop("values")

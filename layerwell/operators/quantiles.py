"""Exact quantiles per group by refining histograms: no sort of the values, no sketch, no set of values per group.

A quantile is the value of a rank. Each round reads the next ``DIGIT`` bits of the values that agree with what is known of the
wanted one, counts them per group, and picks the digit in which the rank falls. Counts combine in the map tasks, so a round
shuffles at most 2^DIGIT numbers per group, quantile and task, however many rows a group has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwell.session import materialize

DIGIT = 12


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, str]) -> DataFrame:
    """Keys and, per name, the smallest value of which at least the share ``quantiles[name]`` of the group's values are not larger.

    ``value`` is a whole number; nulls are left out, and a group of nulls has no row. Shares are decimal texts, as ``0.9``,
    so that ranks are exact. Null keys are a group.
    """
    rows = materialize(df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("long").alias("_value")), "values")
    low, high = rows.agg(F.min("_value"), F.max("_value")).first()
    shares = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(Decimal(q)).alias("share")) for n, q in quantiles.items()))
    wanted = rows.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_asked", F.explode(shares))
    rank = F.greatest(F.lit(1), F.ceil(F.col("_asked.share") * F.col("_n"))).cast("long")
    targets = wanted.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_asked.name").alias("_name"), rank.alias("_rank"), F.lit(0).cast("long").alias("_prefix"))
    names = [f"_{k}" for k in keys]
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.lit(True))
    rows = rows.withColumn("_value", F.col("_value") - F.lit(low if low is not None else 0))
    bits = 0 if low is None else max(1, (high - low).bit_length())
    for shift in range(DIGIT * (-(-bits // DIGIT) - 1), -1, -DIGIT):
        targets = materialize(targets, "targets")
        digit = F.shiftright("_value", shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        # Above the highest digit nothing is known yet; a shift by all 64 bits would be none.
        agrees = F.shiftright("_value", shift + DIGIT) == F.col("_prefix") if shift + DIGIT < 64 else F.lit(True)
        counted = rows.join(targets, same & agrees).groupBy(*names, "_name", "_rank", "_prefix", digit.alias("_digit")).agg(F.count("*").alias("_n"))
        order = Window.partitionBy(*names, "_name").orderBy("_digit")
        counted = counted.withColumn("_upto", F.sum("_n").over(order))
        here = (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))
        targets = counted.where(here).select(
            *names, "_name", (F.col("_rank") - (F.col("_upto") - F.col("_n"))).alias("_rank"),
            F.shiftleft("_prefix", DIGIT).bitwiseOR(F.col("_digit")).alias("_prefix"),
        )
    found = (F.col("_prefix") + F.lit(low if low is not None else 0)).cast("long")
    picked = [F.max(F.when(F.col("_name") == n, found)).alias(n) for n in quantiles]
    return targets.groupBy(*names).agg(*picked).select(*(F.col(f"_{k}").alias(k) for k in keys), *quantiles)

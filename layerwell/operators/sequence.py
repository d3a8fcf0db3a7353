"""Position and predecessor of each event within its session."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwell.session import materialize

SESSION_KEYS = ("user_id", "session_id")
EVENT_ORDER = ("event_time", "event_id")


def session_sequence(
    df: DataFrame,
    keys: tuple[str, ...] = SESSION_KEYS,
    order: tuple[str, ...] = EVENT_ORDER,
    slices: int | None = None,
) -> DataFrame:
    """Add ``seq`` (1-based) and ``prev_time`` (previous event time) within each session.

    A plain window would put a whole session into one task. Here the rows are
    range-partitioned by session and time, so a long session is cut into several
    slices; numbers are given per slice and shifted by what came before. Only
    the first session of a slice can continue one from an earlier slice, so the
    table of shifts has at most one row per slice and is safe to broadcast.
    """
    time = order[0]
    ranged = df.repartitionByRange(*([slices] if slices else []), *keys, *order)
    # Written once: the slice of a row must be the same for numbering and for shifting.
    rows = materialize(ranged.withColumn("_slice", F.spark_partition_id()), "sequence")

    in_slice = Window.partitionBy("_slice", *keys).orderBy(*order)
    numbered = rows.withColumns(
        {"_seq": F.row_number().over(in_slice), "_prev": F.lag(time).over(in_slice)}
    )

    along = Window.partitionBy(*keys).orderBy("_slice")
    shifts = (
        rows.groupBy("_slice", *keys)
        .agg(F.count("*").alias("_rows"), F.max(time).alias("_last"))
        .withColumns(
            {
                "_before": F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1)),
                "_carried": F.lag("_last").over(along),
            }
        )
        .where("_before > 0")
        .select(
            F.col("_slice").alias("_shift_slice"),
            *(F.col(k).alias(f"_shift_{k}") for k in keys),
            "_before",
            "_carried",
        )
    )
    same = F.col("_slice") == F.col("_shift_slice")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_shift_{k}"))
    return numbered.join(F.broadcast(shifts), same, "left").select(
        *df.columns,
        (F.col("_seq") + F.coalesce("_before", F.lit(0))).alias("seq"),
        F.coalesce("_prev", "_carried").alias("prev_time"),
    )

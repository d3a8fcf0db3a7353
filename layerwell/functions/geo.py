"""Region of an IP number, as a bucketed range join."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The painting travels with its task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# 2^16 addresses per bucket: disjoint ranges over the 2^32 addresses spread to
# at most 65,536 bucket rows plus one per range.
BUCKET_BITS = 16


def ip_number(address: Column) -> Column:
    """IPv4 text as a number; null if it is not four numbers of 0-255."""
    octets = F.transform(F.split(address, r"\."), lambda x: x.try_cast("int"))
    valid = (F.size(octets) == 4) & F.forall(octets, lambda x: F.coalesce(x.between(0, 255), F.lit(False)))
    number = F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, x: acc * 256 + x)
    return F.when(valid, number)


def ip_region(df: DataFrame, ip_ranges: DataFrame, ip_col: str = "ip_num", out: str = "user_region") -> DataFrame:
    """Left join each row to the disjoint range ``[ip_from, ip_to]`` holding its IP number.

    Ranges that overlap are made disjoint by ``most_specific`` first.

    Ranges are cut at bucket borders so the join has an equality on the bucket
    and never compares every row with every range.
    """
    buckets = ip_ranges.select(
        F.explode(
            F.sequence(F.shiftright("ip_from", BUCKET_BITS), F.shiftright("ip_to", BUCKET_BITS))
        ).alias("_bucket"),
        F.col("ip_from").alias("_from"),
        F.col("ip_to").alias("_to"),
        F.col("region").alias(out),
    )
    rows = df.withColumn("_bucket_of_row", F.shiftright(F.col(ip_col), BUCKET_BITS))
    inside = (
        (F.col("_bucket_of_row") == F.col("_bucket"))
        & (F.col(ip_col) >= F.col("_from"))
        & (F.col(ip_col) <= F.col("_to"))
    )
    return rows.join(buckets, inside, "left").drop("_bucket_of_row", "_bucket", "_from", "_to")


def most_specific(ip_ranges: DataFrame) -> DataFrame:
    """Disjoint ranges from overlapping ones: each address gets the region of the narrowest range that holds it.

    Of ranges of one width the one that starts first wins, then the smaller name. The ranges are cut at bucket borders. Of
    those that cover a whole bucket only the narrowest counts; most buckets have no other. Where ranges start or end inside a bucket,
    its 2^16 addresses are painted from the widest range to the narrowest, and equal neighbours are joined again.
    """
    size = 1 << BUCKET_BITS
    ranges = ip_ranges.where("ip_from <= ip_to").select(
        F.col("ip_from").cast("long").alias("ip_from"), F.col("ip_to").cast("long").alias("ip_to"), F.col("region").cast("string").alias("region")
    ).distinct()
    bucket = F.explode(F.sequence(F.shiftright("ip_from", BUCKET_BITS), F.shiftright("ip_to", BUCKET_BITS)))
    first = F.shiftleft("bucket", BUCKET_BITS)
    cut = ranges.withColumn("bucket", bucket).withColumns({"first": first, "last": first + (size - 1)})
    one = F.struct((F.col("ip_to") - F.col("ip_from")).alias("width"), "ip_from", F.col("region").isNull().alias("no_name"), "region", "ip_to")
    whole = (F.col("ip_from") <= F.col("first")) & (F.col("ip_to") >= F.col("last"))
    held = cut.groupBy("bucket", "first", "last").agg(F.min(F.when(whole, one)).alias("base"), F.collect_list(F.when(~whole, one)).alias("parts"))

    def paint(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for start, base, parts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                order = sorted([*([base] if base else []), *parts], key=lambda r: (r["width"], r["ip_from"], r["no_name"], r["region"] or ""))
                cells = np.full(size, -1, np.int64)
                for i in reversed(range(len(order))):
                    cells[max(0, order[i]["ip_from"] - start) : order[i]["ip_to"] - start + 1] = i
                cuts = np.flatnonzero(np.diff(cells, prepend=-2))
                ends = np.append(cuts[1:], size) - 1
                out += [(start + int(a), start + int(b), order[cells[a]]["region"]) for a, b in zip(cuts, ends) if cells[a] >= 0]
            columns = list(zip(*out)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["ip_from", "ip_to", "region"])

    plain = held.where(F.size("parts") == 0).select(F.col("first").alias("ip_from"), F.col("last").alias("ip_to"), "base.region")
    edged = held.where(F.size("parts") > 0).select("first", "base", "parts")
    return plain.unionByName(edged.mapInArrow(paint, "ip_from long, ip_to long, region string"))

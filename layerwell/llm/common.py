"""Column expressions and distributed running totals shared by the operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` is the same on pure ASCII and much faster."""
    is_ascii = F.octet_length(text) == F.length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def running_totals(
    df: DataFrame, group: list[str], slice_col: str, order: list[str], value: str, per_group: DataFrame | None = None
) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the group's rows that come earlier in (slice, order).

    A group is cut into slices, each summed on its own and shifted by the slices
    before it, so that no task needs a whole group. ``per_group`` adds columns of
    one row per group; it is joined to the slices, not to the rows, because rows of
    a hot group would meet in one task. Group columns must not be null.
    """
    keys = [*group, slice_col]
    earlier = Window.partitionBy(*group).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    offsets = offsets.withColumn("_offset", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    if per_group is not None:
        offsets = offsets.join(per_group, group)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(offsets, keys).withColumn("before", F.col("_inside") + F.col("_offset")).drop("_inside", "_offset")


BITS_PER_KEY = 16
MAX_FILTER_BITS = 1 << 26


def filter_bits(keys: int) -> int:
    """Size of a Bloom filter: a power of two with 16 bits per key, at most ``MAX_FILTER_BITS``.

    More keys share the largest filter: more false positives, which later steps sort
    out, but never a missed key. As a table of 64-bit words it has at most
    MAX_FILTER_BITS / 64 rows of 12 bytes (12.6 MB), so it may always be broadcast.
    """
    return min(MAX_FILTER_BITS, 1 << max(10, (keys * BITS_PER_KEY - 1).bit_length()))


def filter_words(keys: DataFrame, key: Column, bits: int, least: int = 1) -> DataFrame:
    """Words (word, mask) of a Bloom filter with the cells that at least ``least`` rows hit."""
    cells = keys.select(F.explode(F.array(*_cells(key, bits))).alias("cell"))
    often = cells.groupBy("cell").count().where(F.col("count") >= least)
    word, mask = F.shiftright("cell", 6), F.expr("shiftleft(1L, cell & 63)")
    return often.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("mask"))


def with_filter_hit(rows: DataFrame, key: Column, words: DataFrame, bits: int, hit: str) -> DataFrame:
    """Add boolean ``hit``: whether all cells of the row's key are in the filter."""
    names = ["_cell1", "_cell2"]
    rows = rows.withColumns(dict(zip(names, _cells(key, bits))))
    for cell in names:
        side = words.select(F.col("word").alias(f"{cell}_word"), F.col("mask").alias(f"{cell}_mask"))
        rows = rows.join(F.broadcast(side), F.shiftright(cell, 6) == F.col(f"{cell}_word"), "left")
    marked = [F.expr(f"coalesce({c}_mask & shiftleft(1L, {c} & 63), 0L) <> 0") for c in names]
    extra = [f"{c}{end}" for c in names for end in ("", "_word", "_mask")]
    return rows.withColumn(hit, marked[0] & marked[1]).drop(*extra)


def _cells(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), key), F.lit(bits)).cast("int") for seed in (1, 2)]


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that added columns cannot clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name)

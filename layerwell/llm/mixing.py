"""Mixing sources to target weights by distributed prefix sums over hash-random order.

Every document gets a key from a hash of its id. Within a source, documents are
sorted by that key, cut into key ranges (the first digits of the key), word counts
are summed per range and then along the ranges, and the mix takes each source up to
its budget: whole rounds over all its documents first, then documents in key order
until the rest is used up.

Targets share the total of all words by weight. A source gets at most ``max_epochs``
times its own size; what it cannot take goes to the others by weight. With sources
ordered by size per weight, those that are capped come first, so two running
totals over the sources give the solution without iterating.

Defined results: null text has size 0 and is never taken; a null source is a source
of its own, ordered last; equal ids are ordered by their text; rows alike in both are
interchangeable; an empty table gives an empty result; further columns are carried along unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwell.llm.common import packed, running_totals, word_count
from layerwell.session import materialize

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
ROWS_PER_SLICE = 200_000
SOURCE = ["no_source", "source"]


def slice_digits(rows: int) -> int:
    """Hex digits of the key that number the ranges of a source: two, or more if ranges got long."""
    digits = 2
    while rows > ROWS_PER_SLICE * 16**digits:
        digits += 1
    return digits


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, **payload) -> DataFrame:
    text = F.col(text_col)
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    return docs.select(
        F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        word_count(text).alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), name)).alias("key"),
        *(c.alias(n) for n, c in payload.items()),
    )


def _along(sources: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """Add ``before_<value>`` along a total order of the sources, range by range."""
    ranged = sources.repartitionByRange(*order).withColumn("slice", F.spark_partition_id())
    rows = materialize(ranged, "sources")  # a row's range must not change between two uses
    for v in values:
        rows = running_totals(rows, [], "slice", order, v).withColumnRenamed("before", f"before_{v}")
    return rows


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Per source (no_source, source, source_size): its weight and ``target`` words."""
    one = F.lit(1).cast("long").alias("one")
    ranked = _along(sizes.select("*", one), SOURCE, ["one"])
    cycle = F.array(*(F.lit(w).cast("long") for w in weights))
    weight = F.element_at(cycle, (F.col("before_one") % len(weights) + 1).cast("int"))
    weighed = ranked.select(*SOURCE, "source_size", weight.alias("weight"))
    weighed = weighed.withColumn("ratio", F.col("source_size") / F.col("weight"))
    totals = _along(weighed, ["ratio", *SOURCE], ["source_size", "weight"])
    words, weight_sum = totals.agg(F.sum("source_size"), F.sum("weight")).first()
    words, weight_sum = words or 0, weight_sum or 0
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    capped = (max_epochs * exact("source_size")) * (F.lit(weight_sum) - exact("before_weight")) < (
        F.lit(words) - max_epochs * exact("before_source_size")
    ) * exact("weight")
    totals = totals.withColumn("capped", capped)
    capped_words, capped_weight = totals.where("capped").agg(F.sum("source_size"), F.sum("weight")).first()
    rest_words = words - max_epochs * (capped_words or 0)
    rest_weight = weight_sum - (capped_weight or 0)
    own = F.lit(float(rest_words)) * F.col("weight") / F.lit(float(rest_weight or 1))
    target = F.when(F.col("capped"), max_epochs * F.col("source_size").cast("double")).otherwise(own)
    return totals.select(*SOURCE, "source_size", "weight", target.alias("target"))


def _plan(narrow: DataFrame, rows: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``rows`` with source_size, target, whole copies and the words of a last, partial copy."""
    targets = source_targets(narrow.groupBy(*SOURCE).agg(F.sum("size").alias("source_size")), weights, max_epochs)
    budget = F.floor("target").cast("long")
    copies = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("copies", copies).withColumn("rest", budget - F.col("copies") * F.col("source_size"))
    digits = slice_digits(narrow.count())
    sliced = rows.withColumn("slice", F.substring("key", 1, digits))
    order = [c for c in ("key", "size", "tie") if c in rows.columns]
    placed = running_totals(sliced, SOURCE, "slice", order, "size", targets)
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return placed.withColumn("part", part)


def mix_report(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes, to the word)."""
    keyed = _keyed(docs, id_col, text_col, source_col, seed, doc_id=F.col(id_col))
    narrow = materialize(keyed, "sizes")
    plan = _plan(narrow, narrow, weights, max_epochs)
    taken = F.col("copies") * F.col("size") + F.col("part")
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix", cut_documents: bool = False,
) -> DataFrame:
    """The mixed corpus: documents repeated as often as their source's budget asks for.

    At the end of a source's budget one document is taken in part. With
    ``cut_documents`` its text is cut after that many words; without, it is taken
    whole if at least half of it was due, so texts stay whole and each source is off by
    half a document at most.
    """
    narrow = materialize(_keyed(docs, id_col, text_col, source_col, seed), "sizes")
    full = _keyed(docs, id_col, text_col, source_col, seed, row=packed(docs), tie=F.xxhash64(F.col(text_col)))
    plan = _plan(narrow, full, weights, max_epochs)
    if not cut_documents:
        last = ((F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))).cast("long")
        times = (F.col("copies") + last).cast("int")
        return plan.where(times > 0).select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")
    whole_last = (F.col("part") > 0) & (F.col("part") == F.col("size"))
    times = (F.col("copies") + whole_last.cast("long")).cast("int")
    whole = plan.where(times > 0).select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")
    pieces = F.split(F.col(f"row.`{text_col}`"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, 1, F.col("part").cast("int")), "")
    partial = plan.where((F.col("part") > 0) & (F.col("part") < F.col("size")))
    return whole.unionByName(partial.select(F.col("row").withField(f"`{text_col}`", cut).alias("row")).select("row.*"))

"""Trie of conversation prefixes: which conversations share their first turns, and what sharing saves.

Every prefix of a conversation gets a digest: the exclusive or of the SHA-256 of its turns, each hashed with
its position (128 bits are kept). It is a running aggregate, so a conversation of any length is cut into slices that are
digested on their own and shifted by what came before.

A count-min sketch (``common.filter_words``: two counters per digest in one array, of which only "more than one"
is kept) screens the prefixes. Counters never count too little, so an estimate of one proves that no other conversation
has the prefix. Such tails never meet other rows: their nodes are emitted as they are. Only possibly shared prefixes
are shuffled by digest and grouped exactly; those that turn out single join the tails.

A node belongs to its smallest member. What a conversation owns is the end of its own path, because along a path members
only get fewer, so the trie is a set of paths: conversation c owns the depths from ``first`` to its length and hangs on a
node of a smaller conversation. Children are counted from where paths hang. Sums over a subtree are sums over
the members' rows: each member adds what its own path holds from the node's depth on (a leaf, saved tokens). Nothing
recurses, and no task or row holds a whole conversation or a whole group; what hangs on one digest is added
up in ``SALTS`` parts first.

Defined results: turns without a conversation id belong to no conversation; turns with one number are ordered by role
and text, repeated rows are repeated turns; null role and text are empty; a conversation without turns ends at the root; an empty
table has no members, so no root and no rows; c % every is SQL's, which rounds towards zero for ids below zero; further columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwell.llm.common import filter_bits, filter_words, running_totals, with_filter_hit, word_count
from layerwell.session import materialize

SALTS = 64
SHARED_EVERY = 20
ENDS_PER_RANGE = 100_000
NOTHING = hashlib.sha256(b"").hexdigest()
DIGEST = ["digest1", "digest2"]


def number_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Turns with their place: conv_id, slice, turn, role, text; slices are ranges, so one conversation may span many."""
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ranged = rows.repartitionByRange("conv_id", "turn", "role", "text").withColumn("slice", F.spark_partition_id())
    return materialize(ranged, "turns")


def rebuild(turns: DataFrame, every: int = SHARED_EVERY) -> tuple[DataFrame, DataFrame]:
    """Conversations that borrow an opening: (conv_id, position, role, text) and (conv_id, length).

    Conversation c starts with the first h turns of conversation c - c % every, and goes on with its own turns after
    its first h, where h = crc32(c as text) % 4. ``turns`` is the result of ``number_turns``. At most ``every``
    conversations borrow the three turns at most of one, so the join is bounded; the others' turns are not joined at all.
    """
    lengths = materialize(turns.groupBy("conv_id").agg(F.count("*").alias("turns")), "lengths")
    given = lengths.select(F.col("conv_id").alias("donor"), F.col("turns").alias("donor_turns"))
    skipped = F.crc32(F.col("conv_id").cast("string")) % 4
    convs = lengths.withColumns({"skipped": skipped, "donor": F.col("conv_id") - F.col("conv_id") % every}).join(given, "donor", "left")
    taken = F.least("skipped", F.coalesce("donor_turns", F.lit(0).cast("long")))
    convs = convs.select(
        "conv_id", "donor", "skipped", taken.alias("taken"),
        (taken + F.greatest(F.lit(0).cast("long"), F.col("turns") - F.col("skipped"))).alias("length"),
    )
    convs = materialize(convs, "conversations")
    placed = running_totals(
        turns.withColumn("one", F.lit(1).cast("long")), ["conv_id"], "slice", ["turn", "role", "text"], "one",
        convs.select("conv_id", "skipped", "taken"),
    )
    placed = materialize(placed.select("conv_id", F.col("before") + 1, "skipped", "taken", "role", "text").toDF(
        "conv_id", "number", "skipped", "taken", "role", "text"), "numbered")
    own = placed.where("number > skipped").select("conv_id", (F.col("number") - F.col("skipped") + F.col("taken")).alias("position"), "role", "text")
    opening = placed.where("number <= 3").select(F.col("conv_id").alias("donor"), F.col("number").alias("position"), "role", "text")
    borrowed = convs.where("taken > 0").join(opening, "donor").where("position <= taken").select("conv_id", "position", "role", "text")
    return borrowed.unionByName(own), convs.select("conv_id", "length")


def _lanes() -> list[Column]:
    """128 bits of the SHA-256 of a turn with its position, as two signed numbers."""
    turn = F.concat_ws(":", "position", F.octet_length("role"), F.concat("role", "text"))
    digest = F.sha2(turn, 256)
    return [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long") for i in range(2)]


def prefix_digests(sequences: DataFrame) -> DataFrame:
    """(conv_id, slice, depth, digest1, digest2, words) of every prefix; ``words`` counts those of its last turn."""
    rows = sequences.select("conv_id", F.col("position").alias("depth"), *(x.alias(d) for x, d in zip(_lanes(), DIGEST)), word_count(F.col("text")).alias("words"))
    rows = materialize(rows.repartitionByRange("conv_id", "depth").withColumn("slice", F.spark_partition_id()), "hashed")
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    parts = rows.groupBy("conv_id", "slice").agg(*(F.bit_xor(d).alias(d) for d in DIGEST))
    shift = parts.select("conv_id", "slice", *(F.coalesce(F.bit_xor(d).over(earlier), F.lit(0).cast("long")).alias(f"{d}_shift") for d in DIGEST))
    running = rows.withColumns({d: F.bit_xor(d).over(inside) for d in DIGEST}).join(shift, ["conv_id", "slice"])
    shifted = {d: F.col(d).bitwiseXOR(F.col(f"{d}_shift")) for d in DIGEST}
    return materialize(running.withColumns(shifted).select("conv_id", "slice", "depth", *DIGEST, "words"), "prefixes")


def _owners(prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix rows with their node: (conv_id, slice, depth, words, owner, n_convs), shared rows and tails apart."""
    key = F.struct(*DIGEST)
    bits = filter_bits(prefixes.count())
    sketch = materialize(filter_words(prefixes, key, bits, least=2), "sketch")
    screened = with_filter_hit(prefixes, key, sketch, bits, "maybe")
    maybe = screened.where("maybe").withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)))
    parts = maybe.groupBy(*DIGEST, "salt").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n"))
    nodes = (
        parts.groupBy(*DIGEST)
        .agg(F.min("owner").alias("owner"), F.sum("n").alias("n_convs"), F.collect_list("salt").alias("salts"))
        .select(*DIGEST, "owner", "n_convs", F.explode("salts").alias("salt"))
    )
    columns = ["conv_id", "slice", "depth", "words", "owner", "n_convs"]
    grouped = materialize(maybe.join(nodes, [*DIGEST, "salt"]).select(columns), "grouped")
    alone = screened.where("not maybe").withColumns({"owner": F.col("conv_id"), "n_convs": F.lit(1).cast("long")})
    tails = alone.select(columns).unionByName(grouped.where("n_convs = 1"))
    return grouped.where("n_convs > 1"), tails


def _paths(shared: DataFrame, convs: DataFrame, root: int) -> DataFrame:
    """Per conversation: conv_id, length, first (depth it owns from), hangs_on (owner of the node above), leaf, saved."""
    foreign = shared.where("owner <> conv_id").groupBy("conv_id").agg(F.max("depth").alias("above"), F.max_by("owner", "depth").alias("upper"))
    saved = shared.where("owner = conv_id").groupBy("conv_id").agg(F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    zero = F.lit(0).cast("long")
    paths = convs.join(foreign, "conv_id", "left").join(saved, "conv_id", "left").select(
        "conv_id", "length", (F.coalesce("above", zero) + 1).alias("first"),
        F.coalesce("upper", F.lit(root).cast("long")).alias("hangs_on"), F.coalesce("saved", zero).alias("saved"),
    )
    paths = materialize(paths, "paths")
    forks = _forks(paths).select(F.col("owner").alias("conv_id"), F.col("depth").alias("length"), F.lit(True).alias("forked"))
    ends = (F.col("first") <= F.col("length")) & F.col("forked").isNull()
    return materialize(paths.join(forks, ["conv_id", "length"], "left").withColumn("leaf", ends.cast("long")).drop("forked"), "paths")


def _forks(paths: DataFrame) -> DataFrame:
    """Paths that hang on a node: (owner, depth, forks)."""
    hanging = paths.where("first <= length").groupBy(F.col("hangs_on").alias("owner"), (F.col("first") - 1).alias("depth"))
    return hanging.agg(F.count("*").alias("forks"))


def _end_digests(ended: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) from rows (owner, depth, conv_id).

    A digest of a list has to read the list in order. Ranges of ids are joined to texts in parallel; the last step hashes
    these texts one after the other, so a node with any number of ids costs it a stream of a few rows.
    """
    ended = materialize(ended, "ended")
    ranges = max(64, ended.count() // ENDS_PER_RANGE)
    ranged = ended.repartitionByRange(ranges, "owner", "depth", "conv_id").withColumn("slice", F.spark_partition_id())
    ids = F.sort_array(F.collect_list("conv_id"))
    chunks = ranged.groupBy("owner", "depth", "slice").agg(F.array_join(ids.cast("array<string>"), ",").alias("ids"))

    def hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, state):
            return pa.RecordBatch.from_pydict(
                {"owner": pa.array([key[0]], pa.int64()), "depth": pa.array([key[1]], pa.int64()), "ends_sha256": [state.hexdigest()]}
            )

        last, state = None, None
        for batch in batches:
            for owner, depth, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (owner, depth) == last:
                    state.update(b",")
                else:
                    if last is not None:
                        yield row(last, state)
                    last, state = (owner, depth), hashlib.sha256()
                state.update(ids.as_buffer())
        if last is not None:
            yield row(last, state)

    ordered = chunks.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "slice").select("owner", "depth", "ids")
    return ordered.mapInArrow(hash_lists, "owner long, depth long, ends_sha256 string")


def trie_nodes(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``sequences`` holds (conv_id, position from 1, role, text), ``convs`` (conv_id, length), also those without turns.
    """
    total, root = convs.agg(F.count("*"), F.min("conv_id")).first()
    shared, tails = _owners(prefix_digests(sequences))
    paths = _paths(shared, convs, root)
    forks = materialize(_forks(paths), "forks")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    ends_here = F.col("depth") == F.col("length")
    parent = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("hangs_on"))

    parts = tails.select("conv_id", "slice").distinct().join(paths, "conv_id")
    single = tails.join(parts, ["conv_id", "slice"]).select(
        "conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), (~ends_here).cast("long").alias("n_children"),
        one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(ends_here, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )

    owned = F.col("owner") == F.col("conv_id")
    rows = shared.withColumn("saves", F.when(owned, (F.col("n_convs") - 1) * F.col("words")).otherwise(zero))
    rows = materialize(running_totals(rows, ["conv_id"], "slice", ["depth"], "saves", paths), "members")
    nodes = rows.groupBy("owner", "depth").agg(
        F.max("n_convs").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum(F.col("saved") - F.col("before")).alias("saved_tokens"),
        F.max(F.when(owned, parent)).alias("parent_conv_id"), F.max(F.when(owned, (~ends_here).cast("long"))).alias("goes_on"),
    )
    ended = rows.where(ends_here).select("owner", "depth", "conv_id")
    turnless = convs.where("length = 0").select(F.lit(root).cast("long").alias("owner"), zero.alias("depth"), "conv_id")
    top = paths.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")).where(F.lit(total) > 0).select(
        F.lit(root).cast("long").alias("owner"), zero.alias("depth"), F.lit(total).cast("long").alias("n_convs"),
        F.greatest("n_leaves", one).alias("n_leaves"), "saved_tokens", F.lit(None).cast("long").alias("parent_conv_id"), zero.alias("goes_on"),
    )
    nodes = nodes.unionByName(top).join(forks, ["owner", "depth"], "left").join(_end_digests(ended.unionByName(turnless)), ["owner", "depth"], "left")
    return single.unionByName(
        nodes.select(
            F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
            (F.col("goes_on") + F.coalesce("forks", zero)).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )


def conversation_trie(turns: DataFrame, every: int = SHARED_EVERY) -> DataFrame:
    """``trie_nodes`` of the conversations that ``rebuild`` makes."""
    return trie_nodes(*rebuild(number_turns(turns), every))


def shared_turns(nodes: DataFrame, sequences: DataFrame, least: int = 2) -> DataFrame:
    """Turns that at least ``least`` conversations share, written once: conv_id, depth, parent_conv_id, n_convs, role, text."""
    shared = nodes.where((F.col("n_convs") >= least) & (F.col("depth") > 0)).select("conv_id", "depth", "parent_conv_id", "n_convs")
    return shared.join(sequences.withColumnRenamed("position", "depth"), ["conv_id", "depth"])

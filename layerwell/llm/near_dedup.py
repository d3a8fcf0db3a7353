"""Near-duplicate documents from SetSketch registers.

1. Every text becomes its set of word shingles, a digest of that set and a SetSketch. Texts
   with one digest are one class; from here on only classes are looked at, each with a
   number of its own and one row's text, so copies cost nothing. Classes that hold
   the same doc_id are linked by it.
2. Registers are cut into bands. In each bucket of classes that agree in a band, the
   smallest class is compared with all others: the joint likelihood of both sketches
   must allow the similarity, then the full sets decide.
3. Buckets whose classes are now all connected are done. In the others, classes that
   are not connected yet are compared, all of them, in blocks of ``BLOCK``
   classes. A pair is compared in the first band it shares only, and only links
   leave a task, never pairs.
4. Connected components of the links, then one row per document.

With 51 bands of 5 registers a pair of similarity 0.75 shares no band with probability
1e-6; an estimate is off by more than the margin of 0.12 with probability 1e-6.

Defined results: null and empty texts, and texts without words, have no shingles and are linked with
nothing of their own; fewer words than a shingle make one shingle; rows of one doc_id are one
document, whatever their texts; rows without a doc_id link others and get the smallest doc_id they reach, or null; an empty
table gives an empty result; further columns are carried along unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwell.llm.batches import groups
from layerwell.llm.common import filter_bits, filter_words, packed, with_filter_hit
from layerwell.llm.components import connected
from layerwell.llm.sketch import REGISTERS, SHINGLE, Shingler, chunks, likely_similarity, sketch
from layerwell.session import materialize

SIMILARITY = (75, 100)
BAND = 5
BANDS = REGISTERS // BAND
MARGIN = 0.12
BLOCK = 1024
BLOCK_SHINGLES = 4_000_000
SALTS = 64
LINKS = "a long, b long"


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, row_key, n_shingles, digest of the shingle set, registers (16-bit words)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(SHINGLE)
        for batch in batches:
            for first, last in chunks(_sizes(batch.column(1))):
                sets = shingler.sets([t or b"" for t in batch.column(1).slice(first, last - first).to_pylist()])
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                registers = [r.tobytes() if len(s) else None for r, s in zip(sketch(sets), sets)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(registers, pa.binary()),
                    ],
                    names=["doc_id", "row_key", "n_shingles", "digest", "registers"],
                )

    texts = _rows(docs, id_col, text_col).select("doc_id", "text", "row_key")
    return texts.mapInArrow(make, "doc_id long, row_key long, n_shingles long, digest binary, registers binary")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, row_key); with the doc_id, the key names a text of that id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.withColumn("row_key", F.xxhash64("doc_id", "text"))


def _classes(rows: DataFrame) -> DataFrame:
    """(digest, node, low, row_key, of_id, salts): a number per digest, its smallest doc_id, and one of its rows.

    Large classes are reduced in salted parts. Numbers rise with the smallest doc_id, so the centre of a star is the earliest
    text, of which the others are copies; they are pinned by writing them.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(SALTS)))
    row = F.struct("row_key", F.coalesce("doc_id", F.lit(-1).cast("long")).alias("of_id"))
    parts = salted.groupBy("digest", "salt").agg(F.min("doc_id").alias("low"), F.min(row).alias("row"))
    classes = parts.groupBy("digest").agg(F.min("low").alias("low"), F.min("row").alias("row"), F.collect_list("salt").alias("salts"))
    classes = classes.orderBy(F.asc_nulls_last("low"), "digest")
    return materialize(classes.select("digest", F.monotonically_increasing_id().alias("node"), "low", "row.*", "salts"), "classes")


def _spread(rows: DataFrame, by: str, salt_of: str, values: DataFrame) -> DataFrame:
    """Join one value row per ``by`` to rows of which very many may share a key: in salted parts that exist."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(SALTS)))
    parts = salted.select(by, "_salt").distinct().join(values, by)
    return salted.join(parts, [by, "_salt"]).drop("_salt")


def _id_links(classed: DataFrame) -> DataFrame:
    """Links between the classes that rows of one doc_id are in."""
    ids = classed.where("doc_id is not null")
    several = ids.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("top")).where("a <> top").drop("top")
    several = materialize(several, "several")
    bits = filter_bits(several.count())
    words = materialize(filter_words(several, F.col("doc_id"), bits), "several")
    asked = with_filter_hit(ids.select("doc_id", "node"), F.col("doc_id"), words, bits, "hit").where("hit").distinct()
    return asked.join(several, "doc_id").where("a <> node").select("a", F.col("node").alias("b"))


def _buckets(nodes: DataFrame) -> DataFrame:
    """Members of all buckets with two or more classes: band, key, node, low (smallest class), members, shingles."""
    width = 2 * BAND
    keys = F.array(*(F.xxhash64(F.substring("registers", 1 + width * b, width)) for b in range(BANDS)))
    bands = nodes.select("node", "n_shingles", F.posexplode(keys).alias("band", "key"))
    shared = bands.groupBy("band", "key").agg(F.min("node").alias("low"), F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"))
    shared = materialize(shared.where("members > 1"), "buckets")
    return materialize(bands.drop("n_shingles").join(shared, ["band", "key"]), "members")


def _texts(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the classes named in ``ids`` (node); a filter keeps other texts from moving."""
    wanted = materialize(ids.join(nodes.select("node", "row_key", "of_id"), "node"), "wanted")
    bits = filter_bits(wanted.count())
    words = materialize(filter_words(wanted, F.col("row_key"), bits), "wanted")
    rows = _rows(docs, id_col, text_col).select("row_key", F.coalesce("doc_id", F.lit(-1).cast("long")).alias("of_id"), "text")
    likely = with_filter_hit(rows, F.col("row_key"), words, bits, "hit").where("hit").drop("hit")
    return likely.join(wanted, ["row_key", "of_id"]).select("node", "text").dropDuplicates(["node"])


def _likely(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Which pairs of sketches may reach the similarity."""
    least = SIMILARITY[0] / SIMILARITY[1]
    sized = np.minimum(n_left, n_right) >= least * np.maximum(n_left, n_right)
    found = np.zeros(len(left), bool)
    at = np.flatnonzero(sized)
    for some in np.array_split(at, max(1, len(at) // 4096)):
        found[some] = likely_similarity(left[some], right[some], n_left[some], n_right[some]) >= least - MARGIN
    return found


def _similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Exact test on two sorted sets."""
    small, large = (left, right) if len(left) <= len(right) else (right, left)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return SIMILARITY[1] * both >= SIMILARITY[0] * (len(left) + len(right) - both)


def _sizes(texts: pa.Array) -> list[int]:
    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _star_links(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Links between the smallest class of a bucket and its other classes."""
    pairs = members.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    side = lambda x: nodes.select(
        F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"registers_{x}")
    )
    both = pairs.join(side("b"), "b").join(side("a"), "a")

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                may = _likely(
                    _registers(c["registers_a"]), _registers(c["registers_b"]),
                    c["n_a"].to_numpy().astype(float), c["n_b"].to_numpy().astype(float),
                )
                yield pa.RecordBatch.from_arrays([c["a"], c["b"]], names=["a", "b"]).filter(pa.array(may))

    likely = materialize(both.mapInArrow(estimate, LINKS), "likely")
    ids = materialize(likely.select("a").union(likely.select("b")).distinct().toDF("node"), "ids")
    texts = materialize(_texts(docs, id_col, text_col, ids, nodes), "texts")
    # A class at the centre of many pairs is joined in salted parts that exist, so small groups are not copied more.
    salt = F.pmod(F.xxhash64("b"), F.lit(SALTS))
    salted = likely.withColumn("salt", salt)
    left = salted.select("a", "salt").distinct().join(texts.toDF("a", "text_a"), "a")
    ready = salted.join(texts.toDF("b", "text_b"), "b").join(left, ["a", "salt"])
    ready = ready.select("a", "b", "text_a", "text_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(SHINGLE)
        for batch in batches:
            sizes = [x + y for x, y in zip(_sizes(batch.column(2)), _sizes(batch.column(3)))]
            for first, last in chunks(sizes):
                part = batch.slice(first, last - first)
                left, right = shingler.sets(part.column(2).to_pylist()), shingler.sets(part.column(3).to_pylist())
                good = pa.array([_similar(x, y) for x, y in zip(left, right)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(good)

    return materialize(ready.mapInArrow(verify, LINKS), "stars")


def _block_links(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, members: DataFrame, known: DataFrame) -> DataFrame:
    """Links between classes of a bucket that ``known`` (node, component) does not connect yet."""
    labelled = members.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = materialize(labelled, "labelled")
    spread = labelled.groupBy("band", "key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    unfinished = materialize(spread.where("c0 <> c1").select("band", "key"), "open")
    rows = materialize(labelled.join(unfinished, ["band", "key"]).drop("low"), "rows")
    ids = materialize(rows.select("node").distinct(), "ids")
    full = _texts(docs, id_col, text_col, ids, nodes).join(nodes.select("node", "registers"), "node")
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        "band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component"
    ).join(full, "node")
    keys = ["band", "key", "i", "j"]
    rows = rows.select(*keys, "own", "node", "component", "registers", "text")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(SHINGLE)
        for group in groups(batches, 4):
            links = _compare_block(group, shingler)
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())],
                    names=["a", "b"],
                )

    return materialize(rows.mapInArrow(compare, LINKS), "blocks")


def _compare_block(group: pa.Table, shingler: Shingler) -> list[tuple[int, int]]:
    """Links within one block pair; classes that get connected on the way need no further test."""
    group = group.combine_chunks()
    band, crossing = group["band"][0].as_py(), group["i"][0].as_py() != group["j"][0].as_py()
    own = group["own"].to_numpy()
    node = group["node"].to_numpy()
    component = group["component"].to_numpy()
    registers = np.frombuffer(b"".join(group["registers"].to_pylist()), np.uint16).reshape(len(node), -1)
    texts = group["text"].combine_chunks()
    parts = chunks(_sizes(texts))
    sets = [s for first, last in parts for s in shingler.sets(texts.slice(first, last - first).to_pylist())]
    sizes = np.array([len(s) for s in sets], float)
    left, right = [], []
    for x in range(len(node) - 1):
        rest = np.arange(x + 1, len(node))
        test = component[rest] != component[x]
        if crossing:
            test &= own[rest] != own[x]
        rest = rest[test]
        for b in range(band):  # a pair belongs to the first band it shares
            if len(rest):
                part = slice(b * BAND, (b + 1) * BAND)
                rest = rest[(registers[rest, part] != registers[x, part]).any(axis=1)]
        left += [x] * len(rest)
        right += rest.tolist()
    if not left:
        return []
    x, y = np.array(left), np.array(right)
    may = np.zeros(len(x), bool)
    agree = np.zeros(len(x))
    for first in range(0, len(x), 4096):
        some = slice(first, first + 4096)
        u, v = registers[x[some]], registers[y[some]]
        may[some] = _likely(u, v, sizes[x[some]], sizes[y[some]])
        agree[some] = (u == v).mean(axis=1)
    order = np.flatnonzero(may)
    order = order[np.argsort(-agree[order], kind="stable")]
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    links = []
    for k in order.tolist():
        u, v = find(int(component[x[k]])), find(int(component[y[k]]))
        if u != v and _similar(sets[x[k]], sets[y[k]]):
            root[max(u, v)] = min(u, v)
            links.append((int(node[x[k]]), int(node[y[k]])))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    made = materialize(sketches(docs, id_col, text_col), "sketches")
    filled = made.where("n_shingles > 0")
    classes = _classes(filled)
    salted = filled.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(SALTS)))
    named = classes.select("digest", "node", F.explode("salts").alias("salt"))
    classed = salted.join(named, ["digest", "salt"]).select("doc_id", "row_key", "n_shingles", "node")
    classed = materialize(classed, "classed")
    own = F.coalesce("doc_id", F.lit(-1).cast("long")).alias("of_id")
    nodes = made.select("row_key", own, "digest", "n_shingles", "registers").join(classes.drop("low", "salts"), ["row_key", "of_id", "digest"])
    nodes = materialize(nodes.drop("digest").dropDuplicates(["node"]), "nodes")
    members = _buckets(nodes)
    stars = _star_links(docs, id_col, text_col, nodes, members).unionByName(_id_links(classed))
    known = materialize(connected(stars), "components")
    blocks = _block_links(docs, id_col, text_col, nodes, members, known)
    forest = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = connected(forest.unionByName(blocks))
    # A component is called by the smallest doc_id of its classes; a component or a class may hold very many rows.
    labelled = classes.select("node", "low").join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = materialize(labelled, "components")
    lowest = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    called = materialize(_spread(labelled.select("node", "component"), "component", "node", lowest), "called")
    linked = materialize(_spread(classed, "node", "row_key", called.select("node", "component_id")).select("doc_id", "row_key", "n_shingles", "component_id"), "linked")
    # A row without shingles belongs to the component of its doc_id, if another row of that id has one.
    alone = made.where("n_shingles = 0").select("doc_id", "row_key", "n_shingles")
    asked = alone.select("doc_id").distinct().join(linked.select("doc_id", "component_id").distinct(), "doc_id")
    asked = asked.groupBy("doc_id").agg(F.min("component_id").alias("found"))
    parts = alone.withColumn("_salt", F.pmod(F.xxhash64("row_key"), F.lit(SALTS)))
    alone = parts.join(parts.select("doc_id", "_salt").distinct().join(asked, "doc_id"), ["doc_id", "_salt"], "left")
    alone = alone.select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
    result = linked.drop("row_key").unionByName(alone)
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that a smaller doc_id represents; only rows to be dropped are shuffled."""
    dropped = near_duplicates(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias("gone"))
    dropped = materialize(dropped.distinct(), "dropped")
    bits = filter_bits(dropped.count())
    words = materialize(filter_words(dropped, F.col("gone"), bits), "gone")
    row_id = F.col(f"row.`{id_col}`").cast("long")
    rows = with_filter_hit(docs.select(packed(docs)), row_id, words, bits, "hit")
    stay = rows.where("not hit").select("row.*")
    checked = rows.where("hit").join(dropped, row_id == F.col("gone"), "left_anti").select("row.*")
    return stay.unionByName(checked)

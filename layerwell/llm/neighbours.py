"""Nearest neighbours by inner product from randomly rotated one-bit codes.

Every vector is centred, normalised and rotated at random; its code is the signs, packed
into bits, with two correction scalars: the length of the centred vector and the inner product
of the code with what it stands for. From these an inner product with any query is
estimated without bias, with an error bound that holds with high probability. Vectors
whose upper bound reaches the k-th largest lower bound are ranked again with their original
components in double precision; all others are left out.

Vectors and queries are dealt into blocks, and each pair of blocks is one unit of work:
bounded memory, no order between units, at most k results per query and unit. The
best k per query are then taken over the units, each task first keeping its own best.

Every valid vector is indexed. Only the centre comes from a sample, of about
``CENTRE_SAMPLE`` vectors.

Defined results: a vector that is null, zero, or holds null or non-finite components takes no part,
nor does one of another length than most (the shorter length if tied), nor one without id; rows of one
vec_id count once (the smallest by components); ties go to the smaller vec_id; fewer candidates
than k give all of them; an empty table or query set gives an empty result; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwell.llm.batches import groups
from layerwell.session import materialize

VECTORS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 4096
TILE = 256  # queries estimated at a time
CENTRE_SAMPLE = 20_000
BOUND = 4.0  # standard errors
SEED = 11
FOUND = "query_id long, vec_id long, score double"


def valid_vectors(
    table: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, int]:
    """(vec_id, vector, asks) of the vectors that take part, one per id, and their length."""
    vector = F.col(vector_col).cast("array<float>")
    rows = table.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"), is_query.alias("asks")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = sizes["size"] if sizes else 0
    rows = rows.where(F.size("vector") == size).groupBy("vec_id")
    return rows.agg(F.min("vector").alias("vector"), F.coalesce(F.bool_or("asks"), F.lit(False)).alias("asks")), size


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, lengths of the centred vectors, inner products of unit code and unit vector."""
    apart = (vectors - centre) @ turn
    length = np.sqrt((apart * apart).sum(axis=1))
    signs = apart >= 0
    fit = np.abs(apart).sum(axis=1) / np.sqrt(vectors.shape[1]) / np.maximum(length, 1e-30)
    return np.packbits(signs, axis=1), length, np.where(length > 0, fit, 1.0)


def estimate(
    codes: np.ndarray, length: np.ndarray, fit: np.ndarray, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and the bounds of their errors."""
    size = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    turned = (queries @ turn).astype(np.float32)
    scale = (length / fit / np.sqrt(size)).astype(np.float32)
    about = (turned @ signs.T) * scale + (queries @ centre).astype(np.float32)[:, None]
    spread = length * np.sqrt(np.maximum(1 - fit * fit, 0)) / fit * BOUND / np.sqrt(max(size - 1, 1))
    bound = np.sqrt((queries * queries).sum(axis=1))[:, None].astype(np.float32) * spread.astype(np.float32)
    return about, bound


def _best(group: pa.Table, size: int, k: int, centre: np.ndarray, turn: np.ndarray) -> pa.RecordBatch | None:
    """Each query's k nearest within one unit."""
    group = group.combine_chunks()
    asks = group["asks"].to_numpy()
    ids = group["vec_id"].to_numpy()
    vectors = np.frombuffer(b"".join(group["vector"].to_pylist()), np.float32).reshape(len(ids), size).astype(np.float64)
    has = ~asks
    if not has.any() or not asks.any():
        return None
    order = np.flatnonzero(has)
    order = order[np.argsort(ids[order], kind="stable")]  # so that equal scores keep the smaller id
    codes = np.frombuffer(b"".join(group["code"].take(pa.array(order)).to_pylist()), np.uint8).reshape(len(order), -1)
    length, fit = group["length"].to_numpy()[order], group["fit"].to_numpy()[order]
    stored, stored_ids = vectors[order], ids[order]
    queries, query_ids = vectors[asks], ids[asks]
    out_q, out_v, out_s = [], [], []
    keep = min(k + 1, len(order))  # the query itself may be among them
    for first in range(0, len(queries), TILE):
        tile = queries[first : first + TILE]
        about, bound = estimate(codes, length, fit, tile, centre, turn)
        low = about - bound
        floor = np.partition(low, len(order) - keep, axis=1)[:, len(order) - keep]
        reach = about + bound >= floor[:, None]
        for i, query in enumerate(tile):
            at = np.flatnonzero(reach[i])
            at = at[stored_ids[at] != query_ids[first + i]]
            exact = (stored[at] * query).sum(axis=1)
            best = np.argsort(-exact, kind="stable")[:k]
            out_q.append(np.full(len(best), query_ids[first + i]))
            out_v.append(stored_ids[at[best]])
            out_s.append(exact[best])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x)) for x in (out_q, out_v, out_s)], names=["query_id", "vec_id", "score"]
    )


def search(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest of each query row among all other rows: query_id, rank (from 1), vec_id, score."""
    spark = table.sparkSession
    vectors, size = valid_vectors(table, is_query, id_col, vector_col)
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = materialize(vectors, "vectors")
    rows = vectors.count()
    draw = F.pmod(F.xxhash64(F.lit("centre"), "vec_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = vectors.where(draw < min(1.0, CENTRE_SAMPLE / max(rows, 1))).select("vector").toPandas()["vector"]
    centre = np.mean(np.stack(sample.to_list()), axis=0).astype(np.float64) if len(sample) else np.zeros(size)
    turn = rotation(size)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(batch.num_rows, size)
            codes, length, fit = encode(flat.astype(np.float64), centre, turn)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([v.tobytes() for v in flat], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(length),
                    pa.array(fit),
                    batch.column(2),
                ],
                names=["vec_id", "vector", "code", "length", "fit", "asks"],
            )

    indexed = vectors.mapInArrow(index, "vec_id long, vector binary, code binary, length double, fit double, asks boolean")
    indexed = materialize(indexed, "codes")
    asked = indexed.where("asks")
    blocks = max(1, -(-rows // VECTORS_PER_BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    own = lambda n: F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["vec_id", "vector", "code", "length", "fit"]
    stored = indexed.select(own(blocks).alias("i"), every(query_blocks).alias("j"), F.lit(False).alias("asks"), *columns)
    asking = asked.select(every(blocks).alias("i"), own(query_blocks).alias("j"), F.lit(True).alias("asks"), *columns)
    units = stored.unionByName(asking).repartition("i", "j").sortWithinPartitions("i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 2):
            found = _best(group, size, k, centre, turn)
            if found is not None:
                yield found

    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = units.mapInArrow(compare, FOUND).withColumn("rank", F.row_number().over(nearest))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Best-fit packing of token pieces into sequences, planned on a histogram of lengths.

Tasks turn texts into pieces of at most ``capacity`` tokens. Only the histogram of the
piece lengths, at most ``capacity`` rows, reaches the driver, which runs best-fit
decreasing over counts: all pieces of a length are placed at once, into runs of sequences
that have the same room left. The plan is a table of runs: pieces number a to b of a
length go to the sequences from s on, k in each, from offset o on. Pieces then take their
places by joining their rank within their length with that table.

The plan is small at any size of the input: there are at most 3 * capacity runs of equal
sequences (a length opens one and splits two), each filled with at most
sqrt(2 * capacity) different lengths, so under 140,000 rows of 48 bytes for 1024 tokens.

Defined results: null text is empty; an empty text is the end id alone; equal texts and
repeated rows are placed one by one; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwell.llm.common import running_totals
from layerwell.session import materialize

CAPACITY = 1024
END_ID = 2
ROWS_PER_SLICE = 200_000
CACHED_WORDS = 150_000
PLAN_SCHEMA = "length int, rank_from long, rank_to long, first_sequence long, per_sequence long, first_offset long"


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts; rows as in ``PLAN_SCHEMA``, rank_to exclusive."""
    plan: list[tuple[int, int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, sequences)
    rooms: list[int] = []  # sorted keys of runs
    sequences = 0

    def put(room: int, first: int, count: int) -> None:
        if count and room:
            if room not in runs:
                bisect.insort(rooms, room)
            runs.setdefault(room, []).append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                opened = -(-left // (capacity // length))
                put(capacity, sequences, opened)
                sequences += opened
                continue
            room = rooms[at]
            first, count = runs[room].pop()
            if not runs[room]:
                del runs[room], rooms[at]
            each = room // length
            full = min(count, left // each)
            if full:
                plan.append((length, rank, rank + full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < count:
                if left:  # fewer than one sequence takes
                    plan.append((length, rank, rank + left, first + full, each, capacity - room))
                    put(room - left * length, first + full, 1)
                    put(room, first + full + 1, count - full - 1)
                    left = 0
                else:
                    put(room, first + full, count - full)
    return plan


def _encoder(tokenizer_path: str, ranks_path: str | None):
    """A function from a text to its ids as little-endian 32-bit words.

    A space between two other characters always starts a token of its own or the next
    word's token, so texts are cut there and each distinct word is encoded once per
    task. Texts with special tokens or runs of spaces are encoded whole.
    """
    import base64

    import numpy as np
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    if ranks_path is None:
        return whole
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(text: str) -> bytes:
        return np.array(bpe.encode_ordinary(text), "<u4").tobytes()

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            if len(self) >= CACHED_WORDS:
                self.clear()
            found = plain(" " + word)
            if len(word) <= 64:
                self[word] = found
            return found

    words = Words()

    def encode(text: str) -> bytes:
        if any(s in text for s in special):
            return whole(text)
        parts = text.split(" ")
        if "" in parts:
            return plain(text)
        return plain(parts[0]) + b"".join([words[p] for p in parts[1:]])

    return encode


def token_pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, with_tokens: bool = False,
) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and ``ids`` if asked for.

    ``ranks_path`` is the same vocabulary as ranks; it only makes encoding faster.
    """
    id_type = docs.schema[id_col].dataType
    fields = [
        T.StructField("doc_id", id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("ids_crc32", T.LongType()),
    ] + [T.StructField("ids", T.BinaryType())] * with_tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path, ranks_path)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            source, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                data = encode(text.as_py() or "") + end
                tokens = len(data) // 4
                at = 0
                upto = (tokens - 1) % capacity + 1
                number = 0
                while at < tokens:
                    part = data[4 * at : 4 * upto]
                    source.append(row)
                    pieces.append(number)
                    starts.append(at)
                    lengths.append(upto - at)
                    sums.append(zlib.crc32(part))
                    if with_tokens:
                        ids.append(part)
                    at, upto, number = upto, upto + capacity, number + 1
            columns = [
                batch.column(0).take(pa.array(source, pa.int64())),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int32()),
                pa.array(sums, pa.int64()),
            ] + [pa.array(ids, pa.binary())] * with_tokens
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(cut, T.StructType(fields))


def pack(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, with_tokens: bool = False,
) -> DataFrame:
    """All pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    pieces = materialize(
        token_pieces(docs, tokenizer_path, ranks_path, id_col, text_col, capacity, end_id, with_tokens), "pieces"
    )
    histogram = dict(pieces.groupBy("length").count().collect())  # at most ``capacity`` rows
    plan = docs.sparkSession.createDataFrame(plan_sequences(histogram, capacity), PLAN_SCHEMA)
    slices = max(64, sum(histogram.values()) // ROWS_PER_SLICE)
    identity = F.xxhash64("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumns({"slice": F.pmod(identity, F.lit(slices)), "one": F.lit(1).cast("long")})
    ranked = running_totals(ranked, ["length"], "slice", ["doc_id", "piece", "ids_crc32"], "one")
    rank, nth = F.col("before"), F.col("before") - F.col("rank_from")
    runs = F.broadcast(plan.withColumnRenamed("length", "planned"))
    at = (F.col("length") == F.col("planned")) & (rank >= F.col("rank_from")) & (rank < F.col("rank_to"))
    return ranked.join(runs, at).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence")).cast("long")).alias("sequence_id"),
        (F.col("first_offset") + F.pmod(nth, F.col("per_sequence")) * F.col("length")).alias("offset"),
        *(["ids"] if with_tokens else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Training sequences from ``pack(with_tokens=True)``: sequence_id, n_tokens, ids (32-bit words).

    A group is one sequence, so it never holds more than ``capacity`` tokens.
    """
    placed = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(placed, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))

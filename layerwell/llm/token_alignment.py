"""Alignment of two tokenizers: which ids stand for the same bytes, counted over the corpus.

Both tokenizers split the bytes of one text. Where tokens of both end at the same byte, a group ends; every pair of a token of A
and a token of B in a group is a link. A pair's count is the number of documents that hold it linked.

Every document is aligned once. A task writes two kinds of rows to the shared folder: what it has counted per distinct pair, and one row
per document with its numbers, its digest and its distinct pairs with their numbers of links. The distinct pairs get a minimal perfect
hash (``minimal_hash``), built per bucket of about 32,768 pairs. With it the tasks' counts become dense vectors,
indexed by hash and checked against the stored key, and are summed up a tree with ``FAN`` branches per node. A second pass reads the
documents' rows and looks the counts of their pairs up; texts are not read again.

The table for the lookup (hash, keys, counts) holds at most ``RESIDENT`` pairs of 17 bytes (68 MB), so it may be sent to all
tasks at any size of the corpus. If there are more distinct pairs, it holds those that most documents hold (all above
a power of two), and the links of the others are joined with their counts in a shuffle: few by their rarity, and no pair among them is hot.
Besides, the driver gets the highest count per id of A: one row per id of the vocabulary.

Texts are cut before each run of spaces, and before a line end, that follows another character: neither tokenizer
has a token across such a cut, so distinct pieces are encoded and aligned once per task (the pair files are checked for that).
The cuts are found in the bytes of a batch of texts, and its distinct pieces by Arrow's dictionary encoding.

Defined results: null and empty texts, and texts whose tokens do not spell a space and the text, have no tokens (zeros
and an empty hash); texts of any length are read whole; equal rows count as documents of their own; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwell.llm import minimal_hash
from layerwell.llm.minimal_hash import KEYS_PER_BUCKET, MinimalHash
from layerwell.session import materialize

RESIDENT = 4_000_000
FAN = 16
FLUSHED = 4_000_000
DOCS_AT_ONCE = 512
BYTES_AT_ONCE = 8 << 20
READ_AT_ONCE = 2048
PAIRS_AT_ONCE = 2_000_000
CACHED_PIECES = 300_000
JOINED = 64
LARGE_GROUP = 4096
_CUT = re.compile(r"(?<=\S)(?= |\n\S)")
_NONE = np.empty(0, np.int64)
_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
# White space as ``\s`` knows it, in UTF-8: single bytes, and longer ones as numbers.
_BLANKS = [chr(c).encode() for c in range(0x3001) if chr(c).isspace()]
_BLANK_BYTE = np.isin(np.arange(256), [b[0] for b in _BLANKS if len(b) == 1])
_LONG_BLANKS = {size: np.array([int.from_bytes(b) for b in _BLANKS if len(b) == size]) for size in (2, 3)}


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for bytes: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranked(path: str):
    """Encoder by the rank file of the vocabulary of A."""
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Aligner:
    """Tokens of both kinds, aligned for many pieces at once."""

    def __init__(self, byte_bpe_path: str, piece_path: str, ranks_path: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        self.fast = ranks_path and _ranked(ranks_path)
        self.a = Tokenizer.from_file(byte_bpe_path)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        named = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(named)]
        self.space = self.b.piece_to_id("▁")
        self.span = len(self.a_bytes) * len(self.b_bytes)  # keys of pairs are below it
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        crossing = any(b" " in x.lstrip(b" ") or (b"\n" in x and len(x) > 1) for x in self.b_bytes)
        self.cut = None if crossing else _CUT
        a_names, b_names = map(str, range(len(self.a_bytes))), map(str, range(len(self.b_bytes)))
        # The digest text of an id, by what follows it: of A a comma or a bar, of B a comma or a semicolon.
        written = [end for names, ends in ((list(a_names), ",|"), (list(b_names), ",;")) for e in ends for end in [n + e for n in names]]
        self.written = pa.array(written, pa.large_string())
        self.a_cells, self.b_cells = (pa.array(table, pa.large_binary()) for table in (self.a_bytes, self.b_bytes))

    def pieces(self, text: str) -> list[str]:
        """The space and the text, cut where no token of either kind crosses."""
        return self.cut.split(" " + text) if self.cut else [" " + text]

    def cut_all(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """``pieces`` of all (not null, not empty) texts in a row, and where those of each text begin."""
        spaced = pc.binary_join_element_wise(" ", texts.cast(pa.string()), "")
        ends = np.frombuffer(spaced.buffers()[1], np.int32)[spaced.offset : spaced.offset + len(texts) + 1]
        data = np.frombuffer(spaced.buffers()[2], np.uint8)[: ends[-1]]
        starts = np.zeros(len(data), bool)
        if self.cut:
            # Whether a character of white space ends, or starts, at a byte; behind the last text it does.
            ending = _BLANK_BYTE[data]
            starting = np.append(ending, True)
            for size, blanks in _LONG_BLANKS.items():
                leads = np.unique(blanks >> 8 * (size - 1))
                at = np.flatnonzero((data >= leads[0]) & (data <= leads[-1]))
                at = at[at + size <= len(data)]
                at = at[np.isin(sum(data[at + i].astype(np.int64) << 8 * (size - 1 - i) for i in range(size)), blanks)]
                ending[at + size - 1] = starting[at] = True
            starts[1:] = ~ending[:-1] & ((data[1:] == 32) | ((data[1:] == 10) & ~starting[2:]))
        starts[ends[:-1]] = True
        first = np.flatnonzero(starts)
        offsets = pa.py_buffer(np.append(first, len(data)).astype(np.int32))
        return pa.StringArray.from_buffers(len(first), offsets, pa.py_buffer(data)).dictionary_encode(), np.searchsorted(first, ends)

    def encode_each(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both kinds, piece by piece; a piece starts with a space or a line end."""
        a = [e.ids for e in self.a.encode_batch(pieces, add_special_tokens=False)]
        b = self.b.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        # The tokenizer puts a space before what it gets: nothing is left of a lone space, a line end gets one too many.
        b = [[self.space] if p == " " else ids[1:] if p[0] == "\n" else ids for p, ids in zip(pieces, b)]
        return a, b

    def _encode_joined(self, data: memoryview, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are encoded some dozens at a time, as one text."""
        edges = [0, *np.add.reduceat(sizes, np.arange(0, len(sizes), JOINED)).cumsum().tolist()]
        texts = [str(data[first:last], "utf-8") for first, last in zip(edges, edges[1:])]
        a = [self.fast(t) for t in texts] if self.fast else [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        b = [ids if t[0] == " " else ids[1:] for t, ids in zip(texts, b)]  # as in ``encode_each``
        return self._flat(a), self._flat(b)

    def _flat(self, ids: list[list[int]]) -> np.ndarray:
        return np.array(list(chain.from_iterable(ids)), np.int64)

    def encode(self, pieces: list[str], data: memoryview, sizes: np.ndarray, joined: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both kinds of all pieces in a row, and which pieces both kinds spell; the others have no ids here.

        ``data`` holds the pieces' bytes in a row. Pieces that end with a letter may be joined, since they would be cut there again.
        If tokens do not spell the joined text, or pieces are of another form, they are encoded one by one.
        """
        spelled = np.ones(len(pieces), bool)
        if joined:
            a, b = self._encode_joined(data, sizes)
            ends, both = np.cumsum(sizes), ((self.a_cells, self.a_sizes, a), (self.b_cells, self.b_sizes, b))
            if all(self._spell(cells, ids, data) and np.isin(ends, np.cumsum(table[ids])).all() for cells, table, ids in both):
                return a, b, spelled
        a, b = self.encode_each(pieces)
        for i, piece in enumerate(pieces):
            if not all(b"".join([table[x] for x in ids]) == piece.encode() for table, ids in ((self.a_bytes, a[i]), (self.b_bytes, b[i]))):
                spelled[i], a[i], b[i] = False, [], []
        return self._flat(a), self._flat(b), spelled

    def _spell(self, cells: pa.Array, ids: np.ndarray, data: memoryview) -> bool:
        if not len(ids):
            return False
        offsets, spelled = cells.take(pa.array(ids)).buffers()[1:]
        size = int(np.frombuffer(offsets, np.int64)[len(ids)])
        return size == len(data) and spelled[:size].equals(pa.py_buffer(data))


class Pieces:
    """What is known of the pieces that a task has met: numbers, links and the digest's text of each."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.spelled = np.empty(0, bool)
        self.numbers = np.empty((0, len(_NUMBERS)), np.int64)
        self.first, self.keys, self.times = np.zeros(1, np.int64), _NONE, _NONE
        self.texts = pa.array([], pa.large_string())

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of every text: numbers as in ``_NUMBERS``, digest, where its distinct pairs begin, and all pairs with their numbers of links."""
        if len(self.known) > CACHED_PIECES or len(self.keys) > 8 * CACHED_PIECES:
            self.clear()
        filled = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
        numbers, digests, cuts = np.zeros((len(texts), len(_NUMBERS)), np.int64), [""] * len(texts), np.zeros(len(texts) + 1, np.int64)
        if not len(filled):
            return numbers, digests, cuts, _NONE, _NONE
        row, begins = self.aligner.cut_all(texts.take(pa.array(filled)))
        words, codes = row.dictionary.to_numpy(zero_copy_only=False).tolist(), row.indices.to_numpy()
        self._learn(row.dictionary, words)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        doc = np.repeat(filled, np.diff(begins))
        wrong = np.zeros(len(texts), bool)
        wrong[doc[~self.spelled[at][codes]]] = True
        written = self.texts.take(pa.array(at)).take(row.indices)
        ends, data = np.frombuffer(written.buffers()[1], np.int64), memoryview(written.buffers()[2] or b"")
        for i, first, last in zip(filled.tolist(), ends[begins[:-1]].tolist(), ends[begins[1:]].tolist()):
            if not wrong[i]:
                digests[i] = hashlib.sha256(data[first : last - 1]).hexdigest()
        doc, codes = doc[~wrong[doc]], codes[~wrong[doc]]
        # Each document's distinct pieces and how often it has them, then its distinct pairs.
        distinct, often = np.unique(doc * len(words) + codes, return_counts=True)
        doc, word = np.divmod(distinct, len(words))
        places = at[word]
        edges = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i in range(len(_NUMBERS)):
            numbers[:, i] = np.diff(_running(self.numbers[places, i] * often)[edges])
        first, found = self.first[places], self.first[places + 1] - self.first[places]
        links = np.repeat(first - (np.cumsum(found) - found), found) + np.arange(found.sum())
        span = self.aligner.span
        pairs = np.repeat(doc, found) * span + self.keys[links]
        order = np.argsort(pairs)
        pairs, times = pairs[order], (self.times[links] * np.repeat(often, found))[order]
        heads = np.flatnonzero(np.diff(pairs, prepend=-1))
        times = np.diff(_running(times)[np.append(heads, len(times))])
        doc, keys = np.divmod(pairs[heads], span)
        return numbers, digests, np.searchsorted(doc, np.arange(len(texts) + 1)), keys, times

    def _learn(self, dictionary: pa.StringArray, words: list[str]) -> None:
        new = [(i, w[-1].isspace() or "▁" in w or not self.aligner.cut) for i, w in enumerate(words) if w not in self.known]
        for joined in (True, False):
            part = [i for i, apart in new if apart != joined]
            if part:
                pieces = [words[i] for i in part]
                self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(part))))
                self._add(pieces, dictionary.take(pa.array(part)), joined)

    def _add(self, pieces: list[str], cells: pa.StringArray, joined: bool) -> None:
        """Align new pieces: groups end where tokens of both kinds do; each token's group gives its links."""
        own = self.aligner
        sizes = pc.binary_length(cells).to_numpy().astype(np.int64)
        data = memoryview(cells.buffers()[2])[: sizes.sum()]
        a, b, spelled = own.encode(pieces, data, sizes, joined)
        ends_a, ends_b = np.cumsum(own.a_sizes[a]), np.cumsum(own.b_sizes[b])
        piece_ends = np.cumsum(np.where(spelled, sizes, 0))
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        n_a, n_b = np.bincount(of_a, minlength=len(common)), np.bincount(of_b, minlength=len(common))
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        # Pieces that are not spelled have no bytes here, so a byte's piece is the first that ends behind it.
        piece = np.searchsorted(piece_ends, common)
        total = lambda of_group: np.bincount(piece, weights=of_group, minlength=len(pieces)).astype(np.int64)
        pairs = n_a * n_b
        where, keys, times = self._links(a, b, of_a, of_b, n_a, n_b, first_b, piece)
        found = np.bincount(where, minlength=len(pieces))
        numbers = np.array([total(n_a), total(n_b), total(np.ones(len(common))), total(pairs)]).T
        written = self._written(a, b, of_a, of_b, n_a, n_b, first_a, first_b, piece_ends, ends_a, ends_b)
        self.texts = pa.concat_arrays([self.texts, written])
        self.spelled = np.concatenate([self.spelled, spelled])
        self.numbers = np.concatenate([self.numbers, numbers])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(found)])
        self.keys, self.times = np.concatenate([self.keys, keys]), np.concatenate([self.times, times])

    def _links(self, a, b, of_a, of_b, n_a, n_b, first_b, piece):
        """Distinct pairs of each piece, in its order: piece, key, number of links."""
        width, span = len(self.aligner.b_bytes), self.aligner.span
        small = n_a * n_b <= LARGE_GROUP
        repeats = np.where(small, n_b, 0)[of_a]
        left = np.repeat(np.arange(len(a)), repeats)
        nth = np.arange(len(left)) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        group = of_a[left]
        combined = [piece[group] * span + a[left] * width + b[first_b[group] + nth]]
        weights = [np.ones(len(left), np.int64)]
        for g in np.flatnonzero(~small):  # long groups: each distinct pair once
            (x, x_times), (y, y_times) = np.unique(a[of_a == g], return_counts=True), np.unique(b[of_b == g], return_counts=True)
            combined.append((piece[g] * span + x[:, None] * width + y).ravel())
            weights.append((x_times[:, None] * y_times).ravel())
        distinct, where = np.unique(np.concatenate(combined), return_inverse=True)
        times = np.bincount(where, weights=np.concatenate(weights), minlength=len(distinct)).astype(np.int64)
        return distinct // span, distinct % span, times

    def _written(self, a, b, of_a, of_b, n_a, n_b, first_a, first_b, piece_ends, ends_a, ends_b) -> pa.Array:
        """The digest's text of every piece, with a semicolon behind each group."""
        count_a, count_b = len(self.aligner.a_bytes), len(self.aligner.b_bytes)
        codes = np.empty(len(a) + len(b), np.int64)
        last_a = np.arange(len(a)) == (first_a + n_a - 1)[of_a]
        last_b = np.arange(len(b)) == (first_b + n_b - 1)[of_b]
        codes[np.arange(len(a)) + first_b[of_a]] = a + count_a * last_a
        codes[np.arange(len(b)) + (first_a + n_a)[of_b]] = 2 * count_a + b + count_b * last_b
        ends = np.searchsorted(ends_a, piece_ends, "right") + np.searchsorted(ends_b, piece_ends, "right")
        if not len(codes):
            return pa.array([""] * len(ends), pa.large_string())
        parts = self.aligner.written.take(pa.array(codes))
        offsets = np.frombuffer(parts.buffers()[1], np.int64)[np.append(0, ends)]
        return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets), parts.buffers()[2])


def _running(values: np.ndarray) -> np.ndarray:
    """Sums of the values before each place, and of all."""
    return np.concatenate([[0], np.cumsum(values)])


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, rows: int, total: int) -> Iterator[pa.RecordBatch]:
    """At most ``rows`` rows at once, whose sizes exceed ``total`` only by the last one of them."""
    full = np.diff((_running(sizes) // total)[:-1], prepend=0) > 0
    starts = np.flatnonzero(full | (np.arange(len(sizes)) % rows == 0)).tolist()
    for first, last in zip(starts, [*starts[1:], len(sizes)]):
        yield batch.slice(first, last - first)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        yield from _slices(batch, sizes, DOCS_AT_ONCE, BYTES_AT_ONCE)


def _cells(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One cell of bytes per document."""
    values = values.astype(np.min_scalar_type(values.max(initial=0)))
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _values(cells: pa.Array, counts: pa.Array) -> np.ndarray:
    """The numbers of all cells in a row."""
    parts = [np.frombuffer(c, f"u{len(c) // n}") for c, n in zip(cells.to_pylist(), counts.to_pylist()) if n]
    return np.concatenate([*parts, np.empty(0, np.uint8)]).astype(np.int64)


def document_links(
    docs: DataFrame, byte_bpe_path: str, piece_path: str, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of two kinds, told apart by which columns are null.

    What a task counts, pair by pair: task, key, mixed, n (documents of the task that hold the pair). And one row per document: doc_id,
    n_a, n_b, n_groups, n_links, groups_sha256, and how many distinct pairs it has (``pairs``), which (``keys``) and with how many links
    (``times``); the latter are unsigned numbers of as few bytes as hold them.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pair_columns = {"task": pa.int32(), "key": pa.int64(), "mixed": pa.int64(), "n": pa.int64()}
    columns = [*pair_columns, "doc_id", *_NUMBERS, "groups_sha256", "pairs", "keys", "times"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, task = Pieces(Aligner(byte_bpe_path, piece_path, ranks_path)), TaskContext.get().partitionId()
        id_type = None
        held: list[tuple[np.ndarray, np.ndarray]] = [(_NONE, _NONE)]
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held))
            distinct, where = np.unique(keys, return_inverse=True)
            return distinct, np.bincount(where, weights=n, minlength=len(distinct)).astype(np.int64)

        def rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for first in range(0, len(keys), 100_000):
                part = keys[first : first + 100_000]
                own = [np.full(len(part), task, np.int32), part, minimal_hash.mix(part), n[first : first + 100_000]]
                empty = [pa.nulls(len(part), t) for t in (id_type, *[pa.int64()] * len(_NUMBERS), pa.string(), pa.int64(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*map(pa.array, own), *empty], names=columns)

        for batch in _documents(batches):
            id_type = batch.column(0).type
            numbers, digests, cuts, keys, times = pieces.documents(batch.column(1))
            own = [batch.column(0), *map(pa.array, numbers.T), pa.array(digests), pa.array(np.diff(cuts)), _cells(keys, cuts), _cells(times, cuts)]
            empty = [pa.nulls(batch.num_rows, t) for t in pair_columns.values()]
            yield pa.RecordBatch.from_arrays([*empty, *own], names=columns)
            held.append(np.unique(keys, return_counts=True))
            size += len(held[-1][0])
            if size >= FLUSHED:
                held, size = [merged()], 0
                if len(held[0][0]) >= FLUSHED:
                    yield from rows(*held[0])
                    held = [(_NONE, _NONE)]
        yield from rows(*merged())

    schema = ", ".join(["task int, key long, mixed long, n long", f"doc_id {kind}", *(f"{c} long" for c in _NUMBERS), "groups_sha256 string"])
    schema += ", pairs long, keys binary, times binary"
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(texts.mapInArrow(link, schema), "links")


def _counted(links: DataFrame) -> DataFrame:
    return links.where(F.col("key").isNotNull()).select("task", "key", "mixed", "n")


def pair_counts(
    docs: DataFrame, byte_bpe_path: str, piece_path: str, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """What tasks count, pair by pair: task, key, mixed, n (documents of the task that hold the pair)."""
    return _counted(document_links(docs, byte_bpe_path, piece_path, ranks_path, id_col, text_col))


_HASH = "bucket long, seed long, sizes binary, bits binary, keys binary"


def hash_pairs(pairs: DataFrame) -> tuple[DataFrame, int]:
    """The minimal perfect hash of distinct (key, mixed), one row per bucket as in ``_HASH``, and the number of buckets."""
    buckets = max(1, -(-pairs.count() // KEYS_PER_BUCKET))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, sizes, bits, keys = minimal_hash.build(np.sort(pdf["key"].to_numpy()))
        row = [int(pdf["bucket"].iloc[0]), seed, sizes.tobytes(), bits.tobytes(), keys.tobytes()]
        return pd.DataFrame([row], columns=["bucket", "seed", "sizes", "bits", "keys"])

    rows = pairs.select("key", (F.col("mixed") % buckets).alias("bucket"))
    return materialize(rows.groupBy("bucket").applyInPandas(build, _HASH), "hash"), buckets


def sum_counts(counted: DataFrame, hashes: DataFrame, buckets: int) -> DataFrame:
    """Dense count vectors (bucket, counts), in the order of the hash, summed over all tasks up a tree."""
    tasks = (counted.agg(F.max("task")).first()[0] or 0) + 1
    branches = -(-tasks // FAN)
    branch = F.floor(F.col("task") / FAN)
    leaves = counted.select((F.col("mixed") % buckets).alias("bucket"), branch.alias("branch"), "key", "n")
    spread = hashes.withColumn("branch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(branches - 1).cast("long"))))

    def dense(rows: pd.DataFrame, hashed: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=["bucket", "branch", "counts"])
        own = hashed.iloc[0]
        table = MinimalHash([own.seed], [np.frombuffer(own.sizes, np.int64)], [np.frombuffer(own.bits, np.uint64)])
        keys, stored = rows["key"].to_numpy(), np.frombuffer(own["keys"], np.int64)
        at = table.index(keys)
        if not np.array_equal(stored[at], keys):
            raise ValueError("a pair is not in the hash of its bucket")
        counts = np.bincount(at, weights=rows["n"].to_numpy(), minlength=len(stored)).astype(np.int64)
        return pd.DataFrame([[int(own.bucket), int(own.branch), counts.tobytes()]], columns=["bucket", "branch", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in pdf["counts"])
        return pd.DataFrame([[pdf["bucket"].iloc[0], pdf["branch"].iloc[0], total.tobytes()]], columns=["bucket", "branch", "counts"])

    schema = "bucket long, branch long, counts binary"
    vectors = leaves.groupBy("bucket", "branch").cogroup(spread.groupBy("bucket", "branch")).applyInPandas(dense, schema)
    while branches > 1:
        branches = -(-branches // FAN)
        vectors = vectors.withColumn("branch", F.floor(F.col("branch") / FAN)).groupBy("bucket", "branch").applyInPandas(add, schema)
    return vectors.select("bucket", "counts")


def _rows(table: DataFrame) -> DataFrame:
    """(key, mixed, n) of all pairs of a table (bucket, ..., keys, counts)."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, counts = np.frombuffer(keys, np.int64), np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, minimal_hash.mix(keys), counts)], names=["key", "mixed", "n"])

    return table.select("keys", "counts").mapInArrow(unpack, "key long, mixed long, n long")


def pair_table(counted: DataFrame) -> DataFrame:
    """One row per bucket as in ``_HASH``, with ``counts``: in how many documents a pair is linked."""
    hashes, buckets = hash_pairs(counted.select("key", "mixed").distinct())
    return materialize(hashes.join(sum_counts(counted, hashes, buckets), "bucket"), "table")


def _resident(table: DataFrame, resident: int) -> tuple[DataFrame, DataFrame | None]:
    """Buckets of the pairs that are sent to all tasks, and the rows (key, n) of the others, if there are any."""
    rows = materialize(_rows(table), "counts")
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    levels = dict(rows.groupBy(level.alias("level")).count().collect())  # at most 63 rows
    least, total = 64, 0
    while least and total + levels.get(least - 1, 0) <= resident:
        least -= 1
        total += levels.get(least, 0)
    if not least:
        return table, None
    head = materialize(rows.where(level >= least), "head")
    return pair_table(head.withColumn("task", F.lit(0))), rows.where(level < least).select("key", "n")


def align(
    docs: DataFrame, byte_bpe_path: str, piece_path: str, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    resident: int = RESIDENT,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``ranks_path`` is the vocabulary of A as ranks; it only makes encoding faster.
    """
    spark = docs.sparkSession
    links = document_links(docs, byte_bpe_path, piece_path, ranks_path, id_col, text_col)
    table = pair_table(_counted(links))
    head, tail = _resident(table, resident)
    parts = head.orderBy("bucket").collect()  # at most ``resident`` pairs
    b_count = _pieces_in(piece_path)
    width = F.lit(b_count)
    by_a = _rows(table).groupBy(F.floor(F.col("key") / width).alias("a")).agg(F.max("n").alias("most")).collect()  # one row per id of A
    whole = lambda name: np.concatenate([_NONE, *(np.frombuffer(p[name], np.int64) for p in parts)])
    most = np.zeros(max((r.a for r in by_a), default=0) + 1, np.int64)
    for r in by_a:
        most[r.a] = r.most
    sizes, bits = ([np.frombuffer(p[name], kind) for p in parts] for name, kind in (("sizes", np.int64), ("bits", np.uint64)))
    sent = spark.sparkContext.broadcast((MinimalHash([p.seed for p in parts], sizes, bits), whole("keys"), whole("counts"), most))
    columns = ["doc_id", *_NUMBERS, "n_best", "count_sum"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, stored, counts, most = sent.value
        row = TaskContext.get().partitionId() << 40
        for batch in (part for b in batches for part in _slices(b, b.column("pairs").to_numpy(), READ_AT_ONCE, PAIRS_AT_ONCE)):
            own, cuts = batch.columns[:-3], _running(batch.column("pairs").to_numpy())
            links_of, times = (_values(batch.column(c), batch.column("pairs")) for c in ("keys", "times"))
            keys, where = np.unique(links_of, return_inverse=True)
            at = hashed.index(keys)
            known = at >= 0
            known[known] = stored[at[known]] == keys[known]
            n = np.zeros(len(keys), np.int64)
            n[known] = counts[at[known]]
            best = known & (n == most[keys // b_count])
            sums = [pa.array(np.diff(_running(times * x[where])[cuts])) for x in (best, n)]
            missing = ~known[where]
            cuts = pa.array(_running(missing)[cuts], pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x[missing])) for x in (links_of, times)]
            rows = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([*own[:-1], *sums, own[-1], rows, *lists], names=[*columns, "groups_sha256", "row", "keys", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"{c} long" for c in columns[1:]), "groups_sha256 string, row long, keys array<long>, times array<long>"])
    aligned = links.where(F.col("key").isNull()).select("doc_id", *_NUMBERS, "groups_sha256", "pairs", "keys", "times")
    found = aligned.mapInArrow(look_up, schema)
    if tail is None:
        return found.select(*columns, "groups_sha256")
    found = materialize(found, "rare")
    # ``tail`` holds one row per pair and no pair of many documents, so the join has no hot key.
    asked = found.select("row", F.explode(F.arrays_zip("keys", "times")).alias("link")).select("row", "link.keys", "link.times")
    highest = spark.createDataFrame([(int(r.a), int(r.most)) for r in by_a], "a long, most long")
    asked = asked.join(tail, asked["keys"] == tail["key"]).join(F.broadcast(highest), F.floor(F.col("key") / width) == F.col("a"))
    best = F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)
    sums = asked.groupBy("row").agg(F.sum(best).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    added = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return found.join(sums, "row", "left").select(*columns[:5], added("n_best", "more_best"), added("count_sum", "more_sum"), "groups_sha256")


def _pieces_in(piece_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()


def pair_links(table: DataFrame, piece_path: str) -> DataFrame:
    """The corpus-wide dictionary of a ``pair_table``: a, b, n (documents that hold the pair linked)."""
    width = F.lit(_pieces_in(piece_path))
    return _rows(table).select(F.floor(F.col("key") / width).cast("int").alias("a"), (F.col("key") % width).cast("int").alias("b"), "n")

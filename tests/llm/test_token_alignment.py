import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
from llm_support import docs

from layerwell.llm import minimal_hash, token_alignment
from layerwell.llm.token_alignment import Aligner, Pieces, align, pair_counts, pair_links, pair_table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    parts = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "é", "🙂", "日本", "<s>", "<|endoftext|>", "▁", "ﬁ", "1234", "word", "'s", "\x00", " ", "　", ".", "\r"]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(n)]


def whole(aligner, text):
    """Groups of a text encoded in one piece, from the sets of ends."""
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    a_parts, b_parts = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if b"".join(a_parts) != (" " + text).encode() or b"".join(b_parts) != (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(p) for p in a_parts]), np.cumsum([len(p) for p in b_parts])
    groups, last = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        groups.append(([i for i, e in zip(a, ends_a) if last < e <= end], [i for i, e in zip(b, ends_b) if last < e <= end]))
        last = end
    return groups


def brute(aligner, rows):
    found = [(doc, whole(aligner, text) if text else None) for doc, text in rows]
    links = [[(x, y) for a, b in groups for x in a for y in b] if groups else [] for _, groups in found]
    count = Counter(pair for own in links for pair in set(own))
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (doc, groups), own in zip(found, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        out.append((doc, sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(groups or []), len(own),
                    sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr), count


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cut_texts_have_the_ids_of_whole_texts():
    aligner = Aligner(A, B)
    for text in odd_texts(6000):
        pieces = aligner.pieces(text)
        a, b = aligner.encode_each(pieces)
        assert "".join(pieces) == " " + text
        assert sum(a, []) == aligner.a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        if "▁" not in text:  # stands for a space in B, so no such text is spelled by its tokens
            assert sum(b, []) == aligner.b.encode(text), repr(text)


def test_batches_are_cut_like_single_texts():
    aligner = Aligner(A, B)
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    around = [f"a{x}b\n{x}c{y}\n d \n{y}" for x in blanks for y in (" ", "\n", "é", "\u2003")]
    texts = around + odd_texts(3000, 5) + blanks + ["\u2019\u00c2\u2026 \u2014", "x\n", "\ny"]
    row, begins = aligner.cut_all(pa.array(texts))
    found = row.to_pylist()
    for text, first, last in zip(texts, begins, begins[1:]):
        assert found[first:last] == aligner.pieces(text), repr(text)


def test_documents_in_batches_with_forgotten_pieces_equal_brute_force(monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHED_PIECES", 20)
    monkeypatch.setattr(token_alignment, "BYTES_AT_ONCE", 600)
    aligner = Aligner(A, B, RANKS)
    pieces = Pieces(aligner)
    rows = cases()
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], names=["doc_id", "text"])
    at = 0
    for part in token_alignment._documents([batch]):
        numbers, digests, cuts, keys, times = pieces.documents(part.column(1))
        for i, text in enumerate(part.column(1).to_pylist()):
            groups = whole(aligner, text) if text else None
            links = Counter(x * len(aligner.b_bytes) + y for a, b in groups or [] for x in a for y in b)
            assert dict(zip(keys[cuts[i] : cuts[i + 1]].tolist(), times[cuts[i] : cuts[i + 1]].tolist())) == links
            assert numbers[i].tolist() == [sum(len(g[0]) for g in groups or []), sum(len(g[1]) for g in groups or []), len(groups or []), links.total()]
            assert bool(digests[i]) == bool(groups)
        at += part.num_rows
    assert at == len(rows)


def test_texts_are_read_and_aligned_once(spark, tmp_path):
    path = str(tmp_path / "documents")
    docs(spark, [(i, t, None, None) for i, t in cases()]).write.parquet(path)
    found = align(spark.read.parquet(path), A, B)
    assert found.inputFiles() and not any(path in f for f in found.inputFiles())


def test_slices_hold_all_rows_and_few_bytes():
    rng = random.Random(4)
    for total in (1, 50, 10_000):
        sizes = np.array([rng.choice([0, 1, 30, 200]) for _ in range(300)])
        batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(sizes)], names=["i", "size"])
        parts = [p.to_pydict() for p in token_alignment._slices(batch, sizes, 64, total)]
        assert sum((p["i"] for p in parts), []) == list(range(300))
        assert all(0 < len(p["i"]) <= 64 and sum(p["size"][:-1]) < total for p in parts)
    assert list(token_alignment._slices(batch.slice(0, 0), sizes[:0], 64, 50)) == []


def cases():
    texts = [None, "", " ", "\n", "▁", "a▁b", "<0x41>", "plain words", "plain words", "z" * 20_000, "日本語" * 2000, "=" * 5000, "x " * 5000]
    return [(i, t) for i, t in enumerate(texts + odd_texts(150, 8))] + [(8, "other plain words"), (None, "plain"), (8, "other plain words")]


def test_equals_brute_force_with_all_and_with_few_resident_pairs(spark):
    rows = cases()
    want, _ = brute(Aligner(A, B), rows)
    frame = docs(spark, [(i, t, None, None, 1, "x") for i, t in rows], ", key long, n_a string")
    assert table(align(frame, A, B)) == table(align(frame, A, B, RANKS)) == want
    assert table(align(frame, A, B, resident=40)) == want
    assert table(align(frame, A, B, resident=0)) == want


def test_pair_table_counts_documents(spark):
    rows = cases()
    _, count = brute(Aligner(A, B), rows)
    counted = pair_counts(docs(spark, [(i, t, None, None) for i, t in rows]).repartition(40), A, B, RANKS)
    got = {(r.a, r.b): r.n for r in pair_links(pair_table(counted), B).collect()}
    assert got == dict(count)


def test_minimal_hash_is_minimal_and_perfect():
    for n in (1, 2, 63, 5000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n))
        seed, sizes, bits, ordered = minimal_hash.build(keys)
        found = minimal_hash.MinimalHash([seed], [sizes], [bits])
        at = found.index(keys)
        assert sorted(at) == list(range(len(keys))) and (ordered[at] == keys).all()
        other = found.index(keys + (1 << 41))
        assert (other < len(keys)).all() and (ordered[other[other >= 0]] != (keys + (1 << 41))[other >= 0]).all()


def test_no_rows_and_no_tokens(spark):
    assert align(docs(spark, []), A, B).collect() == []
    assert table(align(docs(spark, [(1, None, None, None), (2, "a▁b", None, None)]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]

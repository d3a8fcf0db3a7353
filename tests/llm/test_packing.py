import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_support import docs
from tokenizers import Tokenizer

from layerwell.llm.packing import pack, plan_sequences, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "a  b   c", " lead", "trail ", "\n\n a \n b", "a <|endoftext|> b", "nbsp x  y", "it's we'll I'D",
    "日本語 テスト 123 45.6", "🙂🙂 🙂", "x" * 70 + " y", "tab\tsep \t mix", " em space", "é combining",
]


def brute(rows, capacity=1024):
    tokenizer = Tokenizer.from_file(PATH)
    out = {}
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[r[0], piece] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    return out


def best_fit(lengths, capacity):
    """Room left in each sequence after best-fit decreasing, one piece at a time."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(capacity - length)
    return rooms


@pytest.mark.parametrize("ranks", [RANKS, None])
def test_pieces_and_places(spark, ranks):
    random.seed(3)
    words = ["alpha", "Beta,", "gamma-ray", "das", "été", "42"]
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(random.choices(words, k=random.choice([3, 50, 900, 5000]))), "en", "s", 1, "x") for i in range(40)]
    got = pack(docs(spark, rows, ", length int, offset string"), PATH, ranks).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == brute(rows)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(held) == len(best_fit([r.length for r in got], 1024))


def test_plan_equals_best_fit_decreasing():
    random.seed(5)
    for _ in range(30):
        capacity = random.choice([7, 50, 128])
        lengths = [random.randint(1, capacity) for _ in range(random.randint(1, 400))]
        rooms = best_fit(lengths, capacity)
        histogram = {n: lengths.count(n) for n in set(lengths)}
        plan = plan_sequences(histogram, capacity)
        used, placed = {}, dict.fromkeys(histogram, 0)
        for length, a, b, first, each, offset in plan:
            assert a == placed[length]
            placed[length] = b
            for rank in range(b - a):
                used.setdefault(first + rank // each, []).append((offset + rank % each * length, length))
        assert placed == histogram and len(used) == len(rooms)
        for places in used.values():
            ends = 0
            for offset, length in sorted(places):
                assert offset == ends
                ends += length
            assert ends <= capacity


def test_plan_stays_small():
    random.seed(6)
    assert len(plan_sequences({n: random.randint(1, 10**9) for n in range(1, 1025)})) < 140_000


def test_sequences_hold_the_tokens(spark):
    rows = [(i, "word " * (i * 37), "en", "s") for i in range(60)]
    packed = pack(docs(spark, rows), PATH, RANKS, with_tokens=True)
    made = sequences(packed).collect()
    assert sum(r.n_tokens for r in made) == sum(len(r.ids) // 4 for r in made)
    assert max(r.n_tokens for r in made) <= 1024


def test_one_length_for_all_repeated_rows_and_no_rows(spark):
    got = pack(docs(spark, [(5, "same", "en", "s")] * 2000), PATH, RANKS).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 2000 and len({r.sequence_id for r in got}) == 4
    assert pack(docs(spark, []), PATH, RANKS).collect() == []

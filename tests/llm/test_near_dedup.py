import random
import re
from itertools import combinations

import numpy as np
from llm_support import by_id, docs

from layerwell.llm.near_dedup import drop_near_duplicates, near_duplicates
from layerwell.llm.sketch import Shingler, likely_similarity, sketch


def shingles(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 75 * len(s | t):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(copies=330):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(4000)]
    text = lambda n: [random.choice(vocabulary) for _ in range(n)]
    base, passage = text(120), text(60)
    rows = []
    for i in range(copies):  # a large group of near copies, some of them near to a few others only
        words = list(base)
        for _ in range(random.choice([0, 1, 1, 2, 3, 4])):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        rows.append((10 + i, " ".join(words)))
    for i in range(120):  # a passage that many documents share
        rows.append((2000 + i, " ".join(text(random.choice([20, 40, 60])) + passage)))
    rows += [(3000, "Tiny text"), (3001, "tiny  TEXT"), (3002, "tiny text more"), (3003, None), (3004, ""), (3005, " \n\t")]
    rows += [(3006, "É a b c d e"), (3007, "é a b c d e"), (3008, "x" * 2_000_000), (3009, "y z " * 300_000), (3010, "y z " * 300_001)]
    return [(i, t, None, "s", 1, "x") for i, t in rows]


EXTRA = ", node int, component string"


def test_components_equal_brute_force(spark):
    rows = corpus()
    got = by_id(near_duplicates(docs(spark, rows, EXTRA)))
    want = brute(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_stage_keeps_one_row_of_each_group(spark):
    rows = corpus(40)
    frame = docs(spark, rows, EXTRA)
    got = drop_near_duplicates(frame)
    assert got.columns == frame.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted({c for _, c in brute(rows).values()})


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(1, "a b c d e f", None, "s"), (1, "a b c d e f", None, "s"), (None, "a b c d e f", None, "s"), (None, "q", None, None)]
    got = near_duplicates(docs(spark, rows)).collect()
    assert len(got) == 4 and sorted(r.component_id or 0 for r in got) == [0, 1, 1, 1]
    assert near_duplicates(docs(spark, [])).collect() == []
    assert drop_near_duplicates(docs(spark, [])).collect() == []


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 2**63, 3000).astype(np.uint64)
    left, right = np.sort(pool[:2000]), np.sort(pool[500:2500])
    a, b, union = sketch([left, right, np.sort(pool[:2500])])
    assert (np.maximum(a, b) == union).all()
    found = likely_similarity(a[None], b[None], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(found - 1500 / 2500) < 0.12


def test_words_are_cut_and_folded_as_stated():
    sets = Shingler().sets([b"One\x0btwo three\x0cfour five six", "one two  three four five six ".encode(), b"ONE TWO THREE FOUR FIVE SIX"])
    assert len(sets[0]) == 2 and (sets[0] == sets[2]).all() and len(np.intersect1d(sets[0], sets[1])) == 1


def test_one_id_with_two_texts(spark):
    """The texts of one id link it to both of their neighbours, whatever the order of the rows."""
    base, other = [" ".join(f"{x}{i}" for i in range(100)) for x in "ab"]
    near = lambda text: text.replace("50", "x")
    rows = [(5, base, None, None), (5, other, None, None), (9, near(other), None, None), (7, near(base), None, None), (4, "", None, None), (5, None, None, None)]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        got = near_duplicates(docs(spark, order)).collect()
        assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(5, 5, True), (7, 5, False), (9, 5, False), (4, 4, True)}
        assert len(got) == 6


def test_rows_without_ids_link_others(spark):
    base = [f"w{i}" for i in range(100)]
    step = lambda n: " ".join([f"n{i}" for i in range(n)] + base[n:])
    rows = [(1, step(0), None, None), (None, step(9), None, None), (2, step(18), None, None), (None, "far from all others", None, None)]
    want = brute([(r[0] if r[0] else -i, r[1]) for i, r in enumerate(rows)])
    assert want[1][1] == want[2][1] == -1, "linked through the row without an id"
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near_duplicates(docs(spark, rows)).collect()}
    assert got == {(1, 96): 1, (None, 96): 1, (2, 96): 1, (None, 1): None}


def test_long_texts_of_one_band_are_cut_into_blocks(spark, monkeypatch):
    """Texts that share bands without being near, with blocks of few shingles."""
    from layerwell.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 3000)
    rows = corpus(60)
    want = brute(rows)
    got = by_id(near_duplicates(docs(spark, rows, EXTRA)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want

import hashlib
import string

from llm_support import by_id, docs

from layerwell.llm.common import filter_bits
from layerwell.llm.exact_dedup import deduplicate, duplicate_report

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
LONG = "Ab é" * 500_000
ROWS = [
    (1, "Same Text", "en", "a", 0, "x"), (2, "same text", "en", None, 0, "y"), (3, "SAME TEXT", None, "b", 1, None),
    (4, "É", "fr", "a", 1, "x"), (5, "é", "fr", "a", 0, "x"), (6, None, None, None, None, None), (7, "", "en", "a", 1, "x"),
    (8, LONG, "en", "a", 1, "x"), (9, LONG.upper().replace("É", "é"), "en", "a", 1, "x"), (10, "alone", "en", "a", 1, "x"),
    (11, "twice", "en", "a", 1, "x"), (11, "twice", "en", "a", 1, "x"), (None, "twice", "en", "a", 1, "x"),
]
EXTRA = ", kept int, digest string"


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[1] or "").translate(FOLD), []).append(r[0])
    return groups


def test_report_equals_brute_force(spark):
    got = duplicate_report(docs(spark, ROWS, EXTRA)).collect()
    groups = expected(ROWS)
    assert len(got) == len(ROWS)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        top = max(i for i in ids if i is not None)
        assert (r.keep_id, r.group_size, r.kept) == (top, len(ids), r.doc_id == top)


def test_stage_keeps_one_whole_row_per_text(spark):
    frame = docs(spark, ROWS, EXTRA)
    got = deduplicate(frame)
    assert got.columns == frame.columns
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(max(i for i in ids if i is not None) for ids in expected(ROWS).values())
    whole = {(r[0], r[1]) for r in ROWS}
    assert all((r.doc_id, r.text) in whole for r in rows)


def test_a_large_group_and_a_full_filter(spark, monkeypatch):
    """All rows of one text, with a filter so small that everything looks repeated."""
    import layerwell.llm.exact_dedup as module

    monkeypatch.setattr(module, "filter_bits", lambda keys: 64)
    frame = docs(spark, [(i, "copy" if i % 3 else f"own {i}", "en", "a") for i in range(3000)])
    got = by_id(duplicate_report(frame))
    assert all(got[i].group_size == (2000 if i % 3 else 1) for i in got)
    assert got[1].keep_id == 2999 and deduplicate(frame).count() == 1001


def test_empty_table(spark):
    frame = docs(spark, [])
    assert duplicate_report(frame).collect() == [] and deduplicate(frame).collect() == []


def test_filter_size_is_bounded():
    assert filter_bits(0) == 1 << 10 and filter_bits(1000) == 1 << 14 and filter_bits(10**12) == 1 << 26

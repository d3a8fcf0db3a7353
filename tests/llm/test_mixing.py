import random
import re
from collections import Counter

from llm_support import docs

from layerwell.llm.mixing import mix, mix_report, slice_digits


def targets(sizes):
    """The stated rule, taken literally: share by weight, stop at three times the size, reshare."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    stopped, total = {}, sum(sizes.values())
    while True:
        rest = total - sum(stopped.values())
        going = [s for s in names if s not in stopped]
        share = sum(weight[s] for s in going)
        over = [s for s in going if rest * weight[s] / share > 3 * sizes[s]]
        if not over:
            return {s: stopped.get(s, rest * weight[s] / share if s not in stopped else 0) for s in names}
        stopped |= {s: 3 * sizes[s] for s in over}


def corpus(seed=1):
    random.seed(seed)
    rows = []
    for i in range(400):
        source = random.choices(["b", "a", "é", None, "tiny", "zz"], [30, 10, 10, 5, 1, 44])[0]
        words = random.choice([0, 1, 5, 40, 300])
        rows.append((i, " \t".join(["w"] * words) if i % 50 else None, "en", source, 1, "x"))
    return rows + [rows[7], (None, "no id", "en", "a", 1, "x")]


EXTRA = ", size int, row string"


def test_report_takes_the_targets_to_the_word(spark):
    rows = corpus()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = targets(sizes)
    frame = docs(spark, rows, EXTRA)
    got = mix_report(frame).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 and 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    assert all(taken[s] == int(want[s] + 1e-9) for s in want)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix_report(frame.repartition(5)).collect()), key=repr)


def test_stage_repeats_whole_documents(spark):
    rows = corpus(2)
    frame = docs(spark, rows, EXTRA)
    got = mix(frame)
    assert got.columns == frame.columns
    texts = {(r[0], r[1]) for r in rows}
    copies = Counter((r.doc_id, r.text) for r in got.collect())
    given = Counter((r[0], r[1]) for r in rows)
    assert set(copies) <= texts and all(n <= 3 * given[k] for k, n in copies.items())
    words = lambda f: sum(len((r.text or "").split()) for r in f.collect())
    assert abs(words(got) - words(frame)) <= 6 * 150
    assert words(mix(frame, cut_documents=True)) in range(words(frame) - 6, words(frame) + 1)


def test_all_in_one_source_null_texts_and_no_rows(spark):
    one = [(i, "a b c", "en", "only") for i in range(50)]
    assert all(r.taken == 3 for r in mix_report(docs(spark, one)).collect())
    empty = docs(spark, [(1, None, None, None), (2, "  ", None, "s")])
    assert {r.taken for r in mix_report(empty).collect()} == {0} and mix(empty).collect() == []
    assert mix_report(docs(spark, [])).collect() == [] and mix(docs(spark, [])).collect() == []


def test_ranges_stay_short():
    assert slice_digits(0) == 2 and slice_digits(10**9) == 4

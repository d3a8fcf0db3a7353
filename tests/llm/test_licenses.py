import random
import re

from llm_support import by_id, docs

from layerwell.llm.licenses import BASE, NOTICES, edits_of, license_report, pieces, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(text):
    """Every run of words against every notice."""
    words = WORD.findall(lower(text))
    best = {}
    for label, notice in BASE + NOTICES:
        edits = edits_of(notice)
        for first in range(len(words)):
            joined = ""
            for last in range(first, len(words)):
                joined += " " * (last > first) + words[last]
                if len(joined) > len(notice) + edits:
                    break
                if len(joined) >= len(notice) - edits and (d := distance(joined, notice)) <= edits:
                    best[label, notice] = min(d, best.get((label, notice), 99))
    places = [(i, label) for label, phrase in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places), best


def misspell(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        text[at : at + rng.choice([0, 1, 1])] = rng.choice(["", "x", "é", " "])
    return "".join(text)


def cases():
    rng = random.Random(5)
    filler = ["the", "license", "mit", "gnu", "public", "by", "CC", "Ünder", "2.0", "of"]
    texts = [None, "", "...", "MIT License", "MIT-License,\nCC BY! GNU (General) Public License.", "mit licenses submit license", "cc by cc by cc by",
             "MİT License", "apache  licence", "emit license", "mit license" + "é", "©cc by", "aaa mit license\0mit license"]
    for _ in range(250):
        _, notice = rng.choice(BASE + NOTICES)
        texts.append(" ".join([*rng.choices(filler, k=rng.randrange(4)), misspell(rng, notice, rng.randrange(edits_of(notice) + 3)), *rng.choices(filler, k=3)]))
    return texts


def test_equals_brute_force(spark):
    texts = cases()
    got = by_id(license_report(docs(spark, [(i, t, None, None, 1, "x") for i, t in enumerate(texts)], ", n_words int, spans string")))
    assert len(got) == len(texts)
    near = 0
    for i, text in enumerate(texts):
        n, places, best = brute(text)
        r = got[i]
        assert (r.n_words, r.n_base) == (n, len(places)), text
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None)), text
        assert r.base_labels == ",".join(sorted({p[1] for p in places})), text
        assert r.labels == ",".join(sorted({label for label, _ in best})), text
        want = max((1 - d / len(notice) for (_, notice), d in best.items()), default=0.0)
        assert abs(r.score - want) < 1e-12, text
        near += 0 < want < 1
    assert near > 60


def test_spans_point_into_the_text(spark):
    text = "¡Hola! Released under the   GNU Generl (Public) Licence, v3; see MIT License."
    spans = by_id(scan(docs(spark, [(1, text, None, None)])))[1].spans
    assert [(s.label, s.edits, text[s.start : s.end], s.first_word, s.words) for s in spans] == [
        ("gpl", 2, "GNU Generl (Public) Licence", 4, 4), ("mit", 0, "MIT License", 10, 2)
    ]


def test_one_piece_survives_all_edits():
    for _, notice in BASE + NOTICES:
        cut = pieces(notice, edits_of(notice))
        assert "".join(p for _, p in cut) == notice and all(notice[a : a + len(p)] == p for a, p in cut)
        assert min(len(p) for _, p in cut) >= 5


def test_long_texts_repeated_rows_and_no_rows(spark):
    long = "mit license " * 20_000 + "all right reserved " * 2_000 + "a" * 300_000
    rows = [(1, long, None, None), (1, "cc by", None, None), (1, "cc by", None, None), (None, "cc by", None, None)]
    got = license_report(docs(spark, rows)).collect()
    assert sorted(r.n_base for r in got) == [1, 1, 1, 20_000]
    assert max(got, key=lambda r: r.n_base).labels == "mit,reserved"
    assert license_report(docs(spark, [])).collect() == []

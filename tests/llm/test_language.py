import random

import pytest
from llm_support import by_id, docs, held

from layerwell.llm.language import identify, keep_identified, language_report, scorer, train

SYLLABLES = {"xx": ["ka", "to", "mi", "ru"], "yy": ["sch", "ung", "ber", "ein"], "zz": ["é", "eau", "oui", "ç"]}
COMMON = {"xx": ["no", "wa"], "yy": ["der", "und"], "zz": ["le", "qui"]}
ODD = [None, "", "123 !!", "\n", "Z", "日本語", "ka" * 100_000, "KATO", "der der der 5"]


def sentence(lang, n):
    return " ".join(random.choice(COMMON[lang]) if random.random() < 0.3 else "".join(random.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def corpus():
    random.seed(9)
    rows = []
    for i in range(600):
        lang = random.choice(list(SYLLABLES))
        rows.append((i, sentence(lang, random.choice([1, 5, 50])), None if i % 40 == 0 else lang, "s", 1, "x"))
    rows += [(1000 + i, t, "xx" if i % 2 else None, None, 1, None) for i, t in enumerate(ODD)]
    return rows + [rows[3]]


EXTRA = ", score int, row string"


def test_held_out_accuracy_and_undetermined_texts(spark):
    rows = corpus()
    got = language_report(docs(spark, rows, EXTRA)).collect()
    assert len(got) == len(rows)
    lang = {r[0]: r[2] for r in rows if r[0] < 600}
    tested = [r for r in got if r.held_out and lang.get(r.doc_id)]
    assert len(tested) > 100 and sum(r.lang_pred == lang[r.doc_id] for r in tested) >= 0.98 * len(tested)
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id, 4, 2) for r in got)
    assert {r.doc_id - 1000 for r in got if r.lang_pred == "und"} == {0, 1, 2, 3}


def test_held_out_labels_and_other_columns_change_nothing(spark):
    rows = corpus()
    other = [(r[0], r[1], "yy" if held(r[0], 4, 2) else r[2], "t", 2, "y") for r in rows]
    first = sorted(map(tuple, language_report(docs(spark, rows, EXTRA)).collect()))
    assert first == sorted(map(tuple, language_report(docs(spark, other, EXTRA)).collect()))


def test_words_first_then_shorter_ngrams(spark):
    """Scores against a plain reading of the model."""
    import numpy as np

    model = train(docs(spark, corpus(), EXTRA))
    score = scorer(model)
    known, table = model["words"]

    def plain(word):
        if word in known:
            return table[known[word]]
        for n in (5, 4, 3, 2, 1):
            ids, scores = model["ngrams"][n]
            grams = [f"<{word}>"[i : i + n] for i in range(len(word) + 3 - n)]
            if any(g in ids for g in grams):
                return np.mean([scores[ids[g]] for g in grams if g in ids], axis=0)
        return np.zeros(len(model["languages"]))

    for text in ("der katomi", "unknownword le", "ru", "qqq", "eaué wa schung"):
        total = sum(plain(w) for w in text.split())
        likely = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        lang, value = score(text)
        assert lang == model["languages"][int(total.argmax())] and value == pytest.approx(likely.max())


def test_long_words_are_scored_whole(spark):
    """Runs of more than 64 letters, up to several stretches, whose middle is in another language than their ends."""
    import numpy as np

    model = train(docs(spark, corpus(), EXTRA))
    score = scorer(model)

    def plain(word):
        for n in (5, 4, 3, 2, 1):
            ids, scores = model["ngrams"][n]
            grams = [f"<{word}>"[i : i + n] for i in range(len(word) + 3 - n)]
            if any(g in ids for g in grams):
                return np.mean([scores[ids[g]] for g in grams if g in ids], axis=0)
        return np.zeros(len(model["languages"]))

    ends = "katomiru" * 4
    for middle, lang in (("schungberein" * 10, "yy"), ("eauouié" * 20, "zz"), ("schungberein" * 2500, "yy"), ("eauouié" * 3000, "zz")):
        word = ends + middle + ends
        total = plain(word)
        likely = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        assert score(word) == (lang, pytest.approx(likely.max()))
        assert score(word + " " + word)[1] > score(word)[1]  # the cache is skipped, not the word


def test_stage_drops_only_what_it_cannot_tell(spark):
    rows = corpus()
    frame = docs(spark, rows, EXTRA)
    got = keep_identified(frame)
    assert got.columns == frame.columns
    gone = {r[0] for r in rows} - {r.doc_id for r in got.collect()}
    assert {1000, 1001, 1002, 1003} <= gone and len([i for i in gone if i < 600]) <= 3
    assert {r.lang for r in keep_identified(frame, languages=("xx",)).collect()} <= {"xx", None}


def test_without_labels_and_without_rows(spark):
    unlabelled = docs(spark, [(1, "some text", None, "s"), (2, None, None, None)])
    assert {r.lang_pred for r in language_report(unlabelled).collect()} == {"und"}
    assert language_report(docs(spark, [])).collect() == [] and keep_identified(docs(spark, [])).collect() == []
    clash = identify(docs(spark, [(1, "a", "xx", "s", "old")], ", lang_pred string"), train(docs(spark, corpus(), EXTRA)))
    assert by_id(clash)[1].lang_pred in SYLLABLES and clash.columns.count("lang_pred") == 1

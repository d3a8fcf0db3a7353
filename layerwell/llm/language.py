"""Language identification by known words first, then shorter and shorter character n-grams.

A word of the vocabulary scores by its log frequency in each language. Any other
word is scored by the mean of its longest character n-grams that are known: five characters,
then four, down to one; words of any length are read whole. A text's scores are summed over its words; the softmax of
the sums is the posterior.

The model is counted from a sample of the labelled rows of at most about
``docs_per_language`` documents per language, taken by a hash of the id, and holds the
``vocabulary`` most frequent words and ``ngrams`` most frequent n-grams of each length. These
three bounds are what is broadcast; they do not grow with the corpus.

Defined results: a text that is null or has no letter is ``und`` with score 0; a text of
unknown words and characters only has equal scores for all languages and gets the first by
name; without any labelled row everything is ``und``; ties go to the first language
by name; rows with a null label are not learned from; repeated rows count as often as they
occur; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwell.llm.common import fold, packed
from layerwell.session import materialize

UNDETERMINED = "und"
NGRAMS = (5, 4, 3, 2, 1)
DOCS_PER_LANGUAGE = 4000
VOCABULARY = 40_000
NGRAMS_KEPT = 20_000
LEAST_COUNT = 2
CACHED_WORDS = 200_000
CACHED_LETTERS = 64  # longer words are scored each time they occur
PART = 5000  # words scored at a time
STRETCH = 10_000  # n-grams of a word looked up at a time
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from."""
    return fold(doc_id, FOLDS) == HELD_OUT


def train(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE, vocabulary: int = VOCABULARY, ngrams: int = NGRAMS_KEPT,
) -> dict:
    """The model: languages, and per word and n-gram its log probabilities in each language."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {lang: n for lang, n in rows.groupBy(lang_col).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return {"languages": [], "words": ({}, None), "ngrams": {}}
    rates = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, docs_per_language / sizes[lang]))))
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where(draw < F.element_at(rates, F.col(lang_col)))
    words = F.split(F.lower(F.col(text_col)), r"[^\p{L}]+")
    words = sample.select(F.col(lang_col).alias("lang"), F.explode(words).alias("word")).where("word <> ''")
    by_lang = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(languages)]
    counted = materialize(words.groupBy("word", "lang").agg(F.count("*").alias("n")), "words")

    def most(grouped: DataFrame, key: str, kept: int) -> tuple[dict[str, int], np.ndarray]:
        table = grouped.groupBy(key).agg(*by_lang, F.sum("n").alias("total")).where(F.col("total") >= LEAST_COUNT)
        top = table.orderBy(F.desc("total"), key).limit(kept).drop("total").toPandas()
        counts = top.iloc[:, 1:].to_numpy(float).reshape(len(top), len(languages))
        all_counts = np.maximum(counts.sum(axis=0), 1)
        smooth = np.log((counts + 0.5) / (all_counts + 0.5 * (len(top) + 1)))
        return {k: i for i, k in enumerate(top[key])}, smooth

    model = {"languages": languages, "words": most(counted, "word", vocabulary), "ngrams": {}}
    marked = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    for n in NGRAMS:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("marked") - (n - 1)))
        grams = F.transform(starts, lambda i: F.substring("marked", i, F.lit(n)))  # noqa: B023
        pieces = counted.withColumn("marked", marked).select("lang", "n", F.explode(grams).alias("gram"))
        model["ngrams"][n] = most(pieces.where(F.length("gram") == n), "gram", ngrams)
    return model


def scorer(model: dict):
    """A function from a text to (language, posterior)."""
    import regex

    languages = model["languages"]
    known, table = model["words"]
    letters = regex.compile(r"\p{L}+")

    ngrams = [(n, ids, scores.tolist()) for n, (ids, scores) in model["ngrams"].items()]
    nothing = [0.0] * len(languages)

    def unseen(word: str) -> list[float]:
        """Mean scores of the longest known n-grams."""
        marked = f"<{word}>"
        for n, ids, scores in ngrams:
            sums, hits = nothing, 0
            for first in range(0, len(marked) - n + 1, STRETCH):
                part = marked[first : first + STRETCH + n - 1]
                found = [scores[ids[g]] for g in (part[i : i + n] for i in range(len(part) - n + 1)) if g in ids]
                if found:
                    sums, hits = [s + sum(column) for s, column in zip(sums, zip(*found))], hits + len(found)
            if hits:
                return [s / hits for s in sums]
        return nothing

    if not languages:
        return lambda text: (UNDETERMINED, 0.0)
    rows = np.zeros((len(table) + CACHED_WORDS, len(languages)))
    rows[: len(table)] = table
    index = dict(known)

    def place(word: str) -> int:
        """Row of a word outside the vocabulary, which is scored once per task while there is room."""
        at = index.get(word)
        if at is None:
            at = index[word] = len(index)
            rows[at] = unseen(word)
        return at

    def score(text: str | None) -> tuple[str, float]:
        words = letters.findall(text.lower()) if text else []
        if not words:
            return UNDETERMINED, 0.0
        total = np.zeros(len(languages))
        for first in range(0, len(words), PART):
            part = words[first : first + PART]
            if len(index) + len(part) > len(rows):
                index.clear()
                index.update(known)
            at = [index.get(w, -1) for w in part]
            long = [w for i, w in zip(at, part) if i < 0 and len(w) > CACHED_LETTERS]
            at = [i if i >= 0 else place(w) for i, w in zip(at, part) if i >= 0 or len(w) <= CACHED_LETTERS]
            total += rows[at].sum(axis=0)
            for word in long:
                total += unseen(word)
        total -= total.max()
        likely = np.exp(total)
        best = int(likely.argmax())
        return languages[best], float(likely[best] / likely.sum())

    return score


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``score`` added (columns of these names are replaced).

    Only the text goes to Python; the other columns wait in the executor.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = scorer(shared.value)
        for batch in texts:
            yield pd.DataFrame([score(t) for t in batch], columns=["lang_pred", "score"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*kept).alias("row"), label(F.col(text_col)).alias("found"))
    return rows.select("row.*", "found.lang_pred", "found.score")


def language_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learned from the rows not held out."""
    model = train(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return identify(narrow, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    languages: tuple[str, ...] | None = None, least_score: float = 0.5,
) -> DataFrame:
    """The documents whose language is known with at least ``least_score`` (and is one of ``languages``, if given).

    ``und`` never stays; an empty model rejects everything.
    """
    model = train(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col)
    rows = docs.select(packed(docs), F.col(text_col).alias("text"))
    found = identify(rows, model)
    stay = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score)
    if languages is not None:
        stay = stay & F.col("lang_pred").isin(*languages)
    return found.where(stay).select("row.*")

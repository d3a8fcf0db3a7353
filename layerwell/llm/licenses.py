"""License scan: short notices found in texts with a bounded number of edits.

A text becomes its words, lower-cased and joined by one space. A notice that may differ by k edits (inserted, deleted
or replaced characters) is cut into k + 1 pieces: k edits cannot touch all of them, so one stands in the text
exactly. One automaton looks for the pieces of all notices at once; each piece found says where its notice would start.
That place is compared exactly, and where it differs, the ``regex`` library matches the notice with at most k errors in the
window around it, between word borders. A text without any piece costs one pass of the automaton.

Where matches of a notice overlap, the one with fewest edits is kept, then the earliest, so places without an edit are
always kept. Tasks are independent of each other; nothing is shuffled, and the notices are the only thing that is sent.

Defined results: null text is empty; empty texts have no words and no labels; texts of any length are read whole; equal
rows get equal results; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwell.llm.common import ascii_lower

# Phrases whose exact places are counted, and their labels.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Words of published license notices, and their labels.
NOTICES = [
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-nc", "cc by nc"),
    ("cc0", "creative commons zero"),
    ("epl", "eclipse public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "mozilla public license"),
    ("public-domain", "released into the public domain"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
LETTERS_PER_EDIT = 12
CACHED_WINDOWS = 50_000
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def edits_of(notice: str) -> int:
    """Edits that a notice may have: short phrases none, so that they are not taken for other words."""
    return len(notice) // LETTERS_PER_EDIT


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of about equal length that make up the notice, with their offsets."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


class Finder:
    """Places of notices in texts of words joined by single spaces, with a space at both ends."""

    def __init__(self, notices: list[tuple[str, str]]):
        import ahocorasick
        import regex

        self.notices = [(text, edits_of(text)) for _, text in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (text, edits) in enumerate(self.notices):
            for offset, piece in pieces(text, edits):
                seeds.setdefault(piece, []).append((number, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, places)
        self.automaton.make_automaton()
        self.patterns = [
            regex.compile(rf"(?b)(?<= )(?:{regex.escape(text)}){{e<={edits}}}(?= )") if edits else None for text, edits in self.notices
        ]
        self.windows: dict[tuple[int, str], tuple[int, int, int] | None] = {}

    def _near(self, number: int, window: str) -> tuple[int, int, int] | None:
        """Start, end and edits of the best match in a window."""
        key = (number, window)
        if key not in self.windows:
            if len(self.windows) >= CACHED_WINDOWS:
                self.windows.clear()
            found = self.patterns[number].search(window)
            self.windows[key] = found and (*found.span(), sum(found.fuzzy_counts))
        return self.windows[key]

    def find(self, joined: str) -> list[tuple[int, int, int, int]]:
        """Matches (notice, start, end, edits), by notice and start."""
        starts = {(number, last + 1 - upto) for last, places in self.automaton.iter(joined) for number, upto in places}
        matches = set()
        for number, start in starts:
            text, edits = self.notices[number]
            end = start + len(text)
            if start > 0 and joined[start - 1 : end + 1] == f" {text} ":
                matches.add((0, number, start, end))
            elif edits:
                first = max(0, start - edits - 1)
                if found := self._near(number, joined[first : end + edits + 1]):
                    matches.add((found[2], number, first + found[0], first + found[1]))
        kept: dict[int, list[tuple[int, int]]] = {}
        out = []
        for errors, number, start, end in sorted(matches):
            taken = kept.setdefault(number, [])
            at = bisect.bisect_left(taken, (start, end))
            if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
                continue
            taken.insert(at, (start, end))
            out.append((number, start, end, errors))
        return sorted(out)


_SPAN = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("notice", T.StringType()), T.StructField("edits", T.IntegerType()),
    T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])


def scan(docs: DataFrame, notices: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, spans (label, notice, edits, first_word, words, start, end).

    ``start`` and ``end`` are code points of the text itself, end exclusive; words count from 0.
    ``notices`` are (label, words) pairs, as in ``BASE + NOTICES``.
    """
    notices = BASE + NOTICES if notices is None else notices
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN))]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, word = Finder(notices), re.compile(_WORD)
        spans_type = pa.list_(pa.struct([(f.name, {"string": pa.string(), "int": pa.int32()}.get(f.dataType.simpleString(), pa.int64())) for f in _SPAN]))
        for batch in batches:
            sizes, spans = [], []
            for text in batch.column(1):
                text = text.as_py()
                words = word.findall(text)
                sizes.append(len(words))
                found = finder.find(f" {' '.join(words)} ") if words else []
                spans.append(_spans(found, notices, words, text, word) if found else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, spans_type)], names=["doc_id", "n_words", "spans"]
            )

    texts = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    return texts.mapInArrow(search, T.StructType(fields))


def _spans(found, notices, words, text, word) -> list[dict]:
    """Spans of matches in joined words, with places in the text."""
    borders, at = [], 1
    for w in words:
        borders.append(at)
        at += len(w) + 1
    places = [m.span() for m in word.finditer(text)]
    out = []
    for number, start, end, edits in found:
        first, last = bisect.bisect_left(borders, start), bisect.bisect_left(borders, end) - 1
        label, notice = notices[number]
        out.append({
            "label": label, "notice": notice, "edits": edits, "first_word": first, "words": last - first + 1,
            "start": places[first][0], "end": places[last][1],
        })
    return out


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the best match's share of letters without an edit; 0 without a match.
    """
    phrases = F.array(*(F.lit(text) for _, text in BASE))
    base = F.filter("spans", lambda s: (s["edits"] == 0) & F.array_contains(phrases, s["notice"]))
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    firsts = F.transform("base", lambda s: s["first_word"])
    share = F.transform("spans", lambda s: 1 - s["edits"] / F.length(s["notice"]))
    return scan(docs, None, id_col, text_col).withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(share), F.lit(0.0)).alias("score"),
    )

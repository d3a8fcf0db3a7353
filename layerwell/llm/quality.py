"""Document quality: random Fourier features of document statistics, ridge scores, isotonic calibration.

1. One pass over the texts gives a short vector of statistics per document.
2. Random Fourier features z = sqrt(2 / D) cos(w x + b) of the standardised vector approximate a
   Gaussian kernel. Each partition of the labelled rows adds up its part of the normal
   equations Z'Z and Z'y; Spark adds the parts; the driver solves one D x D system.
3. Ridge scores of a calibration fold, counted per score bin, are fitted by
   pool-adjacent-violators to a monotone step function from score to probability.

All labelled rows outside the held-out fold take part; what reaches the driver is the sum
of the equations and ``BINS`` counts, whatever the number of rows.

Defined results: null text counts as empty, whose statistics are zero; a null label is not learned
from; several labels of one document count as good if one of them is; without labelled rows
the score is 0.5, and with one class only it is that class; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwell.llm.common import fold
from layerwell.session import materialize

FEATURES = 256
WIDTH = 3.0  # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3
BINS = 400
THRESHOLD = 0.3
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
SEED = 7
STATISTICS = (
    "log_chars", "log_words", "word_length", "word_spread", "upper", "letters", "digits", "spaces", "other", "marks_in_row",
    "distinct_words", "top_word", "repeated_next", "log_line", "repeated_lines", "marked_words", "upper_words", "squeezed",
)


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from."""
    return fold(doc_id, FOLDS) == HELD_OUT


def statistics(text: str) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(data, np.uint8)
    kinds = np.bincount(_KIND[codes], minlength=6)
    chars = len(text)
    words = text.split()
    n = max(1, len(words))
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    lines = [s for s in text.split("\n") if s]
    marks = _KIND[codes] == 5
    return [
        float(np.log1p(chars)),
        float(np.log1p(len(words))),
        float(lengths.mean()),
        float(lengths.std()),
        kinds[1] / len(codes),
        (kinds[1] + kinds[2] + kinds[0]) / len(codes),
        kinds[3] / len(codes),
        kinds[4] / len(codes),
        kinds[5] / len(codes),
        float((marks[1:] & marks[:-1]).sum()) / n,
        len(counts) / n**0.9,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words[1:], words[:-1])) / n,
        float(np.log1p(chars / max(1, len(lines)))),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(not w[-1].isalnum() for w in words) / n,
        sum(map(str.isupper, words)) / n,
        len(zlib.compress(data, 1)) / (len(data) + 32),
    ]


# Kind of each byte: 0 part of a longer character, 1 upper, 2 lower, 3 digit, 4 space, 5 other.
_KIND = np.array(
    [
        0 if c >= 128 else 1 if chr(c).isupper() else 2 if chr(c).islower() else 3 if chr(c).isdigit() else 4 if chr(c).isspace() else 5
        for c in range(256)
    ],
    np.uint8,
)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id and one double per statistic."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column(1)], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[:, i]) for i in range(len(STATISTICS)))], names=["doc_id", *STATISTICS]
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, " + ", ".join(f"{s} double" for s in STATISTICS)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(measure, schema)


def fourier(x: np.ndarray, model: dict) -> np.ndarray:
    """Random Fourier features of statistics, and a constant."""
    random = np.random.default_rng(SEED)
    directions = random.normal(size=(x.shape[1], FEATURES)) / WIDTH
    shifts = random.uniform(0, 2 * np.pi, FEATURES)
    standard = np.clip((x - model["mean"]) / model["spread"], -6, 6)
    return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(standard @ directions + shifts), np.ones(len(x))])


def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    return np.column_stack([batch.column(first + i).to_numpy(zero_copy_only=False) for i in range(len(STATISTICS))])


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> dict:
    """The model: mean and spread of the statistics, ridge weights, calibration steps."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col).cast("double")).alias("label"))
    rows = stats.join(known, "doc_id").withColumn("calibrate", fold(F.col("doc_id"), FOLDS) == CALIBRATION)
    rows = materialize(rows.select("label", "calibrate", *STATISTICS), "labelled")
    sums = rows.agg(
        F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0)),
        *(f(s) for s in STATISTICS for f in (F.avg, F.stddev_pop)),
    ).first()
    if not sums[0] or sums[1] in (0, sums[0]):
        return {"always": 0.5 if not sums[0] else float(sums[1] > 0)}
    model = {"mean": np.array(sums[2::2], float), "spread": np.maximum(np.array(sums[3::2], float), 1e-6)}

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = fourier(_matrix(batch, 1), model)
            total += z.T @ np.column_stack([z, batch.column(0).to_numpy()])
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "value"])

    fit = rows.where("not calibrate").select("label", *STATISTICS).mapInArrow(equations, "place long, value double")
    solved = fit.groupBy("place").agg(F.sum("value").alias("value")).toPandas()  # (D + 1)(D + 2) numbers
    system = np.zeros((FEATURES + 1) * (FEATURES + 2))
    system[solved["place"].to_numpy(np.int64)] = solved["value"]
    system = system.reshape(FEATURES + 1, FEATURES + 2)
    model["weights"] = np.linalg.solve(system[:, :-1] + RIDGE * np.eye(FEATURES + 1), system[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fourier(_matrix(batch, 1), model) @ model["weights"]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_bin(found), pa.int32())], names=["label", "bin"])

    binned = rows.where("calibrate").select("label", *STATISTICS).mapInArrow(raw, "label double, bin int")
    counts = binned.groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("good")).orderBy("bin").collect()
    model["steps"] = isotonic([(b, n, good) for b, n, good in counts])
    return model


def _bin(raw: np.ndarray) -> np.ndarray:
    """Score bins over -0.5 .. 1.5, where ridge scores of 0/1 labels lie."""
    return np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)


def isotonic(counts: list[tuple[int, int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (bin, rows, good rows): bins and their non-decreasing shares of good rows."""
    pools: list[list[float]] = []  # first bin, last bin, rows, good
    for b, n, good in counts:
        pools.append([b, b, n, good])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            _, last, n2, good2 = pools.pop()
            pools[-1][1:] = [last, pools[-1][2] + n2, pools[-1][3] + good2]
    at = [x for p in pools for x in (p[0], p[1])]
    share = [(p[3] + 0.5 * p[3] / p[2]) / (p[2] + 0.5) for p in pools for _ in (0, 1)]
    return np.array(at, float), np.array(share, float)


def score(stats: DataFrame, model: dict) -> DataFrame:
    """One row per document of ``document_statistics``: doc_id, score."""
    if "always" in model:
        return stats.select("doc_id", F.lit(model["always"]).alias("score"))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fourier(_matrix(batch, 1), model) @ model["weights"]
            at, share = model["steps"]
            value = np.interp((found + 0.5) / 2 * BINS, at + 0.5, share) if len(at) else np.clip(found, 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value, pa.float64())], names=["doc_id", "score"])

    id_type = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", *STATISTICS).mapInArrow(rate, f"doc_id {id_type}, score double")


def quality_report(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    stats = materialize(document_statistics(docs, id_col, text_col), "statistics")
    return score(stats, train(stats, labels, label_col, id_col)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased and everything but letters and digits becomes one space. Each
distinct n-gram of 3 to 6 characters is a feature, hashed into ``BUCKETS``. A feature's
value is its log-count ratio r = log((p / |p|) / (q / |q|)) with p and q the smoothed
numbers of toxic and other texts that hold it, shrunk to r * (1 - (DOUBT / z)^2), or to 0 where the two shares differ by less
than z = DOUBT standard errors: what the counts cannot tell from chance has no say, and any difference, however small, has
one once there are enough labelled texts. A logistic regression weighs these values.

Learning uses a sample of at most about ``docs_per_class`` labelled documents of each
class, taken by a hash of the id; the regression's constant is corrected for the two sampling rates.
The sample's features are written once and counted in a grouping; the driver gets the buckets whose ratio is not 0, at most
``BUCKETS`` rows of 24 bytes. Each of at most ``ROUNDS`` rounds (L-BFGS) is a job that sums loss and gradient in ``LEARNERS``
tasks, one number per such bucket from each. Scoring reads every text whole and sums the weights of its distinct features.

Defined results: null text counts as empty; a text without features gets the score of the
constant alone; a null label is not learned from; several labels of one document count as
toxic if one of them is; if only one class is labelled (or none), every score is the share of
toxic labels (0 without labels); an empty table gives an empty result; further columns are
not read.
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

LENGTHS = (3, 4, 5, 6)
BUCKETS = 1 << 20
DOCS_PER_CLASS = 8_000
LEARNERS = 16
DOUBT = 3.0  # standard errors
ROUNDS, MEMORY, RIDGE = 30, 5, 1.0
THRESHOLD = 0.5
FOLDS, HELD_OUT = 5, 0
PART = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from."""
    return fold(doc_id, FOLDS) == HELD_OUT


class Features:
    """Hashed character n-grams of texts."""

    def __init__(self):
        codes = range(1 << 16)
        self.plain = np.array([c if chr(c).isalnum() else 32 for c in codes], np.uint32)

    def buckets(self, text: str) -> Iterator[np.ndarray]:
        """Buckets of all n-grams, a stretch of the text at a time, with repeats."""
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(codes < 1 << 16, self.plain[np.minimum(codes, (1 << 16) - 1)], codes)
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])].astype(np.uint64)
        for first in range(0, len(codes), PART):
            part = codes[first : first + PART + LENGTHS[-1] - 1]
            rolled = part
            for n in range(2, LENGTHS[-1] + 1):
                if len(part) < n:
                    break
                rolled = rolled[: len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 :]
                if n >= LENGTHS[0]:
                    mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    yield (mixed >> np.uint64(44)).astype(np.int64)

    def distinct(self, text: str) -> np.ndarray:
        found = [np.unique(b) for b in self.buckets(text)]
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, docs_per_class: int
) -> tuple[DataFrame, dict[int, int], dict[int, float]]:
    """(label, text) of the sample, the number of labelled documents per class, and the sampling rates."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    sizes = {label: n for label, n in known.where("label in (0, 1)").groupBy("label").count().collect()}
    rates = {label: min(1.0, docs_per_class / n) for label, n in sizes.items()}
    if len(sizes) < 2:
        return None, sizes, rates
    draw = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 20)) / float(1 << 20)
    rate = F.when(F.col("label") == 1, F.lit(rates[1])).otherwise(F.lit(rates[0]))
    chosen = known.where(F.col("label").isin(0, 1) & (draw < rate))
    # About 2 * docs_per_class ids of 12 bytes: bounded, so the documents are not shuffled for them.
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "id").select("label", "text"), sizes, rates


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    docs_per_class: int = DOCS_PER_CLASS,
) -> dict:
    """The model: constant, buckets and their weights."""
    sample, sizes, rates = labelled_sample(docs, labels, label_col, id_col, text_col, docs_per_class)
    if sample is None:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        return {"constant": float(np.log((share + 1e-9) / (1 - share + 1e-9))), "buckets": np.empty(0, np.int64), "weights": np.empty(0)}
    rows = materialize(sample_features(sample), "features")
    pos, neg = ({label: n for label, n in rows.groupBy("label").count().collect()}.get(x, 0) for x in (1, 0))
    telling = telling_features(feature_counts(rows), max(pos, 1), max(neg, 1))
    buckets, ratio = telling["bucket"].to_numpy(np.int64), telling["ratio"].to_numpy(float)
    weights, constant = _minimise(materialize(known_features(rows, buckets), "known"), ratio)
    return {"constant": constant + float(np.log(rates[0] / rates[1])), "buckets": buckets, "weights": weights * ratio}


def sample_features(sample: DataFrame) -> DataFrame:
    """(label, found): the distinct buckets of each text, ascending, as compressed steps."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [pack(features.distinct(t)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["label", "found"])

    return sample.repartition(LEARNERS).mapInArrow(find, "label int, found binary")


def pack(buckets: np.ndarray) -> bytes:
    return zlib.compress(np.diff(buckets, prepend=0).astype("<u4").tobytes(), 1)


def unpack(found: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(found), "<u4"), dtype=np.int64)


def feature_counts(rows: DataFrame) -> DataFrame:
    """Toxic and other texts of the sample per bucket: bucket, p, q."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for label, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[label, unpack(found)] += 1
        at = np.flatnonzero(sums.any(axis=0))
        for first in range(0, len(at), 50_000):
            some = at[first : first + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[1, some]), pa.array(sums[0, some])], names=["bucket", "p", "q"])

    counts = rows.mapInArrow(count, "bucket long, p int, q int")
    return counts.groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def telling_features(counts: DataFrame, pos: int, neg: int):
    """Buckets whose shrunk ratio is not 0, ascending, with it; one text is added to every count for the ratio."""
    p, q = F.col("p"), F.col("q")
    ratio = F.log((p + 1) / float(pos + 1)) - F.log((q + 1) / float(neg + 1))
    share = (p + q) / float(pos + neg)
    squared_error = share * (1 - share) * (1 / pos + 1 / neg)
    distance = F.greatest((p / float(pos) - q / float(neg)) ** 2, F.lit(1e-12))
    kept = 1 - DOUBT**2 * squared_error / distance
    return counts.where(kept > 0).select("bucket", (ratio * kept).alias("ratio")).toPandas().sort_values("bucket")


def known_features(rows: DataFrame, buckets: np.ndarray) -> DataFrame:
    """(label, found): places in ``buckets`` of each text's features."""
    shared = rows.sparkSession.sparkContext.broadcast(buckets)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, np.int64)
        place[shared.value] = np.arange(len(shared.value))
        for batch in batches:
            found = [place[unpack(f)] for f in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(f[f >= 0]) for f in found], pa.binary())], names=["label", "found"])

    return rows.mapInArrow(pick, "label int, found binary")


def loss_and_gradient(rows: DataFrame, ratio: np.ndarray, weights: np.ndarray, constant: float) -> tuple[float, np.ndarray]:
    """Logistic loss with ridge, and its gradient by the weights and, last, by the constant; summed by tasks."""
    shared = rows.sparkSession.sparkContext.broadcast((weights * ratio, constant))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, start = shared.value
        total, loss, by_constant = np.zeros(len(factors)), 0.0, 0.0
        for batch in batches:
            for label, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = unpack(found)
                z = float(factors[at].sum()) + start
                miss = float(1 / (1 + np.exp(-np.clip(z, -40, 40)))) - label
                total[at] += miss
                loss += float(np.logaddexp(0, z)) - label * z
                by_constant += miss
        yield pa.RecordBatch.from_pydict({"loss": [loss], "by_constant": [by_constant], "total": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(work, "loss double, by_constant double, total binary").collect()  # one row per task
    shared.destroy()
    by_bucket = sum((np.frombuffer(p.total) for p in parts), np.zeros(len(ratio)))
    gradient = np.append(by_bucket * ratio + RIDGE * weights, sum(p.by_constant for p in parts))
    return sum(p.loss for p in parts) + RIDGE / 2 * float(weights @ weights), gradient


def _minimise(rows: DataFrame, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of the regression, by L-BFGS with step halving."""
    at = np.zeros(len(ratio) + 1)
    value = lambda x: loss_and_gradient(rows, ratio, x[:-1], float(x[-1]))
    loss, gradient = value(at)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    scale, rounds = 1.0 / max(1.0, float(np.abs(gradient).sum())), 1
    while rounds < ROUNDS:
        move, factors = gradient.copy(), []
        for moved, changed in reversed(steps):
            factors.append(float(moved @ move) / float(moved @ changed))
            move -= factors[-1] * changed
        move *= float(steps[-1][0] @ steps[-1][1]) / float(steps[-1][1] @ steps[-1][1]) if steps else scale
        for (moved, changed), factor in zip(steps, reversed(factors)):
            move += (factor - float(changed @ move) / float(moved @ changed)) * moved
        length, slope = 1.0, float(gradient @ move)
        while True:
            new = at - length * move
            new_loss, new_gradient = value(new)
            rounds += 1
            if new_loss <= loss - 1e-4 * length * slope or rounds >= ROUNDS:
                break
            length /= 4
        if new_loss >= loss:
            break
        moved, changed = new - at, new_gradient - gradient
        if float(moved @ changed) > 1e-12:
            steps = [*steps, (moved, changed)][-MEMORY:]
        done = loss - new_loss < 1e-4 * abs(new_loss)
        at, loss, gradient = new, new_loss, new_gradient
        if done:
            break
    return at[:-1], float(at[-1])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, known = Features(), shared.value
        table = np.zeros(BUCKETS, np.float32)
        table[known["buckets"]] = known["weights"]
        for batch in batches:
            found = []
            for text in batch.column(1):
                hits = [b[table[b] != 0] for b in features.buckets(text.as_py() or "")]
                hits = np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int64)
                found.append(known["constant"] + float(table[hits].sum(dtype=np.float64)))
            scores = 1 / (1 + np.exp(-np.clip(np.array(found), -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(rate, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, label_col, id_col, text_col)
    return score(docs, model, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

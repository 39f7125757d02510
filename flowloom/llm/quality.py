"""Quality classifier: naive Bayes features under a linear support vector machine.

A text is the set of its hashed byte n-grams. Over all labelled rows the documents of each class that
hold an n-gram are counted; the log of the ratio of the two smoothed counts scales its indicator. On a
bounded sample of the labelled rows a linear model with squared hinge loss is fitted to the scaled
indicators, of unit length, by dual coordinate descent. The classes weigh the same. The model is one
vector of fixed length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .idfilter import members
from .store import saved

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
GRAM = 4
SMOOTH = 1.0
COST = 1.0
EPOCHS = 12
SHARPNESS = 2.0
SAMPLE_ROWS = 10_000
CHUNK = 1 << 20
SHORT = 4_000
MULTIPLIER = np.uint32(2654435761)

LEARNED = "label int, bucket long, n long, grams binary"


def _hashed(raw: bytes) -> np.ndarray:
    """Buckets of the n-grams of ``raw``, which holds one at least."""
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    n = len(x) - GRAM + 1
    code = np.zeros(n, np.uint32)
    for i in range(GRAM):
        code = (code << np.uint32(8)) | x[i : i + n]
    return ((code * MULTIPLIER) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)


def grams(raw: bytes | None) -> np.ndarray:
    """Sorted distinct buckets of the n-grams of a whole text; a null or empty one has none."""
    if not raw:
        return np.empty(0, np.int32)
    raw = b" " * (GRAM - 1) + raw
    if len(raw) <= SHORT:
        return np.unique(_hashed(raw))
    held = np.zeros(BUCKETS, bool)
    for at in range(0, len(raw) - GRAM + 1, CHUNK):
        held[_hashed(raw[at : at + CHUNK + GRAM - 1])] = True
    return np.flatnonzero(held).astype(np.int32)


def _learner(sample_share: float):
    """Counts of each class and bucket, and the rows of the sample."""
    schema = pa.schema([("label", pa.int32()), ("bucket", pa.int64()), ("n", pa.int64()), ("grams", pa.binary())])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            labels, kept = [], []
            for raw, label, draw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = grams(raw)
                totals[label, held] += 1
                if draw < sample_share:
                    labels.append(label)
                    kept.append(held.tobytes())
            none = pa.nulls(len(labels), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), none, none, pa.array(kept, pa.binary())], schema=schema)
        for label in (0, 1):
            seen = np.flatnonzero(totals[label])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), label), pa.int32()), pa.array(seen, pa.int64()), pa.array(totals[label][seen], pa.int64()), pa.nulls(len(seen), pa.binary())], schema=schema)

    return learn


class Model:
    """Weights of the buckets, already multiplied by their ratios, and the ratios for the length of a text."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, bias: float):
        self.square, self.weight, self.bias = (ratio * ratio).astype(np.float32), (ratio * weight).astype(np.float32), bias

    def score(self, raw: bytes | None) -> float:
        held = grams(raw)
        length = float(np.sqrt(self.square[held].sum(dtype=np.float64)))
        margin = self.bias + (float(self.weight[held].sum(dtype=np.float64)) / length if length else 0.0)
        return float(1 / (1 + np.exp(-np.clip(SHARPNESS * margin, -50, 50))))


def log_count_ratio(counts: np.ndarray) -> np.ndarray:
    smooth = counts + SMOOTH
    return np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the class-weighted squared hinge loss, by dual coordinate descent."""
    w, bias = np.zeros(len(ratio)), 0.0
    y = np.where(labels == 1, 1.0, -1.0)
    sizes = np.bincount(labels, minlength=2).clip(1)
    slack = 1 / (2 * COST * (len(labels) / (2 * sizes))[labels])
    alpha = np.zeros(len(rows))
    values = []
    for held in rows:
        x = ratio[held]
        length = np.sqrt(x @ x)
        values.append(x / length if length else x)
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            held, x = rows[i], values[i]
            gradient = y[i] * (w[held] @ x + bias) - 1 + slack[i] * alpha[i]
            step = max(alpha[i] - gradient / (x @ x + 1 + slack[i]), 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w[held] += step * y[i] * x
                bias += step * y[i]
    return w, bias


def _fitter(sent):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((g, label) for b in batches for label, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        w, bias = descend([np.frombuffer(g, np.int32) for g, _ in found], np.array([label for _, label in found], int), sent.value)
        yield pa.record_batch([pa.array([w.tobytes()], pa.binary()), pa.array([bias])], names=["weight", "bias"])

    return fit


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``label`` of the documents in ``labels`` (``doc_id``, ``label``).

    Texts without a label are mostly set aside where they lie, so that the join moves few of them.
    """
    named = labels.where("label in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return members(texts, named.select("doc_id"), "doc_id").join(named, "doc_id")


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on ``labelled`` (``doc_id``, ``text``, ``label`` 0 or 1; nulls are left out).

    The ratios are counted over every row. The linear model sees all rows while there are no more than
    ``sample_rows``, else that many on average, chosen by a hash of the id, in one task of bounded size.
    """
    spark = labelled.sparkSession
    rows = labelled.where("label in (0, 1)").select(F.col("text").cast("binary"), F.col("label").cast("int"), F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)).cast("double") / 1_000_003)
    total = labelled.where("label in (0, 1)").count()
    learned = saved(rows.mapInArrow(_learner(1.0 if total <= sample_rows else sample_rows / total), LEARNED), "learned")
    sums = saved(learned.where("bucket is not null").groupBy("label", "bucket").agg(F.sum("n").alias("n")), "counts")
    counts = np.zeros((2, BUCKETS))
    for part in sums.select("label", "bucket", "n").toArrow().to_batches():  # at most two for each bucket
        counts[part.column(0).to_numpy(), part.column(1).to_numpy()] = part.column(2).to_numpy()
    ratio = log_count_ratio(counts)
    sample = learned.where("grams is not null").select("label", "grams").repartition(1)
    fitted = sample.mapInArrow(_fitter(spark.sparkContext.broadcast(ratio)), "weight binary, bias double").first()
    return Model(ratio, np.frombuffer(fitted.weight), fitted.bias)


def _scorer(sent):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.score(raw) for raw in batch.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return score


def score_quality(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` of each row from its whole text alone; a null or empty text has the bias' score.

    Rows that repeat get the same score, other columns are not looked at, an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")

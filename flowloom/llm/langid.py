"""Language identification as a mixture of languages.

Each language has probabilities of hashed letter trigrams, counted over all training rows. A document
is a mixture: expectation-maximisation estimates the share of every language from the likelihoods of
its trigrams. The set of languages is then chosen by penalised likelihood: languages join in the order
of their shares as long as each pays for itself, and the shares are estimated anew for the set.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved, small_batches

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
ROUNDS = 8
PENALTY = 6.0
CHUNK = 1 << 20
UNKNOWN = "und"

#: Small letters for large ones, a blank for all other ASCII, the rest as it is.
LETTER_BYTES = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)).lower()
ASCII_LETTER = re.compile(rb"[A-Za-z]")
MULTIPLIER = np.uint32(2654435761)

PREDICTED = "lang_pred string, score double, languages array<string>, shares array<double>"


def has_letter(raw: bytes | None) -> bool:
    return bool(raw) and (ASCII_LETTER.search(raw) is not None or any(map(str.isalpha, raw.decode())))


def trigrams(raw: bytes) -> np.ndarray:
    """Buckets of the trigrams of a text with a blank on either side; those of two blanks on end do not count."""
    return _buckets(np.frombuffer(b" " + raw.translate(LETTER_BYTES) + b" ", np.uint8))


def _buckets(x: np.ndarray) -> np.ndarray:
    code = x.astype(np.uint32)
    code = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    blank = x == 0x20
    pair = blank[:-1] & blank[1:]
    return ((code[~(pair[:-1] | pair[1:])] * MULTIPLIER) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def counted(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs; long texts are counted in chunks that share two bytes."""
    if len(raw) < 1500:
        return np.unique(trigrams(raw), return_counts=True)
    total = np.zeros(BUCKETS, np.int64)
    x = np.frombuffer(b" " + raw.translate(LETTER_BYTES) + b" ", np.uint8)
    for at in range(0, len(x) - 2, CHUNK):
        total += np.bincount(_buckets(x[at : at + CHUNK + 2]), minlength=BUCKETS)
    seen = np.flatnonzero(total)
    return seen, total[seen]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for raw, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if has_letter(raw):
                seen, n = counted(raw)
                totals.setdefault(lang, np.zeros(BUCKETS, np.int64))[seen] += n
    for lang, total in totals.items():
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["lang", "bucket", "n"])


class Languages:
    """Trigram probabilities of each language, smoothed; languages in the order of their code points."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + 0.5
        self.p = (smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)

    def predict(self, raw: bytes | None) -> tuple[str, float, list[str], list[float]]:
        """The main language, its share, and all languages of the document with their shares."""
        if not self.names or not has_letter(raw):
            return UNKNOWN, 0.0, [], []
        seen, n = counted(raw)
        p = self.p[:, seen].astype(np.float64)
        total = n.sum()
        share, _ = mixture(p, n, np.full(len(self.names), 1 / len(self.names)))
        order = np.argsort(-share, kind="stable")
        price = PENALTY * np.log(total + 1)
        single = np.log(p) @ n
        chosen = [int(np.argmax(single))]
        best, shares = single[chosen[0]], np.ones(1)
        for language in (i for i in order if i != chosen[0]):
            start = np.maximum(share[[*chosen, language]], 1e-3)
            tried, likelihood = mixture(p[[*chosen, language]], n, start / start.sum())
            if likelihood - price <= best:
                break
            chosen, best, shares = [*chosen, language], likelihood - price, tried
        ranked = sorted(zip(-shares, chosen, strict=True))
        return self.names[ranked[0][1]], float(-ranked[0][0]), [self.names[i] for _, i in ranked], [float(-s) for s, _ in ranked]


def mixture(p: np.ndarray, n: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares after some rounds of expectation-maximisation from ``share``, and their log-likelihood."""
    total = n.sum()
    for _ in range(ROUNDS):
        weight = n / (share @ p)
        share = share * (p @ weight) / total
    share = share / share.sum()
    return share, float(np.log(share @ p) @ n)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Languages:
    """Count the trigrams of every labelled row; the model is 256 KB for each distinct label."""
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(text).cast("binary"), F.col(lang).cast("string"))
    counts = rows.mapInArrow(_counter, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    with small_batches(labelled.sparkSession):
        packed = saved(counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")), "languages")
    found = sorted(packed.select("lang", "cells.bucket", "cells.n").collect(), key=lambda r: r.lang)
    table = np.zeros((len(found), BUCKETS))
    for i, row in enumerate(found):
        table[i, row.bucket] = row.n
    return Languages([r.lang for r in found], table)


def _predictor(sent, text: str):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            rows = [model.predict(raw) for raw in batch.column(text).cast(pa.binary()).to_pylist()]
            found = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(found, kinds, strict=True))], ["doc_id", "lang_pred", "score", "languages", "shares"])

    return predict


def identify(docs: DataFrame, model: Languages, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``languages``, ``shares`` of each row; other columns are not looked at.

    ``score`` is the share of ``lang_pred``. A null text, one without a letter, and any text under a
    model without languages is ``und`` with score 0. Ties go to the smaller code point. An empty table
    gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_predictor(docs.sparkSession.sparkContext.broadcast(model), "text"), f"doc_id long, {PREDICTED}")


def _keeper(sent, text: str, least: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            told = (model.predict(raw) for raw in batch.column(text).cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score, *_ in told], pa.bool_()))

    return keep


def keep_identified(docs: DataFrame, model: Languages, least_share: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that have a main language with a share of ``least_share`` or more, as they are.

    They are written here, as whole rows pass through Python and only a job run here has small batches.
    """
    with small_batches(docs.sparkSession):
        return saved(docs.mapInArrow(_keeper(docs.sparkSession.sparkContext.broadcast(model), text, least_share), docs.schema), "identified", keep=True)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the crc32 of the id as text falls into the fold; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))

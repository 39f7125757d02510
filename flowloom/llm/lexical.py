"""Ranked lexical search: accumulators for short lists, document-at-a-time for long ones.

The documents are packed into shards of bounded size, each with the postings of all its terms, and the
shards are a written table: the index. A search takes the query texts in chunks of bounded size past
every shard, each shard read once a chunk. Inside a shard a query's short posting lists are summed term
at a time into accumulators. The accumulators then take part as one more iterator, with a bound for
each block of documents, in a document-at-a-time traversal of the long lists: blocks whose bounds
together cannot reach the k-th best score known are skipped, and inside a block a document is probed in
one list after the other only while it can still compete. The best scores go with the task from shard
to shard, and the tasks' best are merged by query.

All scores are integers, so the result does not depend on how the documents were dealt out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .merkle import lower_ascii
from .store import saved

#: What separates terms, and the constants of the score.
SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
SCALE, IMPACT, SATURATION, LENGTH_PERCENT = 1000, 1_000_000_000, 8, 90

#: A shard ends at so many documents (two bytes number them) or terms.
SHARD_DOCS, SHARD_TOKENS = 8192, 2_000_000
PIECE_BYTES = 1 << 20
#: Documents in a block of bounds; blocks that are traversed before the threshold is raised again.
BLOCK, BLOCKS_FIRST = 64, 4
#: Lists are short while together they hold at most this part of a shard's documents.
SHORT_PART = 4
#: A list that holds at least this part of the documents is also kept as one score a document.
DENSE_PART = 4
CHUNK_BYTES = 8 << 20

TO_TERMS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
NULL_ID = -(1 << 63)

INDEX = "part int, seq int, n_docs long, n_tokens long, ids binary, lengths binary, terms array<string>, counts array<int>, docs binary, tfs binary, tf_bytes int"
HITS = "item_id long, doc_id long, score long"


def tokens(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a list for each piece; a piece never ends inside a term."""
    raw = raw.translate(TO_TERMS)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE_BYTES)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


class Packer:
    """Collects documents and makes shards of them."""

    def __init__(self, part: int):
        self.part, self.seq = part, 0
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.parts: list[np.ndarray] = []
        self.total = 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        n = 0
        for piece in tokens(raw):
            self.parts.append(np.fromiter(map(self.codes.__getitem__, piece), np.int32, len(piece)))
            n += len(piece)
        if n:
            self.ids.append(NULL_ID if doc_id is None else doc_id)
            self.lengths.append(n)
            self.total += n

    def shard(self) -> pa.RecordBatch:
        n, lengths = len(self.ids), np.array(self.lengths, np.int64)
        key = np.concatenate(self.parts).astype(np.int64)
        self.parts.clear()
        key *= n
        key += np.repeat(np.arange(n), lengths)
        key, tf = np.unique(key, return_counts=True)
        term, doc = np.divmod(key, n)
        wide = np.min_scalar_type(int(tf.max()))
        terms = pa.array(list(self.codes), pa.binary()).cast(pa.string())
        counts = np.bincount(term, minlength=len(terms)).astype(np.int32)
        cells = [self.part, self.seq, n, self.total, np.array(self.ids, np.int64).tobytes(), lengths.tobytes()]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), x) for x in (terms, pa.array(counts))]
        names = ["part", "seq", "n_docs", "n_tokens", "ids", "lengths", "terms", "counts", "docs", "tfs", "tf_bytes"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        posted = [pa.array([doc.astype(np.uint16).tobytes()]), pa.array([tf.astype(wide).tobytes()]), pa.array([wide.itemsize], pa.int32())]
        self.seq += 1
        self._clear()
        return pa.RecordBatch.from_arrays([*(pa.array([c], t) for c, t in zip(cells, kinds, strict=True)), *lists, *posted], names)


def _indexer(shard_docs: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId())
        for batch in batches:
            for doc_id, raw in zip(batch.column(0), batch.column(1), strict=True):
                if raw.is_valid:
                    packer.add(doc_id.as_py(), raw.as_py())
                if len(packer.ids) >= shard_docs or packer.total >= SHARD_TOKENS:
                    yield packer.shard()
        if packer.ids:
            yield packer.shard()

    return index


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """A row for each shard of documents, written below the shared folder.

    A row of ``docs`` is a document, also where its id repeats or is null. Null texts and texts without
    terms are in no shard. A text is one document whatever its length: a shard ends after the document
    that fills it.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("binary"))
    return saved(rows.mapInArrow(_indexer(min(shard_docs, SHARD_DOCS)), INDEX), "index", keep=True)


class Postings:
    """One term's documents in a shard and what it adds to the score of each."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, n: int):
        self.docs, self.scores, self.most = docs, scores, int(scores.max())
        self.by_doc: np.ndarray | None = None
        if len(docs) * DENSE_PART >= n:
            self.by_doc = np.zeros(n, np.int64)
            self.by_doc[docs] = scores
        self.bounds = np.zeros(-(-n // BLOCK), np.int64)
        np.maximum.at(self.bounds, docs // BLOCK, scores)

    def probe(self, docs: np.ndarray) -> np.ndarray:
        if self.by_doc is not None:
            return self.by_doc[docs]
        at = np.searchsorted(self.docs, docs)
        at[at == len(self.docs)] = 0
        return np.where(self.docs[at] == docs, self.scores[at], 0)


class Shard:
    """The postings of one shard, scored when a query first asks for them."""

    def __init__(self, row: dict, n_docs: int, n_tokens: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * lengths * n_docs) // n_tokens
        self.ends = np.cumsum(row["counts"])
        self.docs = np.frombuffer(row["docs"], np.uint16)
        self.tfs = np.frombuffer(row["tfs"], f"u{row['tf_bytes']}")
        self.known: dict[int, Postings] = {}
        self.visited = 0

    def postings(self, term: int, weight: int) -> Postings:
        if term not in self.known:
            of = slice(self.ends[term - 1] if term else 0, self.ends[term])
            docs, tf = self.docs[of].astype(np.int64), self.tfs[of].astype(np.int64)
            self.known[term] = Postings(docs, weight * ((IMPACT * tf) // (SCALE * tf + SATURATION * self.m[docs])), len(self.ids))
        return self.known[term]

    def search(self, terms: list[tuple[int, int]], k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (scores, ids) of other shards, merged with this shard's documents: the ``k`` best of both."""
        n = len(self.ids)
        lists = sorted((self.postings(t, w) for t, w in terms), key=lambda p: len(p.docs))
        sums, taken, short = np.zeros(n, np.int64), 0, 0
        while short < len(lists) and (taken := taken + len(lists[short].docs)) * SHORT_PART <= n:
            sums[lists[short].docs] += lists[short].scores
            short += 1
        long = sorted(lists[short:], key=lambda p: -p.most)
        # sums of some of a document's terms are never above its score, so they may raise the threshold
        floor = _kth(np.concatenate([best[0], sums[sums > 0]]), k)
        padded = np.zeros(-(-n // BLOCK) * BLOCK, np.int64)
        padded[:n] = sums
        bounds = padded.reshape(-1, BLOCK).max(axis=1)
        rest = np.zeros((len(long) + 1, len(bounds)), np.int64)  # what the lists from here on can add in a block
        for i in range(len(long) - 1, -1, -1):
            rest[i] = rest[i + 1] + long[i].bounds
        bounds = bounds + rest[0]
        order = np.argsort(-bounds, kind="stable")
        at, step = 0, BLOCKS_FIRST
        while at < len(order):
            blocks = order[at : at + step]
            blocks = blocks[bounds[blocks] >= max(floor, 1)]
            if not len(blocks):
                break  # so are the bounds of all blocks after these
            self.visited += len(blocks)
            docs = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            docs = docs[docs < n]
            score = sums[docs]
            for i, p in enumerate(long):
                can = score + rest[i][docs // BLOCK] >= floor
                docs, score = docs[can], score[can]
                score = score + p.probe(docs)
            found = score >= max(floor, 1)
            best = _best(np.concatenate([best[0], score[found]]), np.concatenate([best[1], self.ids[docs[found]]]), k)
            floor = max(floor, _kth(best[0], k))
            at, step = at + step, 2 * step
        return best


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.lexsort((ids, -scores))[:k]
    return scores[first], ids[first]


def _searcher(sent, k: int, n_docs: int, n_tokens: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, ends, term_of, weights, terms = sent.value
        none = np.empty(0, np.int64)
        best = [(none, none)] * len(items)
        vocabulary = pa.array(terms, pa.string())
        for batch in batches:
            for r in range(len(batch)):
                row = batch.slice(r, 1)
                held = row.column(batch.schema.get_field_index("terms")).flatten()
                place = pc.index_in(vocabulary, value_set=held).fill_null(-1).to_numpy()
                cells = {c: row.column(batch.schema.get_field_index(c))[0].as_py() for c in ("ids", "lengths", "docs", "tfs", "tf_bytes")}
                cells["counts"] = row.column(batch.schema.get_field_index("counts")).flatten().to_numpy()
                shard = Shard(cells, n_docs, n_tokens)
                for i, (lo, hi) in enumerate(zip([0, *ends], ends)):
                    at = place[term_of[lo:hi]]
                    here = at >= 0
                    if here.any():
                        best[i] = shard.search(list(zip(at[here].tolist(), weights[lo:hi][here].tolist())), k, best[i])
        for i, (scores, ids) in enumerate(best):
            if len(ids):
                yield pa.record_batch([pa.array([items[i]] * len(ids), pa.int64()), pa.array(ids, mask=ids == NULL_ID), pa.array(scores)], names=["item_id", "doc_id", "score"])

    return search


def terms_of(text: Column) -> Column:
    """Distinct terms of a text: what is not an ASCII separator, A-Z in small letters."""
    return F.array_distinct(F.regexp_extract_all(lower_ascii(text), F.lit(f"([^{SEPARATORS}]+)")))


def weighted_items(index: DataFrame, items: DataFrame, n_docs: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id`` and its ``terms`` (term, weight) as far as the index holds them and they weigh anything.

    The rows of an id are one item. Only terms of items are counted over the shards.
    """
    asked = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.explode(terms_of(F.col(f"`{text}`"))).alias("term")).distinct()
    held = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.counts").alias("df"))
    df = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(SCALE * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    return asked.join(df.withColumn("weight", weight).where("weight > 0"), "term").groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms"))


def _chunks(items: DataFrame) -> Iterator[tuple[list[int | None], list[int], np.ndarray, np.ndarray, list[str]]]:
    """The items, partition by partition, in chunks of about ``CHUNK_BYTES``; an item is never cut."""
    ids: list[int | None] = []
    ends: list[int] = []
    codes: dict[str, int] = defaultdict(count().__next__)
    term_of: list[int] = []
    weights: list[int] = []
    size = 0
    for row in items.toLocalIterator():
        ids.append(row["item_id"])
        for term, weight in row["terms"]:
            size += len(term) + 24
            term_of.append(codes[term])
            weights.append(weight)
        ends.append(len(term_of))
        if size >= CHUNK_BYTES:
            yield ids, ends, np.array(term_of), np.array(weights), list(codes)
            ids, ends, term_of, weights, size = [], [], [], [], 0
            codes = defaultdict(count().__next__)
    if ids:
        yield ids, ends, np.array(term_of), np.array(weights), list(codes)


def search(index: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the ``k`` best documents of each item.

    Scores of 0 are left out, ties go by ascending id, null ids first. Null and empty items and items
    without a term of the corpus have no rows; rows that share an id are one item of all their terms.
    A chunk of about ``CHUNK_BYTES`` of items is with every task at a time; the hits of a task are at
    most ``k`` an item.
    """
    totals = index.agg(F.sum("n_docs"), F.sum("n_tokens")).first()
    n_docs, n_tokens = totals[0] or 0, totals[1] or 1
    asked = saved(weighted_items(index, items, n_docs, item_id, text), "items")
    hits = None
    for chunk in _chunks(asked):
        sent = index.sparkSession.sparkContext.broadcast(chunk)
        found = index.select("ids", "lengths", "terms", "counts", "docs", "tfs", "tf_bytes").mapInArrow(_searcher(sent, k, n_docs, n_tokens), HITS)
        found = saved(found, "hits", keep=True)
        hits = found if hits is None else hits.union(found)
        sent.unpersist()
    if hits is None:
        hits = index.sparkSession.createDataFrame([], HITS)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")

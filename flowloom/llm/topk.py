"""Exact top-k inner-product search with MaxScore over shards of postings.

A vector component is a term, its non-zero values are the term's postings. Vectors are packed into
shards of bounded size, queries into packs of bounded size, and every pack meets every shard once: a
task holds a few shards while all packs pass by, which are copied to it in a shuffle.
Inside a shard each query orders its terms by how much they can move a score. The terms after the
point where all the rest together cannot reach the k-th best score known are non-essential: only the
postings of the essential terms are traversed, and the others are probed for rows that can still
compete. In a shard without many zeros the queries of a pack do so together. The k best of a task's
shards are merged by query, then those of the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.plans.bounded import lookup_join
from flowloom.plans.ranking import number_rows

from .store import saved

SHARD_ROWS = 8192
PACK_ROWS = 256
#: Shards that a task holds at most, and groups of shards a core while there are shards enough.
HELD, GROUPS_A_CORE = 4, 4
#: Terms probed at once, and rows are probed where at most one in so many can still compete.
PROBED_AT_ONCE, PROBED_PART = 4, 64
#: Terms whose heads give a query's first bound.
SEEDS = 8
#: A shard is sparse where less than one cell in so many is not zero.
SPARSE_PART = 4
#: Sums of whole numbers that stay below this are exact as floats.
EXACT = 2.0**52

PACKED = "part int, seq int, n int, ids binary, width int, bytes int, cells binary"
HITS = "query_id long, vec_id long, score long"


def quantise(vectors: DataFrame, scale: float, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``floor(scale * x)`` of every component.

    Rows with a null id, a null vector, or a null or non-finite component are left out. Rows that repeat
    id and cells are one; other vectors of an id stay beside it. An empty vector stays; it scores 0 with
    everything.
    """
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    cells = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    sound = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull()).where(~bad)
    return sound.select(F.col(vec_id).cast("long").alias("vec_id"), cells.alias("cells")).distinct()


def _narrow(matrix: np.ndarray) -> np.dtype:
    """The smallest signed type that holds all values."""
    low, high = matrix.min(initial=0), matrix.max(initial=0)
    return np.promote_types(np.min_scalar_type(min(low, -1)), np.min_scalar_type(min(-1, -1 - high)))


def _packer(most: int):
    """Packs the rows of a task into rows of at most ``most`` vectors: ids and a dense integer matrix."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("width", pa.int32()), ("bytes", pa.int32()), ("cells", pa.binary())])
        ids: list[int] = []
        rows: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            width = max(map(len, rows))
            matrix = np.zeros((len(rows), width), np.int64)
            for i, row in enumerate(rows):
                matrix[i, : len(row)] = row
            matrix = matrix.astype(_narrow(matrix))
            out = pa.record_batch([[part], [seq], [len(ids)], [np.array(ids, np.int64).tobytes()], [width], [matrix.itemsize], [matrix.tobytes()]], schema=schema)
            ids.clear()
            rows.clear()
            return out

        for batch in batches:
            names, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.diff(lists.offsets.to_numpy()))
            start = 0
            for name, end in zip(names, ends, strict=True):
                ids.append(int(name))
                rows.append(np.array(flat[start:end], np.int64))
                start = end
                if len(ids) >= most:
                    yield flush()
                    seq += 1
        if ids:
            yield flush()

    return pack


class Shard:
    """Postings of one shard: for each term the rows that hold it, their values, and the bounds of these."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.matrix = ids, matrix.astype(np.int64, copy=False)
        n, width = matrix.shape
        self.hi = self.matrix.max(axis=0, initial=0)
        self.lo = self.matrix.min(axis=0, initial=0)
        by_value = np.argsort(self.matrix, axis=0, kind="stable").T
        self.heads = np.stack([by_value[:, : 2 * k], by_value[:, -2 * k :]])
        self.sparse = np.count_nonzero(self.matrix) * SPARSE_PART < n * width

    @cached_property
    def postings(self) -> list[tuple[np.ndarray | slice, np.ndarray]]:
        out = []
        for column in self.matrix.T:
            rows = np.flatnonzero(column)
            out.append((slice(None) if len(rows) == len(column) else rows, column[rows]))
        return out

    @cached_property
    def floats(self) -> np.ndarray:
        return self.matrix.astype(float)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows for ``query``, ties to the smaller id; ``own`` is left out."""
        width = min(len(query), self.matrix.shape[1])
        query = query[:width]
        most = np.maximum(query * self.hi[:width], query * self.lo[:width])
        reach = most - np.minimum(query * self.hi[:width], query * self.lo[:width])
        order = np.argsort(-reach, kind="stable")
        rest = np.append(np.cumsum(most[order][::-1])[::-1], 0)  # what the terms from here on can add at most
        alive = np.flatnonzero(self.ids != own)
        floor = self._seeded(own, query, order, k) if len(alive) > 4 * k else None
        # a row without any essential posting scores at most rest[split], below the floor
        split = width if floor is None else int(np.argmax(rest < floor)) if (rest < floor).any() else width
        score = np.zeros(len(self.ids), np.int64)
        touched = np.zeros(len(self.ids), bool)
        if floor is None or rest[split] >= floor:
            touched[:] = True
        for t in order[:split]:
            rows, values = self.postings[t]
            score[rows] += query[t] * values
            touched[rows] = True
        alive = alive[touched[alive]]
        if floor is not None:
            alive = alive[score[alive] + rest[split] >= floor]
        for at in range(split, width, PROBED_AT_ONCE):
            terms = order[at : at + PROBED_AT_ONCE]
            score[alive] += self.matrix[np.ix_(alive, terms)] @ query[terms]
            alive = alive[score[alive] + rest[min(at + PROBED_AT_ONCE, width)] >= floor]
        best = alive[np.lexsort((self.ids[alive], -score[alive]))[:k]]
        return self.ids[best], score[best]

    def _seeded(self, own: int, query: np.ndarray, order: np.ndarray, k: int) -> int | None:
        """The k-th best score among the heads of the strongest terms, a lower bound of the true one."""
        heads = [self.heads[1 if query[t] > 0 else 0, t] for t in order[:SEEDS]]
        rows = np.unique(np.concatenate(heads)) if heads else np.empty(0, int)
        rows = rows[self.ids[rows] != own]
        if len(rows) < k:
            return None
        scores = self.matrix[rows][:, : len(query)] @ query
        return int(np.partition(scores, len(rows) - k)[len(rows) - k])


    def search_pack(self, own: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the pack, id and score of the rows that can be among the ``k`` best of each query.

        ``floor``: the k-th best score known of each query, minus infinity where there is none. Of what
        ``search`` finds, rows that score below it are left out.
        """
        width = min(queries.shape[1], self.matrix.shape[1])
        cells, hi, lo = queries[:, :width].astype(float), self.hi[:width].astype(float), self.lo[:width].astype(float)
        if self.sparse or (np.abs(cells) @ np.maximum(hi, -lo)).max(initial=0) >= EXACT:
            found = [self.search(int(q), vector, k) for q, vector in zip(own, queries, strict=True)]
            return np.repeat(np.arange(len(own)), [len(i) for i, _ in found]), np.concatenate([i for i, _ in found]), np.concatenate([s for _, s in found])
        ends = np.stack([cells * hi, cells * lo])
        most = ends.max(axis=0)
        order = np.argsort(ends.min(axis=0) - most, axis=1, kind="stable")
        rest = np.zeros((len(cells), width + 1))  # what the terms from here on can add at most
        rest[:, :-1] = np.cumsum(np.take_along_axis(most, order, 1)[:, ::-1], axis=1)[:, ::-1]
        if np.isinf(floor).any():
            floor = np.maximum(floor, self._seeds(own, cells, order, k))
        below = rest < floor[:, None]
        split = np.where(below.any(axis=1), below.argmax(axis=1), width)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(width)[None, :], 1)
        essential, rows = place < split[:, None], self.floats[:, :width].T
        score = np.where(essential, cells, 0.0) @ rows
        alive = score >= floor[:, None] - np.take_along_axis(rest, split[:, None], 1)
        many = np.flatnonzero(np.count_nonzero(alive, axis=1) * PROBED_PART > len(self.ids))
        if len(many):  # probes of so many rows cost more than a traversal of the other terms
            many = slice(None) if len(many) == len(cells) else many
            score[many] += np.where(essential[many], 0.0, cells[many]) @ rows
            alive[many], split[many] = score[many] >= floor[many, None], width
        q, row = np.divmod(np.flatnonzero(alive), max(1, len(self.ids)))
        score, others = score[q, row], self.ids[row] != own[q]
        q, row, score = q[others], row[others], score[others]
        for at in range(0, width - int(split.min(initial=width)), PROBED_AT_ONCE):
            for step in range(at, at + PROBED_AT_ONCE):
                probe = np.minimum(split[q] + step, width - 1)
                term = order[q, probe]
                score += np.where(split[q] + step < width, self.floats[row, term] * cells[q, term], 0.0)
            alive = score + rest[q, np.minimum(split[q] + at + PROBED_AT_ONCE, width)] >= floor[q]
            q, row, score = q[alive], row[alive], score[alive]
        return q, self.ids[row], score.astype(np.int64)

    def _seeds(self, own: np.ndarray, cells: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
        """``_seeded`` of each query of a pack, minus infinity where there is none."""
        strong = order[:, :SEEDS]
        up = (np.take_along_axis(cells, strong, 1) > 0).astype(int)
        rows = np.sort(self.heads[up, strong].reshape(len(cells), -1), axis=1)
        if rows.shape[1] < k:
            return np.full(len(cells), -np.inf)
        scores = (self.floats[:, : cells.shape[1]][rows] @ cells[:, :, None])[:, :, 0]
        scores[self.ids[rows] == own[:, None]] = -np.inf
        scores[:, 1:][rows[:, 1:] == rows[:, :-1]] = -np.inf
        return np.partition(scores, rows.shape[1] - k, axis=1)[:, rows.shape[1] - k]


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each query, ties to the smaller id, in order."""
    order = np.lexsort((ids, -score, q))
    q = q[order]
    kept = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[kept], ids[order][kept], score[order][kept]


def _searcher(k: int):
    """The ``k`` best of each pack's queries in the shards of its group, which come before the packs."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        group, held = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["g"] != group:
                    group, held = row["g"], []
                ids, matrix = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["cells"], f"i{row['bytes']}").reshape(row["n"], row["width"])
                if not row["is_pack"]:
                    held.append(Shard(ids, matrix, k))
                    continue
                matrix, found, floor = matrix.astype(np.int64), (np.empty(0, np.int64),) * 3, np.full(len(ids), -np.inf)
                for shard in held:
                    more = shard.search_pack(ids, matrix, k, floor)
                    found = _best(*map(np.concatenate, zip(found, more, strict=True)), k)
                    last = np.flatnonzero(np.bincount(found[0], minlength=len(ids)) == k)
                    floor[last] = found[2][np.searchsorted(found[0], last, side="right") - 1]
                if len(found[0]):
                    yield pa.record_batch([ids[found[0]], found[1], found[2]], schema=schema)

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each row that ``is_query`` (an expression on ``vec_id``) marks, the ``k`` rows of highest score.

    The score is the integer inner product of the quantised vectors; vectors of unequal length are
    filled with zeros. Ties go to the smaller id, rows of the query's id take no part, and an empty table
    gives no rows. The best of all vectors of an id are that id's result. The shards are a written table;
    they and a copy of the packs for each group of shards are dealt to the tasks, nothing is broadcast.
    """
    cells = saved(quantise(vectors, scale), "vectors")
    shards = saved(cells.mapInArrow(_packer(shard_rows), PACKED), "shards")
    packs = saved(cells.where(is_query).mapInArrow(_packer(PACK_ROWS), PACKED), "packs")
    n, cores = shards.count(), vectors.sparkSession.sparkContext.defaultParallelism
    groups = max(1, min(n, GROUPS_A_CORE * cores), -(-n // HELD))
    places = number_rows(shards.select("part", "seq"), [], [F.col("part"), F.col("seq")], "at")
    placed = lookup_join(shards, places, ["part", "seq"], "inner").withColumn("g", F.pmod("at", F.lit(groups)).cast("int"))
    copied = packs.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    names = ["g", "is_pack", "n", "ids", "width", "bytes", "cells"]
    both = placed.withColumn("is_pack", F.lit(False)).select(*names).union(copied.withColumn("is_pack", F.lit(True)).select(*names))
    hits = both.repartitionById(groups, F.col("g")).sortWithinPartitions("g", "is_pack").mapInArrow(_searcher(k), HITS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

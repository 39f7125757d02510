"""A filter of bounded size for ids: it lets every member pass, and few others while it is not crowded."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 24
BITS_PER_ID = 16

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers over all of them, one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def _place(ids: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(ids.astype(np.uint64) + GOLDEN) % np.uint64(bits)).astype(np.int64)


class IdFilter:
    def __init__(self, bits: int, bitmap: bytes):
        self.bits, self.bitmap = bits, bitmap

    def maybe(self, ids: pa.Array) -> pa.Array:
        """Whether each id may be a member; a null is none."""
        at = _place(ids.fill_null(0).to_numpy(zero_copy_only=False), self.bits)
        hit = (np.frombuffer(self.bitmap, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return pa.compute.and_(pa.array(hit.astype(bool)), ids.is_valid())


def _marker(bits: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            at = _place(batch.column(0).drop_null().to_numpy(zero_copy_only=False), bits)
            np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))
        cells = bitmap.view(np.int64)
        full = np.flatnonzero(cells)
        yield pa.record_batch([pa.array(full, pa.int64()), pa.array(cells[full], pa.int64())], names=["cell", "bits"])

    return mark


def id_filter(ids: DataFrame) -> IdFilter:
    """The filter of a table of ids (one column, long): at most 2 MB, whatever the table's size."""
    bits, wanted = MOST_BITS, BITS_PER_ID * max(1, ids.count())
    while bits > 1 << 16 and bits > wanted:
        bits >>= 1
    cells = ids.mapInArrow(_marker(bits), "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    bitmap = np.zeros(bits // 64, np.int64)
    for part in cells.toArrow().to_batches():  # at most bits / 64 rows
        bitmap[part.column(0).to_numpy()] = part.column(1).to_numpy()
    return IdFilter(bits, bitmap.tobytes())


def _dropper(sent, column: int):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(sent.value.maybe(batch.column(column)))

    return drop


def members(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of ``rows`` whose ``column`` (long) is in ``ids``, and a few others. A join decides on these."""
    sent = rows.sparkSession.sparkContext.broadcast(id_filter(ids))
    return rows.mapInArrow(_dropper(sent, rows.columns.index(column)), rows.schema)

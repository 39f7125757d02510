"""Size-checked handling of small tables: lookups, quotas, bounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

LOOKUP_ROWS = 100_000
LOOKUP_BYTES = 32 << 20


def small_table(df: DataFrame, max_rows: int = LOOKUP_ROWS, max_bytes: int = LOOKUP_BYTES) -> DataFrame | None:
    """``df`` as a local relation when it is at most ``max_rows`` and ``max_bytes`` large, else ``None``.

    The limit is part of the plan, so never more than ``max_rows + 1`` rows reach the driver.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = LOOKUP_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``left`` with a table that is unique on ``on``.

    The right side is broadcast only after its size was checked. Beyond that it is a plain shuffle join,
    whose hot keys Spark's adaptive skew handling splits: each part meets the one row of its key.
    """
    small = small_table(right, max_rows)
    if small is not None:
        right = F.broadcast(small)
    if not null_safe:
        return left.join(right, on, how)
    renamed = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}") if c in on else F.col(f"`{c}`") for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_r_{c}`")) for c in on])
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])

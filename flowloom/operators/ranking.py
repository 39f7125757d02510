"""Sorting, top-k, latest-n and positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import col
from ..plans.ranking import WINDOW_ROWS, number_rows

# Up to this n Spark trims every group before the shuffle by itself.
GROUP_LIMIT = 1000
SLICES = 64


def sort_by(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.orderBy(*order)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def latest_n(df: DataFrame, key: str, ts: str, n: int, tie: str) -> DataFrame:
    """The n newest rows of every key. Groups are trimmed per slice first, so a hot key stays small."""
    order = [F.col(ts).desc(), F.col(tie).desc()]
    if n > GROUP_LIMIT:
        slice_ = F.pmod(F.xxhash64(ts, tie), F.lit(SLICES))
        local = Window.partitionBy(key, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", slice_).withColumn("_r", F.row_number().over(local))
            .filter(F.col("_r") <= n).drop("_r", "_slice")
        )
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def with_position(
    df: DataFrame, source: str, order: list[Column], name: str = "historique_id", window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Ids such as csv-0, csv-1 per source, numbered in ``order``."""
    numbered = number_rows(df, [source], order, "_n", window_rows)
    label = F.concat(F.lower(col(source)), F.lit("-"), (F.col("_n") - 1).cast("string"))
    return numbered.withColumn(name, label).drop("_n")


def retain(df: DataFrame, ts: str, ttl: str, now: Column) -> DataFrame:
    """Rows newer than ``now`` minus an interval such as '90 days'."""
    return df.filter(F.col(ts) > now - F.expr(f"INTERVAL {ttl}"))

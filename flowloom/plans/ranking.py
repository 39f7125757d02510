"""Exact row numbers and hash-ranked quotas that do not depend on small groups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .bounded import lookup_join, small_table
from .checkpoints import durable

# A window partition up to this many rows is sorted by one task; larger ones take the split path.
WINDOW_ROWS = 1_000_000
ONE = "_all"


def rank_hash(seed: int, key: list[str]) -> Column:
    """Repeatable pseudo-random rank of a row: md5 of the seed and its key columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in key]))


def largest_group(df: DataFrame, by: list[str]) -> int:
    counts = df.groupBy(*by).count() if by else df.agg(F.count("*").alias("count"))
    return counts.agg(F.max("count")).first()[0] or 0


def number_rows(
    df: DataFrame,
    part: list[str],
    order: list[Column],
    name: str = "position",
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Number rows 1..n inside each ``part`` group in ``order``.

    Small groups use a window. When one group is too large for a task, rows are range partitioned
    on (part, order), numbered per partition, frozen, and shifted by the counts of the partitions
    before. A random last sort key lets even identical rows spread; freezing makes it safe.
    """
    if largest_group(df, part) <= window_rows:
        window = Window.partitionBy(*part).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("long"))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(f"`{c}`") for c in part], *order, F.col("_spread")]
    ranged = (
        df.withColumn("_spread", F.rand(17))
        .repartitionByRange(width, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_spread")
    )
    frozen = durable(ranged)
    before = Window.partitionBy(*part).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        frozen.groupBy(*part, "_slice")
        .agg(F.min("_local").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    placed = lookup_join(frozen, starts, [*part, "_slice"], "inner", null_safe=True)
    return placed.withColumn(name, F.col("_offset") + F.col("_local") - F.col("_first") + 1).drop(
        "_slice", "_local", "_first", "_offset"
    )


def _cutoffs(hashed: DataFrame, by: list[str], quotas: DataFrame) -> DataFrame:
    """Per stratum, the hash of the last row inside its quota, found from counts alone."""
    total = hashed.count()
    digits = min(5, max(1, math.ceil(math.log(max(total / 50_000, 1), 16))))
    prefix = F.substring("_h", 1, digits)
    running = lambda col: F.sum("_n").over(
        Window.partitionBy(*by).orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    )
    buckets = (
        hashed.groupBy(*by, prefix.alias("_p")).agg(F.count("*").alias("_n"))
        .withColumn("_end", running("_p"))
        .withColumn("_size", F.sum("_n").over(Window.partitionBy(*by)))  # one row per prefix
    )
    edge = (
        lookup_join(buckets, quotas, by, "inner", null_safe=True)
        .withColumn("quota", F.least("quota", "_size"))
        .filter((F.col("_end") >= F.col("quota")) & (F.col("_end") - F.col("_n") < F.col("quota")))
        .select(*by, "_p", (F.col("quota") - F.col("_end") + F.col("_n")).alias("_left"))
    )
    inside = (
        lookup_join(hashed.select(*by, "_h", prefix.alias("_p")), edge, [*by, "_p"], "inner", null_safe=True)
        .groupBy(*by, "_h", "_left").agg(F.count("*").alias("_n"))
        .withColumn("_end", running("_h"))
    )
    return inside.filter(
        (F.col("_end") >= F.col("_left")) & (F.col("_end") - F.col("_n") < F.col("_left"))
    ).select(
        *by, F.col("_h").alias("_cut"),
        (F.col("_left") - F.col("_end") + F.col("_n")).alias("_take"), F.col("_n").alias("_ties"),
    )


def flag_quota(
    df: DataFrame,
    by: list[str],
    quotas: DataFrame,
    seed: int,
    key: list[str],
    ties: list[str] = (),
    name: str = "chosen",
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Flag, per stratum, the first ``quota`` rows in hash order (null strata count as one).

    Rows never travel: counts per hash prefix locate the cut, the bucket around it is
    refined, and every row is then compared with its stratum's cut hash. Only rows that share the
    exact cut hash are numbered.
    """
    hashed = df.withColumn("_h", rank_hash(seed, key))
    if not by:
        by = [ONE]
        hashed = hashed.withColumn(ONE, F.lit(1))
        quotas = quotas.withColumn(ONE, F.lit(1))
    found = _cutoffs(hashed, by, quotas)
    cuts = small_table(found)
    cuts = cuts if cuts is not None else durable(found)
    tagged = lookup_join(hashed, cuts, by, "left", null_safe=True)
    split_tie = F.coalesce((F.col("_h") == F.col("_cut")) & (F.col("_take") < F.col("_ties")), F.lit(False))
    plain = tagged.filter(~split_tie).withColumn(name, F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False)))
    if cuts.filter(F.col("_take") < F.col("_ties")).isEmpty():
        return plain.drop("_h", "_cut", "_take", "_ties", ONE)
    tied = number_rows(tagged.filter(split_tie), by, [F.col(c) for c in ("_h", *ties)], "_rank", window_rows)
    tied = tied.withColumn(name, F.col("_rank") <= F.col("_take")).drop("_rank")
    return plain.unionByName(tied).drop("_h", "_cut", "_take", "_ties", ONE)

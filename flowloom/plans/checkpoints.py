"""Lineage cuts and scratch space in storage every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Values (rows x columns) of a partition of a table that a model is fitted on.
PART_CELLS = 8_000_000
# What a row costs beside its values, in values: a fit caches its rows as objects with headers and references.
ROW_CELLS = 12


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder named by the session, else a folder of its warehouse, which executors share too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def durable(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    A lost executor recomputes nothing before it, and later reads take only the columns they need; with
    ``by`` (split, for one) also only the partitions.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for tables written between two jobs."""
    return f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}/{name}"


def spread(df: DataFrame, cells: int = PART_CELLS) -> DataFrame:
    """Give a frozen table one partition per core and per ``cells`` values when it has fewer.

    Files of numbers are packed tightly, so that a split of usual size can hold many millions of rows; the
    second bound keeps what a task of a fit reads and caches the same however large the table is. A row counts
    as ``ROW_CELLS`` values more than it has, else a table of few columns would get very long partitions.
    """
    width = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * (len(df.columns) + ROW_CELLS) // cells))
    return df if df.rdd.getNumPartitions() >= width else df.repartition(width)

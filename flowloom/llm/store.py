"""Intermediate tables in the shared folder, so that a lost executor never repeats what lies before them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from flowloom.plans.checkpoints import scratch_path

_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def saved(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return the written table.

    Inside ``temporaries`` the table goes with the others at the end, unless ``keep`` is set.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    made = _MADE.get()
    if made is not None and not keep:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Jobs that run inside hand rows to Python in batches of at most ``rows``.

    A batch of texts lies in the executor's JVM, in its Python worker, and there again as objects; the
    default of 10,000 rows is tens of MB each time.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``saved`` writes inside; what is needed later has to be kept by then."""
    token = _MADE.set(made := [])
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

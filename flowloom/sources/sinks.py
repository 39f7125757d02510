"""Result sinks and the checked reload of a prepared dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import constants as K
from ..functions.scalars import col, lookup


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a report table; CSV gets a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_dataset(df: DataFrame, path: str, split: str = "split") -> None:
    """Write the split dataset as parquet and as CSV, one folder per split."""
    for fmt in ("parquet", "csv"):
        write_table_by(df, f"{path}/{fmt}", fmt, [split])


def write_table_by(df: DataFrame, path: str, fmt: str, by: list[str]) -> None:
    writer = df.write.mode("overwrite").partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_proof(row: DataFrame, path: str) -> None:
    """Write the metrics of one step as JSON."""
    row.write.mode("overwrite").json(path)


def load_split(spark: SparkSession, path: str, label: str = "label") -> DataFrame:
    """Reload a dataset written by ``write_dataset`` and check it against its CSV twin."""
    data = spark.read.parquet(f"{path}/parquet").withColumn(label, F.col(label).cast("int"))
    twin = spark.read.option("header", True).csv(f"{path}/csv")
    if [c.strip() for c in twin.columns] != data.columns:
        raise ValueError("the stored copies do not have the same columns")
    counts = lambda df: {r[0]: r[1] for r in df.groupBy("split").count().collect()}
    stored, copied = counts(data), counts(twin)
    if stored != copied:
        raise ValueError(f"row counts differ: {stored} and {copied}")
    if {"train", "test"} - set(stored):
        raise ValueError("both a train and a test part are needed")
    if not data.filter(F.col(label).isNull()).isEmpty():
        raise ValueError("labels must be integers")
    return data


def display(df: DataFrame) -> DataFrame:
    """Display values for the coded columns and display names for all known ones."""
    shown = {c: lookup(col(c), K.DISPLAY_VALUES, col(c)) for c in K.DISPLAYED if c in df.columns}
    return df.withColumns(shown).withColumnsRenamed(K.DISPLAY_COLUMNS) if shown else df.withColumnsRenamed(K.DISPLAY_COLUMNS)


def register_filter(
    df: DataFrame, source: str | None = None, severity: str | None = None, status: str | None = None
) -> DataFrame:
    """Keep register rows that match every given choice."""
    for name, wanted in (("source", source), ("gravite", severity), ("statut", status)):
        if wanted is not None:
            df = df.filter(F.col(name) == wanted)
    return df


def export_register(
    df: DataFrame,
    source: str | None = None,
    severity: str | None = None,
    status: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Filtered register without internal columns, in display form; written when a path is given."""
    shown = display(register_filter(df, source, severity, status).drop(*K.INTERNAL_COLUMNS))
    if path:
        write_table(shown, path)
    return shown

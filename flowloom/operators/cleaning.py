"""Infinite and missing values, column selection, duplicates, reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import col
from ..plans.bounded import lookup_join
from ..plans.checkpoints import durable

INFINITY = float("inf")


def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def is_infinite(c: Column) -> Column:
    return F.coalesce(F.abs(c) == INFINITY, F.lit(False))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    c = col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def inf_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Infinities and NaN of the floating columns become null."""
    names = cols if cols is not None else numeric_cols(df)
    floating = [n for n in names if isinstance(df.schema[n].dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns(
        {n: F.when(~(is_infinite(col(n)) | F.isnan(col(n))), col(n)) for n in floating}
    )


def select_features(df: DataFrame, cols: list[str], keep: list[str] = ()) -> DataFrame:
    return df.select(*[col(c) for c in (*cols, *keep)])


def _row_groups(df: DataFrame, by: str | None = None) -> DataFrame:
    """``_n`` of each set of equal rows, with its group; what is shuffled is two hashes a row.

    Rows whose hashes no other row has are sets of one. Only the others are compared in full, so hashes
    that meet by chance, or because they skip nulls, part nothing and join nothing.
    """
    kinds = dict(df.dtypes)
    # equal numbers have equal hashes: zero has one sign
    cells = [col(c).cast("double") + F.lit(0.0) if kinds[c] in ("float", "double") else col(c) for c in df.columns]
    hashes = {"_h1": F.xxhash64(*cells), "_h2": F.xxhash64(F.lit("again"), *reversed(cells))}
    group = [col(by).alias("_g")] if by else []
    hashed = df.select(*group, *[h.alias(c) for c, h in hashes.items()])
    counted = durable(hashed.groupBy("_h1", "_h2").agg(F.count("*").alias("_n"), *([F.any_value("_g").alias("_g")] if by else [])))
    single = counted.filter("_n = 1").select(*(["_g"] if by else []), "_n")
    again = counted.filter("_n > 1").select("_h1", "_h2")
    full = lookup_join(df.withColumns(hashes), again, ["_h1", "_h2"], "left_semi")
    rest = full.groupBy(*[col(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    return single.unionByName(rest.select(*group, "_n"))


def duplicate_count(df: DataFrame, by: str | None = None) -> DataFrame:
    """Rows minus distinct full rows, per group or in total."""
    surplus = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
    groups = _row_groups(df, by)
    return groups.groupBy(F.col("_g").alias(by)).agg(surplus) if by else groups.agg(surplus)


def dedup(df: DataFrame) -> DataFrame:
    """Keep one row of every set of equal rows; null equals null."""
    return df.dropDuplicates()


def dedup_summary(df: DataFrame) -> DataFrame:
    """Rows before, removed, after and the removed share in percent."""
    groups = _row_groups(df)
    before, after = F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")
    return groups.agg(before.alias("before"), after.alias("after")).select(
        "before",
        (F.col("before") - F.col("after")).alias("removed"),
        "after",
        F.round(F.try_divide(100.0 * (F.col("before") - F.col("after")), F.col("before")), 4).alias("removed_pct"),
    )


def melt(df: DataFrame, ids: list[str], cols: list[str], variable="variable", value="value") -> DataFrame:
    """Wide to long, nulls kept."""
    return df.unpivot([col(c) for c in ids], [col(c) for c in cols], variable, value)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks."""
    return a.distinct().subtract(b.distinct())


def column_difference(expected: list[str], found: list[str]) -> tuple[list[str], list[str]]:
    """Sorted missing and extra column names."""
    return sorted(set(expected) - set(found)), sorted(set(found) - set(expected))

"""Exact, repeatable samples, splits and folds ranked by a hash of seed and key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import col
from ..plans.bounded import lookup_join, small_table
from ..plans.ranking import WINDOW_ROWS, flag_quota, number_rows, rank_hash
from .profiling import percent


def _settled(df: DataFrame) -> DataFrame:
    """Small aggregates become local rows, so later steps do not compute them again."""
    local = small_table(df)
    return local if local is not None else df


def sample_n(
    df: DataFrame, by: list[str], n: int, seed: int, key: list[str], ties: list[str] = (),
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """min(n, size) rows of every group."""
    sizes = _settled(df.groupBy(*by).count())
    quotas = sizes.select(*by, F.least(F.col("count"), F.lit(n)).cast("long").alias("quota"))
    flagged = flag_quota(df, by, quotas, seed, key, ties, "_in", window_rows)
    return flagged.filter("_in").drop("_in")


def composition(sample: DataFrame, by: str) -> DataFrame:
    return sample.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by)


def stratified_sample(
    df: DataFrame, label: str, size: int, seed: int, key: list[str], ties: list[str] = (),
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Proportional sample: floor(size * class / total) rows per class, at least one."""
    sizes = _settled(df.groupBy(label).agg(F.count("*").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0]
    if total is None or total <= size:
        return df
    share = F.greatest(F.lit(1), F.floor(F.lit(size) * F.col("n") / F.lit(total)))
    quotas = sizes.select(label, F.least(share, F.col("n")).cast("long").alias("quota"))
    flagged = flag_quota(df, [label], quotas, seed, key, ties, "_in", window_rows)
    return flagged.filter("_in").drop("_in")


def train_quotas(sizes: DataFrame, label: str, test_share: float, n: str = "n") -> DataFrame:
    """Train rows per class: floor of the proportional part plus the largest remainders."""
    total = sizes.agg(F.sum(n)).first()[0] or 0
    n_test = -int(-(total * test_share) // 1)
    n_train = total - n_test
    product = F.lit(n_train).cast("decimal(19,0)") * col(n).cast("decimal(19,0)")
    whole = F.lit(max(total, 1)).cast("decimal(19,0)")
    rest = product % whole
    parts = sizes.withColumns({"_floor": ((product - rest) / whole).cast("long"), "_rest": rest})
    spare = n_train - (parts.agg(F.sum("_floor")).first()[0] or 0)
    by_rest = number_rows(parts, [], [F.desc("_rest"), F.asc(label)], "_r")
    quota = F.col("_floor") + (F.col("_r") <= F.lit(spare)).cast("long")
    return by_rest.select(*sizes.columns, quota.alias("quota"))


def stratified_split(
    df: DataFrame, label: str, test_share: float, seed: int, key: list[str], ties: list[str] = (),
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add ``split`` (train or test) with exact sizes in total and per class."""
    sizes = _settled(df.groupBy(label).agg(F.count("*").alias("n")))
    quotas = train_quotas(sizes, label, test_share).select(label, "quota")
    flagged = flag_quota(df, [label], quotas, seed, key, ties, "_in", window_rows)
    return flagged.withColumn("split", F.when(F.col("_in"), "train").otherwise("test")).drop("_in")


def split_summary(df: DataFrame, split: str = "split") -> DataFrame:
    counted = df.groupBy(split).agg(F.count("*").alias("n"))
    return counted.withColumn("pct", percent(F.col("n"), df.agg(F.count("*")).scalar(), 4))


def split_distribution(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows per class in each part, their sum and the share of the whole."""
    part = lambda name: F.count_if(F.col(split) == name)
    table = df.groupBy(label).agg(part("train").alias("train"), part("test").alias("test"))
    whole = df.agg(F.count("*")).scalar()
    both = F.col("train") + F.col("test")
    return table.select(label, "train", "test", both.alias("total"), percent(both, whole, 6).alias("total_pct"))


def fold_count(sizes: DataFrame, n: str = "n", most: int = 5) -> int:
    """min(most, smallest class), but two folds when a class has a single row."""
    smallest = sizes.agg(F.min(n)).first()[0] or 0
    return min(most, smallest) if smallest > 1 else 2


def stratified_folds(
    df: DataFrame, label: str, k: int, seed: int, key: list[str], ties: list[str] = (),
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add ``fold`` 0..k-1 so that class sizes differ by at most one between folds."""
    hashed = df.withColumn("_h", rank_hash(seed, key))
    placed = number_rows(hashed, [label], [F.col("_h"), *[col(t) for t in ties]], "_n", window_rows)
    return placed.withColumn("fold", ((F.col("_n") - 1) % k).cast("int")).drop("_h", "_n")


def cap_rows(
    df: DataFrame, n: int, seed: int, key: list[str], ties: list[str] = (), window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """At most n rows of the whole table (a sampling step of the comparison, not of the results)."""
    total = df.count()
    if total <= n:
        return df
    quota = df.sparkSession.createDataFrame([(n,)], "quota long")
    return flag_quota(df, [], quota, seed, key, ties, "_in", window_rows).filter("_in").drop("_in")

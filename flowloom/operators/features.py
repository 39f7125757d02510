"""Label codes, class weights, constant columns, medians and min-max scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import col
from ..plans.bounded import lookup_join, small_table
from ..plans.quantiles import BUFFER_CELLS, exact_quantiles
from ..plans.ranking import number_rows


def label_dictionary(df: DataFrame, label: str) -> DataFrame:
    """(code, class): sorted distinct labels numbered from zero."""
    classes = df.select(col(label).alias("classe")).filter("classe is not null").distinct()
    few = small_table(classes)  # numbering reads them twice
    classes = few if few is not None else classes
    return number_rows(classes, [], [F.col("classe")], "_n").select(
        (F.col("_n") - 1).cast("int").alias("code"), "classe"
    )


def label_index(df: DataFrame, label: str, dictionary: DataFrame | None = None) -> DataFrame:
    dictionary = dictionary if dictionary is not None else label_dictionary(df, label)
    return lookup_join(df, dictionary.withColumnRenamed("classe", label), [label])


def decode_label(df: DataFrame, code: str, dictionary: DataFrame) -> DataFrame:
    return lookup_join(df, dictionary.withColumnRenamed("code", code), [code])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_class)."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    classes = Window.partitionBy(F.lit(0))  # one row per class
    return counted.withColumn("weight", F.sum("n").over(classes) / (F.count("*").over(classes) * F.col("n")))


def with_weight(df: DataFrame, label: str, weights: DataFrame | None = None) -> DataFrame:
    weights = weights if weights is not None else class_weights(df, label)
    return lookup_join(df, weights.select(label, "weight"), [label], null_safe=True)


def usable_columns(df: DataFrame, cols: list[str], share: float = 0.95, most: int | None = None) -> list[str]:
    """Columns whose non-null share exceeds ``share``, only the first ``most`` of them if that is given."""
    row = df.agg(*[F.avg(col(c).isNotNull().cast("double")) for c in cols]).first()
    return [c for c, x in zip(cols, row) if x is not None and x > share][:most]


def column_shares(df: DataFrame, cols: list[str], share: float = 0.95) -> DataFrame:
    """Non-null share of every column and whether it passes."""
    wide = df.agg(*[F.avg(col(c).isNotNull().cast("double")).alias(c) for c in cols])
    return wide.unpivot([], [col(c) for c in cols], "variable", "share").select(
        "variable", F.round("share", 6).alias("share"), (F.col("share") > share).alias("usable")
    )


def constant_columns(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Variance per column; one distinct value means constant."""
    stats = [
        F.struct(
            F.lit(c).alias("variable"),
            F.round(F.var_samp(col(c)), digits).alias("variance"),
            (F.min(col(c)) == F.max(col(c))).alias("constant"),
        ).alias(f"s{i}")
        for i, c in enumerate(cols)
    ]
    cells = F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")
    return df.agg(*stats).select(cells).select("s.*")


def kept_columns(df: DataFrame, cols: list[str]) -> list[str]:
    constant = {r["variable"] for r in constant_columns(df, cols).filter("constant").collect()}
    return [c for c in cols if c not in constant]


def fit_median(df: DataFrame, cols: list[str], buffer_cells: int = BUFFER_CELLS) -> dict[str, float]:
    """Exact median per column; columns without values are left out."""
    found = exact_quantiles(df, {c: col(c).cast("double") for c in cols}, [0.5], buffer_cells)
    return {c: q[0] for c, q in found.items() if q[0] is not None}


def apply_median(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def fit_minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    """(variable, low, high) of the training rows."""
    ends = [
        F.struct(F.lit(c).alias("variable"), F.min(col(c)).cast("double").alias("low"), F.max(col(c)).cast("double").alias("high"))
        .alias(f"s{i}")
        for i, c in enumerate(cols)
    ]
    cells = F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")
    return df.agg(*ends).select(cells).select("s.*")


def apply_minmax(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """(x - low) / (high - low) without clipping; a constant column becomes zero at its value."""
    scaled = {}
    for r in bounds.collect():  # one row per feature
        spread = (r["high"] - r["low"]) if r["high"] is not None else 0.0
        scaled[r["variable"]] = (col(r["variable"]) - F.lit(r["low"])) / F.lit(spread or 1.0)
    return df.withColumns(scaled)


def minmax_check(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return fit_minmax(df, cols).select(
        "variable", F.round("low", digits).alias("min_after"), F.round("high", digits).alias("max_after")
    )

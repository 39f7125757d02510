"""Pearson correlation with a target, between columns, and the strongest pairs."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import col
from .cleaning import inf_to_null

# Above this many column pairs one pass of moment matrices beats wide aggregates.
AGGREGATE_PAIRS = 150


def varying_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with more than one distinct non-null value."""
    ends = df.agg(*[f(col(c)) for c in cols for f in (F.min, F.max)]).first()
    return [c for i, c in enumerate(cols) if ends[2 * i] is not None and ends[2 * i] != ends[2 * i + 1]]


def corr_with_target(df: DataFrame, cols: list[str], target: str, digits: int = 6) -> DataFrame:
    """Correlation of every non-constant column with a 0/1 target, strongest first, in one aggregate."""
    clean = inf_to_null(df, cols)
    used = varying_columns(clean, cols)
    wide = clean.agg(*[F.corr(col(c).cast("double"), col(target).cast("double")).alias(c) for c in used])
    return (
        wide.unpivot([], [col(c) for c in used], "variable", "corr")
        .filter(F.col("corr").isNotNull() & ~F.isnan("corr"))
        .select("variable", F.round("corr", digits).alias("corr"), F.round(F.abs("corr"), digits).alias("corr_abs"))
        .orderBy(F.desc("corr_abs"), "variable")
    )


def pair_correlations(df: DataFrame, cols: list[str], aggregate_pairs: int = AGGREGATE_PAIRS) -> DataFrame:
    """Correlation of every unordered column pair over the rows where both are present."""
    clean = inf_to_null(df, cols).select(*[col(c).cast("double").alias(c) for c in cols])
    pairs = list(combinations(range(len(cols)), 2))
    if len(pairs) > aggregate_pairs:
        return _pairs_from_moments(clean, cols)
    wide = clean.agg(*[F.corr(col(cols[i]), col(cols[j])).alias(f"{i}_{j}") for i, j in pairs])
    cells = F.array(
        *[
            F.struct(F.lit(cols[i]).alias("v1"), F.lit(cols[j]).alias("v2"), F.col(f"{i}_{j}").alias("corr"))
            for i, j in pairs
        ]
    )
    return wide.select(F.explode(cells).alias("c")).select("c.*")


def _pairs_from_moments(clean: DataFrame, cols: list[str]) -> DataFrame:
    """One scan: each task folds its batches into k x k moment matrices, Spark adds them up.

    Values are centred on the column mean first, which keeps the sums of squares accurate.
    """
    means = [m if m is not None else 0.0 for m in clean.agg(*[F.avg(col(c)) for c in cols]).first()]
    centre, k = np.array(means), len(cols)
    i, j = np.triu_indices(k, 1)
    names = ["n", "si", "sj", "sii", "sjj", "sij"]

    def fold(batches):
        total = None
        for batch in batches:
            raw = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            seen = ~np.isnan(raw)
            x, m = np.where(seen, raw - centre, 0.0), seen.astype(float)
            parts = np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
            total = parts if total is None else total + parts
        if total is not None:
            data = [pa.array(i, pa.int32()), pa.array(j, pa.int32())]
            data += [pa.array(total[p][i, j]) for p in range(6)]
            yield pa.RecordBatch.from_arrays(data, ["i", "j", *names])

    schema = "i int, j int, " + ", ".join(f"{n} double" for n in names)
    sums = clean.mapInArrow(fold, schema).groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in names])
    cov = F.col("sij") - F.col("si") * F.col("sj") / F.col("n")
    vi = F.col("sii") - F.col("si") * F.col("si") / F.col("n")
    vj = F.col("sjj") - F.col("sj") * F.col("sj") / F.col("n")
    labels = F.array(*map(F.lit, cols))
    corr = F.when((F.col("n") > 1) & (vi > 0) & (vj > 0), cov / F.sqrt(vi * vj))
    return sums.select(labels[F.col("i")].alias("v1"), labels[F.col("j")].alias("v2"), corr.alias("corr"))


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Full matrix in long form (v1, v2, corr), diagonal included."""
    upper = pair_correlations(df, cols)
    lower = upper.select(F.col("v2").alias("v1"), F.col("v1").alias("v2"), "corr")
    clean = inf_to_null(df, cols)
    diagonal = (
        clean.agg(*[F.corr(col(c).cast("double"), col(c).cast("double")).alias(c) for c in cols])
        .unpivot([], [col(c) for c in cols], "v1", "corr")
        .select("v1", F.col("v1").alias("v2"), "corr")
    )
    return upper.unionByName(lower).unionByName(diagonal).withColumn("corr", F.round("corr", digits))


def upper_pairs(matrix: DataFrame, cols: list[str]) -> DataFrame:
    """Upper triangle of a long matrix, in column order."""
    rank = F.create_map(*[F.lit(x) for i, c in enumerate(cols) for x in (c, i)])
    return matrix.filter(rank[F.col("v1")] < rank[F.col("v2")])


def top_pairs(df: DataFrame, cols: list[str], k: int = 100, digits: int = 6) -> DataFrame:
    """The k strongest pairs of non-constant columns by absolute correlation, ranked."""
    used = varying_columns(inf_to_null(df, cols), cols)
    pairs = pair_correlations(df, used).filter(F.col("corr").isNotNull() & ~F.isnan("corr"))
    rounded = pairs.select(
        "v1", "v2", F.round("corr", digits).alias("corr"), F.round(F.abs("corr"), digits).alias("corr_abs")
    )
    best = rounded.orderBy(F.desc("corr_abs"), "v1", "v2").limit(k)
    order = Window.orderBy(F.desc("corr_abs"), "v1", "v2")  # at most k rows
    return best.withColumn("rank", F.row_number().over(order).cast("long"))


def leading_variables(pairs: DataFrame, k: int = 20) -> DataFrame:
    """First k distinct variables met when walking the ranked pairs."""
    met = pairs.select(F.posexplode(F.array("v1", "v2")).alias("side", "variable"), "rank")
    first = met.groupBy("variable").agg(F.min(F.col("rank") * 2 + F.col("side")).alias("met_at"))
    return first.orderBy("met_at").limit(k)

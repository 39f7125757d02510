"""Tukey outliers per variable, per group, and peaks of a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col
from ..plans.checkpoints import durable
from ..plans.quantiles import BUFFER_CELLS, exact_quantiles
from .cleaning import inf_to_null


def tukey_bounds(
    df: DataFrame, cols: list[str], k: float = 1.5, guard: bool = True, buffer_cells: int = BUFFER_CELLS
) -> dict[str, tuple]:
    """(q1, q3, iqr, low, high) per column; with ``guard`` an iqr <= 0 gives no bounds."""
    quartiles = exact_quantiles(df, {c: col(c).cast("double") for c in cols}, [0.25, 0.75], buffer_cells)
    out = {}
    for c in cols:
        q1, q3 = quartiles[c]
        iqr = None if q1 is None else q3 - q1
        usable = iqr is not None and (iqr > 0 or not guard)
        out[c] = (q1, q3, iqr, q1 - k * iqr if usable else None, q3 + k * iqr if usable else None)
    return out


def _outside(c: Column, low, high) -> Column:
    if low is None:
        return F.lit(False)
    return F.coalesce((c < low) | (c > high), F.lit(False))


def iqr_outliers(
    df: DataFrame, cols: list[str], k: float = 1.5, guard: bool = True, buffer_cells: int = BUFFER_CELLS
) -> DataFrame:
    """Quartiles, bounds, valid and outlying cells per variable; one quantile and one counting pass."""
    clean = inf_to_null(df, cols)
    bounds = tukey_bounds(clean, cols, k, guard, buffer_cells)
    stats = []
    for c in cols:
        q1, q3, iqr, low, high = (F.round(F.lit(x).cast("double"), 6) for x in bounds[c])
        valid, hits = F.count(col(c)), F.count_if(_outside(col(c), *bounds[c][3:]))
        share = F.round(F.coalesce(F.try_divide(100.0 * hits, valid), F.lit(0.0)), 6)
        stats.append(
            F.struct(
                F.lit(c).alias("variable"), q1.alias("q1"), q3.alias("q3"), iqr.alias("iqr"),
                low.alias("low"), high.alias("high"), valid.alias("valid"), hits.alias("outliers"),
                share.alias("outliers_pct"),
            )
        )
    wide = clean.agg(*[s.alias(f"s{i}") for i, s in enumerate(stats)])
    cells = F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")
    return wide.select(cells).select("s.*").orderBy(F.desc("outliers"), "variable")


def outliers_by(
    df: DataFrame, cols: list[str], sets: list[str], k: float = 1.5, guard: bool = True,
    buffer_cells: int = BUFFER_CELLS,
) -> DataFrame:
    """Valid and outlying cells per value of each grouping column, from one pass.

    Each row carries its own two counts, so no row is multiplied by the number of variables.
    """
    clean = inf_to_null(df, cols)
    bounds = tukey_bounds(clean, cols, k, guard, buffer_cells)
    valid = sum((col(c).isNotNull().cast("long") for c in cols), F.lit(0))
    hits = sum((_outside(col(c), *bounds[c][3:]).cast("long") for c in cols), F.lit(0))
    rows = clean.select(*[col(s).cast("string").alias(s) for s in sets], valid.alias("_v"), hits.alias("_o"))
    # combine to one row per combination of grouping values before the grouping sets expand it
    small = rows.groupBy(*sets).agg(F.sum("_v").alias("_v"), F.sum("_o").alias("_o"))
    grouped = small.groupingSets([[col(s)] for s in sets], *[col(s) for s in sets]).agg(
        F.sum("_v").alias("valid"), F.sum("_o").alias("outliers"),
        *[F.grouping(s).alias(f"_g_{s}") for s in sets],
    )
    dimension, group = F, F
    for s in sets:
        dimension = dimension.when(F.col(f"_g_{s}") == 0, s)
        group = group.when(F.col(f"_g_{s}") == 0, col(s))
    share = F.round(F.coalesce(F.try_divide(100.0 * F.col("outliers"), F.col("valid")), F.lit(0.0)), 6)
    return grouped.select(
        dimension.alias("dimension"), group.alias("grp"), "valid", "outliers", share.alias("outliers_pct")
    )


def peaks(series: DataFrame, c: str, time: str = "bucket") -> DataFrame:
    """Buckets at or above q3 + 1.5 iqr; the first largest one when none is.

    Needs at least three buckets and a positive maximum, else there is no peak.
    """
    x = col(c).cast("double")
    series = durable(series)  # one row per bucket; it is read several times
    stats = exact_quantiles(series, {c: x}, [0.25, 0.75])
    size = series.agg(F.count(x), F.max(x)).first()
    if size[0] < 3 or size[1] is None or size[1] <= 0:
        return series.limit(0)
    q1, q3 = stats[c]
    above = series.filter(x >= q3 + 1.5 * (q3 - q1))
    if above.isEmpty():
        return series.orderBy(x.desc(), time).limit(1)
    return above

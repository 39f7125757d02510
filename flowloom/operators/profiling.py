"""Counts, distributions and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.scalars import col
from ..plans.bounded import lookup_join
from ..plans.quantiles import BUFFER_CELLS, exact_quantiles, grouped_quantiles
from .cleaning import inf_to_null, is_infinite, is_missing, numeric_cols


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.coalesce(F.try_divide(100.0 * part, whole), F.lit(0.0)), digits)


def shape(df: DataFrame, by: str) -> DataFrame:
    """Rows, columns and numeric columns per source."""
    cols = [c for c in df.columns if c != by]
    numeric = [c for c in numeric_cols(df) if c != by]
    return df.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.lit(len(cols)).cast("long").alias("n_columns"),
        F.lit(len(numeric)).cast("long").alias("n_numeric"),
    )


def null_profile(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """Missing, infinite and zero cells per column (and group), in one aggregate over one scan."""
    kinds = {
        "missing": lambda n: is_missing(df, n),
        "infinite": lambda n: is_infinite(col(n)),
        "zeros": lambda n: col(n) == 0,
    }
    numeric = set(numeric_cols(df))
    counts = []
    for i, name in enumerate(cols):
        fields = []
        for kind, test in kinds.items():
            known = kind == "missing" or name in numeric
            fields.append((F.count_if(test(name)) if known else F.lit(0).cast("long")).alias(kind))
        counts.append(F.struct(F.lit(name).alias("variable"), *fields).alias(f"c{i}"))
    keys = [by] if by else []
    wide = df.groupBy(*keys).agg(*counts)
    cells = F.explode(F.array(*[F.col(f"c{i}") for i in range(len(cols))])).alias("c")
    return wide.select(*keys, cells).select(*keys, "c.*")


def quality_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Infinite and missing cells per column with their sum, worst column first."""
    return (
        null_profile(df, cols)
        .select("variable", "infinite", "missing", (F.col("infinite") + F.col("missing")).alias("to_treat"))
        .orderBy(F.desc("to_treat"), "variable")
    )


def class_distribution(df: DataFrame, label: str, by: str | None = None, digits: int = 6) -> DataFrame:
    """Rows per class with their percentage of the whole, or of each group."""
    counted = df.groupBy(*([by] if by else []), label).agg(F.count("*").alias("n"))
    # the window runs over the counts, one row per class, so the source is read once
    whole = F.sum("n").over(Window.partitionBy(by if by else F.lit(0)))
    shares = counted.withColumn("pct", percent(F.col("n"), whole, digits))
    return shares if by else shares.orderBy(F.desc("n"), label)


def merge_distributions(partials: DataFrame, label: str, n: str = "n", digits: int = 6) -> DataFrame:
    """Global distribution from per-source counts."""
    merged = partials.groupBy(label).agg(F.sum(n).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # one row per class
    return merged.withColumn("pct", percent(F.col("n"), total, digits)).orderBy(F.desc("n"), label)


def quality_report(df: DataFrame, by: str, label: str, benign: str = "BENIGN") -> DataFrame:
    """Per source: rows, classes, missing, infinite, duplicates, benign and attack rows, with rates.

    Equal rows are combined first; everything else is then a sum over the combined rows weighted by
    their count, so one shuffle of the data serves all measures.
    """
    cols = [c for c in df.columns if c != by]
    numeric = [c for c in numeric_cols(df) if c != by]
    missing = sum((is_missing(df, c).cast("long") for c in cols), F.lit(0))
    infinite = sum((is_infinite(col(c)).cast("long") for c in numeric), F.lit(0))
    groups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    weight = lambda c: F.sum(c * F.col("_n"))
    is_benign_row = (F.upper(col(label)) == benign).cast("long")
    report = groups.groupBy(by).agg(
        F.sum("_n").alias("rows"),
        weight(missing).alias("missing"),
        weight(infinite).alias("infinite"),
        F.sum(F.col("_n") - 1).alias("duplicates"),
        F.coalesce(weight(is_benign_row), F.lit(0)).alias("benign"),
        F.count_distinct(col(label)).alias("classes"),
    )
    n_cols, n_numeric = F.lit(len(cols)).cast("long"), F.lit(len(numeric)).cast("long")
    rows, attacks = F.col("rows"), F.col("rows") - F.col("benign")
    return report.select(
        by, "rows", n_cols.alias("n_columns"), n_numeric.alias("n_numeric"), "classes",
        "missing", percent(F.col("missing"), rows * n_cols, 6).alias("missing_pct"),
        "infinite", percent(F.col("infinite"), rows * F.greatest(n_numeric, F.lit(1)), 6).alias("infinite_pct"),
        "duplicates", percent(F.col("duplicates"), rows, 4).alias("duplicates_pct"),
        "benign", attacks.alias("attacks"), percent(attacks, rows, 4).alias("attacks_pct"),
    )


def global_summary(report: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Totals over a quality report; class count from the distinct labels when given."""
    totals = report.agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"), F.max("n_columns").alias("n_columns"),
        F.sum("missing").alias("missing"), F.sum("infinite").alias("infinite"),
        F.sum("duplicates").alias("duplicates"), F.sum("benign").alias("benign"),
        F.sum("attacks").alias("attacks"),
    )
    if classes is not None:
        totals = totals.withColumn("classes", classes.distinct().agg(F.count("*")).scalar())
    return totals.withColumns(
        {
            "benign_pct": percent(F.col("benign"), F.col("rows"), 4),
            "attacks_pct": percent(F.col("attacks"), F.col("rows"), 4),
        }
    )


def imbalance(dist: DataFrame, label: str = "label", n: str = "n", digits: int = 2) -> DataFrame:
    """Largest and smallest class and their ratio; ties go to the first label."""
    largest = F.min(F.struct((-F.col(n)).alias("k"), col(label).alias("label"), F.col(n).alias("n")))
    smallest = F.min(F.struct(F.col(n).alias("k"), col(label).alias("label"), F.col(n).alias("n")))
    ends = dist.agg(largest.alias("a"), smallest.alias("b"))
    return ends.select(
        F.col("a.label").alias("majority"), F.col("a.n").alias("majority_n"),
        F.col("b.label").alias("minority"), F.col("b.n").alias("minority_n"),
        F.round(F.col("a.n") / F.greatest(F.col("b.n"), F.lit(1)), digits).alias("ratio"),
    )


def attack_split(df: DataFrame, by: str, attack: Column) -> DataFrame:
    """Benign and attack share of every source in percent."""
    hits, rows = F.count_if(attack), F.count("*")
    return df.groupBy(by).agg(
        percent(rows - hits, rows, 4).alias("benign_pct"), percent(hits, rows, 4).alias("attack_pct")
    )


def presence_pivot(df: DataFrame, row: str, column: str, values: list | None = None) -> DataFrame:
    """Counts of ``row`` by ``column`` value, zeros filled, with log10(n + 1) beside.

    Without ``values`` every value in the data gets its columns: sources are few, as each is a column.
    """
    if values is None:
        found = df.select(col(column).alias("v")).distinct().filter("v is not null").orderBy("v")
        values = [r["v"] for r in found.collect()]
    names = [str(v) for v in values]
    table = df.groupBy(row).agg(
        *[F.count_if(col(column) == F.lit(v)).alias(f"n_{s}") for v, s in zip(values, names)]
    )
    logs = [F.round(F.log10(col(f"n_{s}") + 1), 6).alias(f"log_{s}") for s in names]
    return table.select(row, *[col(f"n_{s}") for s in names], *logs)


def distinct_counts(df: DataFrame, cols: list[str], by: str, approx: bool = False) -> DataFrame:
    """Distinct non-null values per (group, column). Exact: values are hashed over all tasks."""
    if approx:
        wide = df.groupBy(by).agg(*[F.approx_count_distinct(col(c)).alias(c) for c in cols])
        return wide.unpivot([by], [col(c) for c in cols], "variable", "distinct_values")
    cells = melt_text(df, [by], cols).filter(F.col("value").isNotNull())
    return (
        cells.groupBy(by, "variable", "value").agg(F.lit(1).alias("_one"))
        .groupBy(by, "variable").agg(F.count("*").alias("distinct_values"))
    )


def melt_text(df: DataFrame, ids: list[str], cols: list[str]) -> DataFrame:
    """Melt columns of mixed types; numbers stay numbers when all columns are numeric."""
    if all(isinstance(df.schema[c].dataType, T.NumericType) for c in cols):
        cast = "double"
    else:
        cast = "string"
    casted = df.select(*[col(i) for i in ids], *[col(c).cast(cast).alias(c) for c in cols])
    return casted.unpivot([col(i) for i in ids], [col(c) for c in cols], "variable", "value")


def variable_profile(
    df: DataFrame, cols: list[str], by: str, approx: bool = False, buffer_cells: int = BUFFER_CELLS
) -> DataFrame:
    """Per source and variable: type, missing, infinite, zeros, median, distinct values."""
    counts = null_profile(df, cols, by)
    clean = inf_to_null(df, cols)
    numeric = [c for c in cols if c in set(numeric_cols(df))]
    medians = grouped_quantiles(clean, by, {c: col(c).cast("double") for c in numeric}, [0.5], "q", buffer_cells)
    medians = medians.select(by, "variable", F.col("q")[0].alias("median"))
    distinct = distinct_counts(df, cols, by, approx)
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in types.items() for x in kv]), F.col("variable"))
    keys = [by, "variable"]
    joined = lookup_join(lookup_join(counts, medians, keys, null_safe=True), distinct, keys, null_safe=True)
    return joined.select(
        by, "variable", kind.alias("type"), "missing", "infinite", "zeros",
        F.round("median", 6).alias("median"),
        F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
    )


def describe(df: DataFrame, cols: list[str], buffer_cells: int = BUFFER_CELLS, digits: int = 6) -> DataFrame:
    """Count, mean, deviation, extremes, exact quartiles, zeros and missing cells per column."""
    clean = inf_to_null(df, cols)
    value = {c: col(c).cast("double") for c in cols}
    quartiles = exact_quantiles(clean, value, [0.25, 0.5, 0.75], buffer_cells)
    stats = []
    for c in cols:
        q = [F.lit(x).cast("double") for x in quartiles[c]]
        v = value[c]
        stats.append(
            F.struct(
                F.lit(c).alias("variable"), F.count(v).alias("n"), F.round(F.avg(v), digits).alias("mean"),
                F.round(F.stddev_samp(v), digits).alias("std"), F.min(v).alias("min"),
                F.round(q[0], 6).alias("q1"), F.round(q[1], 6).alias("median"), F.round(q[2], 6).alias("q3"),
                F.max(v).alias("max"), F.count_if(v == 0).alias("zeros"),
                percent(F.count_if(v == 0), F.count("*"), 4).alias("zeros_pct"),
                F.count_if(v.isNull()).alias("missing"),
            )
        )
    wide = clean.agg(*[s.alias(f"s{i}") for i, s in enumerate(stats)])
    cells = F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")
    return wide.select(cells).select("s.*")

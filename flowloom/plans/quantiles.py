"""Exact interpolated quantiles of many columns and groups in a fixed number of scans."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .bounded import lookup_join
from .checkpoints import durable

# Cells that one aggregate may hold; beyond them ranks are found by sketches and a range shuffle.
BUFFER_CELLS = 8_000_000
# Size of a sketch, and the share of a column's values on either side of a rank that its bracket takes.
SKETCH, SLACK = 1024, 0.01
# Columns whose sketches or counts share one scan.
COLUMNS = 40


def exact_quantiles(
    df: DataFrame, values: dict[str, Column], probs: list[float], buffer_cells: int = BUFFER_CELLS
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of each expression; nulls and NaN are skipped.

    Few cells: one ``percentile`` aggregate. More: ``ranked_quantiles`` over one group.
    """
    names, clean = list(values), _clean(values)
    if df.count() * len(names) <= buffer_cells:
        row = df.agg(*[F.percentile(v, F.array(*map(F.lit, probs))).alias(f"p{i}") for i, v in enumerate(clean)]).first()
        return {n: list(row[i]) if row[i] is not None else [None] * len(probs) for i, n in enumerate(names)}
    found = {r["variable"]: list(r["q"]) for r in ranked_quantiles(df, None, values, probs).where("q is not null").collect()}
    return {n: found.get(n, [None] * len(probs)) for n in names}


def grouped_quantiles(
    df: DataFrame, by: str, values: dict[str, Column], probs: list[float], name: str = "q",
    buffer_cells: int = BUFFER_CELLS,
) -> DataFrame:
    """One row per (group, variable) with an array of exact quantiles, null where a group has no value."""
    names, clean = list(values), _clean(values)
    if df.count() * len(names) > buffer_cells:
        return ranked_quantiles(df, by, values, probs, name)
    percent = F.array(*map(F.lit, probs))
    wide = df.groupBy(by).agg(*[F.percentile(v, percent).alias(n) for n, v in zip(names, clean)])
    return wide.unpivot([by], names, "variable", name)


def _clean(values: dict[str, Column]) -> list[Column]:
    cast = [v.cast("double") for v in values.values()]
    return [F.when(~F.isnan(v), v) for v in cast]


def ranked_quantiles(df: DataFrame, by: str | None, values: dict[str, Column], probs: list[float], name: str = "q") -> DataFrame:
    """Exact quantiles of every column in every group of ``by``, from scans whose number is fixed.

    1. Mergeable sketches and counts of all (group, column) pairs bracket each wanted rank.
    2. One counting aggregate proves the brackets; one that misses its rank becomes the whole line.
    3. The values inside the brackets are counted by value, dealt to ranges of (group, column, value),
       and the ranges' sums tell in which of them, and where, each rank lies.

    Scans 1 and 2 take ``COLUMNS`` columns at a time. Nothing is collected and the plan does not grow
    with the groups: sketches, brackets and counts are tables keyed by group, which meet the rows in a
    size-checked join. A group or value of any size is many ranges, so no task holds one.
    """
    names = list(values)
    group = F.struct((F.col(by) if by is not None else F.lit(0)).alias("k"))  # structs of null are equal
    rows = df.select(group.alias("g"), *[v.alias(f"v{i}") for i, v in enumerate(_clean(values))])
    chunks = [range(at, min(at + COLUMNS, len(names))) for at in range(0, len(names), COLUMNS)]
    sketches = durable(_long(rows, chunks, _sketch))
    brackets = sketches.select("g", "i", "n", *_brackets(probs))
    counts = durable(_long(_with(rows, brackets), chunks, lambda i: _count(i, len(probs))))
    proven = durable(_proven(brackets, counts, probs))
    inside = _inside(_with(rows, proven), len(names), len(probs))
    found = _at_ranks(inside, _ranks(proven, probs))
    ends = found.groupBy("g", "i", "j").agg(*[F.max(F.when(F.col("side") == s, F.col("x"))).alias(f"x{s}") for s in (0, 1)])
    at = _element(F.array(*[F.lit(p) for p in probs]), F.col("j")) * (F.col("n") - 1)
    value = F.col("x0") + (F.col("x1") - F.col("x0")) * (at - F.floor(at))
    answers = ends.join(proven.select("g", "i", "n"), ["g", "i"]).groupBy("g", "i").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", value.alias("q")))), lambda e: e["q"]).alias(name)
    )
    out = sketches.select("g", "i").join(answers, ["g", "i"], "left")
    variable = _element(F.array(*map(F.lit, names)), F.col("i")).alias("variable")
    return out.select(*([F.col("g.k").alias(by)] if by is not None else []), variable, name)


def _element(array: Column, at: Column) -> Column:
    return F.element_at(array, (at + 1).cast("int"))


def _long(rows: DataFrame, chunks: list[range], cell) -> DataFrame:
    """The aggregate ``cell`` of each column: one row a group and column, ``g``, ``i`` and its fields."""
    parts = []
    for chunk in chunks:
        wide = rows.groupBy("g").agg(*[cell(i).alias(f"c{i}") for i in chunk])
        parts.append(wide.select("g", F.explode(F.array(*[F.col(f"c{i}") for i in chunk])).alias("c")).select("g", "c.*"))
    return reduce(DataFrame.union, parts)


def _sketch(i: int) -> Column:
    v = F.col(f"v{i}")
    return F.struct(F.lit(i).alias("i"), F.count(v).alias("n"), F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("sketch"))


def _brackets(probs: list[float]) -> tuple[Column, Column]:
    """``low`` and ``high`` of each wanted rank; groups too small for the slack are taken whole."""
    small = F.col("n") * SLACK < 2

    def end(p: float, open_: bool, value: float) -> Column:
        guess = F.lit(value) if open_ else F.kll_sketch_get_quantile_double("sketch", F.lit(p))
        return F.when(F.col("n") == 0, F.lit(None).cast("double")).when(small, F.lit(value)).otherwise(guess)

    low = F.array(*[end(p - SLACK, p - SLACK <= 0, -math.inf) for p in probs])
    high = F.array(*[end(p + SLACK, p + SLACK >= 1, math.inf) for p in probs])
    return low.alias("low"), high.alias("high")


def _with(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """Rows next to their group's brackets: ``b``, a map from the column to ``low`` and ``high``."""
    entry = F.struct("i", F.struct("low", "high"))
    return lookup_join(rows, brackets.groupBy("g").agg(F.map_from_entries(F.collect_list(entry)).alias("b")), ["g"], "inner")


def _bounds(i: int, j: int) -> tuple[Column, Column]:
    return F.col("b")[i]["low"][j], F.col("b")[i]["high"][j]


def _count(i: int, n_probs: int) -> Column:
    v, pairs = F.col(f"v{i}"), [_bounds(i, j) for j in range(n_probs)]
    below = F.array(*[F.count_if(v < low) for low, _ in pairs])
    inside = F.array(*[F.count_if(v.between(low, high)) for low, high in pairs])
    return F.struct(F.lit(i).alias("i"), below.alias("below"), inside.alias("inside"))


def _proven(brackets: DataFrame, counts: DataFrame, probs: list[float]) -> DataFrame:
    """Brackets that hold their ranks, with the number of values ``below``; the others take the whole line."""
    met = brackets.join(counts, ["g", "i"])
    fields = {"low": [], "high": [], "below": []}
    for j, p in enumerate(probs):
        at = F.lit(p) * (F.col("n") - 1)
        below = F.col("below")[j]
        holds = (F.floor(at) >= below) & (F.ceil(at) < below + F.col("inside")[j])
        fields["low"].append(F.when(holds, F.col("low")[j]).otherwise(F.lit(-math.inf)))
        fields["high"].append(F.when(holds, F.col("high")[j]).otherwise(F.lit(math.inf)))
        fields["below"].append(F.when(holds, below).otherwise(0))
    return met.where("n > 0").select("g", "i", "n", *[F.array(*v).alias(k) for k, v in fields.items()])


def _ranks(proven: DataFrame, probs: list[float]) -> DataFrame:
    """``g``, ``i``, ``j``, ``side``, ``want``: the two ranks around each quantile, from 0 inside its bracket."""
    cells = []
    for j, p in enumerate(probs):
        at = F.lit(p) * (F.col("n") - 1)
        for side, rank in enumerate((F.floor(at), F.ceil(at))):
            cells.append(F.struct(F.lit(j).alias("j"), F.lit(side).alias("side"), (rank - F.col("below")[j]).alias("want")))
    return proven.select("g", "i", F.explode(F.array(*cells)).alias("c")).select("g", "i", "c.*")


def _inside(rows: DataFrame, n_names: int, n_probs: int) -> DataFrame:
    """``g``, ``i``, ``j``, ``x``, ``n``: how often each value occurs inside a bracket; counted before the shuffle."""
    cells = []
    for i in range(n_names):
        v = F.col(f"v{i}")
        for j in range(n_probs):
            low, high = _bounds(i, j)
            cells.append(F.when(v.between(low, high), F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), v.alias("x"))))
    each = rows.select("g", F.explode(F.array(*cells)).alias("c")).where("c is not null")
    return each.groupBy("g", "c.i", "c.j", "c.x").agg(F.count("*").alias("n"))


def _at_ranks(inside: DataFrame, ranks: DataFrame) -> DataFrame:
    """``x`` at each wanted rank. Ranges of the order are summed apart; only the range that holds a rank is ranked."""
    key, order = ["g", "i", "j"], ["g", "i", "j", "x"]
    ranges = durable(inside.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    sums = ranges.groupBy(*key, "part").agg(F.sum("n").alias("size"))
    upto = F.sum("size").over(Window.partitionBy(*key).orderBy("part"))
    starts = sums.withColumn("start", upto - F.col("size"))
    hit = ranks.join(starts, key).where("want >= start and want < start + size")
    hit = hit.select(*key, "side", "part", (F.col("want") - F.col("start")).alias("left"))
    rows = ranges.join(hit, [*key, "part"])
    seen = F.sum("n").over(Window.partitionBy(*key, "side", "part").orderBy("x"))
    return rows.withColumn("seen", seen).where("left < seen and left >= seen - n").select(*key, "side", "x")

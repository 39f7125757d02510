"""Mixing sources to target weights by weighted sampling without replacement.

A source gets a budget of words. A budget takes the whole source once for each complete epoch; the
fraction that is left is filled with documents in the order of Efraimidis-Spirakis keys, ``-ln(u) / w``
with ``u`` uniform from a hash of the row and ``w`` its quality weight, until the budget is reached.
All of it is DataFrame work, and what it decides is one row for each source: the number of epochs and
the last key that is taken. Texts are compared with that row where they lie.

The order inside a source is never one task's sort. The keys are cut into ranges, the sums of the
ranges are accumulated, and only the range in which the budget ends is cut again; the documents left
after the second cut, one in millions, are ordered. Windows over all sources hold a row for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import saved

WORDS = r"[^\x20\x09-\x0D]+"
#: Ranges for each unit of the key, and ranges into which each of these is cut again.
RANGES, FINER = 1024, 4096

#: Fixed values of the mix that the query asks for.
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_EPOCHS = 2


def quality_weight(size: Column, chars: Column) -> Column:
    """1, halved for texts under 50 words and halved for means outside of 4 to 9 characters a word."""
    short, odd = size < 50, (chars < 4 * size) | (chars > 9 * size)
    return F.when(short, 0.5).otherwise(1.0) * F.when(odd, 0.5).otherwise(1.0)


def measured(docs: DataFrame, seed: str, weight: Column | None = None) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``key``, ``tie`` and a number ``row`` of each row, next to the row itself as ``doc``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.regexp_count(text, F.lit(WORDS)).cast("long")
    rows = docs.select(
        F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), F.length(text).alias("chars"), F.md5(text.cast("binary")).alias("tie"),
        (weight if weight is not None else F.lit(None).cast("double")).alias("given"),
    )
    mark = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("tie")).cast("binary"))
    u = (F.conv(F.substring(mark, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    w = F.greatest(F.coalesce("given", quality_weight(F.col("size"), F.col("chars"))), F.lit(1e-3))
    return rows.withColumn("key", -F.log(u) / w).select("doc", "row", "doc_id", "source", "size", "key", "tie")


def budgets(sizes: DataFrame, weights: tuple[int, ...], share_percent: int, most_epochs: int) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row (``source``, ``source_size``) for each source.

    Sources in the order of their code points, null last, have the weights in turn. Together they get
    ``share_percent`` of all words, in proportion to the weights, none more than ``most_epochs`` times
    its own; what a full source cannot take goes to the others by weight. Filling the sources in the
    order of the level at which each is full gives the same as sharing again and again. The windows
    run over one row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    rows = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    rows = rows.withColumn("cap", (F.lit(most_epochs) * F.col("source_size")).cast("double"))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything).cast("double") * share_percent / 100
    full, gone = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.coalesce(F.sum("w").over(before), F.lit(0.0))
    rows = rows.withColumn("level", (total - full) / (F.sum("w").over(everything) - gone))
    is_open = F.col("level") * F.col("w") <= F.col("cap")
    level = F.min(F.when(is_open, F.struct((F.col("cap") / F.col("w")).alias("at"), "level"))).over(everything)["level"]
    return rows.withColumn("common", level).select("source", "source_size", F.least("cap", F.coalesce(F.col("common") * F.col("w"), F.col("cap"))).alias("target"))


def _coarse() -> Column:
    return F.floor(F.col("key") * RANGES)


def _fine() -> Column:
    return F.floor((F.col("key") * RANGES - _coarse()) * FINER)


def _end(rows: DataFrame, left: DataFrame, place: Column, name: str) -> DataFrame:
    """``left`` with the range ``name`` in which each source's budget ends and what is left for it there."""
    sums = rows.groupBy("source", place.alias("place")).agg(F.sum("size").alias("size"))
    sums = sums.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("place"))).withColumnRenamed("source", "s")
    met = left.join(sums, F.col("source").eqNullSafe(F.col("s"))).where("upto > left").groupBy("s")
    ends = met.agg(F.min(F.struct("place", (F.col("left") - F.col("upto") + F.col("size")).alias("left"))).alias("end"))
    out = left.drop("left").join(ends, F.col("source").eqNullSafe(F.col("s")), "left").select(left.drop("left")["*"], F.col("end.place").alias(name), F.col("end.left").alias("left"))
    return saved(out, name)


def _of(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows next to their source's cut; a written table of a row a source, which Spark sends around if it is small."""
    other = cuts.withColumnRenamed("source", "s")
    return rows.join(other, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def cut_points(rows: DataFrame, weights: tuple[int, ...], share_percent: int, most_epochs: int) -> DataFrame:
    """One row a source: sizes, target, ``epochs``, and where the keys of the last, partial epoch end."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = budgets(sizes, weights, share_percent, most_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("epochs", epochs.cast("long")).withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
    cuts = _end(rows, saved(plan, "budgets"), _coarse(), "coarse")
    edge = saved(_of(rows, cuts.select("source", "coarse")).where(_coarse() == F.col("coarse")).drop("coarse"), "edge")
    cuts = _end(edge, cuts, _fine(), "fine")
    last = _of(edge, cuts.select("source", "fine", "left")).where(_fine() == F.col("fine"))
    # rows that tie are one line with their number, however many there are
    ties = last.groupBy("source", "key", "doc_id", "tie", "size", "left").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum(F.col("size") * F.col("n")).over(Window.partitionBy("source").orderBy("key", "doc_id", "tie")) - F.col("size") * F.col("n")
    fit = F.when(F.col("size") == 0, F.when(F.col("before") <= F.col("left"), F.col("n")).otherwise(0)).otherwise(F.floor((F.col("left") - F.col("before")) / F.col("size") + 0.5))
    taken = ties.withColumn("before", before).withColumn("most", F.least(fit, F.col("n"))).where("most > 0")
    ends = taken.groupBy(F.col("source").alias("s")).agg(F.max(F.struct("key", "doc_id", "tie", "most", "n")).alias("last"))
    cuts = saved(cuts.drop("left").join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "ends")
    return saved(_last_row(edge, cuts), "cuts")


def _tied(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """The rows of each source that tie with its last one, where not all of them are taken."""
    open_ = cuts.where("last.most < last.n").select("source", "last")
    same = (F.col("key") == F.col("last.key")) & F.col("doc_id").eqNullSafe(F.col("last.doc_id")) & (F.col("tie") == F.col("last.tie"))
    return _of(rows, open_).where(same).select("source", "row", "last")


def _last_row(edge: DataFrame, cuts: DataFrame) -> DataFrame:
    """``cuts`` with ``last_row``, the number of the last row that is taken among those that tie at the end.

    They are counted by the partition they were read from, and only one partition's are put in order.
    """
    tied = _tied(edge, cuts).withColumn("part", F.shiftright("row", 33))
    sums = tied.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.first("last.most").alias("most"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("part"))
    hit = sums.withColumn("upto", upto).where("upto >= most and upto - n < most").select(F.col("source").alias("s"), F.col("part").alias("p"), (F.col("most") - F.col("upto") + F.col("n")).alias("nth"))
    there = tied.join(hit, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    place = F.row_number().over(Window.partitionBy("source").orderBy("row"))
    found = there.withColumn("place", place).where(F.col("place") == F.col("nth")).select(F.col("source").alias("s"), F.col("row").alias("last_row"))
    return cuts.join(found, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def decided(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source's cut and ``copies``, the times that the mix holds the row."""
    inside = (_coarse() < F.col("coarse")) | ((_coarse() == F.col("coarse")) & (_fine() < F.col("fine")))
    order, end = F.struct("key", "doc_id", "tie"), F.struct("last.key", "last.doc_id", "last.tie")
    # among rows that tie with the last one, those read first are taken, as many as fit
    before = F.when(order == end, F.coalesce(F.col("row") <= F.col("last_row"), F.lit(True))).otherwise(order < end)
    at_end = (_coarse() == F.col("coarse")) & (_fine() == F.col("fine")) & F.col("last").isNotNull() & before
    return _of(rows, cuts).withColumn("copies", F.col("epochs") + F.when(inside | F.coalesce(at_end, F.lit(False)), 1).otherwise(0))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most_epochs: int = MOST_EPOCHS, seed: str = "mix", weight: Column | None = None
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` for each row of ``docs``.

    ``taken`` is the row's words times the times that the mix holds it. The taken words of a source
    miss its target by half of one document at most. Keys that tie go by id, then by text; of rows that
    repeat both as many are taken as fit. A null or blank text has size 0; a null source is a source.
    ``weight``, an expression over ``docs``, replaces the default quality weight; null takes that, and
    none is below 0.001. An empty table gives no rows, and the same input gives the same mix.
    """
    rows = saved(measured(docs.select("doc_id", "text", "source"), seed, weight).drop("doc"), "measured")
    cuts = cut_points(rows, weights, share_percent, most_epochs)
    return decided(rows, cuts).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most_epochs: int = MOST_EPOCHS, seed: str = "mix", weight: Column | None = None
) -> DataFrame:
    """The columns of ``docs``, each row as often as the mix holds it. Texts are not shuffled while there are few sources.

    ``docs`` are read twice. Where they are a written table, rows that repeat are numbered alike each time.
    """
    rows = measured(docs, seed, weight)
    cuts = cut_points(saved(rows.drop("doc"), "measured"), weights, share_percent, most_epochs)
    copies = decided(rows, cuts).where("copies > 0").select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return copies.select("doc.*")

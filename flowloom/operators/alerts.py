"""Figures over the alert register: counts, risk, KPIs, series, counters, bursts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import constants as K
from ..functions.labels import action_of, is_attack, is_benign, severity_of
from ..functions.scalars import col, occurrences, parse_number, parse_time, text
from ..plans.bounded import lookup_join
from .history import period_filter
from .profiling import percent

SEVERITIES = list(K.SEVERITY_PRIORITY)


def _units(df: DataFrame) -> Column:
    """Clipped occurrences of a row; a numeric column needs no parsing."""
    if "nombre" not in df.columns:
        return F.lit(1.0)
    if isinstance(df.schema["nombre"].dataType, T.NumericType):
        return F.greatest(F.coalesce(F.col("nombre").cast("double"), F.lit(1.0)), F.lit(0.0))
    return occurrences(F.col("nombre"))


def _sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0)).cast("long")


def weighted_count(df: DataFrame, c: str) -> DataFrame:
    """Occurrences per value, blanks named, largest first."""
    value = F.coalesce(F.nullif(col(c).cast("string"), F.lit("")), F.lit(K.UNDEFINED))
    return df.groupBy(value.alias("value")).agg(_sum(_units(df)).alias("n")).orderBy(F.desc("n"), "value")


def _per_severity(df: DataFrame) -> list[Column]:
    return [_sum(F.when(F.col("gravite") == s, _units(df))).alias(s) for s in SEVERITIES]


def by_severity(df: DataFrame) -> DataFrame:
    """Occurrences of the four severities, zeros included."""
    return df.agg(*_per_severity(df)).unpivot([], SEVERITIES, "gravite", "n")


def global_risk(df: DataFrame) -> DataFrame:
    """Level and score of the highest open severity with the open occurrences per severity."""
    active = df.filter(F.col("statut") != K.DONE).agg(*_per_severity(df))
    level, score = F, F
    for s in SEVERITIES:
        level = level.when(F.col(s) > 0, K.RISK[s][0])
        score = score.when(F.col(s) > 0, K.RISK[s][1])
    total = reduce(lambda a, b: a + b, [F.col(s) for s in SEVERITIES])
    return active.select(
        level.otherwise(K.NO_RISK[0]).alias("niveau"), score.otherwise(K.NO_RISK[1]).cast("long").alias("score"),
        total.alias("incidents_actifs"), *SEVERITIES,
    )


def history_kpis(df: DataFrame) -> DataFrame:
    """Register figures in one aggregate."""
    units = F.when(F.col("gravite").isin(SEVERITIES), _units(df))
    return df.agg(
        F.count("*").alias("total_alertes"),
        _sum(units).alias("attaques_detectees"),
        F.count_if(F.col("source") == "CSV").alias("alertes_csv"),
        F.count_if(F.col("source") == "Suricata").alias("alertes_suricata"),
        F.count_if(F.col("gravite") == "Critique").alias("alertes_critiques"),
        F.count_if(F.col("statut") == K.OPEN).alias("alertes_non_traitees"),
    )


def threat_split(df: DataFrame, c: str = "classe", k: int = 6) -> DataFrame:
    """Occurrences per attack class; beyond k + 1 classes the tail is one line."""
    totals = (
        df.filter(~is_benign(col(c))).groupBy(col(c).alias("classe"))
        .agg(F.coalesce(F.sum(_units(df)), F.lit(0.0)).alias("n")).filter("n > 0")
    )
    order = [F.desc("n"), F.asc("classe")]
    classes = totals.agg(F.count("*")).scalar()
    head = totals.orderBy(*order).limit(k + 1)
    ranked = head.withColumn("_r", F.row_number().over(Window.orderBy(*order)))  # k + 1 rows
    top = ranked.filter((F.col("_r") <= k) | (classes <= k + 1)).drop("_r")
    leaders = ranked.filter(F.col("_r") <= k).select("classe")  # at most k rows
    rest = totals.join(F.broadcast(leaders), "classe", "left_anti").agg(
        F.sum("n").alias("n"), F.count("*").alias("_c")
    )
    tail = rest.filter(F.col("_c") > 1).select(F.lit(K.OTHER_ATTACKS).alias("classe"), "n")
    return top.unionByName(tail)


def series_unit(df: DataFrame, ts: str) -> DataFrame:
    """One row: hour up to two days of data, day up to ninety, else week."""
    span = F.max(ts).cast("timestamp").cast("double") - F.min(ts).cast("timestamp").cast("double")
    day = 86_400.0
    return df.agg(F.when(span <= 2 * day, "hour").when(span <= 90 * day, "day").otherwise("week").alias("unit"))


def time_series(df: DataFrame, ts: str, n: Column, benign: Column) -> DataFrame:
    """Benign and malicious volume per bucket; weeks start on Monday."""
    unit = series_unit(df, ts).scalar()
    bucket = F.call_function("date_trunc", unit, F.col(ts).cast("timestamp")).alias("bucket")
    rows = df.filter(F.col(ts).isNotNull()).select(bucket, n.alias("n"), benign.alias("b"))
    return rows.groupBy("bucket").agg(
        F.sum(F.when(F.col("b"), F.col("n")).otherwise(0.0)).alias("benin"),
        F.sum(F.when(~F.col("b"), F.col("n")).otherwise(0.0)).alias("malveillant"),
    )


def sum_series(df: DataFrame, aliases: dict[str, list[str]] = K.SERIES_ALIASES) -> DataFrame:
    """Series delivered under any of the alias columns, summed per timestamp."""
    first = lambda role: F.coalesce(*[col(c).cast("string") for c in aliases[role] if c in df.columns], F.lit(None).cast("string"))
    number = lambda role: F.coalesce(parse_number(first(role)), F.lit(0.0))
    rows = df.select(
        parse_time(first("horodatage")).alias("bucket"), number("benin").alias("benin"),
        number("malveillant").alias("malveillant"),
    )
    return rows.filter("bucket is not null").groupBy("bucket").agg(
        F.sum("benin").alias("benin"), F.sum("malveillant").alias("malveillant")
    )


def dominant(df: DataFrame, cols: list[str], missing: str = "Non disponible") -> DataFrame:
    """Most frequent non-blank value of each column; ties go to the smallest value."""
    long = df.select(*[text(col(c)).alias(c) for c in cols]).unpivot([], cols, "variable", "value")
    counted = long.filter(F.trim("value") != "").groupBy("variable", "value").agg(F.count("*").alias("n"))
    best = counted.groupBy("variable").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("value"), F.max("n").alias("n")
    )
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    return lookup_join(names, best, ["variable"]).select(
        "variable", F.coalesce("value", F.lit(missing)).alias("value"), F.coalesce("n", F.lit(0)).alias("n")
    )


def treatment_counts(df: DataFrame) -> DataFrame:
    """Treated rows and both definitions of open ones."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("statut") == K.DONE).alias("traitees"),
        F.count_if(F.col("statut") != K.DONE).alias("a_traiter"),
        F.count_if(F.col("statut") == K.OPEN).alias("non_traitees"),
    )


def scoring_summary(df: DataFrame, label: str) -> DataFrame:
    """Attack classes of an upload with count, share of all flows, severity and action."""
    total = df.agg(F.count("*")).scalar()
    counted = df.filter(is_attack(col(label))).groupBy(col(label).alias("classe")).agg(F.count("*").alias("nombre"))
    return counted.select(
        "classe", "nombre", percent(F.col("nombre"), total, 4).alias("pourcentage"),
        severity_of(F.col("classe")).alias("gravite"), action_of(F.col("classe")).alias("action_recommandee"),
    ).orderBy(F.desc("nombre"), "classe")


def user_counters(runs: DataFrame) -> DataFrame:
    """Counters per user from a run log.

    Rows: user_id, run_at, source, flux, evenements, reset. A reset row sets only the flow counter
    back: flows at or before the user's last reset do not count. Runs are first combined per user
    and second, then the small reset table is looked up.
    """
    seconds = (
        runs.groupBy("user_id", F.col("run_at").cast("timestamp").alias("at"))
        .agg(
            F.count_if(~F.col("reset") & (F.col("source") == "CSV")).alias("csv"),
            F.count_if(~F.col("reset") & (F.col("source") == "Suricata")).alias("ids"),
            F.sum(F.when(~F.col("reset"), F.greatest("flux", F.lit(0))).otherwise(0)).alias("flux"),
            F.sum(F.when(~F.col("reset"), F.greatest("evenements", F.lit(0))).otherwise(0)).alias("evenements"),
            F.max(F.when(~F.col("reset"), F.col("source"))).alias("source"),
            F.max("reset").alias("reset"),
        )
    )
    resets = runs.filter("reset").groupBy("user_id").agg(F.max(F.col("run_at").cast("timestamp")).alias("reset_at"))
    joined = lookup_join(seconds, resets, ["user_id"])
    counts = F.col("reset_at").isNull() | (F.col("at") > F.col("reset_at"))
    real = F.col("source").isNotNull()
    return joined.groupBy("user_id").agg(
        F.sum("csv").alias("analyses_csv"),
        F.sum("ids").alias("analyses_suricata"),
        F.sum(F.when(counts, F.col("flux")).otherwise(0)).cast("long").alias("flux_reseau_analyses"),
        F.sum("evenements").cast("long").alias("evenements_ids_analyses"),
        F.max(F.when(real, F.col("at"))).alias("derniere_analyse"),
        F.max_by("source", F.when(real, F.col("at"))).alias("derniere_source"),
    )


def notification_summary(df: DataFrame) -> DataFrame:
    """Messages asked for, sent and failed."""
    asked = ~F.col("notification_email").isin("", "Non demandee")
    sent = F.col("notification_email") == "Envoyee"
    return df.agg(
        F.count_if(asked).alias("demandes"), F.count_if(sent).alias("envoyees"), F.count_if(asked & ~sent).alias("echecs")
    )


def failure_bursts(
    df: DataFrame, keys: list[str], ts: str, window_seconds: int = 300, threshold: int = 5, slot: int = 3600
) -> DataFrame:
    """Failures of the last ``window_seconds`` at every failure second of a key, and whether to block.

    Failures are counted per second first. Time is cut into slots that borrow the tail of the slot
    before, so a busy key is spread over slots and no window task sees more than slot + window rows.
    """
    at = F.unix_timestamp(F.col(ts).cast("timestamp"))
    seconds = df.select(*keys, at.alias("at_second")).groupBy(*keys, "at_second").agg(F.count("*").alias("n"))
    home = F.floor(F.col("at_second") / slot)
    lent = F.floor((F.col("at_second") + window_seconds) / slot)
    placed = seconds.withColumn("_home", home).withColumn("_slot", F.explode(F.sequence(home, lent)))
    window = Window.partitionBy(*keys, "_slot").orderBy("at_second").rangeBetween(-(window_seconds - 1), 0)
    counted = placed.withColumns(
        {"attempts": F.sum("n").over(window), "first_at": F.min("at_second").over(window)}
    ).filter(F.col("_home") == F.col("_slot"))
    left = window_seconds - (F.col("at_second") - F.col("first_at")) + 1
    blocked = F.col("attempts") >= threshold
    return counted.select(
        *keys, "at_second", "attempts", "first_at", blocked.alias("blocked"),
        F.when(blocked, F.greatest(F.lit(1), left)).otherwise(0).cast("long").alias("wait_seconds"),
    )


def period_kpis(prepared: DataFrame, delta: str | None, now: Column, counter: int = 0) -> DataFrame:
    """Malicious occurrences, alert rows and traffic volume of a period.

    Without benign traffic in the period (or without a period) the running counter is the volume.
    """
    rows = period_filter(prepared, "_date", delta, now)
    benign = _sum(F.when(F.col("_benin"), F.col("_occurrences")))
    malicious = _sum(F.when(~F.col("_benin"), F.col("_occurrences")))
    figures = rows.agg(malicious.alias("attaques"), F.count("*").alias("alertes"), benign.alias("benin"))
    own = F.col("benin") > 0 if delta is not None else F.lit(False)
    volume = F.when(own, F.col("benin") + F.col("attaques")).otherwise(F.lit(counter).cast("long"))
    return figures.select("attaques", "alertes", volume.alias("volume"))

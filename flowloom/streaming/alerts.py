"""Structured Streaming: IDS log to register, failure bursts, live series."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import constants as K
from ..operators.history import dedup_batch, new_only, normalize_alerts, to_history
from ..plans.bounded import lookup_join
from ..plans.checkpoints import durable
from ..sources.eve import parse_eve
from .tail import growing_lines

KEYS = ["user_id", "event_id"]
UNDATED = "1970-01-01"
# Default poll interval (seconds) and read size per poll (bytes).
POLL_SECONDS = 2.0
READ_BYTES = 4 * 1024 * 1024
# Error conditions of a folder in which nothing has been stored yet.
NOTHING_STORED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def start_marker(spark: SparkSession, path: str) -> str:
    """Time of the first start, written once; files older than this are never imported."""
    try:
        return spark.read.text(path).first()["value"]
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_STORED:
            raise
        now = spark.range(1).select(F.current_timestamp().cast("string").alias("value"))
        now.coalesce(1).write.text(path)
        return spark.read.text(path).first()["value"]


def log_lines(
    spark: SparkSession, path: str, max_bytes: int | None = None, start_at: str | None = None
) -> DataFrame:
    """New files of a rotated log folder, about ``max_bytes`` per trigger (4 MiB unless given).

    With ``start_at`` files last changed before that time are passed over.
    """
    lines = spark.readStream.option("maxBytesPerTrigger", str(int(READ_BYTES if max_bytes is None else max_bytes))).text(path)
    if start_at is not None:
        changed = F.col("_metadata.file_modification_time")
        lines = lines.filter(changed >= F.lit(start_at).cast("timestamp"))
    return lines.select("value")


def read_register(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame | None:
    """The stored register, or only the folders of some days; None when nothing is stored there."""
    reader = spark.read.option("basePath", path)
    try:
        if days is None:
            return reader.parquet(path)
        return reader.parquet(f"{path}/source=*/event_date={{{','.join(days)}}}")
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_STORED:
            raise
        return None


def _event_date() -> Column:
    """Day of the event's own time; alerts without a readable one share a partition."""
    return F.coalesce(F.substring("date", 1, 10).try_cast("date"), F.lit(UNDATED).cast("date"))


def unseen(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose (user, id) the register lacks.

    The id contains the event's time, so equal ids lie in one day's partition. The register is first
    reduced to the keys of the batch: their days prune its partitions, and no stored row that the
    batch does not name is shuffled when the keys are few enough to be sent around.
    """
    keys = [*KEYS, "event_date"]
    named = rows.filter(F.coalesce("event_id", F.lit("")) != "").select(*keys).distinct()
    return new_only(rows, stored.select(*keys).join(named, keys, "left_semi"), keys=["event_date", *KEYS])


def import_batch(batch: DataFrame, batch_id: int, history: str, metrics: str, user: str, name: str) -> None:
    """Append the unseen alerts of one micro-batch and record how many alerts it held.

    The partition day comes from the event, before a missing time is filled with the present one, so
    the same alert meets itself on whatever day it is read again. A repeated batch finds its own rows
    stored and adds nothing.
    """
    spark = batch.sparkSession
    events = normalize_alerts(parse_eve(batch), now=F.lit(None).cast("string"))
    rows = to_history(events, "Suricata", "eve.json (automatique)", user).withColumn("event_date", _event_date())
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    rows = rows.withColumn("date", F.coalesce("date", now)).persist()
    fresh = dedup_batch(rows, KEYS, ["date"])
    try:
        seen, newest = rows.agg(F.count("*"), F.max("date")).first()
        if seen:
            stored = read_register(spark, history)
            # its rows and its keys are both met with the register, so it is kept rather than shuffled twice
            new = fresh if stored is None else unseen(fresh.persist(), stored)
            new = new.withColumn("batch", F.lit(f"{name}-{batch_id}")).hint("rebalance", "event_date")
            new.write.mode("append").partitionBy("source", "event_date").parquet(history)
        line = spark.range(1, numPartitions=1).select(
            F.lit(seen).cast("long").alias("seen"), F.lit(newest).cast("string").alias("last_event_at"),
            F.current_timestamp().alias("last_scan_at"),
        )
        line.write.mode("overwrite").parquet(f"{metrics}/stream={name}/batch_id={batch_id}")
    finally:
        fresh.unpersist()
        rows.unpersist()


def alert_stream(
    spark: SparkSession, source: str, history: str, metrics: str, checkpoint: str, user: str,
    max_bytes: int | None = None, poll_seconds: float | None = None, from_start: bool = False,
    once: bool = False, growing: bool = False,
) -> StreamingQuery:
    """Follow a folder of IDS log files and keep the register deduplicated.

    Unless ``from_start``, files that were there before the first start are skipped. With ``growing``
    the log is one file, or a folder of some, to which lines are appended: what is there at the first
    start is skipped, and a file that was replaced is read from its start.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    if growing:
        lines = growing_lines(spark, source, max_bytes, from_start)
    else:
        start = None if from_start else start_marker(spark, f"{checkpoint.rstrip('/')}-start")
        lines = log_lines(spark, source, max_bytes, start)
    writer = (
        lines.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, i: import_batch(df, i, history, metrics, user, name))
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{POLL_SECONDS if poll_seconds is None else poll_seconds} seconds").start()


def _status_path(path: str) -> str:
    return f"{path.rstrip('/')}-status"


def store_status(updates: DataFrame, path: str, user: str, key: str = "event_id") -> None:
    """Append status changes (``key``, ``statut``, ``seq``) of the alerts of ``user`` beside the register.

    Nothing of the register is rewritten: the change with the highest ``seq`` of an alert counts when it
    is read. Other statuses and blank keys are passed over; alerts of other owners cannot be named.
    """
    named = updates.filter(F.col("statut").isin(K.OPEN, K.DONE) & (F.coalesce(F.col(key).cast("string"), F.lit("")) != ""))
    rows = named.select(F.lit(user).alias("user_id"), F.col(key).cast("string").alias("event_id"), "statut", "seq")
    _latest(rows).write.mode("append").parquet(_status_path(path))


def _latest(changes: DataFrame) -> DataFrame:
    """The last change of each alert; of two with one ``seq`` the larger status."""
    last = changes.groupBy(*KEYS).agg(F.max(F.struct("seq", "statut")).alias("_c"))
    return last.select(*KEYS, F.col("_c.statut").alias("statut"), F.col("_c.seq").alias("seq"))


def _changes(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(_status_path(path))
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_STORED:
            raise
        return None


def current_register(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame | None:
    """The stored register, or some days of it, with the last stored status of each alert."""
    stored, changes = read_register(spark, path, days), _changes(spark, path)
    if stored is None or changes is None:
        return stored
    last = _latest(changes).select(*KEYS, F.col("statut").alias("_new"))
    merged = lookup_join(stored, last, KEYS).withColumn("statut", F.coalesce("_new", "statut"))
    return merged.select(*stored.columns)


def compact_register(spark: SparkSession, path: str, days: list[str]) -> None:
    """Rewrite the small files of closed days with their status folded in; each day is replaced at once.

    The changes stay as one line an alert, so that an older change that is stored again still changes
    nothing. Call it while no status is being stored.
    """
    stored = current_register(spark, path, days)
    if stored is not None:
        whole = durable(stored).hint("rebalance", "event_date")
        writer = whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("source", "event_date").parquet(path)
    changes = _changes(spark, path)
    if changes is not None:
        durable(_latest(changes)).coalesce(max(1, changes.rdd.getNumPartitions() // 8)).write.mode("overwrite").parquet(_status_path(path))


def follow_totals(
    rows: DataFrame, partial: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Keep the partial totals of every micro-batch, one folder each.

    A repeated batch replaces its own folder. No row is dropped for being late and no window waits to
    be closed: totals are merged when they are read.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def burst_counts(events: DataFrame, keys: list[str], ts: str, size: str = "5 minutes", step: str = "1 minute") -> DataFrame:
    """Failures per key and sliding window in one micro-batch."""
    window = F.window(F.col(ts).cast("timestamp"), size, step)
    counted = events.groupBy(*keys, window.alias("window")).agg(F.count("*").alias("attempts"))
    return counted.select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "attempts")


def bursts(partials: DataFrame, keys: list[str], threshold: int = 5) -> DataFrame:
    """Windows in which a key failed at least ``threshold`` times, over all micro-batches."""
    merged = partials.groupBy(*keys, "start", "end").agg(F.sum("attempts").alias("attempts"))
    return merged.filter(F.col("attempts") >= threshold)


def series_totals(events: DataFrame, ts: str, n: Column, benign: Column, size: str = "1 hour") -> DataFrame:
    """Benign and malicious volume per tumbling window in one micro-batch."""
    rows = events.select(F.col(ts).cast("timestamp").alias("_at"), n.alias("n"), benign.alias("b"))
    totals = rows.groupBy(F.window("_at", size).alias("window")).agg(
        F.sum(F.when(F.col("b"), F.col("n")).otherwise(0.0)).alias("benin"),
        F.sum(F.when(~F.col("b"), F.col("n")).otherwise(0.0)).alias("malveillant"),
    )
    return totals.select(F.col("window.start").alias("bucket"), "benin", "malveillant")


def series(partials: DataFrame) -> DataFrame:
    """The live series, over all micro-batches."""
    return partials.groupBy("bucket").agg(F.sum("benin").alias("benin"), F.sum("malveillant").alias("malveillant"))


def write_stream(df: DataFrame, path: str, checkpoint: str, once: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """Append closed windows to files."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def monitor_status(spark: SparkSession, metrics: str, history: str) -> DataFrame:
    """One line per stream: imported and ignored alerts, last cycle, last event, last scan.

    Imported rows are counted in the register itself, so a repeated batch changes nothing.
    """
    lines = spark.read.parquet(metrics).withColumn("stream", F.col("stream").cast("string")).groupBy("stream").agg(
        F.sum("seen").alias("seen"), F.max("batch_id").alias("batch_id"),
        F.max("last_event_at").alias("last_event_at"), F.max("last_scan_at").alias("last_scan_at"),
    )
    stored = read_register(spark, history)
    if stored is None:
        stored = spark.createDataFrame([], "batch string")
    counts = stored.groupBy("batch").count().select(
        F.substring_index("batch", "-", 1).alias("stream"),
        F.substring_index("batch", "-", -1).cast("long").alias("batch_id"), F.col("count").alias("imported"),
    )
    totals = counts.groupBy("stream").agg(F.sum("imported").alias("imported"))
    latest = counts.select("stream", "batch_id", F.col("imported").alias("latest"))
    joined = lookup_join(lookup_join(lines, totals, ["stream"]), latest, ["stream", "batch_id"])
    imported = F.coalesce("imported", F.lit(0))
    return joined.select(
        "stream", imported.alias("alerts_imported_total"),
        (F.col("seen") - imported).alias("duplicates_ignored_total"),
        F.coalesce("latest", F.lit(0)).alias("new_alerts_last_cycle"), "last_event_at", "last_scan_at",
    )

"""Streaming operators, run to the end of the available files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import is_benign
from ..functions.scalars import occurrences
from ..operators.history import dedup_batch, normalize_alerts, to_history
from ..plans.checkpoints import scratch_path
from ..sources.eve import parse_eve
from ..streaming import alerts as live
from .alerts import IDS, NORMAL
from .inputs import ALERTS, REGISTER, log_lines, logs, register
from .registry import query, table

EVENTS = "event_id LONG, ts TIMESTAMP, user_id LONG, event_type STRING, value DOUBLE, props STRING"
PANEL = ["event_id", "classe", "gravite", "ip_source", "protocole", "statut"]


def _follow(spark, sf):
    """Write the log twice in several files, follow it, and follow it again from the checkpoint."""
    root = scratch_path(spark, "live")
    log_lines(spark, sf).repartition(4).write.text(f"{root}/log")
    lines = spark.read.text(f"{root}/log")  # the files that are there now
    args = (f"{root}/log", f"{root}/register", f"{root}/metrics", f"{root}/checkpoint", "u1")
    live.alert_stream(spark, *args, max_bytes=64 << 20, from_start=True, once=True).awaitTermination()
    lines.repartition(2).write.mode("append").text(f"{root}/log")
    live.alert_stream(spark, *args, max_bytes=64 << 20, from_start=True, once=True).awaitTermination()
    return root


@query("J1_eve_source", f"WITH {IDS} SELECT timestamp, signature FROM alerts")
def j1(spark, sf):
    root = scratch_path(spark, "source")
    log_lines(spark, sf).repartition(3).write.text(f"{root}/log")
    events = parse_eve(live.log_lines(spark, f"{root}/log")).filter("event_type = 'alert'")
    rows = events.select("timestamp", F.col("alert.signature").alias("signature"))
    live.write_stream(rows, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("J2_start_at_end", f"WITH {ALERTS} SELECT timestamp, proto FROM logs WHERE proto = 'UDP'")
def j2(spark, sf):
    """What is in the log at the first start is passed over, what is appended later is read."""
    root = scratch_path(spark, "start")
    lines = logs(spark, sf).select("proto", F.to_json(F.struct(*logs(spark, sf).columns)).alias("value"))

    def follow(proto):
        if proto:
            lines.filter(F.col("proto") == proto).select("value").repartition(2).write.mode("append").text(f"{root}/log")
        events = parse_eve(live.growing_lines(spark, f"{root}/log")).select("timestamp", "proto")
        live.write_stream(events, f"{root}/out", f"{root}/checkpoint").awaitTermination()

    follow("TCP")
    follow("UDP")
    return spark.read.parquet(f"{root}/out")


@query("J3_normalized_stream", f"WITH {NORMAL} SELECT event_id, classe, gravite FROM normal")
def j3(spark, sf):
    root = scratch_path(spark, "normal")
    log_lines(spark, sf).repartition(3).write.text(f"{root}/log")
    rows = normalize_alerts(parse_eve(live.log_lines(spark, f"{root}/log"))).select("event_id", "classe", "gravite")
    live.write_stream(rows, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


REGISTERED = f"""{NORMAL}, one AS (SELECT DISTINCT event_id, classe, gravite, ip_source, protocole, 'Non traitee' AS statut FROM normal)"""


@query("J4_exactly_once", f"WITH {REGISTERED} SELECT * FROM one")
def j4(spark, sf):
    return spark.read.parquet(f"{_follow(spark, sf)}/register").select(*PANEL)


@query("J5_register_equals_batch", f"WITH {REGISTERED} SELECT event_id, classe, 'stream' AS origin FROM one UNION ALL SELECT event_id, classe, 'batch' FROM one")
def j5(spark, sf):
    stored = spark.read.parquet(f"{_follow(spark, sf)}/register")
    rows = dedup_batch(to_history(normalize_alerts(logs(spark, sf)), "Suricata", "f", "u1"), live.KEYS, ["date"])
    return stored.select("event_id", "classe", F.lit("stream").alias("origin")).unionByName(
        rows.select("event_id", "classe", F.lit("batch").alias("origin")))


@query("J6_monitor_status", f"""WITH {REGISTERED}, lines AS (SELECT count(*) AS c, max(date) AS m FROM normal)
SELECT (SELECT count(*) FROM one) AS alerts_imported_total, 2 * c - (SELECT count(*) FROM one) AS duplicates_ignored_total, CAST(0 AS BIGINT) AS new_alerts_last_cycle, m AS last_event_at FROM lines""")
def j6(spark, sf):
    root = _follow(spark, sf)
    return live.monitor_status(spark, f"{root}/metrics", f"{root}/register").drop("last_scan_at", "stream")


def _event_files(spark, sf, n=4):
    root = scratch_path(spark, "events")
    ev = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.repartitionByRange(n, "ts").sortWithinPartitions("ts").write.parquet(f"{root}/in")
    return root


@query("J7_burst_stream", """WITH w AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * i AS s FROM events, (VALUES (0), (1)) t(i)),
c AS (SELECT event_type, s, count(*) AS attempts FROM w GROUP BY 1, 2)
SELECT event_type, CAST(s AS TIMESTAMP) AS start, s + INTERVAL 1 HOUR AS "end", attempts FROM c WHERE attempts >= 3""")
def j7(spark, sf):
    root = _event_files(spark, sf)
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    count = lambda batch: live.burst_counts(batch, ["event_type"], "ts", "1 hour", "30 minutes")
    live.follow_totals(events, count, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return live.bursts(spark.read.parquet(f"{root}/out"), ["event_type"], 3)


@query("J8_series_stream", f"""WITH {REGISTER} SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS bucket, sum(CASE WHEN benign THEN u ELSE 0 END) AS benin,
 sum(CASE WHEN benign THEN 0 ELSE u END) AS malveillant FROM units GROUP BY 1""")
def j8(spark, sf):
    root = scratch_path(spark, "series")
    rows = register(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartition(4, "event_id").write.parquet(f"{root}/in")  # no order in time: late rows count too
    events = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    total = lambda batch: live.series_totals(batch, "ts", occurrences(F.col("nombre")), is_benign(F.col("classe")))
    live.follow_totals(events, total, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return live.series(spark.read.parquet(f"{root}/out"))

"""The alert stream: replays, restarts, crashes, first start."""

import json
import os
import time

from pyspark.sql import functions as F

from flowloom.operators.history import dedup_batch, latest_alerts
from flowloom.sources.eve import parse_eve
from flowloom.streaming import alerts as live


def line(i, kind="alert", stamp="2026-08-09T02:25:01.000000+0100"):
    return json.dumps({"event_type": kind, "timestamp": stamp, "flow_id": i, "alert": {"signature": "LAB DDoS simulation", "severity": 1}})


def run(spark, root, **kw):
    args = (f"{root}/log", f"{root}/register", f"{root}/metrics", f"{root}/checkpoint", "u1")
    live.alert_stream(spark, *args, once=True, **kw).awaitTermination()


def put(root, name, lines):
    os.makedirs(f"{root}/log", exist_ok=True)
    with open(f"{root}/log/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def status(spark, root):
    row = live.monitor_status(spark, f"{root}/metrics", f"{root}/register").first()
    return row["alerts_imported_total"], row["duplicates_ignored_total"], row["new_alerts_last_cycle"]


def test_restart_and_duplicates(spark, tmp_path):
    root = str(tmp_path)
    put(root, "a.json", [line(1), line(1), line(2), line(3, "flow"), "{broken"])
    run(spark, root, from_start=True)
    assert status(spark, root) == (2, 1, 2)
    put(root, "b.json", [line(2), line(4), line(5, stamp="2026-08-10T00:00:00+0100"), line(6, stamp="soon")])
    run(spark, root, from_start=True)
    run(spark, root, from_start=True)
    stored = live.read_register(spark, f"{root}/register")
    assert stored.count() == 5 and stored.select("event_id").distinct().count() == 5
    assert status(spark, root) == (5, 2, 3)
    live.compact_register(spark, f"{root}/register", ["2026-08-09", "1970-01-01"])
    assert live.read_register(spark, f"{root}/register").count() == 5
    put(root, "c.json", [line(6, stamp="soon"), line(5, stamp="2026-08-10T00:00:00+0100")])
    run(spark, root, from_start=True)
    assert status(spark, root) == (5, 4, 0)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    batch = spark.createDataFrame([(line(i % 7),) for i in range(20)], "value string")
    for _ in range(2):
        live.import_batch(batch, 3, f"{root}/register", f"{root}/metrics", "u1", "s")
    assert live.read_register(spark, f"{root}/register").count() == 7
    assert status(spark, root) == (7, 13, 7)


def test_first_start_skips_old_files(spark, tmp_path):
    root = str(tmp_path)
    put(root, "old.json", [line(1)])
    past = time.time() - 3600
    os.utime(f"{root}/log/old.json", (past, past))
    run(spark, root)
    assert live.read_register(spark, f"{root}/register") is None
    time.sleep(1.1)
    put(root, "new.json", [line(2), line(3)])
    run(spark, root)
    assert live.read_register(spark, f"{root}/register").count() == 2


def test_an_alert_without_time_is_stored_once_on_any_day(spark, tmp_path):
    root = str(tmp_path)
    undated = spark.createDataFrame([(line(1, stamp=None),), (line(2),), (line(1, stamp=None),)], "value string")
    live.import_batch(undated, 0, f"{root}/register", f"{root}/metrics", "u1", "s")
    stored = live.read_register(spark, f"{root}/register")
    assert stored.count() == 2 and stored.filter("event_date = '1970-01-01'").filter("date is not null").count() == 1
    # read again after midnight: the row that is stored carries another day as its date
    moved = stored.withColumn("date", F.lit("2001-01-01 00:00:00"))
    moved.write.partitionBy("source", "event_date").parquet(f"{root}/yesterday")
    live.import_batch(undated, 7, f"{root}/yesterday", f"{root}/metrics", "u1", "s")
    assert live.read_register(spark, f"{root}/yesterday").count() == 2
    live.import_batch(undated, 8, f"{root}/yesterday", f"{root}/metrics", "u2", "s")
    assert live.read_register(spark, f"{root}/yesterday").count() == 4


def test_copies_that_differ_give_the_same_row_in_any_order(spark):
    rows = [("u", "1", "d", "Moyenne"), ("u", "1", "d", "Critique"), ("u", "", "d", "x"), ("u", "", "d", "x")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "user_id string, event_id string, date string, gravite string")
        got = dedup_batch(df, live.KEYS, ["date"]).orderBy("gravite").collect()
        assert [r.gravite for r in got] == ["Critique", "x", "x"]


def test_windows_keep_late_rows_and_the_last_window(spark, tmp_path):
    root = str(tmp_path)
    day = lambda h: f"2026-08-0{1 + h // 24} {h % 24:02d}:10:00"
    for part, hours in enumerate(([40, 41], [1, 1, 1], [40, 1])):
        spark.createDataFrame([("k", day(h)) for h in hours], "k string, ts string").coalesce(1).write.mode("append").parquet(f"{root}/in")
    events = spark.readStream.schema("k string, ts string").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    count = lambda batch: live.burst_counts(batch, ["k"], "ts", "1 hour", "1 hour")
    for _ in range(2):
        live.follow_totals(events, count, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    got = live.bursts(spark.read.parquet(f"{root}/out"), ["k"], 1).orderBy("start").collect()
    assert [(str(r.start), r.attempts) for r in got] == [("2026-08-01 01:00:00", 4), ("2026-08-02 16:00:00", 2), ("2026-08-02 17:00:00", 1)]


def test_latest_alerts_of_one_owner(spark):
    columns = "user_id string, event_id string, date string, classe string, gravite string, ip_source string, ip_destination string, protocole string, statut string"
    df = spark.createDataFrame([(f"u{i % 2}", str(i), f"2026-01-{i % 28 + 1:02d}", f"u{i % 2}", "", "", "", "", "") for i in range(60)], columns)
    assert latest_alerts(df, 50).count() == 50
    assert {r.classe for r in latest_alerts(df, 50, user="u1").collect()} == {"u1"}


def grown(spark, root, **options):
    lines = live.growing_lines(spark, f"{root}/log", **options)
    lines.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    return sorted(r.value for r in spark.read.schema("value string").parquet(f"{root}/out").collect())


def test_growing_log(spark, tmp_path):
    root = str(tmp_path)
    log = f"{root}/log/eve.json"
    os.makedirs(f"{root}/log")

    def append(text, mode="a"):
        with open(log, mode) as f:
            f.write(text)

    append("old 1\nold 2\nold ")
    assert grown(spark, root) == []  # what is there at the first start is passed over
    append("3\nnew é 1\nhalf")
    assert grown(spark, root) == ["new é 1", "old 3"]  # the half line waits
    assert grown(spark, root) == ["new é 1", "old 3"]
    append(" and whole\r\n\n")
    assert grown(spark, root) == ["", "half and whole", "new é 1", "old 3"]
    append("shrunk\n", "w")  # replaced by a shorter file: read from the start
    assert grown(spark, root)[-1] == "shrunk"
    append("another beginning that is longer than before\n" * 3, "w")
    assert grown(spark, root).count("another beginning that is longer than before") == 3


def test_growing_log_in_small_ranges(spark, tmp_path, monkeypatch):
    from flowloom.streaming import tail

    path = tmp_path / "log"
    lines = [f"line {i} " + "x" * (i % 37) for i in range(400)]
    path.write_text("\n".join(lines) + "\n")
    monkeypatch.setattr(tail, "RANGE_BYTES", 64)
    monkeypatch.setattr(tail, "TAIL_BYTES", 16)
    reader = tail.LogReader({"path": str(path), "from_start": "true", "max_bytes": "500"})
    offset, got, batches = reader.initialOffset(), [], 0
    while (end := reader.latestOffset()) != offset:
        for part in reader.partitions(offset, end):
            got += [v for b in reader.read(part) for v in b.column(0).to_pylist()]
        offset, batches = end, batches + 1
    assert got == lines and batches > 10


def test_stored_status_is_merged_on_reading(spark, tmp_path):
    root = str(tmp_path)
    path = f"{root}/register"
    assert live.current_register(spark, path) is None
    batch = spark.createDataFrame([(line(i, stamp=f"2026-08-{9 + i % 2:02d}T02:25:01+0000"),) for i in range(8)], "value string")
    for user in ("u1", "u2"):
        live.import_batch(batch, 1, path, f"{root}/metrics", user, user)
    ids = sorted({r["event_id"] for r in live.read_register(spark, path).select("event_id").collect()})
    files = set(os.listdir(path))

    def store(rows, user="u1"):
        live.store_status(spark.createDataFrame(rows, "event_id string, statut string, seq long"), path, user)

    def treated(**kw):
        return sorted((r["user_id"], ids.index(r["event_id"])) for r in live.current_register(spark, path, **kw).filter("statut = 'Traitee'").collect())

    first = [(ids[0], "Traitee", 1), (ids[1], "Traitee", 1), (ids[1], "Non traitee", 2), (ids[2], "Perdue", 9), ("unknown", "Traitee", 1), (None, "Traitee", 1), ("", "Traitee", 1)]
    store(first)
    assert treated() == [("u1", 0)] and set(os.listdir(path)) == files and live.read_register(spark, path).filter("statut = 'Traitee'").isEmpty()
    store([(ids[0], "Traitee", 1), (ids[3], "Traitee", 5)], "u2")
    want = [("u1", 0), ("u2", 0), ("u2", 3)]
    assert treated() == want
    live.compact_register(spark, path, ["2026-08-09", "2026-08-10"])
    assert sorted((r["user_id"], ids.index(r["event_id"])) for r in live.read_register(spark, path).filter("statut = 'Traitee'").collect()) == want
    store(first)  # a replay, also of the change that a later one undid
    store([(ids[1], "Traitee", 1)])
    assert treated() == want and live.current_register(spark, path).count() == 16
    store([(ids[0], "Non traitee", 7)])
    assert treated() == [("u2", 0), ("u2", 3)]
    assert {d for _, d in treated(days=["2026-08-09"])} <= {0, 3}


def test_a_line_is_parsed_once(spark):
    """Filters and columns that follow take the parsed event instead of parsing the line again."""
    lines = spark.createDataFrame([(line(1),), (line(2, "flow"),), ("{broken",), ("",), (" ",), (None,), ("null",)], "value string")
    alerts = parse_eve(lines).filter("event_type = 'alert' and flow_id is not null").select("flow_id", "alert.signature", "timestamp")
    plan = alerts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert [tuple(r) for r in alerts.collect()] == [("1", "LAB DDoS simulation", "2026-08-09T02:25:01.000000+0100")]


def test_a_batch_is_deduplicated_once(spark, tmp_path, monkeypatch):
    """Rows and keys that meet the register come from one deduplication, and nothing stays cached."""
    root, kept, real = str(tmp_path), [], live.unseen

    def watched(rows, stored):
        kept.append(rows.storageLevel.useMemory)
        return real(rows, stored)

    monkeypatch.setattr(live, "unseen", watched)
    for at in (1, 2):
        batch = spark.createDataFrame([(line(i % (5 * at)),) for i in range(30)], "value string")
        live.import_batch(batch, at, f"{root}/register", f"{root}/metrics", "u1", "s")
    assert kept == [True] and spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    assert live.read_register(spark, f"{root}/register").groupBy("event_id").count().filter("count = 1").count() == 10

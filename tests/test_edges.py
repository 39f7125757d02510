"""Literal edge rows with their expected results."""

import pytest
from pyspark.sql import functions as F

from flowloom.functions import labels, rules, scalars
from flowloom.operators import alerts, cleaning, evaluation, features, history, outliers, profiling, sampling

NAN, INF = float("nan"), float("inf")


def values(spark, rows, kind="string"):
    return spark.createDataFrame([(r,) for r in rows], f"v {kind}")


def apply(spark, rows, fn, kind="string"):
    indexed = spark.createDataFrame(list(enumerate(rows)), f"i int, v {kind}")
    return [r[1] for r in indexed.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_label_normalisers(spark):
    raw = ["Web Attack � XSS", "Web Attack – Sql Injection", "FTP-Patator", None, "DoS_Hulk", ""]
    assert apply(spark, raw, labels.normalize_label) == [
        "Web Attack - XSS", "Web Attack - SQL Injection", "FTP-Patator", "LABEL_MANQUANT", "DoS_Hulk", ""]
    assert apply(spark, raw, labels.normalize_label_v1)[:4] == [
        "Web Attack - XSS", "Web Attack - SQL Injection", "FTP - Patator", None]
    assert apply(spark, raw, labels.canonical_attack) == [
        "Web Attack - XSS", "Web Attack - SQL Injection", "FTP-Patator", "", "DoS Hulk", ""]
    assert apply(spark, ["web attack brute force sql injection xss"], labels.normalize_label) == ["Web Attack - XSS"]


def test_short_names(spark):
    names = ["Monday-WorkingHours.pcap_ISCX.csv", "Friday-WorkingHours-Afternoon-DDos.pcap_ISCX.csv", "other.file.csv"]
    assert apply(spark, names, labels.short_name) == ["Monday", "Fri-DDoS", "other.file"]
    assert apply(spark, names[:1], labels.slug) == ["monday_workinghours"]


def test_benign_keys(spark):
    assert apply(spark, ["benign", "Bénin", " normal ", "BENIGN flow", "DDoS", None], labels.is_benign) == [
        True, True, True, True, False, False]


def test_lenient_numbers(spark):
    raw = ["1,5", "", "nan", "abc", None, "inf", "-Infinity", "1e3", " 7 ", "1d"]
    assert apply(spark, raw, scalars.lenient_double) == [1.5, 0, 0, 0, 0, 0, 0, 1000, 7, 0]
    assert apply(spark, ["x", "-3", "", "4", None], scalars.occurrences) == [1, 0, 1, 4, 1]


def test_severity_lookup(spark):
    assert apply(spark, ["1", "2", "3", "9", "N/A", None, "1.0"], rules.ids_severity) == [
        "Critique", "Elevee", "Moyenne", "Faible", "Faible", "Faible", "Faible"]
    assert apply(spark, ["Foo", "", "hulk", None, "BENIGN"], labels.severity_of) == [
        "Moyenne", "Faible", "Critique", "Faible", "Faible"]
    assert apply(spark, ["Foo"], labels.action_of) == ["Analyser l'evenement et verifier les journaux"]


def test_masking(spark):
    assert apply(spark, ["user@site.org", "a@b", "", "abcd", "abcde", None, "@x"], scalars.mask_recipient) == [
        "us***@site.org", "a***@b", "", "****", "***bcde", "", "***@x"]


def test_flow_rules(spark):
    cols = "`Flow Packets/s` string, `Destination Port` string, `Total Fwd Packets` string, `Flow Duration` string"
    rows = [("150001", "1", "0", "9999"), ("0", "22", "16", "9999"), ("0", "21", "16", "9999"), ("0", "9", "4", "1999"),
            ("20001", "443", "5", "5000"), ("inf", "22", "15", "9999")]
    df = spark.createDataFrame(rows, cols)
    got = [r[0] for r in df.select(rules.rule_class(df)).collect()]
    assert got == ["DDoS", "SSH-Patator", "FTP-Patator", "PortScan", "DoS Hulk", "BENIGN"]
    typed = df.select(*[F.col(f"`{c}`").try_cast("double").alias(c) for c in df.columns])
    assert [r[0] for r in typed.select(rules.rule_class(typed)).collect()] == got


def test_ids_rules(spark):
    rows = [("LAB PortScan simulation", ""), ("LAB Brute Force simulation", "web"), ("ET DOS flood", ""), ("", "Denial of Service"),
            ("", ""), ("Notice", ""), ("x", "trojan activity")]
    df = spark.createDataFrame(rows, "s string, c string")
    got = [r[0] for r in df.select(rules.ids_class(F.col("s"), F.col("c"))).collect()]
    assert got == ["PortScan", "Web Attack - Brute Force", "DoS Hulk", "DoS Hulk", "Alerte Suricata", "Notice", "Bot"]


def test_special_numbers(spark):
    df = spark.createDataFrame([(x, "f") for x in (NAN, INF, -INF, None, -1.0)], "v double, source_file string")
    row = profiling.null_profile(df, ["v"]).first()
    assert (row["missing"], row["infinite"], row["zeros"]) == (2, 2, 0)
    assert [r[0] for r in cleaning.inf_to_null(df, ["v"]).select("v").collect()] == [None, None, None, None, -1.0]


def test_duplicates(spark):
    rows = [(1.0, None, "a"), (1.0, None, "a"), (1.0, None, "b"), (INF, 2.0, "a"), (None, 2.0, "a"), (-0.0, 1.0, "c"), (0.0, 1.0, "c")]
    df = spark.createDataFrame(rows, "x double, y double, source_file string")
    assert cleaning.dedup(df).count() == 5
    assert cleaning.dedup(cleaning.inf_to_null(df)).count() == 4
    counts = {r[0]: r[1] for r in cleaning.duplicate_count(df, "source_file").collect()}
    assert counts == {"a": 1, "b": 0, "c": 1}
    assert cleaning.dedup_summary(df).first().asDict() == {"before": 7, "removed": 2, "after": 5, "removed_pct": 28.5714}


def test_zero_iqr(spark):
    df = values(spark, [0.0] * 90 + [1.0] * 10, "double")
    guarded = outliers.iqr_outliers(df, ["v"]).first()
    assert (guarded["outliers"], guarded["low"], guarded["high"]) == (0, None, None)
    assert outliers.iqr_outliers(df, ["v"], guard=False).first()["outliers"] == 10


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    assert features.kept_columns(df, ["a", "b"]) == ["b"]
    scaled = features.apply_minmax(df, features.fit_minmax(df, ["a", "b"])).collect()
    assert [tuple(r) for r in scaled] == [(0.0, 0.0), (0.0, 1.0)]
    outside = features.apply_minmax(spark.createDataFrame([(6.0, 5.0)], "a double, b double"), features.fit_minmax(df, ["a", "b"]))
    assert tuple(outside.first()) == (1.0, 2.0)


def test_rare_class_folds(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 90)], "label string, n long")
    assert sampling.fold_count(sizes) == 2
    assert sampling.fold_count(sizes.filter("n > 1")) == 5
    assert sampling.fold_count(spark.createDataFrame([("a", 3)], "label string, n long")) == 3


def test_batch_ids(spark):
    schema = "user_id string, event_id string, date string"
    batch = spark.createDataFrame([("u", "a", "1"), ("u", "a", "2"), ("u", "b", "3"), ("v", "b", "4"), ("u", "", "5"), ("u", "", "6")], schema)
    stored = spark.createDataFrame([("u", "b", "0")], schema)
    keys = ["user_id", "event_id"]
    fresh = history.new_only(history.dedup_batch(batch, keys, ["date"]), stored, keys)
    assert sorted(tuple(r) for r in fresh.collect()) == [("u", "", "5"), ("u", "", "6"), ("u", "a", "1"), ("v", "b", "4")]


def test_risk(spark):
    schema = "gravite string, nombre string, statut string"
    df = spark.createDataFrame([("Elevee", "1", "Non traitee"), ("Critique", "4", "Traitee")], schema)
    row = alerts.global_risk(df).first()
    assert (row["niveau"], row["score"], row["incidents_actifs"]) == ("Eleve", 75, 1)
    empty = alerts.global_risk(df.limit(0)).first()
    assert (empty["niveau"], empty["score"], empty["incidents_actifs"]) == ("Maitrise", 0, 0)


def test_mixed_dates(spark):
    got = apply(spark, ["2026-08-09 02:25:01", "2026-08-09T02:25:01.123456+0100", "soon", ""],
                lambda c: scalars.parse_time(c).cast("string"))
    assert got == ["2026-08-09 02:25:01", "2026-08-09 01:25:01.123456", None, None]


@pytest.mark.parametrize(
    "series, expected",
    [([1, 1, 1, 1, 50], [1, 1, 1, 1, 50]), ([5, 5], []), ([1, 2, 3, 4, 5], [5]), ([0, 0, 0], [])],
)
def test_peaks(spark, series, expected):
    df = spark.createDataFrame(list(enumerate(series)), "bucket int, n long")
    assert sorted(r["n"] for r in outliers.peaks(df, "n").collect()) == expected


def test_threat_tail(spark):
    rows = [(f"c{i}", str(8 - i)) for i in range(8)] + [("Normal", "99"), ("zero", "0")]
    df = spark.createDataFrame(rows, "classe string, nombre string")
    got = {r["classe"]: r["n"] for r in alerts.threat_split(df).collect()}
    assert got == {"c0": 8, "c1": 7, "c2": 6, "c3": 5, "c4": 4, "c5": 3, "Autres attaques": 3}
    seven = alerts.threat_split(df.filter("classe <> 'c7'"))
    assert "Autres attaques" not in {r["classe"] for r in seven.collect()} and seven.count() == 7


def test_empty_confusion_row(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "y long, p long")
    matrix = evaluation.confusion(df, "y", "p", [0, 1, 2])
    shares = {r["y"]: tuple(r)[1:] for r in evaluation.confusion_shares(matrix).collect()}
    assert shares == {0: (0.5, 0.5, 0.0), 1: (0.0, 0.0, 0.0), 2: (0.0, 0.0, 0.0)}
    report = {r["classe"]: tuple(r)[1:] for r in evaluation.class_report(matrix, [0, 1, 2]).collect()}
    assert report["2"] == (0.0, 0.0, 0.0, 0) and report["accuracy"][2] == 0.5


def test_weekly_series(spark):
    rows = [("2024-01-03 10:00:00", 1.0, True), ("2024-01-07 23:00:00", 2.0, False), ("2024-05-01 00:00:00", 4.0, False)]
    df = spark.createDataFrame(rows, "d string, n double, b boolean").withColumn("ts", F.col("d").cast("timestamp"))
    got = sorted((str(r[0]), r[1], r[2]) for r in alerts.time_series(df, "ts", F.col("n"), F.col("b")).collect())
    assert got == [("2024-01-01 00:00:00", 1.0, 2.0), ("2024-04-29 00:00:00", 0.0, 4.0)]


def test_counter_reset_leaves_the_rest(spark):
    schema = "user_id string, run_at string, source string, flux long, evenements long, reset boolean"
    rows = [("a", "2024-01-01 00:00:00", "CSV", 6662856, 0, False), ("a", "2024-01-02 00:00:00", None, 0, 0, True),
            ("b", "2024-01-01 00:00:00", "CSV", 10, 0, False), ("a", "2024-01-01 12:00:00", "Suricata", 0, 7, False)]
    got = {r["user_id"]: r for r in alerts.user_counters(spark.createDataFrame(rows, schema)).collect()}
    assert got["a"]["flux_reseau_analyses"] == 0 and got["a"]["evenements_ids_analyses"] == 7
    assert got["a"]["analyses_csv"] == 1 and got["a"]["derniere_source"] == "Suricata"
    assert got["b"]["flux_reseau_analyses"] == 10


def test_fifth_failure_blocks(spark):
    rows = [("u", f"2024-01-01 00:59:{s:02d}") for s in (50, 52, 54, 56)] + [("u", "2024-01-01 01:00:10"), ("u", "2024-01-01 01:04:50")]
    got = alerts.failure_bursts(spark.createDataFrame(rows, "k string, ts string"), ["k"], "ts").orderBy("at_second").collect()
    assert [r["attempts"] for r in got] == [1, 2, 3, 4, 5, 5]
    assert [r["blocked"] for r in got] == [False] * 4 + [True] * 2


def test_series_from_aliases(spark):
    df = spark.createDataFrame([("2024-01-01", "3", "x"), ("2024-01-01", None, "2"), ("bad", "1", "1")], "date string, benign string, attaques string")
    assert tuple(alerts.sum_series(df).first())[1:] == (3.0, 2.0)


def test_column_difference():
    assert cleaning.column_difference(["a", "b"], ["b", "c"]) == (["a"], ["c"])

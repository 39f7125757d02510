"""Readers, header checks, sinks and the checked reload."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.constants import EXPECTED_FILES, FLOW_FEATURES
from flowloom.operators import history
from flowloom.sources import flows, sinks
from flowloom.sources.eve import read_eve
from flowloom.sources.schemas import FLOW_SCHEMA

HEADER = ", ".join([f" {c}".replace("Fwd Header Length.1", "Fwd Header Length") for c in FLOW_FEATURES] + [" Label"])


def write_flows(folder, name, rows, header=HEADER, encoding="utf-8"):
    path = folder / name
    path.write_bytes(("\n".join([header, *rows]) + "\n").encode(encoding))
    return path


def row(first, label, rate="2.5"):
    cells = [str(first)] + ["0"] * 77 + [label]
    cells[14] = rate
    return ",".join(cells)


def test_flow_files(spark, tmp_path):
    write_flows(tmp_path, EXPECTED_FILES[0], [row(80, "DDoS", "Infinity"), row(81, " BENIGN ", "NaN")])
    write_flows(tmp_path, EXPECTED_FILES[3], [row(53, "BENIGN", "")])
    df = flows.read_flows(spark, str(tmp_path))
    assert len(df.columns) == 80 and len(FLOW_SCHEMA) == 79
    got = sorted((r["Destination Port"], r["Label"], r["source_file"], str(r["Flow Bytes/s"])) for r in df.collect())
    assert got == [(53.0, "BENIGN", "Monday", "None"), (80.0, "DDoS", "Fri-DDoS", "inf"), (81.0, "BENIGN", "Fri-DDoS", "nan")]


def test_latin_fallback(spark, tmp_path):
    write_flows(tmp_path, "a b+1.csv", [row(1, "Attaque détectée")], encoding="latin-1")
    write_flows(tmp_path, "c.csv", [row(2, "Web Attack – XSS")])
    got = {r["Destination Port"]: (r["Label"], r["source_file"]) for r in flows.read_flows(spark, str(tmp_path), encoding=None).collect()}
    assert got == {1.0: ("Attaque détectée", "a b+1"), 2.0: ("Web Attack – XSS", "c")}
    assert "�" in flows.read_flows(spark, str(tmp_path)).filter("`Destination Port` = 1").first()["Label"]


def test_other_columns_raise(spark, tmp_path):
    schema = "x DOUBLE, y DOUBLE, `y.1` DOUBLE, Label STRING"
    (tmp_path / "a.csv").write_text('x, "y" ,y,Label\n1,2,3,B\n')
    parsed = T._parse_datatype_string(schema)
    assert flows.read_flows(spark, str(tmp_path), parsed).drop("source_file").collect() == [(1.0, 2.0, 3.0, "B")]
    (tmp_path / "b.csv").write_text("y,x,y,Label\n1,2,3,B\n")
    with pytest.raises(ValueError, match="b.csv"):
        flows.read_flows(spark, str(tmp_path), parsed)
    assert flows.read_flows(spark, str(tmp_path), parsed, check_headers=False).count() == 2
    (tmp_path / "b.csv").write_text("x,y,Label\n1,2,B\n")
    with pytest.raises(ValueError, match="b.csv"):
        flows.read_flows(spark, str(tmp_path), parsed)


def test_schema_and_inventory(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿ x, y ,Label\n1,2,B\n")
    (tmp_path / "b.csv").write_text("x,y,Label\n1,2,B\n")
    (tmp_path / "c.csv").write_text("y,x,Label")
    (tmp_path / "d.csv").write_text("x,z,Label\r\n1,2,B\r\n")
    got = {r["file"]: tuple(r)[1:] for r in flows.schema_check(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": (3, True, "", ""), "b.csv": (3, True, "", ""), "c.csv": (3, False, "", ""), "d.csv": (3, False, "y", "z")}
    inventory = flows.file_inventory(spark, str(tmp_path))
    assert [(r["n"], r["file"], r["short_name"]) for r in inventory.orderBy("n").collect()][0] == (1, "a.csv", "a")
    flows.assert_inputs(inventory, 4)
    flows.assert_inputs(inventory, ["a.csv", "d.csv"])
    with pytest.raises(ValueError):
        flows.assert_inputs(inventory, 8)
    with pytest.raises(FileNotFoundError, match="z.csv"):
        flows.assert_inputs(inventory, ["a.csv", "z.csv"])


def test_alert_log(spark, tmp_path):
    alert = {"event_type": "alert", "timestamp": "2026-08-09T02:25:01.1+0100", "flow_id": 12345678901234567, "src_port": 80,
             "alert": {"signature": "LAB DDoS simulation", "severity": 1, "category": "x"}}
    lines = [json.dumps(alert), "", "not json", '{"event_type": "flow"}', json.dumps(alert | {"alert": {}}), "   "]
    (tmp_path / "eve.json").write_text("\n".join(lines))
    events = read_eve(spark, str(tmp_path))
    assert events.count() == 3
    rows = history.normalize_alerts(events).orderBy("classe").collect()
    assert [(r["classe"], r["gravite"]) for r in rows] == [("Alerte Suricata", "Faible"), ("DDoS", "Critique")]
    assert rows[1]["date"] == alert["timestamp"] and len(rows[1]["event_id"]) == 64


def test_reload_checks(spark, tmp_path):
    df = spark.range(20).select("id", (F.col("id") % 2).alias("label"), F.when(F.col("id") < 14, "train").otherwise("test").alias("split"))
    sinks.write_dataset(df, str(tmp_path / "ok"))
    again = sinks.load_split(spark, str(tmp_path / "ok"))
    assert again.count() == 20 and dict(again.dtypes)["label"] == "int"
    sinks.write_dataset(df.filter("split = 'train'"), str(tmp_path / "half"))
    with pytest.raises(ValueError, match="train and a test"):
        sinks.load_split(spark, str(tmp_path / "half"))
    sinks.write_table_by(df.limit(3), str(tmp_path / "ok/csv"), "csv", ["split"])
    with pytest.raises(ValueError, match="row counts"):
        sinks.load_split(spark, str(tmp_path / "ok"))


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("1", "CSV", "Elevee", "Traitee"), ("2", "Suricata", "Faible", "Traitee")], "event_id string, source string, gravite string, statut string")
    out = history.export_register(df, source="CSV", path=str(tmp_path / "x"))
    assert out.columns == ["Moteur de détection", "Niveau de sévérité", "Statut de traitement"]
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "x")).collect()] == [("Moteur IA", "Élevée", "Traité")]

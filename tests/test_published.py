"""Formulas checked on published counts of the public intrusion dataset."""

import pytest
from pyspark.sql import functions as F

from flowloom.operators import evaluation, features, profiling, sampling

# Rows per class after cleaning and in the train part.
COUNTS = {
    "BENIGN": (2148386, 1503870), "Bot": (1953, 1367), "DDoS": (128016, 89611), "DoS GoldenEye": (10286, 7200),
    "DoS Hulk": (172849, 120994), "DoS Slowhttptest": (5228, 3660), "DoS slowloris": (5385, 3770), "FTP-Patator": (5933, 4153),
    "Heartbleed": (11, 8), "Infiltration": (36, 25), "PortScan": (90819, 63573), "SSH-Patator": (3219, 2253),
    "Web Attack - Brute Force": (1470, 1029), "Web Attack - SQL Injection": (21, 15), "Web Attack - XSS": (652, 456),
}


@pytest.fixture(scope="module")
def sizes(spark):
    return spark.createDataFrame([(c, a, t) for c, (a, t) in COUNTS.items()], "label string, n long, train long")


def test_train_quotas(sizes):
    quotas = sampling.train_quotas(sizes, "label", 0.3)
    assert quotas.filter("quota <> train").isEmpty()
    assert quotas.agg(F.sum("quota")).first()[0] == 1801984


def test_imbalance(sizes):
    row = profiling.imbalance(sizes.select("label", F.col("train").alias("n")), digits=4).first()
    assert (row["majority"], row["minority"], row["ratio"]) == ("BENIGN", "Heartbleed", 187983.75)


def test_class_weights(spark):
    rows = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "label string")
    got = {r["label"]: r["weight"] for r in features.class_weights(rows, "label").collect()}
    assert got == pytest.approx({"a": 10 / 18, "b": 10 / 9, "c": 10 / 3})
    assert 1801984 / (15 * 8) == pytest.approx(15016.5333, abs=1e-3)


def test_error_rate(spark):
    df = spark.range(196).select(F.lit(14).cast("long").alias("y"), F.when(F.col("id") < 128, 0).otherwise(14).cast("long").alias("p"))
    row = evaluation.errors_by_class(df, "y", "p").first()
    assert (row["total"], row["errors"], row["error_pct"]) == (196, 128, 65.3061)

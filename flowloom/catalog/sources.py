"""Readers and sinks, exercised on files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cleaning import dedup_summary
from ..operators.profiling import class_distribution
from ..operators.sampling import split_distribution
from ..plans import batch
from ..plans.checkpoints import scratch_path
from ..sources import flows as flow_files
from ..sources import sinks
from .flows import SPLIT, split
from .inputs import COPIES, FLOWS, KEY, copies, flows
from .registry import query, table


def _csv(df, name, **options):
    path = scratch_path(df.sparkSession, name)
    df.write.options(header=True, **options).csv(path)
    return path


@query("A1_read_flows", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem""")
def a1(spark, sf):
    df = table(spark, sf, "lineitem").drop("l_linestatus", "l_shipdate")
    return flow_files.read_flows(spark, _csv(df, "flows"), df.schema).drop("source_file")


def _by_source(df):
    """One folder of CSV files for each source of the flows; its path."""
    path = scratch_path(df.sparkSession, "flows")
    df.write.partitionBy("source_file").option("header", True).csv(path)
    return path


@query("A2_file_inventory", f"""WITH {FLOWS} SELECT row_number() OVER (ORDER BY source_file) AS n, 'source_file=' || source_file AS file, true AS filled
FROM (SELECT DISTINCT source_file FROM flows)""")
def a2(spark, sf):
    inventory = flow_files.file_inventory(spark, f"{_by_source(flows(spark, sf))}/*/*.csv", folders=True)
    return inventory.select("n", "file", (F.col("size_mb") >= 0).alias("filled"))


@query("A3_missing_inputs", f"""WITH {FLOWS} SELECT DISTINCT 'source_file=' || source_file AS file FROM flows WHERE source_file NOT IN
 (SELECT source_file FROM flows WHERE l_quantity > 25 AND CAST(source_file AS INTEGER) % 2 = 0)""")
def a3(spark, sf):
    """Sources of the flows without files, after the large flows of even years were written."""
    df = flows(spark, sf)
    path = _by_source(df.filter("l_quantity > 25 and cast(source_file as int) % 2 = 0"))
    expected = df.select(F.concat(F.lit("source_file="), "source_file").alias("file"))
    return flow_files.missing_inputs(flow_files.file_inventory(spark, f"{path}/*/*.csv", folders=True), expected)


@query("A4_schema_check", """SELECT CAST(count(*) AS BIGINT) AS n, v.compatible, CAST(1 AS BIGINT) AS kinds
FROM (DESCRIBE lineitem), (VALUES (true), (false)) v(compatible) GROUP BY v.compatible""")
def a4(spark, sf):
    path = scratch_path(spark, "mixed")
    df = table(spark, sf, "lineitem")
    df.write.option("header", True).csv(f"{path}/a")
    df.drop("l_tax").withColumn("extra", F.lit(1)).write.option("header", True).csv(f"{path}/b")
    checked = flow_files.schema_check(spark, f"{path}/*/*.csv")
    return checked.groupBy("n", "compatible").agg(F.countDistinct("missing", "extra").alias("kinds"))


@query("A6_encoding_fallback", "SELECT c_custkey, c_name || ' é' AS c_name FROM customer")
def a6(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit(" é")).alias("c_name"))
    return flow_files.read_flows(spark, _csv(df, "latin", encoding="ISO-8859-1"), df.schema, None).drop("source_file")


@query("A8_write_table", f"""WITH {FLOWS} SELECT label, CAST(count(*) AS VARCHAR) AS n FROM flows GROUP BY 1""")
def a8(spark, sf):
    path = scratch_path(spark, "report")
    sinks.write_table(class_distribution(flows(spark, sf), "label"), path)
    return spark.read.option("header", True).csv(path).select("label", "n")


@query("A9_write_dataset", f"""WITH {SPLIT} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, label, split FROM parts""")
def a9(spark, sf):
    path = scratch_path(spark, "dataset")
    sinks.write_dataset(split(spark, sf).select(*KEY, "label", "split"), path)
    return spark.read.parquet(f"{path}/parquet")


@query("A10_write_proof", f"""WITH {COPIES}, a AS (SELECT count(*) AS before FROM copies), b AS (SELECT count(*) AS after FROM (SELECT DISTINCT * FROM copies))
SELECT before, before - after AS removed, after, round(100.0 * (before - after) / before, 4) AS removed_pct FROM a, b""")
def a10(spark, sf):
    path = scratch_path(spark, "proof")
    sinks.write_proof(dedup_summary(copies(spark, sf)), path)
    return spark.read.schema("before LONG, removed LONG, after LONG, removed_pct DOUBLE").json(path)


@query("A12_load_split", f"""WITH {SPLIT} SELECT l_linenumber, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'test') AS test, count(*) AS total,
 round(100.0 * count(*) / (SELECT count(*) FROM parts), 6) AS total_pct FROM parts GROUP BY 1""")
def a12(spark, sf):
    path = scratch_path(spark, "dataset")
    sinks.write_dataset(split(spark, sf).select(*KEY, "split"), path)
    return split_distribution(sinks.load_split(spark, path, "l_linenumber"), "l_linenumber")


@query("P2_score_upload", """WITH r AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'DDoS' WHEN l_returnflag = 'A' THEN 'PortScan' ELSE 'BENIGN' END AS classe FROM lineitem)
SELECT 'u1' AS user_id, '2024-01-01 00:00:00' AS date, 'CSV' AS source, classe, count(*) AS nombre, CASE classe WHEN 'DDoS' THEN 'Critique' ELSE 'Elevee' END AS gravite,
 'Non traitee' AS statut FROM r WHERE classe <> 'BENIGN' GROUP BY classe""")
def p2(spark, sf):
    """A labelled upload to register rows, end to end."""
    flag = F.col("l_returnflag")
    raw = F.when(flag == "R", "ddos").when(flag == "A", "port scan").otherwise("BENIGN")
    upload = table(spark, sf, "lineitem").select("l_quantity", raw.alias("Label"))
    _, rows = batch.score_upload(upload, "upload.csv", "u1", now=F.lit("2024-01-01 00:00:00"))
    return rows.select("user_id", "date", "source", "classe", "nombre", "gravite", "statut")

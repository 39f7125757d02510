"""Flow, register and log tables derived from the given ones, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .registry import table

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "rate"]
KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
TIES = ["l_shipdate", "l_quantity", "l_extendedprice"]
YEARS = ["1995", "1996", "1997", "1998", "1999", "2000", "2001"]
CLASSES = ["BENIGN", "Bot", "DDoS", "PortScan", "Web Attack - XSS"]

FLOWS = """
flows AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
         WHEN l_orderkey % 89 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE l_tax END AS rate,
    CASE l_returnflag || l_linestatus WHEN 'NO' THEN 'BENIGN' WHEN 'NF' THEN 'BENIGN'
         WHEN 'AF' THEN 'DDoS' WHEN 'AO' THEN 'PortScan' WHEN 'RF' THEN 'Bot'
         ELSE 'Web Attack - XSS' END AS label,
    CAST(year(l_shipdate) AS VARCHAR) AS source_file, l_shipdate
  FROM lineitem),
clean AS (SELECT * REPLACE (CASE WHEN isinf(rate) THEN NULL ELSE rate END AS rate) FROM flows)
"""


def flows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as labelled flows with missing and infinite rates."""
    key = F.col("l_orderkey")
    kind = F.concat("l_returnflag", "l_linestatus")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        F.when(key % 97 == 0, None).when(key % 89 == 0, float("inf")).otherwise(F.col("l_tax")).alias("rate"),
        F.when(kind.isin("NO", "NF"), "BENIGN").when(kind == "AF", "DDoS").when(kind == "AO", "PortScan")
        .when(kind == "RF", "Bot").otherwise("Web Attack - XSS").alias("label"),
        F.year("l_shipdate").cast("string").alias("source_file"),
        "l_shipdate",
    )


COPIES = f"""{FLOWS.rstrip()},
copies AS (SELECT * FROM flows UNION ALL SELECT * FROM flows WHERE l_orderkey % 10 = 0)
"""


def copies(spark: SparkSession, sf: str) -> DataFrame:
    """Flows with one tenth of them stored twice."""
    base = flows(spark, sf)
    return base.unionByName(base.filter(F.col("l_orderkey") % 10 == 0))


REGISTER = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
register AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
    CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+0000' END AS date,
    CASE WHEN event_id % 2 = 0 THEN 'CSV' ELSE 'Suricata' END AS source,
    CASE event_type WHEN 'click' THEN 'BENIGN' WHEN 'view' THEN 'Trafic normal' WHEN 'error' THEN 'DDoS'
         WHEN 'purchase' THEN 'PortScan' ELSE 'Web Attack - XSS' END AS classe,
    CASE k % 10 WHEN 0 THEN 'x' WHEN 1 THEN '' WHEN 2 THEN '-3' ELSE CAST(k AS VARCHAR) END AS nombre,
    CASE k % 4 WHEN 0 THEN 'Critique' WHEN 1 THEN 'Elevee' WHEN 2 THEN 'Moyenne' ELSE 'Faible' END AS gravite,
    CASE event_id % 3 WHEN 0 THEN 'Non traitee' WHEN 1 THEN 'Traitee' ELSE 'En cours' END AS statut,
    CASE WHEN k % 5 = 0 THEN '' ELSE '10.0.0.' || k END AS ip_source,
    CASE WHEN k % 7 = 0 THEN '' ELSE '192.168.0.' || (user_id % 250) END AS ip_destination,
    CASE WHEN k % 2 = 0 THEN 'TCP' ELSE 'UDP' END AS protocole,
    CASE WHEN k % 3 = 0 THEN 'Surveiller' ELSE 'Bloquer' END AS action_recommandee,
    CASE k % 4 WHEN 0 THEN 'Envoyee' WHEN 1 THEN 'Echec' WHEN 2 THEN 'Non demandee' ELSE 'Non configuree' END
      AS notification_email,
    ts
  FROM ev),
units AS (
  SELECT *, greatest(coalesce(try_cast(nullif(nombre, '') AS DOUBLE), 1), 0) AS u,
    (upper(classe) IN ('TRAFIC NORMAL') OR upper(classe) LIKE '%BENIGN%') AS benign
  FROM register)
"""


def _pick(c, pairs: dict, other: str):
    out = F
    for value, name in pairs.items():
        out = out.when(c == value, name)
    return out.otherwise(other)


def register(spark: SparkSession, sf: str) -> DataFrame:
    """Events as an alert register with mixed date formats and dirty counts."""
    ev = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    n, k, uid = F.col("event_id"), F.col("k"), F.col("user_id")
    plain = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'")
    kinds = {"click": "BENIGN", "view": "Trafic normal", "error": "DDoS", "purchase": "PortScan"}
    return ev.select(
        n.cast("string").alias("event_id"), uid.cast("string").alias("user_id"),
        F.when(n % 2 == 0, plain).otherwise(iso).alias("date"),
        F.when(n % 2 == 0, "CSV").otherwise("Suricata").alias("source"),
        _pick(F.col("event_type"), kinds, "Web Attack - XSS").alias("classe"),
        F.when(k % 10 == 0, "x").when(k % 10 == 1, "").when(k % 10 == 2, "-3").otherwise(k.cast("string")).alias("nombre"),
        _pick(k % 4, {0: "Critique", 1: "Elevee", 2: "Moyenne"}, "Faible").alias("gravite"),
        _pick(n % 3, {0: "Non traitee", 1: "Traitee"}, "En cours").alias("statut"),
        F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("10.0.0."), k)).alias("ip_source"),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("192.168.0."), uid % 250)).alias("ip_destination"),
        F.when(k % 2 == 0, "TCP").otherwise("UDP").alias("protocole"),
        F.when(k % 3 == 0, "Surveiller").otherwise("Bloquer").alias("action_recommandee"),
        _pick(k % 4, {0: "Envoyee", 1: "Echec", 2: "Non demandee"}, "Non configuree").alias("notification_email"),
        "ts",
    )


MESSY = """
messy AS (
  SELECT event_id, CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 12
    WHEN 0 THEN 'Web Attack – XSS' WHEN 1 THEN ' web  attack � sql injection ' WHEN 2 THEN 'FTP-Patator'
    WHEN 3 THEN NULL WHEN 4 THEN 'DoS_Hulk' WHEN 5 THEN 'port scan ' || event_type
    WHEN 6 THEN 'ssh login ' || event_type WHEN 7 THEN 'BENIGN' WHEN 8 THEN 'Web Attack — Brute Force'
    WHEN 9 THEN event_type WHEN 10 THEN 'Web Attack – Sql Injection' ELSE 'dos   slowloris' END AS raw
  FROM events)
"""


def messy(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as badly as they are typed: dashes, blanks, underscores, missing."""
    k = F.col("k")
    names = {
        0: "Web Attack – XSS", 1: " web  attack � sql injection ", 2: "FTP-Patator", 4: "DoS_Hulk",
        7: "BENIGN", 8: "Web Attack — Brute Force", 10: "Web Attack – Sql Injection", 11: "dos   slowloris",
    }
    raw = F
    for value, name in names.items():
        raw = raw.when(k == value, name)
    raw = (
        raw.when(k == 5, F.concat(F.lit("port scan "), "event_type"))
        .when(k == 6, F.concat(F.lit("ssh login "), "event_type")).when(k == 9, F.col("event_type"))
    )
    events = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int") % 12)
    return events.select("event_id", raw.alias("raw"))


ALERTS = """
logs AS (
  SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN 'flow' ELSE 'alert' END AS event_type,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+0000' AS timestamp,
    CAST(event_id % 4000 AS VARCHAR) AS flow_id, '10.0.0.' || (user_id % 250) AS src_ip,
    '10.1.0.' || CAST(json_extract_string(props, '$.k') AS INTEGER) AS dest_ip,
    CASE WHEN event_id % 2 = 0 THEN 'TCP' ELSE 'UDP' END AS proto,
    CASE event_type WHEN 'error' THEN 'LAB DDoS simulation' WHEN 'click' THEN 'LAB PortScan simulation'
         WHEN 'signup' THEN 'LAB Brute Force simulation' ELSE 'Policy notice' END AS signature,
    CASE WHEN event_type = 'signup' THEN 'web application' ELSE 'misc' END AS category,
    CASE WHEN event_id % 9 = 0 THEN 'N/A'
         ELSE CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) END AS severity
  FROM events)
"""


def logs(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the shape of the IDS log."""
    k, n = F.get_json_object("props", "$.k").cast("int"), F.col("event_id")
    kind = F.col("event_type")
    signatures = {"error": "LAB DDoS simulation", "click": "LAB PortScan simulation", "signup": "LAB Brute Force simulation"}
    signature = _pick(kind, signatures, "Policy notice")
    severity = F.when(n % 9 == 0, "N/A").otherwise((k % 5).cast("string"))
    return table(spark, sf, "events").select(
        F.when(kind == "view", "flow").otherwise("alert").alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'").alias("timestamp"),
        (n % 4000).cast("string").alias("flow_id"),
        F.concat(F.lit("10.0.0."), F.col("user_id") % 250).alias("src_ip"), F.lit(None).cast("string").alias("src_port"),
        F.concat(F.lit("10.1.0."), k).alias("dest_ip"), F.lit(None).cast("string").alias("dest_port"),
        F.when(n % 2 == 0, "TCP").otherwise("UDP").alias("proto"), F.lit(None).cast("string").alias("signature"),
        F.struct(
            signature.alias("signature"), F.lit(None).cast("string").alias("signature_id"), F.lit(None).cast("string").alias("rev"),
            F.when(kind == "signup", "web application").otherwise("misc").alias("category"), severity.alias("severity"),
        ).alias("alert"),
    )


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The log as JSON lines, each followed by a blank or a broken line."""
    rows = logs(spark, sf)
    line = F.to_json(F.struct(*rows.columns))
    broken = F.when(F.pmod(F.xxhash64("timestamp"), F.lit(10)) == 0, '{"event_type": "alert", ').otherwise("")
    return rows.select(F.explode(F.array(line, broken)).alias("value"))


def label_names(c, classes: list[str] = CLASSES):
    return F.array(*map(F.lit, classes))[c]

"""Cleaning, profiling, statistics, outliers, sampling and features on the flow table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import canonical_attack, is_attack, normalize_label, normalize_label_v1, short_name, slug
from ..operators import cleaning, correlation, features, outliers, profiling, ranking, sampling
from .inputs import COPIES, FEATURES, FLOWS, KEY, MESSY, TIES, YEARS, copies, flows, messy
from .registry import query, table

F3 = ["l_quantity", "l_extendedprice", "l_discount"]


def union_sql(cols: list[str], line: str, sep: str = "\nUNION ALL\n") -> str:
    """One SELECT per column, joined."""
    return sep.join(line.replace("{c}", c) for c in cols)


FILES = """
files AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN dayname(o_orderdate) || '-WorkingHours.pcap_ISCX.csv'
  WHEN o_orderkey % 3 = 1 THEN 'Thursday-' || o_orderpriority || '-WebAttacks.csv'
  ELSE 'Friday WorkingHours-Morning ' || o_orderpriority || '.csv' END AS file FROM orders)
"""


def files(spark, sf):
    priority = F.col("o_orderpriority")
    name = (
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.date_format("o_orderdate", "EEEE"), F.lit("-WorkingHours.pcap_ISCX.csv")))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("Thursday-"), priority, F.lit("-WebAttacks.csv")))
        .otherwise(F.concat(F.lit("Friday WorkingHours-Morning "), priority, F.lit(".csv")))
    )
    return table(spark, sf, "orders").select("o_orderkey", name.alias("file"))


@query("A5_short_name", f"""WITH {FILES}
SELECT o_orderkey, CASE WHEN lower(file) LIKE '%monday%' THEN 'Monday' WHEN lower(file) LIKE '%tuesday%' THEN 'Tuesday'
  WHEN lower(file) LIKE '%wednesday%' THEN 'Wednesday' WHEN lower(file) LIKE '%webattacks%' THEN 'Thu-WebAttacks'
  WHEN lower(file) LIKE '%friday-workinghours-morning%' THEN 'Fri-Morning'
  ELSE regexp_replace(file, '\\.[^.]*$', '') END AS short_name,
  lower(replace(replace(replace(replace(file, '.pcap_ISCX.csv', ''), '.csv', ''), '-', '_'), ' ', '_')) AS slug
FROM files""")
def a5(spark, sf):
    return files(spark, sf).select("o_orderkey", short_name(F.col("file")).alias("short_name"), slug(F.col("file")).alias("slug"))


# ---- B: labels and cleaning

@query("B1_normalize_label_v1", f"""WITH {MESSY},
t AS (SELECT event_id, regexp_replace(translate(trim(raw), '�–—', '---'), '\\s*-\\s*', ' - ', 'g') AS v FROM messy)
SELECT event_id, CASE WHEN v = 'Web Attack - Sql Injection' THEN 'Web Attack - SQL Injection' ELSE v END AS label FROM t""")
def b1(spark, sf):
    return messy(spark, sf).select("event_id", normalize_label_v1(F.col("raw")).alias("label"))


@query("B2_normalize_label", f"""WITH {MESSY},
t AS (SELECT event_id, regexp_replace(translate(trim(coalesce(raw, 'LABEL_MANQUANT')), '�–—', '---'), '\\s+', ' ', 'g') AS v FROM messy)
SELECT event_id, CASE WHEN regexp_matches(lower(v), 'web\\s*attack.*xss') THEN 'Web Attack - XSS'
  WHEN regexp_matches(lower(v), 'web\\s*attack.*sql\\s*injection') THEN 'Web Attack - SQL Injection'
  WHEN regexp_matches(lower(v), 'web\\s*attack.*brute\\s*force') THEN 'Web Attack - Brute Force' ELSE v END AS label FROM t""")
def b2(spark, sf):
    return messy(spark, sf).select("event_id", normalize_label(F.col("raw")).alias("label"))


CANONICAL = """CASE
  WHEN lower(v) IN ('benign','bot','ddos','dos goldeneye','dos hulk','dos slowhttptest','dos slowloris','ftp-patator','heartbleed',
    'infiltration','portscan','ssh-patator','web attack - brute force','web attack - sql injection','web attack - xss')
  THEN CASE lower(v) WHEN 'benign' THEN 'BENIGN' WHEN 'bot' THEN 'Bot' WHEN 'ddos' THEN 'DDoS' WHEN 'dos goldeneye' THEN 'DoS GoldenEye'
    WHEN 'dos hulk' THEN 'DoS Hulk' WHEN 'dos slowhttptest' THEN 'DoS Slowhttptest' WHEN 'dos slowloris' THEN 'DoS slowloris'
    WHEN 'ftp-patator' THEN 'FTP-Patator' WHEN 'heartbleed' THEN 'Heartbleed' WHEN 'infiltration' THEN 'Infiltration'
    WHEN 'portscan' THEN 'PortScan' WHEN 'ssh-patator' THEN 'SSH-Patator' WHEN 'web attack - brute force' THEN 'Web Attack - Brute Force'
    WHEN 'web attack - sql injection' THEN 'Web Attack - SQL Injection' ELSE 'Web Attack - XSS' END
  WHEN lower(v) LIKE '%sql%' THEN 'Web Attack - SQL Injection' WHEN lower(v) LIKE '%xss%' THEN 'Web Attack - XSS'
  WHEN lower(v) LIKE '%brute%' AND lower(v) LIKE '%web%' THEN 'Web Attack - Brute Force'
  WHEN lower(v) LIKE '%port%' AND lower(v) LIKE '%scan%' THEN 'PortScan'
  WHEN lower(v) LIKE '%goldeneye%' THEN 'DoS GoldenEye' WHEN lower(v) LIKE '%hulk%' THEN 'DoS Hulk'
  WHEN lower(v) LIKE '%slowhttptest%' THEN 'DoS Slowhttptest' WHEN lower(v) LIKE '%slowloris%' THEN 'DoS slowloris'
  WHEN lower(v) LIKE '%ddos%' THEN 'DDoS' WHEN lower(v) LIKE '%ssh%' THEN 'SSH-Patator' WHEN lower(v) LIKE '%ftp%' THEN 'FTP-Patator'
  ELSE v END"""


@query("B3_canonical_attack", f"""WITH {MESSY},
t AS (SELECT event_id, trim(regexp_replace(replace(translate(coalesce(raw, ''), '�–—', '---'), '_', ' '), '\\s+', ' ', 'g')) AS v FROM messy)
SELECT event_id, {CANONICAL} AS label FROM t""")
def b3(spark, sf):
    return messy(spark, sf).select("event_id", canonical_attack(F.col("raw")).alias("label"))


@query("B4_inf_to_null", f"WITH {FLOWS} SELECT l_orderkey, l_linenumber, l_partkey, rate FROM clean")
def b4(spark, sf):
    return cleaning.inf_to_null(flows(spark, sf)).select("l_orderkey", "l_linenumber", "l_partkey", "rate")


@query("B5_numeric_cols", f"""WITH {FLOWS} SELECT count(l_orderkey) AS l_orderkey, count(l_partkey) AS l_partkey,
  count(l_suppkey) AS l_suppkey, count(l_linenumber) AS l_linenumber, count(l_quantity) AS l_quantity,
  count(l_extendedprice) AS l_extendedprice, count(l_discount) AS l_discount, count(rate) AS rate FROM flows""")
def b5(spark, sf):
    df = flows(spark, sf)
    return df.agg(*[F.count(c).alias(c) for c in cleaning.numeric_cols(df)])


@query("B6_is_attack", "SELECT event_id, upper(event_type) <> 'CLICK' AND upper(replace(event_type, 'view', 'benign')) <> 'BENIGN' AS attack FROM events")
def b6(spark, sf):
    kind = F.when(F.col("event_type").isin("view", "click"), "benign").otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", is_attack(kind).alias("attack"))


@query("B8_select_features", f"WITH {FLOWS} SELECT l_quantity, l_extendedprice, l_discount, rate, label FROM flows")
def b8(spark, sf):
    return cleaning.select_features(flows(spark, sf), FEATURES, ["label"])


# ---- D: profiles

@query("D1_shape", f"""WITH {FLOWS} SELECT source_file, count(*) AS rows, CAST(9 AS BIGINT) AS n_columns, CAST(8 AS BIGINT) AS n_numeric
FROM flows GROUP BY source_file""")
def d1(spark, sf):
    return profiling.shape(flows(spark, sf).drop("l_shipdate"), "source_file")


PROFILE = union_sql(FEATURES, """SELECT '{c}' AS variable, count(*) FILTER ({c} IS NULL) AS missing,
 count(*) FILTER (isinf({c})) AS infinite, count(*) FILTER ({c} = 0) AS zeros FROM flows""")


@query("D2_missing", f"WITH {FLOWS}, p AS ({PROFILE}) SELECT variable, missing FROM p")
def d2(spark, sf):
    return profiling.null_profile(flows(spark, sf), FEATURES).select("variable", "missing")


@query("D3_infinite", f"WITH {FLOWS}, p AS ({PROFILE}) SELECT variable, infinite FROM p")
def d3(spark, sf):
    return profiling.null_profile(flows(spark, sf), FEATURES).select("variable", "infinite")


@query("D4_zeros", f"WITH {FLOWS}, p AS ({PROFILE}) SELECT variable, zeros FROM p")
def d4(spark, sf):
    return profiling.null_profile(flows(spark, sf), FEATURES).select("variable", "zeros")


@query("D5_quality_table", f"WITH {FLOWS}, p AS ({PROFILE}) SELECT variable, infinite, missing, infinite + missing AS to_treat FROM p")
def d5(spark, sf):
    return profiling.quality_table(flows(spark, sf), FEATURES)


@query("D6_duplicate_count", f"""WITH {COPIES}, d AS (SELECT source_file, count(*) AS n FROM (SELECT DISTINCT * FROM copies) GROUP BY 1),
a AS (SELECT source_file, count(*) AS n FROM copies GROUP BY 1)
SELECT a.source_file, a.n - d.n AS duplicates FROM a JOIN d USING (source_file)""")
def d6(spark, sf):
    return cleaning.duplicate_count(copies(spark, sf), "source_file")


@query("D7_class_distribution", f"""WITH {FLOWS} SELECT label, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM flows), 6) AS pct
FROM flows GROUP BY label""")
def d7(spark, sf):
    return profiling.class_distribution(flows(spark, sf), "label")


@query("D8_class_distribution_by_file", f"""WITH {FLOWS} SELECT source_file, label, count(*) AS n,
 round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY source_file), 6) AS pct FROM flows GROUP BY 1, 2""")
def d8(spark, sf):
    return profiling.class_distribution(flows(spark, sf), "label", "source_file")


@query("D9_merged_distribution", f"""WITH {FLOWS} SELECT label, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM flows), 6) AS pct
FROM flows GROUP BY label""")
def d9(spark, sf):
    partial = profiling.class_distribution(flows(spark, sf), "label", "source_file")
    return profiling.merge_distributions(partial, "label")


REPORT = f"""{COPIES.rstrip()},
slim AS (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, rate, label, source_file FROM copies),
dist AS (SELECT source_file, count(*) AS n FROM (SELECT DISTINCT * FROM slim) GROUP BY 1),
agg AS (SELECT source_file, count(*) AS rows, count(DISTINCT label) AS classes, count(*) FILTER (rate IS NULL) AS missing,
  count(*) FILTER (isinf(rate)) AS infinite, count(*) FILTER (label = 'BENIGN') AS benign FROM slim GROUP BY 1),
report AS (SELECT source_file, rows, CAST(6 AS BIGINT) AS n_columns, CAST(5 AS BIGINT) AS n_numeric, classes, missing,
  round(100.0 * missing / (rows * 6), 6) AS missing_pct, infinite, round(100.0 * infinite / (rows * 5), 6) AS infinite_pct,
  rows - n AS duplicates, round(100.0 * (rows - n) / rows, 4) AS duplicates_pct, benign, rows - benign AS attacks,
  round(100.0 * (rows - benign) / rows, 4) AS attacks_pct FROM agg JOIN dist USING (source_file))
"""


def report(spark, sf):
    slim = copies(spark, sf).select("l_orderkey", *FEATURES, "label", "source_file")
    return profiling.quality_report(slim, "source_file", "label")


@query("D10_quality_report", f"WITH {REPORT} SELECT * FROM report")
def d10(spark, sf):
    return report(spark, sf)


@query("D11_global_summary", f"""WITH {REPORT} SELECT count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows, max(n_columns) AS n_columns,
 CAST(sum(missing) AS BIGINT) AS missing, CAST(sum(infinite) AS BIGINT) AS infinite, CAST(sum(duplicates) AS BIGINT) AS duplicates,
 CAST(sum(benign) AS BIGINT) AS benign, CAST(sum(attacks) AS BIGINT) AS attacks, (SELECT count(DISTINCT label) FROM copies) AS classes,
 round(100.0 * sum(benign) / sum(rows), 4) AS benign_pct, round(100.0 * sum(attacks) / sum(rows), 4) AS attacks_pct FROM report""")
def d11(spark, sf):
    return profiling.global_summary(report(spark, sf), copies(spark, sf).select("label"))


@query("D12_imbalance", f"""WITH {FLOWS}, d AS (SELECT label, count(*) AS n FROM flows GROUP BY 1),
a AS (SELECT label, n FROM d ORDER BY n DESC, label LIMIT 1), b AS (SELECT label, n FROM d ORDER BY n, label LIMIT 1)
SELECT a.label AS majority, a.n AS majority_n, b.label AS minority, b.n AS minority_n, round(a.n / greatest(b.n, 1), 2) AS ratio FROM a, b""")
def d12(spark, sf):
    return profiling.imbalance(profiling.class_distribution(flows(spark, sf), "label"))


@query("D13_variable_profile", f"WITH {FLOWS}\n" + union_sql(FEATURES, """SELECT f.source_file, '{c}' AS variable, 'double' AS type,
 count(*) FILTER (f.{c} IS NULL) AS missing, count(*) FILTER (isinf(f.{c})) AS infinite, count(*) FILTER (f.{c} = 0) AS zeros,
 round(quantile_cont(CASE WHEN isinf(f.{c}) THEN NULL ELSE f.{c} END, 0.5), 6) AS median, count(DISTINCT f.{c}) AS distinct_values
 FROM flows f GROUP BY 1"""))
def d13(spark, sf):
    return profiling.variable_profile(flows(spark, sf), FEATURES, "source_file")


@query("D14_describe", f"WITH {FLOWS}\n" + union_sql(FEATURES, """SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 5) AS mean,
 round(stddev_samp({c}), 5) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
 round(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS max, count(*) FILTER ({c} = 0) AS zeros,
 round(100.0 * count(*) FILTER ({c} = 0) / count(*), 4) AS zeros_pct, count(*) FILTER ({c} IS NULL) AS missing FROM clean"""))
def d14(spark, sf):
    return profiling.describe(flows(spark, sf), FEATURES, digits=5)


TARGET = FLOWS.rstrip() + ",\ntgt AS (SELECT *, CASE WHEN label <> 'BENIGN' THEN 1 ELSE 0 END AS attack FROM clean)\n"


def with_target(spark, sf):
    return flows(spark, sf).withColumn("attack", is_attack(F.col("label")).cast("int"))


@query("D15_corr_with_target", f"WITH {TARGET}, c AS (" + union_sql(FEATURES, "SELECT '{c}' AS variable, corr({c}, attack) AS r FROM tgt")
       + ") SELECT variable, round(r, 6) AS corr, round(abs(r), 6) AS corr_abs FROM c")
def d15(spark, sf):
    return correlation.corr_with_target(with_target(spark, sf), FEATURES, "attack")


M5 = [*FEATURES, "attack"]
MATRIX = f"WITH {TARGET}, m AS (" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS v1, '{b}' AS v2, round(corr({a}, {b}), 6) AS corr FROM tgt" for a in M5 for b in M5) + ")"
PAIRS = f"WITH {TARGET}, m AS (" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS v1, '{b}' AS v2, round(corr({a}, {b}), 6) AS corr FROM tgt"
    for i, a in enumerate(M5) for b in M5[i + 1:]) + """),
top AS (SELECT v1, v2, corr, abs(corr) AS corr_abs, row_number() OVER (ORDER BY abs(corr) DESC, v1, v2) AS rank FROM m)"""


@query("D16_corr_matrix", MATRIX + " SELECT * FROM m")
def d16(spark, sf):
    return correlation.corr_matrix(with_target(spark, sf), M5)


@query("D17_top_pairs", PAIRS + " SELECT * FROM top WHERE rank <= 8")
def d17(spark, sf):
    return correlation.top_pairs(with_target(spark, sf), M5, 8)


@query("D17_top_pairs_one_scan", PAIRS + " SELECT v1, v2, corr FROM m")
def d17b(spark, sf):
    pairs = correlation.pair_correlations(with_target(spark, sf), M5, aggregate_pairs=0)
    return pairs.withColumn("corr", F.round("corr", 6))


@query("D18_leading_variables", PAIRS + """, met AS (SELECT v1 AS variable, rank * 2 AS pos FROM top WHERE rank <= 8
  UNION ALL SELECT v2, rank * 2 + 1 FROM top WHERE rank <= 8)
SELECT variable, min(pos) AS met_at FROM met GROUP BY 1 ORDER BY 2 LIMIT 4""")
def d18(spark, sf):
    return correlation.leading_variables(correlation.top_pairs(with_target(spark, sf), M5, 8), 4)


# discount made sparse, so that one variable has a zero iqr
TUKEY = FLOWS.rstrip() + ",\nwide AS (SELECT *, CASE WHEN l_linenumber = 7 THEN l_quantity ELSE 0 END AS burst FROM clean)\n"
BURST = [*FEATURES, "burst"]


def with_burst(spark, sf):
    burst = F.when(F.col("l_linenumber") == 7, F.col("l_quantity")).otherwise(0.0)
    return flows(spark, sf).withColumn("burst", burst)


def tukey_sql(guard: str) -> str:
    bounds = union_sql(BURST, f"""SELECT '{{c}}' AS variable, q1, q3, q3 - q1 AS iqr, CASE WHEN {guard} THEN q1 - 1.5 * (q3 - q1) END AS low,
 CASE WHEN {guard} THEN q3 + 1.5 * (q3 - q1) END AS high FROM (SELECT quantile_cont({{c}}, 0.25) AS q1, quantile_cont({{c}}, 0.75) AS q3 FROM wide)""")
    counts = union_sql(BURST, """SELECT b.variable, count(w.{c}) AS valid, count(*) FILTER (w.{c} < b.low OR w.{c} > b.high) AS outliers
 FROM wide w, b WHERE b.variable = '{c}' GROUP BY 1""")
    return f"""WITH {TUKEY}, b AS ({bounds}), n AS ({counts})
SELECT variable, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(low, 6) AS low, round(high, 6) AS high,
 valid, outliers, round(100.0 * outliers / valid, 6) AS outliers_pct FROM b JOIN n USING (variable)"""


@query("D19_iqr_outliers", tukey_sql("q3 > q1"))
def d19(spark, sf):
    return outliers.iqr_outliers(with_burst(spark, sf), BURST)


@query("D20_iqr_outliers_unguarded", tukey_sql("true"))
def d20(spark, sf):
    return outliers.iqr_outliers(with_burst(spark, sf), BURST, guard=False)


_SIDES = " + ".join(
    f"CASE WHEN {c} < (SELECT q1 - 1.5 * (q3 - q1) FROM q_{c}) OR {c} > (SELECT q3 + 1.5 * (q3 - q1) FROM q_{c}) THEN 1 ELSE 0 END"
    for c in FEATURES)
_VALID = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in FEATURES)
_QS = ",\n".join(
    f"q_{c} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM clean)" for c in FEATURES)


@query("D21_outliers_by_group", f"""WITH {FLOWS}, {_QS}, r AS (SELECT source_file, label, {_VALID} AS v, {_SIDES} AS o FROM clean),
g AS (SELECT 'source_file' AS dimension, source_file AS grp, CAST(sum(v) AS BIGINT) AS valid, CAST(sum(o) AS BIGINT) AS outliers FROM r GROUP BY 2
 UNION ALL SELECT 'label', label, CAST(sum(v) AS BIGINT), CAST(sum(o) AS BIGINT) FROM r GROUP BY 2)
SELECT dimension, grp, valid, outliers, round(100.0 * outliers / valid, 6) AS outliers_pct FROM g""")
def d21(spark, sf):
    return outliers.outliers_by(flows(spark, sf), FEATURES, ["source_file", "label"])


@query("D22_class_weights", f"""WITH {FLOWS}, d AS (SELECT label, count(*) AS n FROM flows GROUP BY 1)
SELECT label, n, round((SELECT sum(n) FROM d) / ((SELECT count(*) FROM d) * n), 9) AS weight FROM d""")
def d22(spark, sf):
    return features.class_weights(flows(spark, sf), "label").withColumn("weight", F.round("weight", 9))


@query("D23_usable_columns", f"WITH {FLOWS}\n" + union_sql(FEATURES, """SELECT '{c}' AS variable, round(count({c}) / count(*), 6) AS share,
 count({c}) / count(*) > 0.98 AS usable FROM clean"""))
def d23(spark, sf):
    return features.column_shares(cleaning.inf_to_null(flows(spark, sf)), FEATURES, 0.98)


@query("D24_constant_columns", f"WITH {FLOWS.rstrip()}, w AS (SELECT *, 5.0 AS fixed FROM clean)\n" + union_sql([*FEATURES, "fixed"],
       "SELECT '{c}' AS variable, round(var_samp({c}), 4) AS variance, min({c}) = max({c}) AS constant FROM w"))
def d24(spark, sf):
    df = cleaning.inf_to_null(flows(spark, sf)).withColumn("fixed", F.lit(5.0))
    return features.constant_columns(df, [*FEATURES, "fixed"], 4)


@query("D25_minmax_check", f"WITH {FLOWS}\n" + union_sql(FEATURES, """SELECT '{c}' AS variable,
 CAST(0.0 AS DOUBLE) AS min_after, round((max({c}) - min({c})) / (max({c}) - min({c})), 6) AS max_after FROM clean"""))
def d25(spark, sf):
    df = cleaning.inf_to_null(flows(spark, sf))
    return features.minmax_check(features.apply_minmax(df, features.fit_minmax(df, FEATURES)), FEATURES)


@query("D26_presence_pivot", f"WITH {FLOWS} SELECT label, " + ", ".join(
    f"count(*) FILTER (source_file = '{y}') AS n_{y}, round(log10(count(*) FILTER (source_file = '{y}') + 1), 6) AS log_{y}" for y in YEARS)
    + " FROM flows GROUP BY label")
def d26(spark, sf):
    return profiling.presence_pivot(flows(spark, sf), "label", "source_file")


@query("D27_attack_split", f"""WITH {FLOWS} SELECT source_file, round(100.0 * count(*) FILTER (label = 'BENIGN') / count(*), 4) AS benign_pct,
 round(100.0 * count(*) FILTER (label <> 'BENIGN') / count(*), 4) AS attack_pct FROM flows GROUP BY 1""")
def d27(spark, sf):
    return profiling.attack_split(flows(spark, sf), "source_file", is_attack(F.col("label")))


# ---- E: samples, splits, folds

RANK = "md5(concat_ws('|', '42', l_orderkey, l_partkey, l_suppkey, l_linenumber))"
RANKED = f"{FLOWS.rstrip()}, ranked AS (SELECT *, {RANK} AS h FROM flows)"
ORDER = "ORDER BY h, l_shipdate, l_quantity, l_extendedprice"


@query("E1_sort", f"""WITH {FLOWS}, d AS (SELECT label, source_file, count(*) AS n, round(avg(l_discount) - 0.05, 9) AS gap FROM flows GROUP BY 1, 2)
SELECT label, source_file, n, gap FROM d ORDER BY abs(gap) DESC, label, source_file""")
def e1(spark, sf):
    d = flows(spark, sf).groupBy("label", "source_file").agg(
        F.count("*").alias("n"), F.round(F.avg("l_discount") - 0.05, 9).alias("gap"))
    return ranking.sort_by(d, [F.abs("gap").desc(), F.asc("label"), F.asc("source_file")])


@query("E2_top_k", f"""WITH {FLOWS} SELECT l_orderkey, l_partkey, l_extendedprice FROM flows
 ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 100""")
def e2(spark, sf):
    order = [F.desc("l_extendedprice"), *[F.asc(k) for k in KEY]]
    return ranking.top_k(flows(spark, sf), order, 100).select("l_orderkey", "l_partkey", "l_extendedprice")


@query("E3_latest_n", """SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER
 (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank FROM orders) WHERE rank <= 5""")
def e3(spark, sf):
    return ranking.latest_n(table(spark, sf, "orders"), "o_custkey", "o_orderdate", 5, "o_orderkey").select(
        "o_custkey", "o_orderkey", F.col("rank").cast("long").alias("rank"))


@query("E5_sample_n", f"""WITH {RANKED}, s AS (SELECT *, row_number() OVER (PARTITION BY source_file {ORDER}) AS r FROM ranked)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, source_file FROM s WHERE r <= 2500""")
def e5(spark, sf):
    return sampling.sample_n(flows(spark, sf), ["source_file"], 2500, 42, KEY, TIES).select(*KEY, "source_file")


@query("E5_sample_n_split_path", f"""WITH {RANKED}, s AS (SELECT *, row_number() OVER (PARTITION BY source_file {ORDER}) AS r FROM ranked)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, source_file FROM s WHERE r <= 2500""")
def e5b(spark, sf):
    """The same sample by counting hash prefixes, as for groups too large for a task."""
    return sampling.sample_n(flows(spark, sf), ["source_file"], 2500, 42, KEY, TIES, window_rows=100).select(*KEY, "source_file")


@query("E6_composition", f"""WITH {FLOWS} SELECT source_file, least(count(*), 2500) AS n FROM flows GROUP BY 1""")
def e6(spark, sf):
    return sampling.composition(sampling.sample_n(flows(spark, sf), ["source_file"], 2500, 42, KEY, TIES), "source_file")


@query("E7_stratified_sample", f"""WITH {RANKED}, d AS (SELECT label, count(*) AS c FROM flows GROUP BY 1),
q AS (SELECT label, greatest(1, CAST(floor(5000 * c / (SELECT sum(c) FROM d)) AS BIGINT)) AS quota FROM d),
s AS (SELECT *, row_number() OVER (PARTITION BY label {ORDER}) AS r FROM ranked)
SELECT label, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM s JOIN q USING (label) WHERE r <= quota GROUP BY 1""")
def e7(spark, sf):
    s = sampling.stratified_sample(flows(spark, sf), "label", 5000, 42, KEY, TIES)
    return s.groupBy("label").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


SPLIT = f"""{RANKED}, d AS (SELECT label, count(*) AS c FROM flows GROUP BY 1), t AS (SELECT sum(c) AS n, sum(c) - CAST(ceil(0.3 * sum(c)) AS BIGINT) AS ntr FROM d),
f AS (SELECT label, c, (ntr * c) // n AS base, (ntr * c) % n AS rest, ntr FROM d, t),
q AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= ntr - (SELECT sum(base) FROM f) THEN 1 ELSE 0 END AS quota FROM f),
parts AS (SELECT ranked.*, CASE WHEN row_number() OVER (PARTITION BY ranked.label {ORDER}) <= quota THEN 'train' ELSE 'test' END AS split
 FROM ranked JOIN q ON ranked.label = q.label)"""


def split(spark, sf, **kw):
    return sampling.stratified_split(flows(spark, sf), "label", 0.3, 42, KEY, TIES, **kw)


@query("E8_stratified_split", f"WITH {SPLIT} SELECT label, split, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM parts GROUP BY 1, 2")
def e8(spark, sf):
    return split(spark, sf).groupBy("label", "split").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


@query("E8_stratified_split_rows", f"WITH {SPLIT} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, label, split FROM parts")
def e8b(spark, sf):
    """Every row with its part, by counting hash prefixes."""
    return split(spark, sf, window_rows=100).select(*KEY, "label", "split")


@query("E9_split_summary", f"""WITH {SPLIT} SELECT label, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'test') AS test,
 count(*) AS total, round(100.0 * count(*) / (SELECT count(*) FROM parts), 6) AS total_pct FROM parts GROUP BY 1""")
def e9(spark, sf):
    return sampling.split_distribution(split(spark, sf), "label")


@query("E9_split_sizes", f"WITH {SPLIT} SELECT split, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM parts), 4) AS pct FROM parts GROUP BY 1")
def e9b(spark, sf):
    return sampling.split_summary(split(spark, sf))


FOLDS = f"""WITH {RANKED} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, label,
 CAST((row_number() OVER (PARTITION BY label {ORDER}) - 1) % 5 AS INTEGER) AS fold FROM ranked"""


@query("E10_stratified_folds", FOLDS)
def e10(spark, sf):
    return sampling.stratified_folds(flows(spark, sf), "label", 5, 42, KEY, TIES).select(*KEY, "label", "fold")


@query("E10_stratified_folds_split_path", FOLDS)
def e10b(spark, sf):
    """Folds by range partitions and offsets, as for classes too large for a task."""
    df = sampling.stratified_folds(flows(spark, sf), "label", 5, 42, KEY, TIES, window_rows=100)
    return df.select(*KEY, "label", "fold")


@query("E11_cap_rows", f"""WITH {RANKED} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM ranked {ORDER} LIMIT 2000""")
def e11(spark, sf):
    return sampling.cap_rows(flows(spark, sf), 2000, 42, KEY, TIES).select(*KEY)


@query("E13_retain", """SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def e13(spark, sf):
    ev = table(spark, sf, "events")
    return ranking.retain(ev, "ts", "7 DAYS", ev.agg(F.max("ts")).scalar()).select("event_id", "ts")


# ---- F: sets, duplicates, shape

@query("F1_union", """SELECT event_id, event_type, CAST(NULL AS DOUBLE) AS value FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, NULL, value FROM events WHERE event_id % 2 = 1""")
def f1(spark, sf):
    ev = table(spark, sf, "events")
    even = ev.filter("event_id % 2 = 0").select("event_id", "event_type")
    odd = ev.filter("event_id % 2 = 1").select("event_id", "value")
    return even.unionByName(odd, allowMissingColumns=True)


@query("F2_dedup", f"WITH {COPIES} SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, rate, label, source_file, l_quantity, l_extendedprice FROM copies")
def f2(spark, sf):
    slim = copies(spark, sf).select(*KEY, "rate", "label", "source_file", "l_quantity", "l_extendedprice")
    return cleaning.dedup(slim)


@query("F3_dedup_summary", f"""WITH {COPIES}, a AS (SELECT count(*) AS before FROM copies), b AS (SELECT count(*) AS after FROM (SELECT DISTINCT * FROM copies))
SELECT before, before - after AS removed, after, round(100.0 * (before - after) / before, 4) AS removed_pct FROM a, b""")
def f3(spark, sf):
    return cleaning.dedup_summary(copies(spark, sf))


@query("F5_melt", f"WITH {FLOWS}\n" + union_sql(F3, "SELECT l_orderkey, l_linenumber, '{c}' AS variable, {c} AS value FROM flows"))
def f5(spark, sf):
    return cleaning.melt(flows(spark, sf), ["l_orderkey", "l_linenumber"], F3)


@query("F6_upper_pairs", PAIRS + " SELECT v1, v2, corr FROM m")
def f6(spark, sf):
    return correlation.upper_pairs(correlation.corr_matrix(with_target(spark, sf), M5), M5)


@query("F7_column_difference", """SELECT DISTINCT p_partkey AS partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)""")
def f7(spark, sf):
    found = table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("partkey"))
    return cleaning.set_difference(table(spark, sf, "part").select(F.col("p_partkey").alias("partkey")), found)


@query("C9_set_difference", """SELECT DISTINCT s_suppkey AS suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 48)""")
def c9(spark, sf):
    found = table(spark, sf, "lineitem").filter("l_quantity > 48").select(F.col("l_suppkey").alias("suppkey"))
    return cleaning.set_difference(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("suppkey")), found)


@query("D25_minmax_on_test", f"""WITH {SPLIT}, tr AS (SELECT * REPLACE (CASE WHEN isinf(rate) THEN NULL ELSE rate END AS rate) FROM parts)
""" + union_sql(FEATURES, """SELECT '{c}' AS variable, round((min({c}) FILTER (split = 'test') - min({c}) FILTER (split = 'train')) / (max({c}) FILTER (split = 'train') - min({c}) FILTER (split = 'train')), 6) AS min_after,
 round((max({c}) FILTER (split = 'test') - min({c}) FILTER (split = 'train')) / (max({c}) FILTER (split = 'train') - min({c}) FILTER (split = 'train')), 6) AS max_after FROM tr"""))
def d25b(spark, sf):
    """Bounds of the train part applied to the test part, where they need not be 0 and 1."""
    df = cleaning.inf_to_null(split(spark, sf), FEATURES)
    bounds = features.fit_minmax(df.filter("split = 'train'"), FEATURES)
    return features.minmax_check(features.apply_minmax(df.filter("split = 'test'"), bounds), FEATURES)

"""Label codes, imputation, scaling, training and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, evaluation, features, imputation, models, sampling
from ..plans import batch
from ..plans.checkpoints import durable
from .flows import ORDER, RANKED, SPLIT, split, union_sql
from .inputs import CLASSES, FEATURES, FLOWS, KEY, TIES, flows
from .registry import query, table

TREES = {"numTrees": 5, "maxDepth": 6}


def clean(spark, sf):
    return cleaning.inf_to_null(flows(spark, sf))


# ---- codes and weights

@query("I1_label_index", f"""WITH {FLOWS}, d AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT label FROM flows))
SELECT l_orderkey, l_linenumber, l_partkey, label, code FROM flows JOIN d USING (label)""")
def i1(spark, sf):
    return features.label_index(flows(spark, sf), "label").select("l_orderkey", "l_linenumber", "l_partkey", "label", "code")


@query("C4_decode_label", f"""WITH {FLOWS} SELECT label AS classe, count(*) AS n FROM flows GROUP BY 1""")
def c4(spark, sf):
    df = flows(spark, sf)
    dictionary = features.label_dictionary(df, "label")
    coded = features.label_index(df, "label", dictionary).select("code")
    return features.decode_label(coded, "code", dictionary).groupBy("classe").agg(F.count("*").alias("n"))


@query("C6_with_weight", f"""WITH {FLOWS}, d AS (SELECT label, count(*) AS n FROM flows GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, round((SELECT sum(n) FROM d) / ((SELECT count(*) FROM d) * n), 9) AS weight FROM flows JOIN d USING (label)""")
def c6(spark, sf):
    df = features.with_weight(flows(spark, sf), "label")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.round("weight", 9).alias("weight"))


# ---- imputation

FILLED = {
    "zero": "0.0", "mean": "(SELECT avg(rate) FROM clean)", "median": "(SELECT quantile_cont(rate, 0.5) FROM clean)",
    "frequent": "(SELECT rate FROM clean WHERE rate IS NOT NULL GROUP BY rate ORDER BY count(*) DESC, rate LIMIT 1)",
}


@query("I2_fill_constant", f"WITH {FLOWS}\n" + "\nUNION ALL\n".join(
    f"SELECT '{how}' AS how, l_orderkey, l_linenumber, l_partkey, round(coalesce(rate, {value}), 9) AS rate FROM clean" for how, value in FILLED.items()))
def i2(spark, sf):
    df = clean(spark, sf)
    parts = [
        imputation.fill_constant(df, "rate", how).select(
            F.lit(how).alias("how"), "l_orderkey", "l_linenumber", "l_partkey", F.round("rate", 9).alias("rate"))
        for how in FILLED
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


MEDIAN = f"""{SPLIT}, tr AS (SELECT * REPLACE (CASE WHEN isinf(rate) THEN NULL ELSE rate END AS rate) FROM parts)"""


@query("I3_median_imputer", f"""WITH {MEDIAN}, m AS (SELECT quantile_cont(rate, 0.5) AS m FROM tr WHERE split = 'train')
SELECT split, count(*) AS n, round(sum(coalesce(rate, (SELECT m FROM m))), 4) AS total FROM tr GROUP BY 1""")
def i3(spark, sf):
    df = durable(cleaning.inf_to_null(split(spark, sf), FEATURES))
    medians = features.fit_median(df.filter("split = 'train'"), FEATURES)
    filled = features.apply_median(df, medians)
    return filled.groupBy("split").agg(F.count("*").alias("n"), F.round(F.sum("rate"), 4).alias("total"))


def _parts(spark, sf):
    df = durable(cleaning.inf_to_null(split(spark, sf), FEATURES))
    return df.filter("split = 'train'"), df.filter("split = 'test'")


def _impute(spark, sf, how, **kw):
    """Per split: rows, cells still missing, known cells, and known cells that kept their value."""
    train, test = (part.withColumn("given", F.col("rate")) for part in _parts(spark, sf))
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    a, b = how(train, test, "rate", names, **kw)
    return a.unionByName(b).groupBy("split").agg(
        F.count("*").alias("n"), F.count_if(F.col("rate").isNull()).alias("missing"), F.count("given").alias("known"),
        F.count_if(F.col("rate") == F.col("given")).alias("unchanged"))


IMPUTED = f"""WITH {MEDIAN} SELECT split, count(*) AS n, CAST(0 AS BIGINT) AS missing, count(rate) AS known, count(rate) AS unchanged FROM tr GROUP BY 1"""


@query("I4_impute_forest", IMPUTED)
def i4(spark, sf):
    return _impute(spark, sf, imputation.impute_forest, trees=10, depth=6)


@query("I6_forest_regressor", IMPUTED)
def i6(spark, sf):
    return _impute(spark, sf, imputation.impute_forest, trees=6, depth=5)


@query("I7_impute_gbt", IMPUTED)
def i7(spark, sf):
    return _impute(spark, sf, imputation.impute_gbt, rounds=5, depth=3)


# A target that the predictors determine, so that a model which learns nothing is found out.
NET = "l_extendedprice * (1 - l_discount)"
_NET_FOLDS = f"""{RANKED}, folded AS (SELECT *, (row_number() OVER (PARTITION BY label {ORDER}) - 1) % 2 AS fold FROM ranked)"""
HELD = f"""WITH {_NET_FOLDS} SELECT CAST(fold + 1 AS INTEGER) AS fold, count(*) AS n, count(*) AS predicted,
 avg(({NET} - l_extendedprice * (1 - l_discount)) ** 2) < var_pop({NET}) AS better_than_mean FROM folded GROUP BY 1"""


def _held(spark, sf, model):
    df = clean(spark, sf).withColumn("net", F.expr(NET))
    # only what the folds and the model read travels and is kept
    needed = df.select(*dict.fromkeys([*KEY, *TIES, *NEAR, "label", "net"]))
    folded = durable(sampling.stratified_folds(needed, "label", 2, 42, KEY, TIES).select(*NEAR, "net", "fold"))
    return imputation.held_fold_scores(folded, "net", NEAR, model, 2)


@query("I6_forest_held_folds", HELD)
def i6b(spark, sf):
    return _held(spark, sf, imputation.forest_model(6, 6))


@query("I7_gbt_held_folds", HELD)
def i7b(spark, sf):
    return _held(spark, sf, imputation.gbt_model(4, 4))


@query("I7_neural_held_folds", HELD)
def i7c(spark, sf):
    return _held(spark, sf, imputation.neural_model((32, 16), 15))


NEAR = ["l_quantity", "l_extendedprice", "l_discount"]
_SQUARES = " + ".join(f"(q.{d} - r.{d}) ** 2" for d in NEAR)


@query("I5_impute_knn", f"""WITH {FLOWS}, d AS (SELECT q.l_orderkey, q.l_partkey, q.l_suppkey, q.l_linenumber, r.rate AS t, sqrt({_SQUARES}) AS dist
 FROM clean q, clean r WHERE q.rate IS NULL AND r.rate IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber ORDER BY dist, t) AS r FROM d),
g AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, avg(t) AS guess FROM k WHERE r <= 5 GROUP BY ALL)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(coalesce(rate, guess), 6) AS rate FROM clean LEFT JOIN g USING (l_orderkey, l_partkey, l_suppkey, l_linenumber)""")
def i5(spark, sf):
    """Every missing rate of the flows, from all three predictors."""
    df = clean(spark, sf).withColumn("key", F.concat_ws("-", *KEY))
    return imputation.impute_knn(df, df, "key", "rate", NEAR).select(*KEY, F.round("rate", 6).alias("rate"))


@query("I8_nrmse_nmae", f"""WITH {FLOWS}, s AS (SELECT quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS iqr FROM clean),
e AS (SELECT l_extendedprice - l_quantity * 900 AS gap FROM clean)
SELECT round(sqrt(avg(gap * gap)) / (SELECT iqr FROM s), 9) AS nrmse, round(avg(abs(gap)) / (SELECT iqr FROM s), 9) AS nmae FROM e""")
def i8(spark, sf):
    df = clean(spark, sf).withColumn("guess", F.col("l_quantity") * 900)
    scale = imputation.error_scale(df, "l_extendedprice")
    return imputation.nrmse_nmae(df, "l_extendedprice", "guess", scale).select(
        F.round("nrmse", 9).alias("nrmse"), F.round("nmae", 9).alias("nmae"))


@query("I9_compare_imputers")
def i9(spark, sf):
    df = clean(spark, sf).withColumn("key", F.concat_ws("-", *KEY))
    fitted = {"Random Forest": imputation.forest_model(5, 4), "GBT": imputation.gbt_model(3, 3)}
    scores = imputation.compare_imputers(
        df, ["rate"], "label", "key", ["l_quantity", "l_extendedprice", "l_discount"], fitted, folds=2)
    return imputation.rank_imputers(scores).select(
        "family", "method", F.round("nrmse", 6).alias("nrmse"), F.round("nmae", 6).alias("nmae"))


_FOLDED = f"""{RANKED}, known AS (SELECT * FROM ranked WHERE rate IS NOT NULL AND NOT isinf(rate)),
folded AS (SELECT *, (row_number() OVER (PARTITION BY label {ORDER}) - 1) % 2 AS fold FROM known),
fit AS (SELECT v.fold, quantile_cont(t.l_extendedprice, 0.75) - quantile_cont(t.l_extendedprice, 0.25) AS iqr, avg(t.l_extendedprice) AS mean, quantile_cont(t.l_extendedprice, 0.5) AS median
 FROM (VALUES (0), (1)) v(fold), folded t WHERE t.fold <> v.fold GROUP BY 1),
guess AS (SELECT fold, iqr, 'Zero' AS method, 0.0 AS g FROM fit UNION ALL SELECT fold, iqr, 'Moyenne', mean FROM fit UNION ALL SELECT fold, iqr, 'Mediane', median FROM fit)"""


@query("I9_constant_scores", f"""WITH {_FOLDED} SELECT CAST(fold + 1 AS INTEGER) AS fold, method,
 round(sqrt(avg((l_extendedprice - g) ** 2)) / any_value(iqr), 6) AS nrmse, round(avg(abs(l_extendedprice - g)) / any_value(iqr), 6) AS nmae
 FROM folded JOIN guess USING (fold) GROUP BY 1, 2""")
def i9b(spark, sf):
    """The constant methods of the comparison, on all rows."""
    known = clean(spark, sf).filter("rate is not null")
    folded = durable(sampling.stratified_folds(known, "label", 2, 42, KEY, TIES))
    out = None
    for fold in (0, 1):
        train, held = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        scale = imputation.error_scale(train, "l_extendedprice")
        for method in ("Zero", "Moyenne", "Mediane"):
            value = imputation.constant_value(train, "l_extendedprice", imputation.CONSTANTS[method])
            scored = imputation.nrmse_nmae(held.withColumn("_p", F.lit(value)), "l_extendedprice", "_p", scale)
            line = scored.select(
                F.lit(fold + 1).alias("fold"), F.lit(method).alias("method"), F.round("nrmse", 6).alias("nrmse"), F.round("nmae", 6).alias("nmae"))
            out = line if out is None else out.unionByName(line)
    return out


# ---- scaling

@query("I10_minmax", f"""WITH {MEDIAN}, b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, min(rate) AS rlo, max(rate) AS rhi FROM tr WHERE split = 'train')
SELECT l_orderkey, l_linenumber, l_partkey, split, round((l_extendedprice - lo) / (hi - lo), 6) AS price, round((rate - rlo) / (rhi - rlo), 6) AS rate FROM tr, b""")
def i10(spark, sf):
    df = durable(cleaning.inf_to_null(split(spark, sf), FEATURES))
    bounds = features.fit_minmax(df.filter("split = 'train'"), FEATURES)
    scaled = features.apply_minmax(df, bounds)
    return scaled.select(
        "l_orderkey", "l_linenumber", "l_partkey", "split", F.round("l_extendedprice", 6).alias("price"), F.round("rate", 6).alias("rate"))


# ---- models: every kind trains and predicts on the whole split

def _coded(spark, sf):
    """The split with label codes, frozen. The classes are those of the flows, so that no row is ranked again for them."""
    classes = features.label_dictionary(flows(spark, sf), "label")
    coded = features.label_index(cleaning.inf_to_null(split(spark, sf), FEATURES), "label", classes)
    return durable(coded.select(*FEATURES, "label", "code", "split"))


def _prepared(spark, sf):
    df = _coded(spark, sf)
    return _weighted(df, features.fit_median(df.filter("split = 'train'"), FEATURES))


def _weighted(df, medians):
    filled = features.apply_median(df, medians)
    bounds = features.fit_minmax(filled.filter("split = 'train'"), FEATURES)
    scaled = features.apply_minmax(filled, bounds)
    weights = features.class_weights(scaled.filter("split = 'train'"), "code")
    weighted = features.with_weight(scaled, "code", weights)
    return weighted.filter("split = 'train'"), weighted.filter("split = 'test'"), bounds


def _report(spark, sf, kind, params):
    train, test, _ = _prepared(spark, sf)
    model = models.train(train, kind, "code", FEATURES, CLASSES, "weight", params)
    matrix = evaluation.confusion(model.transform(test), "code", "prediction", list(range(len(CLASSES))))
    report = evaluation.class_report(matrix, list(range(len(CLASSES))))
    # scores depend on the trees' random choices; supports and the range of the scores do not
    sound = F.least("precision", "recall", "f1").between(0, 1) & F.greatest("precision", "recall", "f1").between(0, 1)
    return report.select("classe", "support", sound.alias("sound"))


SUPPORTS = f"""WITH {SPLIT}, held AS (SELECT label, count(*) FILTER (split = 'test') AS n FROM parts GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS VARCHAR) AS classe, n AS support, true AS sound FROM held
UNION ALL SELECT v.classe, (SELECT CAST(sum(n) AS BIGINT) FROM held), true FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) v(classe)"""


@query("I11_decision_tree", SUPPORTS)
def i11(spark, sf):
    return _report(spark, sf, "decision_tree", {"maxDepth": 8})


@query("I12_random_forest", SUPPORTS)
def i12(spark, sf):
    return _report(spark, sf, "random_forest", TREES)


@query("I13_extra_trees", SUPPORTS)
def i13(spark, sf):
    return _report(spark, sf, "extra_trees", {"numTrees": 3, "maxDepth": 6, "cuts": 16})


@query("I14_logistic_regression", SUPPORTS)
def i14(spark, sf):
    return _report(spark, sf, "logistic_regression", {"maxIter": 20})


@query("I15_naive_bayes", SUPPORTS)
def i15(spark, sf):
    return _report(spark, sf, "naive_bayes", {})


NB = ["l_quantity", "l_extendedprice", "l_discount"]


@query("I15_gaussian_moments", f"WITH {FLOWS}\n" + union_sql(NB, """SELECT label, round(count(*) / (SELECT count(*) FROM clean), 9) AS prior, '{c}' AS variable,
 round(avg({c}), 6) AS mean, round(var_pop({c}), 3) AS var FROM clean GROUP BY label"""))
def i15b(spark, sf):
    return models.gaussian_moments(clean(spark, sf), "label", NB).select(
        "label", F.round("prior", 9).alias("prior"), "variable", F.round("mean", 6).alias("mean"), F.round("var", 3).alias("var"))


_LOGS = " + ".join(f"-0.5 * ln(2 * pi() * (m.v_{c} + 1e-9 * w.w)) - (t.{c} - m.m_{c}) ** 2 / (2 * (m.v_{c} + 1e-9 * w.w))" for c in NB)


@query("I15_gaussian_nb", f"""WITH {SPLIT}, m AS (SELECT label, count(*) / (SELECT count(*) FROM parts WHERE split = 'train') AS p,
 {", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in NB)} FROM parts WHERE split = 'train' GROUP BY 1),
w AS (SELECT greatest({", ".join(f"var_pop({c})" for c in NB)}) AS w FROM parts WHERE split = 'train'),
s AS (SELECT t.l_orderkey, t.l_partkey, t.l_suppkey, t.l_linenumber, t.label AS truth, m.label AS guess, ln(m.p) + {_LOGS} AS score FROM parts t, m, w WHERE t.split = 'test'),
b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber ORDER BY score DESC, guess) AS r FROM s)
SELECT truth AS label, guess AS prediction, count(*) AS n FROM b WHERE r = 1 GROUP BY 1, 2""")
def i15c(spark, sf):
    df = durable(split(spark, sf))
    out = models.gaussian_nb(df.filter("split = 'train'"), df.filter("split = 'test'"), "label", NB)
    return out.groupBy("label", "prediction").agg(F.count("*").alias("n"))


# ---- evaluation on given predictions

def judged(spark, sf):
    return table(spark, sf, "labels").select("doc_id", F.col("quality").cast("long").alias("y"), F.col("toxic").cast("long").alias("yhat"))


CONF = """c(y) AS (VALUES (0), (1), (2)), cm AS (SELECT CAST(c.y AS BIGINT) AS y, count(l.doc_id) FILTER (toxic = 0) AS p_0, count(l.doc_id) FILTER (toxic = 1) AS p_1,
 count(l.doc_id) FILTER (toxic = 2) AS p_2 FROM c LEFT JOIN labels l ON l.quality = c.y GROUP BY 1)"""


@query("I16_confusion", f"WITH {CONF} SELECT * FROM cm")
def i16(spark, sf):
    return evaluation.confusion(judged(spark, sf), "y", "yhat", [0, 1, 2])


@query("I16_confusion_shares", f"WITH {CONF} SELECT y, " + ", ".join(
    f"CASE WHEN p_0 + p_1 + p_2 = 0 THEN 0.0 ELSE round(CAST(p_{i} AS DOUBLE) / (p_0 + p_1 + p_2), 6) END AS p_{i}" for i in range(3)) + " FROM cm")
def i16b(spark, sf):
    return evaluation.confusion_shares(evaluation.confusion(judged(spark, sf), "y", "yhat", [0, 1, 2]))


REPORT = f"""{CONF}, s AS (SELECT y, CASE y WHEN 0 THEN p_0 WHEN 1 THEN p_1 ELSE p_2 END AS tp, p_0 + p_1 + p_2 AS support,
 CASE y WHEN 0 THEN (SELECT sum(p_0) FROM cm) WHEN 1 THEN (SELECT sum(p_1) FROM cm) ELSE (SELECT sum(p_2) FROM cm) END AS pp FROM cm),
r AS (SELECT *, CASE WHEN pp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / pp END AS precision, CASE WHEN support = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / support END AS recall FROM s),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM r),
rep AS (SELECT CAST(y AS VARCHAR) AS classe, precision, recall, f1, support FROM f
 UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM f
 UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM f
 UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f)"""


@query("I17_class_report", f"WITH {REPORT} SELECT classe, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep")
def i17(spark, sf):
    return evaluation.class_report(evaluation.confusion(judged(spark, sf), "y", "yhat", [0, 1, 2]), [0, 1, 2])


@query("I20_errors_by_class", """SELECT CAST(quality AS BIGINT) AS y, count(*) AS total, count(*) FILTER (quality <> toxic) AS errors,
 round(100.0 * count(*) FILTER (quality <> toxic) / count(*), 4) AS error_pct FROM labels GROUP BY 1""")
def i20(spark, sf):
    return evaluation.errors_by_class(judged(spark, sf), "y", "yhat")


@query("I18_rank_models")
def i18(spark, sf):
    train, test, _ = _prepared(spark, sf)
    lines, codes = None, list(range(len(CLASSES)))
    for kind, params in {"decision_tree": {"maxDepth": 5}, "naive_bayes": {}}.items():
        model = models.train(train, kind, "code", FEATURES, CLASSES, "weight", params)
        matrix = evaluation.confusion(model.transform(test), "code", "prediction", codes)
        line = evaluation.model_metrics(evaluation.class_report(matrix, codes), kind)
        lines = line if lines is None else lines.unionByName(line)
    return evaluation.rank_models(lines)


@query("I19_importance")
def i19(spark, sf):
    train, _, _ = _prepared(spark, sf)
    return models.importance(models.train(train, "decision_tree", "code", FEATURES, CLASSES, "weight", {"maxDepth": 5}))


@query("I18_ranking_order", """SELECT v.model, CAST(true AS BOOLEAN) AS in_order, true AS timed FROM (VALUES ('decision_tree'), ('extra_trees'), ('naive_bayes')) v(model)""")
def i18b(spark, sf):
    """The ranking of the end-to-end job: each model's macro F1 against the next one's, and its seconds."""
    prepared = batch.prepare(flows(spark, sf), FEATURES, "label", "source_file", forest_targets=[])
    ranking, _, _ = batch.evaluate_models(prepared, {"naive_bayes": {}, "decision_tree": {"maxDepth": 5}, "extra_trees": {"numTrees": 2, "maxDepth": 4}})
    lines = ranking.collect()  # one line a model
    after = [*(r["f1_macro"] for r in lines[1:]), -1.0]
    told = [(r["model"], r["f1_macro"] >= f, r["fit_seconds"] > 0 and r["score_seconds"] > 0) for r, f in zip(lines, after)]
    return spark.createDataFrame(told, "model string, in_order boolean, timed boolean")


@query("I19_importance_of_what_decides", """SELECT v.kind, v.variable, v.decides FROM (VALUES ('decision_tree', 'l_discount', true), ('decision_tree', 'l_extendedprice', false), ('decision_tree', 'l_quantity', true),
 ('extra_trees', 'l_discount', true), ('extra_trees', 'l_extendedprice', false), ('extra_trees', 'l_quantity', true)) v(kind, variable, decides), (SELECT count(*) AS n FROM lineitem) WHERE n > 0""")
def i19b(spark, sf):
    """Importances where two predictors decide the class: they have nearly all of it, and all sum to one."""
    train, _ = _banded(spark, sf)
    out = None
    for kind, params in {"decision_tree": {"maxDepth": 4}, "extra_trees": {"numTrees": 4, "maxDepth": 6, "featuresPerNode": 3}}.items():
        found = models.importance(models.train(train, kind, "band", NEAR, ["0", "1", "2"], None, params))
        whole = found.agg(F.sum("importance")).scalar()
        line = found.select(F.lit(kind).alias("kind"), "variable", ((F.col("importance") > 0.2) & (F.abs(whole - 1) < 1e-6)).alias("decides"))
        out = line if out is None else out.unionByName(line)
    return out


BAND = "CAST(CASE WHEN l_quantity > 30 THEN 2 WHEN l_discount > 0.045 THEN 1 ELSE 0 END AS INTEGER)"


def _banded(spark, sf):
    """Train and test part with a class that quantity and discount decide."""
    df = durable(split(spark, sf).withColumn("band", F.expr(BAND)).select(*NEAR, "band", "split"))
    return df.filter("split = 'train'"), df.filter("split = 'test'")


@query("I11_models_learn", f"""WITH {SPLIT}, held AS (SELECT {BAND} AS band FROM parts WHERE split = 'test')
SELECT v.kind, CAST(count(*) AS BIGINT) AS support, CAST(count(*) AS BIGINT) AS predicted, true AS better_than_largest
FROM held, (VALUES ('decision_tree'), ('random_forest'), ('extra_trees'), ('logistic_regression'), ('naive_bayes')) v(kind) GROUP BY 1""")
def i11b(spark, sf):
    """Every kind of model on a class that its inputs decide: right more often than the largest class by a fifth of what is left."""
    train, test = _banded(spark, sf)
    kinds = {
        "decision_tree": {"maxDepth": 5}, "random_forest": TREES, "extra_trees": {"numTrees": 5, "maxDepth": 6}, "logistic_regression": {"maxIter": 30}, "naive_bayes": {},
    }
    largest = test.groupBy("band").count().agg(F.max("count") / F.sum("count")).scalar()
    out, shared = None, models.training_matrix(train, "band", NEAR).persist()
    for kind, params in kinds.items():
        matrix = evaluation.confusion(models.train(train, kind, "band", NEAR, ["0", "1", "2"], None, params, shared).transform(test), "band", "prediction", [0, 1, 2])
        scored = evaluation.class_scores(matrix, [0, 1, 2]).withColumn("largest", largest)
        right = F.sum("tp") / F.sum("support")
        line = scored.agg(F.lit(kind).alias("kind"), F.sum("support").alias("support"), F.sum("pp").alias("predicted"), (right > F.max("largest") + (1 - F.max("largest")) / 5).alias("better_than_largest"))
        out = line if out is None else out.unionByName(line)
    shared.unpersist()
    return out.select("kind", "support", "predicted", "better_than_largest")


@query("I21_save_load", f"WITH {SPLIT} SELECT label, count(*) AS n, CAST(0 AS BIGINT) AS differing FROM parts WHERE split = 'test' GROUP BY 1")
def i21(spark, sf):
    from ..plans.checkpoints import scratch_path

    train, test, _ = _prepared(spark, sf)
    model = models.train(train, "decision_tree", "code", FEATURES, CLASSES, "weight", {"maxDepth": 5})
    path = scratch_path(spark, "model")
    model.save(path)
    again = models.Classifier.load(spark, path, FEATURES)
    scored = model.transform(test).select("label", F.col("prediction").alias("before"), *FEATURES)
    both = again.transform(scored)
    return both.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("prediction") != F.col("before")).alias("differing"))


@query("I22_score", f"WITH {FLOWS} SELECT count(*) AS n, count(*) AS scored FROM clean")
def i22(spark, sf):
    df = _coded(spark, sf)
    medians = features.fit_median(df.filter("split = 'train'"), FEATURES)
    train, _, bounds = _weighted(df, medians)
    model = models.train(train, "decision_tree", "code", FEATURES, CLASSES, "weight", {"maxDepth": 5})
    raw = features.apply_median(clean(spark, sf), medians)
    return models.score(raw, model, bounds).agg(F.count("*").alias("n"), F.count_if(F.col("predicted_class").isin(CLASSES)).alias("scored"))


@query("I23_preprocessing_summary", f"""WITH {MEDIAN} SELECT split, count(*) AS rows, CAST(4 AS BIGINT) AS features, count(DISTINCT label) AS classes,
 count(*) FILTER (rate IS NULL) AS missing, CAST(0 AS BIGINT) AS infinite FROM tr GROUP BY 1""")
def i23(spark, sf):
    df = durable(cleaning.inf_to_null(split(spark, sf), FEATURES))
    return models.preprocessing_summary(df, FEATURES, "label")


@query("P1_prepare_and_evaluate")
def p1(spark, sf):
    """Raw flows to ranked models, end to end."""
    prepared = batch.prepare(
        flows(spark, sf), FEATURES, "label", "source_file", forest_targets=["rate"], trees=5, depth=5)
    ranking, _, _ = batch.evaluate_models(prepared, {"decision_tree": {"maxDepth": 5}, "naive_bayes": {}})
    return ranking



"""Classifiers, persistence, scoring and the end-to-end jobs."""

import datetime

import pytest
from pyspark.sql import functions as F

from flowloom.catalog import learning
from flowloom.operators import features, imputation, models
from flowloom.plans import batch


@pytest.fixture(scope="module")
def blobs(spark):
    """Three separable classes, one of them rare."""
    noise = lambda s: F.rand(s) * 2
    code = F.when(F.col("id") % 50 == 0, 2).otherwise(F.col("id") % 2).cast("int")
    df = spark.range(1500, numPartitions=4).select("id", code.alias("code"))
    return df.select("id", "code", (F.col("code") * 10 + noise(1)).alias("a"), (F.col("code") * -5 + noise(2)).alias("b"),
                     F.when(F.col("code") == 2, 25.0).otherwise(1.0).alias("w")).persist()


@pytest.mark.parametrize("kind, params", [
    ("decision_tree", {"maxDepth": 5}), ("random_forest", {"maxDepth": 5, "numTrees": 5}),
    ("extra_trees", {"maxDepth": 5, "numTrees": 3}), ("logistic_regression", {"maxIter": 30}), ("naive_bayes", {}),
])
def test_kinds_learn(spark, blobs, kind, params, tmp_path):
    model = models.train(blobs, kind, "code", ["a", "b"], ["x", "y", "z"], "w", params)
    out = model.transform(blobs)
    assert set(out.columns) == {*blobs.columns, "prediction"} and dict(out.dtypes)["prediction"] == "int"
    assert out.filter("prediction <> code").count() <= 15
    table = models.importance(model)
    assert table.count() == (1 if kind == "naive_bayes" else 2)
    if kind in ("decision_tree", "extra_trees"):
        model.save(str(tmp_path / "m"))
        again = models.Classifier.load(spark, str(tmp_path / "m"), ["a", "b"])
        assert again.transform(blobs).exceptAll(out).isEmpty()
        with pytest.raises(ValueError):
            models.Classifier.load(spark, str(tmp_path / "m"), ["b", "a"])


def test_gaussian_matches_builtin(blobs):
    out = models.gaussian_nb(blobs, blobs, "code", ["a", "b"])
    assert out.filter("prediction <> code").count() <= 5


def test_forest_imputation(spark, blobs):
    holes = blobs.withColumn("t", F.when(F.col("id") % 9 != 0, F.col("a") * 3))
    train, test = holes.filter("id % 4 <> 0"), holes.filter("id % 4 = 0")
    for fill in (imputation.impute_forest(train, test, "t", ["a", "b"], 5, 6), imputation.impute_gbt(train, test, "t", ["a", "b"], 5, 4)):
        done = fill[0].unionByName(fill[1])
        assert done.count() == 1500 and done.filter("t is null").isEmpty()
        assert done.filter("id % 9 <> 0 and t <> a * 3").isEmpty()
        assert done.filter("id % 9 = 0").agg(F.avg(F.abs(F.col("t") - F.col("a") * 3))).first()[0] < 3


def test_prepare_fits_on_train_only(blobs):
    df = blobs.select(
        F.col("a").alias("f a"), F.when(F.col("id") % 13 == 0, float("inf")).otherwise(F.col("b")).alias("f/b"), F.lit(1.0).alias("fixed"),
        F.when(F.col("code") == 0, "BENIGN").when(F.col("code") == 1, "Bot").otherwise("DDoS").alias("Label"), F.lit("Monday").alias("source"))
    ready = batch.prepare(df, ["f a", "f/b", "fixed"], "Label", "source", forest_targets=["f/b"], trees=3, depth=4)
    assert ready.features == ["f a", "f/b"] and ready.data.count() == 1500
    assert ready.data.filter("split = 'test'").count() == 450
    low_high = ready.data.filter("split = 'train'").agg(F.min("`f a`"), F.max("`f a`")).first()
    assert tuple(low_high) == (0.0, 1.0) and ready.data.filter("`f/b` is null").isEmpty()
    ranking, fitted, errors = batch.evaluate_models(ready, {"decision_tree": {"maxDepth": 4}, "naive_bayes": {}})
    assert ranking.count() == 2 and ranking.first()["f1_macro"] > 0.9
    assert errors.agg(F.sum("total")).first()[0] == 450
    upload = df.drop("Label").withColumn("f/b", F.when(F.col("f/b") < float("inf"), F.col("f/b")).otherwise(0.0))
    details, rows = batch.score_upload(upload, "x.csv", "u1", fitted["decision_tree"], ready.bounds)
    assert {r["classe"] for r in details.collect()} <= {"Bot", "DDoS"} and rows.columns[0] == "user_id"


def test_coded_split_ranks_its_rows_for_the_split_only(spark, tmp_path, monkeypatch):
    """The classes come from the flows themselves, and only what the models read is frozen."""
    day = datetime.datetime(1997, 1, 1)
    kinds = [("N", "O"), ("A", "F"), ("R", "F"), (None, "F"), ("A", "O")]
    rows = [(i // 2 if i % 11 else None, i % 7, i % 3, i % 4, float(i % 50), float(i * 10), 0.01 * (i % 10), 0.01 * (i % 8), *kinds[i % 5], day) for i in range(400)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows + rows[:20], names).write.parquet(f"{tmp_path}/lineitem.parquet")
    asked, real = [], features.label_dictionary

    def watched(df, label):
        asked.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(features, "label_dictionary", watched)
    coded = learning._coded(spark, str(tmp_path))
    assert len(asked) == 1 and "md5" not in asked[0] and coded.columns == [*learning.FEATURES, "label", "code", "split"]
    want = {label: i for i, label in enumerate(sorted({r["label"] for r in coded.select("label").distinct().collect()}))}
    assert {(r["label"], r["code"]) for r in coded.collect()} == set(want.items()) and len(want) == 5
    assert {r["split"]: r["count"] for r in coded.groupBy("split").count().collect()} == {"train": 294, "test": 126}


def test_kinds_share_a_training_matrix(spark, blobs, monkeypatch):
    """Nothing is frozen again for a kind that is given the matrix, which stays cached, and the model is the same."""
    shared = models.training_matrix(blobs, "code", ["a", "b"], "w").persist()
    own = models.train(blobs, "decision_tree", "code", ["a", "b"], ["x", "y", "z"], "w", {"maxDepth": 5})
    monkeypatch.setattr(models, "durable", None)
    for kind, params in {"decision_tree": {"maxDepth": 5}, "extra_trees": {"maxDepth": 4, "numTrees": 2}}.items():
        model = models.train(blobs, kind, "code", ["a", "b"], ["x", "y", "z"], "w", params, shared)
        assert shared.storageLevel.useMemory and model.transform(blobs).filter("prediction <> code").count() <= 15
        if kind == "decision_tree":
            assert model.members[0].stages[-1].toDebugString.split("\n")[1:] == own.members[0].stages[-1].toDebugString.split("\n")[1:]
    shared.unpersist()

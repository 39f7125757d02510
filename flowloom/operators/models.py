"""Class-weighted classifiers, importance, persistence and batch scoring."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import col
from ..plans.checkpoints import durable, spread
from .extra_trees import ExtraTreesModel, grow
from .features import apply_minmax

SEED = 42
TREE = {"maxBins": 256, "minInstancesPerNode": 1, "cacheNodeIds": False, "maxMemoryInMB": 512, "seed": SEED}
KINDS = ["decision_tree", "random_forest", "extra_trees", "logistic_regression", "naive_bayes"]


@dataclass
class Classifier:
    """A fitted model with the feature order and classes it was trained on."""

    kind: str
    features: list[str]
    classes: list[str]
    members: list[PipelineModel | ExtraTreesModel] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (int code). Several members vote with their class probabilities."""
        ready = df.withColumns({f"_f{i}": col(c).cast("double") for i, c in enumerate(self.features)})
        scores = []
        for m, member in enumerate(self.members):
            before = set(ready.columns)
            ready = member.transform(ready)
            shares = F.col("_probability") if isinstance(member, ExtraTreesModel) else vector_to_array("_probability")
            ready = ready.withColumn(f"_p{m}", shares)
            ready = ready.drop(*(set(ready.columns) - before - {f"_p{m}"}))
            scores.append(F.col(f"_p{m}"))
        total = scores[0]
        for other in scores[1:]:
            total = F.zip_with(total, other, lambda a, b: a + b)
        code = F.array_position(total, F.array_max(total)).cast("int") - 1
        added = [f"_f{i}" for i in range(len(self.features))] + [f"_p{m}" for m in range(len(self.members))]
        return ready.withColumn("prediction", code.cast("int")).drop(*added)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = {"kind": self.kind, "features": self.features, "classes": self.classes, "members": len(self.members)}
        for i, member in enumerate(self.members):
            if isinstance(member, ExtraTreesModel):
                member.save(f"{path}/member-{i}")
            else:
                member.write().overwrite().save(f"{path}/member-{i}")
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @staticmethod
    def load(spark: SparkSession, path: str, features: list[str] | None = None) -> "Classifier":
        """Reload a model; raises when the given feature order differs from the stored one."""
        meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
        if features is not None and list(features) != meta["features"]:
            raise ValueError("feature names or their order differ from the trained model")
        kind = ExtraTreesModel if meta["kind"] == "extra_trees" else PipelineModel
        members = [kind.load(f"{path}/member-{i}") for i in range(meta["members"])]
        return Classifier(meta["kind"], meta["features"], meta["classes"], members)


def _stage(kind: str, weight: str | None, params: dict):
    common = {"labelCol": "_label", "featuresCol": "_vector", "probabilityCol": "_probability", "rawPredictionCol": "_raw", "predictionCol": "_code"}
    if weight and kind != "naive_bayes":
        common["weightCol"] = weight
    if kind == "decision_tree":
        return DecisionTreeClassifier(**common, **(TREE | {"maxDepth": 30} | params))
    if kind == "random_forest":
        return RandomForestClassifier(**common, **(TREE | {"maxDepth": 30, "numTrees": 20} | params))
    if kind == "logistic_regression":
        return LogisticRegression(**common, **({"family": "multinomial", "maxIter": 1000} | params))
    if kind == "naive_bayes":
        return NaiveBayes(**common, **({"modelType": "gaussian"} | params))
    raise ValueError(f"unknown classifier: {kind}")


def _extra_trees(rows: DataFrame, names: list[str], classes: int, weight: str | None, params: dict) -> ExtraTreesModel:
    """Extremely randomised trees on all rows; ``featuresPerNode`` is the root of the number of features unless given."""
    most = params.get("featuresPerNode", max(1, math.isqrt(len(names))))
    weighted = rows.select(*names, "_label", (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_weight"))
    forest = grow(weighted, names, classes, params.get("numTrees", 20), params.get("maxDepth", 30), most, params.get("seed", SEED))
    return ExtraTreesModel(forest, len(names))


def training_matrix(df: DataFrame, label: str, cols: list[str], weight: str | None = None) -> DataFrame:
    """What a fit reads, frozen once, so a lost executor does not bring back the whole preparation in the middle of it."""
    features = [col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(cols)]
    return spread(durable(df.select(*features, col(label).cast("double").alias("_label"), *([col(weight)] if weight else []))))


def train(
    df: DataFrame, kind: str, label: str, cols: list[str], classes: list[str], weight: str | None = None,
    params: dict | None = None, matrix: DataFrame | None = None,
) -> Classifier:
    """Fit one classifier on integer codes in ``label`` and the given features.

    ``matrix``: the ``training_matrix`` of the same rows and columns, where several kinds are fitted on it.
    """
    names = [f"_f{i}" for i in range(len(cols))]
    ready = matrix if matrix is not None else training_matrix(df, label, cols, weight).persist()
    try:
        if kind == "extra_trees":
            members = [_extra_trees(ready, names, len(classes), weight, params or {})]
        else:
            stages = [VectorAssembler(inputCols=names, outputCol="_vector"), _stage(kind, weight, params or {})]
            members = [Pipeline(stages=stages).fit(ready)]
    finally:
        if matrix is None:
            ready.unpersist()
    return Classifier(kind, list(cols), [str(c) for c in classes], members)


def importance(model: Classifier) -> DataFrame:
    """Feature importance (mean over members) or mean absolute coefficient, largest first."""
    spark = SparkSession.getActiveSession()
    if isinstance(model.members[0], ExtraTreesModel):
        rows = list(zip(model.features, model.members[0].importances))
        return spark.createDataFrame(rows, "variable string, importance double").orderBy(F.desc("importance"), "variable")
    last = [m.stages[-1] for m in model.members]
    if hasattr(last[0], "featureImportances"):
        values = [sum(float(m.featureImportances[i]) for m in last) / len(last) for i in range(len(model.features))]
    elif hasattr(last[0], "coefficientMatrix"):
        matrix = abs(last[0].coefficientMatrix.toArray()).mean(axis=0)
        values = [float(v) for v in matrix]
    else:
        return spark.createDataFrame([("Non disponible", None)], "variable string, importance double")
    rows = list(zip(model.features, values))
    return spark.createDataFrame(rows, "variable string, importance double").orderBy(F.desc("importance"), "variable")


def score(df: DataFrame, model: Classifier, bounds: DataFrame | None = None) -> DataFrame:
    """Scale raw flows with the training bounds, predict, and name the class."""
    ready = apply_minmax(df, bounds) if bounds is not None else df
    names = F.array(*map(F.lit, model.classes))
    return model.transform(ready).withColumn("predicted_class", names[F.col("prediction")])


def preprocessing_summary(df: DataFrame, cols: list[str], label: str, split: str = "split") -> DataFrame:
    """Rows, features, classes, and the missing or infinite cells that remain per part."""
    missing = sum((col(c).isNull().cast("long") for c in cols), F.lit(0))
    infinite = sum((F.coalesce(F.abs(col(c)) == float("inf"), F.lit(False)).cast("long") for c in cols), F.lit(0))
    return df.groupBy(split).agg(
        F.count("*").alias("rows"), F.lit(len(cols)).cast("long").alias("features"),
        F.count_distinct(col(label)).alias("classes"), F.sum(missing).alias("missing"), F.sum(infinite).alias("infinite"),
    )


def gaussian_moments(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """(label, variable, prior, mean, var): all that a Gaussian naive Bayes model stores."""
    total = df.agg(F.count("*")).scalar()
    stats = [
        F.struct(F.lit(c).alias("variable"), F.avg(col(c)).alias("mean"), F.var_pop(col(c)).alias("var")).alias(f"s{i}")
        for i, c in enumerate(cols)
    ]
    wide = df.groupBy(label).agg(F.count("*").alias("n"), *stats)
    cells = F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")
    return wide.select(label, (F.col("n") / total).alias("prior"), cells).select(label, "prior", "s.*")


def gaussian_nb(train_rows: DataFrame, test: DataFrame, label: str, cols: list[str], smoothing: float = 1e-9) -> DataFrame:
    """Predict the class with the largest Gaussian log likelihood; ties go to the smallest label."""
    moments = gaussian_moments(train_rows, label, cols).orderBy(label).collect()  # classes x features
    widest = max(train_rows.agg(*[F.var_pop(col(c)) for c in cols]).first())
    by_class: dict = {}
    for r in moments:
        by_class.setdefault(r[label], (r["prior"], {}))[1][r["variable"]] = (r["mean"], r["var"] + smoothing * widest)
    scores = []
    for name, (prior, parts) in by_class.items():
        likelihood: Column = F.lit(math.log(prior))
        for c, (mean, var) in parts.items():
            likelihood = likelihood - 0.5 * math.log(2 * math.pi * var) - (col(c) - mean) * (col(c) - mean) / (2 * var)
        scores.append((name, likelihood))
    best = F.greatest(*[s for _, s in scores]) if len(scores) > 1 else scores[0][1]
    chosen = F
    for name, s in scores:
        chosen = chosen.when(s == best, F.lit(name))
    return test.withColumn("prediction", chosen)

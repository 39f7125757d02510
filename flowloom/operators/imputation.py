"""Missing-value models and their comparison by cross-validation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import col
from ..plans.bounded import lookup_join
from ..plans.checkpoints import durable, spread
from ..plans.quantiles import BUFFER_CELLS, exact_quantiles
from ..plans.ranking import WINDOW_ROWS
from .features import fit_median
from .neighbours import LEAF, nearest_lists
from .neural import NeuralRegressor
from .sampling import cap_rows, fold_count, stratified_folds

SEED = 42


def constant_value(df: DataFrame, c: str, how: str, buffer_cells: int = BUFFER_CELLS) -> float | None:
    """Zero, mean, median or most frequent value (the smallest one on a tie)."""
    x = col(c).cast("double")
    if how == "zero":
        return 0.0
    if how == "mean":
        return df.agg(F.avg(x)).first()[0]
    if how == "median":
        return exact_quantiles(df, {c: x}, [0.5], buffer_cells)[c][0]
    if how == "frequent":
        counted = df.filter(x.isNotNull()).groupBy(x.alias("x")).agg(F.count("*").alias("n"))
        best = counted.orderBy(F.desc("n"), "x").first()
        return best["x"] if best else None
    raise ValueError(f"unknown constant: {how}")


def fill_constant(df: DataFrame, c: str, how: str, fit_on: DataFrame | None = None) -> DataFrame:
    value = constant_value(fit_on if fit_on is not None else df, c, how)
    return df.withColumn(c, F.coalesce(col(c).cast("double"), F.lit(value)))


def _regression(train: DataFrame, test: list[DataFrame], target: str, cols: list[str], model, medians: dict[str, float] | None = None) -> list[DataFrame]:
    """Fit on known training rows with median-filled inputs; add ``prediction`` to every table.

    ``medians``: those of the training rows, where they are known already.
    """
    known = train.filter(col(target).isNotNull())
    medians = fit_median(train, cols) if medians is None else medians
    fill = lambda df: df.withColumns(
        {f"_x{i}": F.coalesce(col(c).cast("double"), F.lit(medians.get(c, 0.0))) for i, c in enumerate(cols)}
    )
    names = [f"_x{i}" for i in range(len(cols))]
    matrix = fill(known).select(*names, col(target).cast("double").alias("_y"))
    if isinstance(model, NeuralRegressor):
        ready = spread(durable(matrix)).persist()
        network = model.fit(ready, names)
        ready.unpersist()
        return [network.transform(fill(df), names).drop(*names) for df in test]
    assembler = VectorAssembler(inputCols=names, outputCol="_features")
    model = model.copy().setLabelCol("_y").setFeaturesCol("_features").setPredictionCol("prediction")
    ready = spread(durable(matrix)).persist()
    fitted = Pipeline(stages=[assembler, model]).fit(ready)
    ready.unpersist()
    return [fitted.transform(fill(df)).drop("_features", *names) for df in test]


def forest_model(trees: int = 80, depth: int = 14) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=False, maxMemoryInMB=512)


def gbt_model(rounds: int = 20, depth: int = 5) -> GBTRegressor:
    return GBTRegressor(maxIter=rounds, maxDepth=depth, seed=SEED)


def neural_model(hidden: tuple[int, ...] = (32, 16), rounds: int = 100) -> NeuralRegressor:
    return NeuralRegressor(tuple(hidden), rounds, seed=SEED)


def _impute(train, test, target, cols, model) -> tuple[DataFrame, DataFrame]:
    guessed = _regression(train, [train, test], target, cols, model)
    return tuple(
        g.withColumn(target, F.coalesce(col(target).cast("double"), F.col("prediction"))).drop("prediction")
        for g in guessed
    )


def impute_forest(train, test, target, cols, trees: int = 80, depth: int = 14) -> tuple[DataFrame, DataFrame]:
    """Replace nulls of ``target`` in both parts by a forest fitted on known training rows."""
    return _impute(train, test, target, cols, forest_model(trees, depth))


def impute_gbt(train, test, target, cols, rounds: int = 20, depth: int = 5) -> tuple[DataFrame, DataFrame]:
    return _impute(train, test, target, cols, gbt_model(rounds, depth))


def impute_neural(train, test, target, cols, hidden: tuple[int, ...] = (32, 16), rounds: int = 100) -> tuple[DataFrame, DataFrame]:
    return _impute(train, test, target, cols, neural_model(hidden, rounds))


def held_fold_scores(folded: DataFrame, target: str, cols: list[str], model, folds: int) -> DataFrame:
    """Per fold: held rows, rows with a prediction, and whether the squared error is below that of the training mean."""
    out = None
    for f in range(folds):
        train, held = folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f)
        (scored,) = _regression(train, [held], target, cols, model)
        y, mean = col(target).cast("double"), train.agg(F.avg(col(target).cast("double"))).scalar()
        line = scored.withColumn("_m", mean).agg(
            F.lit(f + 1).alias("fold"), F.count("*").alias("n"), F.count("prediction").alias("predicted"),
            (F.avg((y - F.col("prediction")) ** 2) < F.avg((y - F.col("_m")) ** 2)).alias("better_than_mean"))
        out = line if out is None else out.unionByName(line)
    return out


def impute_knn(
    reference: DataFrame, query: DataFrame, key: str, target: str, cols: list[str], k: int = 5,
    leaf: int = LEAF,
) -> DataFrame:
    """Replace null targets of ``query`` by the mean of the k nearest known values.

    A row without any comparable neighbour gets the reference mean.
    """
    asked = query.filter(col(target).isNull())
    found = nearest_lists(reference, asked, key, target, cols, k, leaf)
    total = F.aggregate("value", F.lit(0.0), lambda a, v: a + v)
    mean = durable(found.select("key", (total / F.size("value")).alias("_guess")))
    keyed = query.withColumn("key", col(key).cast("string"))
    fallback = reference.agg(F.avg(col(target).cast("double")))
    joined = lookup_join(keyed, mean, ["key"]).drop("key")
    return joined.withColumn(
        target, F.coalesce(col(target).cast("double"), F.col("_guess"), fallback.scalar())
    ).drop("_guess")


def error_scale(reference: DataFrame, target: str, buffer_cells: int = BUFFER_CELLS) -> float:
    """IQR of the reference values, their deviation when it is zero, else one."""
    x = col(target).cast("double")
    q1, q3 = exact_quantiles(reference, {"x": x}, [0.25, 0.75], buffer_cells)["x"]
    if q1 is not None and q3 > q1:
        return q3 - q1
    return reference.agg(F.stddev_pop(x)).first()[0] or 1.0


def nrmse_nmae(df: DataFrame, truth: str, pred: str, scale: float) -> DataFrame:
    """Root mean square and mean absolute error divided by ``scale``."""
    gap = col(truth).cast("double") - col(pred)
    return df.agg(
        (F.sqrt(F.avg(gap * gap)) / scale).alias("nrmse"), (F.avg(F.abs(gap)) / scale).alias("nmae")
    )


CONSTANTS = {"Zero": "zero", "Moyenne": "mean", "Mediane": "median", "Valeur frequente": "frequent"}


def compare_imputers(
    df: DataFrame, targets: list[str], label: str, key: str, features: list[str], models: dict | None = None,
    sample: int | None = None, validation: int | None = None, folds: int | None = None, k: int = 5,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """NRMSE and NMAE of every method per target and fold, on all rows.

    ``sample`` and ``validation``, where given, are the sizes of a sampled comparison.
    """
    models = models if models is not None else {"Random Forest": forest_model(60, 12), "GBT": gbt_model(), "Reseau de neurones": neural_model()}
    spark = df.sparkSession
    lines = []
    for target in targets:
        known = df.filter(col(target).isNotNull())
        if sample is not None:
            known = cap_rows(known, sample, SEED, [key], (), window_rows)
        k_folds = folds or fold_count(known.groupBy(label).agg(F.count("*").alias("n")))
        folded = stratified_folds(known, label, k_folds, SEED, [key], [], window_rows).persist()
        used = [c for c in features if c != target]
        for f in range(k_folds):
            train, held = folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f)
            if validation is not None:
                held = cap_rows(held, validation, SEED + f + 1, [key], (), window_rows)
            scale = error_scale(train, target)
            score = lambda d, p: nrmse_nmae(d, target, p, scale).first()  # noqa: E731,B023
            for method, how in CONSTANTS.items():
                value = constant_value(train, target, how)
                lines.append((target, f + 1, method, "Statistique", *score(held.withColumn("_p", F.lit(value)), "_p")))
            masked = held.withColumn("_truth", col(target)).withColumn(target, F.lit(None).cast("double"))
            guessed = impute_knn(train, masked, key, target, used, k)
            lines.append(
                (target, f + 1, "KNN", "Machine Learning", *nrmse_nmae(guessed, "_truth", target, scale).first())
            )
            medians = fit_median(train, used)
            for method, model in models.items():
                (predicted,) = _regression(train, [held], target, used, model, medians)
                lines.append((target, f + 1, method, "Machine Learning", *score(predicted, "prediction")))
        folded.unpersist()
    return spark.createDataFrame(
        lines, "variable string, fold int, method string, family string, nrmse double, nmae double"
    )


def rank_imputers(scores: DataFrame) -> DataFrame:
    """Mean errors per method, best first by NMAE, then NRMSE."""
    means = scores.groupBy("family", "method").agg(F.avg("nrmse").alias("nrmse"), F.avg("nmae").alias("nmae"))
    return means.orderBy("nmae", "nrmse")



"""The three end-to-end jobs, declared from the operators."""

from __future__ import annotations

import time

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import normalize_label
from ..functions.rules import in_scaled_range, resolve_class
from ..functions.scalars import col
from ..operators.alerts import scoring_summary
from ..operators.cleaning import dedup, inf_to_null
from ..operators.evaluation import class_report, confusion, errors_by_class, model_metrics, rank_models
from ..operators.features import (
    apply_median, apply_minmax, class_weights, fit_median, fit_minmax, kept_columns, label_index,
    usable_columns, with_weight,
)
from ..operators.history import to_history
from ..operators.imputation import impute_forest
from ..operators.models import Classifier, score, train
from ..operators.sampling import stratified_split
from .checkpoints import durable
from .ranking import WINDOW_ROWS


@dataclass
class Prepared:
    """A scaled, weighted, split dataset with everything needed to apply it to new flows."""

    data: DataFrame
    features: list[str]
    dictionary: DataFrame
    medians: dict[str, float]
    bounds: DataFrame
    weights: DataFrame


def prepare(
    flows: DataFrame, features: list[str], label: str, source: str, seed: int = 42, test_share: float = 0.3,
    forest_targets: list[str] = (), trees: int = 80, depth: int = 14, window_rows: int = WINDOW_ROWS,
    most_predictors: int | None = None,
) -> Prepared:
    """Clean, deduplicate, split, impute, drop constants, scale and weigh.

    Everything is fitted on the train part only. The cleaned split is frozen once, because all
    later fits read it.
    """
    named = flows.withColumn(label, normalize_label(col(label))).select(*[col(c) for c in (*features, label, source)])
    # frozen, because the dictionary, the class sizes, the cuts of the split and the split itself all read it
    clean = durable(dedup(inf_to_null(named, features)))
    coded = label_index(clean, label)
    # rows are distinct by now; should two hashes meet, the split still counts them exactly
    whole = [col(c) for c in (*features, label, source)]
    keyed = coded.withColumn("_key", F.concat_ws("-", F.xxhash64(*whole), F.hash(*whole)))
    data = durable(stratified_split(keyed, label, test_share, seed, ["_key"], (), window_rows).drop("_key"), ("split",))
    dictionary = durable(data.select("code", col(label).alias("classe")).distinct())
    fit_on = data.filter("split = 'train'")
    medians = fit_median(fit_on, features)
    usable = usable_columns(fit_on, features)
    for target in forest_targets:
        predictors = [c for c in usable if c != target][:most_predictors]
        if predictors and not data.filter(col(target).isNull()).isEmpty():
            fit_on, data = impute_forest(fit_on, data, target, predictors, trees, depth)
    filled = durable(apply_median(data, medians), ("split",))
    kept = kept_columns(filled.filter("split = 'train'"), features)
    bounds = fit_minmax(filled.filter("split = 'train'"), kept)
    scaled = apply_minmax(filled, bounds).select(*[col(c) for c in kept], label, "code", source, "split")
    weights = class_weights(scaled.filter("split = 'train'"), "code")
    weighted = with_weight(scaled, "code", weights)
    return Prepared(weighted, kept, dictionary, medians, bounds, weights)


def evaluate_models(prepared: Prepared, kinds: dict[str, dict]) -> tuple[DataFrame, dict[str, Classifier], DataFrame]:
    """Train every kind on the train part, score the test part, rank by macro F1.

    Returns the ranking with the seconds of fitting and of scoring, the models, and the errors per class of the best one.
    """
    classes = [r["classe"] for r in prepared.dictionary.orderBy("code").collect()]
    codes = list(range(len(classes)))
    fit_on, test = (prepared.data.filter(F.col("split") == s) for s in ("train", "test"))
    models, lines, predictions = {}, None, {}
    for kind, params in kinds.items():
        began = time.monotonic()
        models[kind] = train(fit_on, kind, "code", prepared.features, classes, "weight", params)
        fitted = time.monotonic()
        predictions[kind] = models[kind].transform(test).select("code", "prediction").persist()
        matrix = durable(confusion(predictions[kind], "code", "prediction", codes))
        seconds = {"fit_seconds": F.lit(fitted - began), "score_seconds": F.lit(time.monotonic() - fitted)}
        line = model_metrics(class_report(matrix, codes), kind).withColumns(seconds)
        lines = line if lines is None else lines.unionByName(line)
    ranking = rank_models(durable(lines))
    best = ranking.first()["model"]
    errors = durable(errors_by_class(predictions[best], "code", "prediction"))
    for kept in predictions.values():
        kept.unpersist()
    return ranking, models, errors


def score_upload(
    flows: DataFrame, file: str, user: str, model: Classifier | None = None, bounds: DataFrame | None = None,
    now: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Classify an upload and turn its attack classes into register rows: (details, history rows)."""
    prediction = None
    if model is not None and not set(model.features) - set(flows.columns):
        flows, prediction = score(flows, model, bounds), F.col("predicted_class")
        if bounds is None:
            # without training bounds only rows that are scaled already can be given to the model
            prediction = F.when(in_scaled_range(model.features), prediction)
    labelled = resolve_class(flows, prediction)
    details = scoring_summary(labelled, "classe")
    return details, to_history(details, "CSV", file, user, now)

"""Confusion matrix, class report, model ranking and errors per class."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col
from ..plans.bounded import lookup_join


def _known(spark, classes: list) -> DataFrame:
    kind = "long" if all(isinstance(c, int) for c in classes) else "string"
    return spark.createDataFrame([(c,) for c in classes], f"y {kind}")


def confusion(df: DataFrame, y: str, yhat: str, classes: list) -> DataFrame:
    """Dense matrix: one row per true class, one count column per predicted class."""
    kind = _known(df.sparkSession, classes).schema["y"].dataType
    hits = [F.count_if(col(yhat) == F.lit(c)).alias(f"p_{c}") for c in classes]
    table = df.groupBy(col(y).cast(kind).alias("y")).agg(*hits)
    full = lookup_join(_known(df.sparkSession, classes), table, ["y"])
    return full.select("y", *[F.coalesce(col(f"p_{c}"), F.lit(0)).alias(f"p_{c}") for c in classes])


def confusion_shares(matrix: DataFrame, digits: int = 6) -> DataFrame:
    """Rows divided by their sum; an empty row stays zero."""
    cells = [c for c in matrix.columns if c != "y"]
    whole = reduce(lambda a, b: a + b, [col(c) for c in cells])
    return matrix.select(
        "y", *[F.round(F.coalesce(F.try_divide(col(c), whole), F.lit(0.0)), digits).alias(c) for c in cells]
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_scores(matrix: DataFrame, classes: list) -> DataFrame:
    """Unrounded precision, recall, F1 and support per class."""
    diagonal = reduce(lambda a, b: a + b, [F.when(F.col("y") == F.lit(c), col(f"p_{c}")).otherwise(0) for c in classes])
    support = reduce(lambda a, b: a + b, [col(f"p_{c}") for c in classes])
    totals = matrix.agg(
        F.map_from_arrays(
            F.array(*[F.lit(str(c)) for c in classes]), F.array(*[F.sum(col(f"p_{c}")) for c in classes])
        )
    )
    predicted = F.try_element_at(totals.scalar(), F.col("y").cast("string"))
    scored = matrix.select(
        F.col("y").cast("string").alias("classe"), diagonal.alias("tp"), support.alias("support"), predicted.alias("pp")
    )
    precision, recall = _ratio(F.col("tp"), F.col("pp")), _ratio(F.col("tp"), F.col("support"))
    return scored.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def class_report(matrix: DataFrame, classes: list, digits: int = 6) -> DataFrame:
    """Per class scores plus accuracy, macro and weighted averages; division by zero gives zero."""
    scores = class_scores(matrix, classes)
    names = ["precision", "recall", "f1"]
    support = F.sum("support")
    accuracy = _ratio(F.sum("tp"), support)
    macro = [F.avg(n).alias(n) for n in names]
    weighted = [_ratio(F.sum(F.col(n) * F.col("support")), support).alias(n) for n in names]
    rows = scores.select("classe", *names, "support")
    rows = rows.unionByName(
        scores.agg(accuracy.alias("a"), support.alias("support")).select(
            F.lit("accuracy").alias("classe"), *[F.col("a").alias(n) for n in names], "support"
        )
    )
    for title, parts in (("macro avg", macro), ("weighted avg", weighted)):
        rows = rows.unionByName(
            scores.agg(*parts, support.alias("support")).select(F.lit(title).alias("classe"), *names, "support")
        )
    return rows.select("classe", *[F.round(n, digits).alias(n) for n in names], "support")


def model_metrics(report: DataFrame, model: str) -> DataFrame:
    """One line per model from its class report."""
    pick = lambda row, n: F.max(F.when(F.col("classe") == row, F.col(n)))
    wanted = {"accuracy": ("accuracy", "f1")} | {
        f"{n}_{short}": (row, n)
        for row, short in (("macro avg", "macro"), ("weighted avg", "weighted"))
        for n in ("precision", "recall", "f1")
    }
    return report.agg(*[F.round(pick(*w), 4).alias(n) for n, w in wanted.items()]).select(
        F.lit(model).alias("model"), *wanted
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models by macro F1, best first."""
    return metrics.orderBy(F.desc("f1_macro"), "model")


def errors_by_class(df: DataFrame, y: str, yhat: str) -> DataFrame:
    wrong = F.count_if(col(y) != col(yhat))
    return df.groupBy(col(y).alias("y")).agg(
        F.count("*").alias("total"), wrong.alias("errors"), F.round(100.0 * wrong / F.count("*"), 4).alias("error_pct")
    )

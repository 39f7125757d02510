"""The neural regressor: gradients against differences, sums over tasks, and what it learns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.operators import imputation
from flowloom.operators.neural import NeuralRegressor, initial, loss_and_gradient, minimise, predict, shapes, total_gradient


@pytest.mark.parametrize("hidden", [(), (5,), (6, 4)])
def test_gradient_is_that_of_the_loss(hidden):
    rng = np.random.default_rng(1)
    layers = shapes(3, hidden)
    x, y, w = rng.normal(size=(40, 3)), rng.normal(size=40), initial(layers, 3) + 0.1
    _, gradient = loss_and_gradient(w, layers, x, y)
    for i in range(len(w)):
        up, down = w.copy(), w.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        assert gradient[i] == pytest.approx((loss_and_gradient(up, layers, x, y)[0] - loss_and_gradient(down, layers, x, y)[0]) / 2e-6, rel=1e-4, abs=1e-4)


def test_tasks_sum_to_the_whole(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(200, 2)), rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, _y double")
    layers = shapes(2, (4,))
    w = initial(layers)
    loss, gradient = loss_and_gradient(w, layers, x, y)
    for parts in (1, 7):
        got, some = total_gradient(df.repartition(parts), ["a", "b"], layers, w, 0.0)
        assert got == pytest.approx(loss / 200) and some == pytest.approx(gradient / 200)


def test_minimiser_finds_a_valley():
    def bowl(w):
        a = np.array([1.0, 100.0])
        return float(0.5 * (a * (w - 3) ** 2).sum()), a * (w - 3)

    assert minimise(bowl, np.zeros(2), 50, 1e-14) == pytest.approx([3, 3], abs=1e-3)


def test_learns_what_a_line_cannot(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-2, 2, (600, 2))
    y = np.abs(x[:, 0]) * 10 + x[:, 1] + 500
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, _y double").repartition(3).persist()
    model = NeuralRegressor((8, 4), 60).fit(df, ["a", "b"])
    gap = y - (model.y_mean + model.y_spread * predict(model.weights, model.layers, (x - model.mean) / model.spread))
    assert (gap**2).mean() < 0.1 * y.var()
    scored = model.transform(df, ["a", "b"]).agg(F.avg((F.col("_y") - F.col("prediction")) ** 2)).first()[0]
    assert scored == pytest.approx((gap**2).mean())


def test_imputes_and_keeps_what_is_known(spark):
    rows = [(float(i % 17), float(i % 5), None if i % 9 == 0 else (i % 17) * 2.0 + (i % 5)) for i in range(300)] + [(None, None, 4.0), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, t double")
    a, b = imputation.impute_neural(df, df.limit(20), "t", ["a", "b"], (6,), 30)
    assert a.filter("t is null").isEmpty() and b.count() == 20 and a.columns == df.columns
    known = a.filter("a = 3 and b = 3").select("t").distinct().collect()
    assert any(abs(r["t"] - 9.0) < 1e-9 for r in known)
    empty, _ = imputation.impute_neural(df.limit(0), df.limit(0), "t", ["a", "b"], (6,), 3)
    assert empty.count() == 0

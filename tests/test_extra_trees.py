"""Extremely randomised trees against a plain version with the same draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.operators import models
from flowloom.operators.extra_trees import Forest, draw_splits, grow

NAMES = ["a", "b", "c", "d"]


def rows(rng, n=400):
    x = rng.normal(size=(n, 4))
    x[:, 3] = 1.0
    x[rng.random((n, 4)) < 0.05] = np.nan
    y = (np.nan_to_num(x[:, 0]) + np.nan_to_num(x[:, 1]) ** 2 > 0.7).astype(int) + (np.nan_to_num(x[:, 2]) > 1)
    return x, y, rng.integers(0, 4, n).astype(float)


def plain(x, y, w, classes, trees, depth, most, seed):
    """Breadth first over all trees, one node at a time; nodes as (rows, children)."""
    nodes, left, split = [np.flatnonzero(w > 0) for _ in range(trees)], {}, {}
    open_ = list(range(trees))
    for _ in range(depth):
        chosen = []
        for node in open_:
            part = nodes[node]
            if len(set(y[part])) < 2:
                continue
            known = ~np.isnan(x[part])
            low, high = np.where(known, x[part], np.inf).min(axis=0), np.where(known, x[part], -np.inf).max(axis=0)
            if not (high > low).any():
                continue
            feature, threshold = (v[0] for v in draw_splits(seed, np.array([node]), low[None], high[None], most))
            best = None
            for f, t in zip(feature, threshold):
                if f >= 0:
                    right = x[part, f] > t
                    sides = [np.bincount(y[part[s]], w[part[s]], classes) for s in (~right, right)]
                    purity = sum((s**2).sum() / s.sum() for s in sides)
                    if best is None or purity > best[0]:
                        best = (purity, f, t, part[~right], part[right])
            if best:
                chosen.append((node, best))
        before = len(nodes)
        for node, (_, f, t, a, b) in chosen:
            left[node], split[node] = len(nodes), (f, t)
            nodes += [a, b]
        open_ = list(range(before, len(nodes)))
    weights = [np.bincount(y[n], w[n], classes) for n in nodes]
    return left, split, np.array(weights)


@pytest.fixture(scope="module")
def data(spark):
    x, y, w = rows(np.random.default_rng(4))
    table = [(*[None if np.isnan(v) else float(v) for v in r], int(c), float(k)) for r, c, k in zip(x, y, w)]
    return x, y, w, spark.createDataFrame(table, "a double, b double, c double, d double, _label int, _weight double").repartition(5).persist()


@pytest.mark.parametrize("group_cells", [10**6, 40])
def test_equals_the_plain_version(data, group_cells):
    x, y, w, df = data
    forest = grow(df, NAMES, 3, trees=4, depth=6, most=2, seed=7, group_cells=group_cells)
    left, split, weights = plain(x, y, w, 3, 4, 6, 2, 7)
    assert {i: int(v) for i, v in enumerate(forest.left) if v >= 0} == left
    assert {i: (int(forest.feature[i]), float(forest.threshold[i])) for i in left} == {i: (int(f), float(t)) for i, (f, t) in split.items()}
    assert (forest.weights == weights).all() and len(left) > 40


def test_grown_out_trees_know_their_rows(data):
    x, y, w, df = data
    forest = grow(df, NAMES, 3, trees=3, depth=40, most=2, seed=1)
    seen = w > 0
    assert (forest.probabilities(x[seen]).argmax(axis=1) == y[seen]).all()
    for tree in range(3):
        at = forest.route(x[seen], tree)
        assert (forest.left[at] < 0).all()
    gains = forest.importances(4)
    assert gains.sum() == pytest.approx(1) and gains[3] == 0 and gains[0] > 0.1


def test_classifier_round_trip(spark, data, tmp_path):
    *_, df = data
    model = models.train(df, "extra_trees", "_label", NAMES, ["x", "y", "z"], "_weight", {"numTrees": 5, "maxDepth": 8})
    out = model.transform(df)
    right = out.filter("_weight > 0").agg(F.avg((F.col("prediction") == F.col("_label")).cast("int"))).first()[0]
    assert right > 0.85 and out.columns == [*df.columns, "prediction"]
    model.save(f"file://{tmp_path}/m")
    again = models.Classifier.load(spark, f"file://{tmp_path}/m", NAMES)
    assert again.transform(df).exceptAll(out).isEmpty()
    assert [r["variable"] for r in models.importance(model).collect()][-1] == "d"


def test_empty_and_single_class(spark):
    schema = "a double, b double, c double, d double, _label int, _weight double"
    forest = grow(spark.createDataFrame([], schema), NAMES, 2, 2, 3, 2, 1)
    assert (forest.left == -1).all() and forest.probabilities(np.zeros((1, 4))).tolist() == [[0.0, 0.0]]
    one = grow(spark.createDataFrame([(1.0, 2.0, None, None, 1, 1.0)] * 9, schema), NAMES, 2, 2, 3, 2, 1)
    assert isinstance(one, Forest) and one.probabilities(np.zeros((1, 4))).tolist() == [[0.0, 1.0]]

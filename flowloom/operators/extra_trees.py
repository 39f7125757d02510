"""Extremely randomised trees, grown level by level over all rows.

Every node looks at a few random features that vary in it, with one random threshold each between the
ends of the feature there, and takes the split that leaves the purest children. All trees grow at once:
a level costs two scans of the rows, one for the classes and ends of its nodes, one for the split
statistics of what was drawn. A task routes its rows through the trees so far and sums up by node, so
what is shuffled is a line for each task and node. Nodes are taken in groups whose statistics have a
fixed size; those, and the trees, are all that the driver holds, as in Spark's own tree learners.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Statistics (nodes x columns) of a group of nodes; 8 bytes each with the driver and every task.
GROUP_CELLS = 1_000_000


@dataclass
class Forest:
    """Nodes of all trees side by side; ``left`` is -1 in a leaf, else the left child, the right one is next to it."""

    classes: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    weights: np.ndarray  # by node and class

    @staticmethod
    def planted(trees: int, classes: int) -> Forest:
        none = np.full(trees, -1)
        return Forest(classes, np.arange(trees), none.copy(), np.zeros(trees), none.copy(), np.zeros((trees, classes)))

    def add_children(self, nodes: np.ndarray, features: np.ndarray, thresholds: np.ndarray) -> None:
        n = len(self.left)
        self.feature[nodes], self.threshold[nodes], self.left[nodes] = features, thresholds, n + 2 * np.arange(len(nodes))
        more = np.full(2 * len(nodes), -1)
        self.feature, self.left = np.append(self.feature, more), np.append(self.left, more)
        self.threshold = np.append(self.threshold, np.zeros(2 * len(nodes)))
        self.weights = np.vstack([self.weights, np.zeros((2 * len(nodes), self.classes))])

    def route(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The node of each row in one tree; a missing value goes left."""
        at = np.full(len(x), self.roots[tree])
        moving = np.arange(len(x))
        while len(moving := moving[self.left[at[moving]] >= 0]):
            here = at[moving]
            at[moving] = self.left[here] + (x[moving, self.feature[here]] > self.threshold[here])
        return at

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros((len(x), self.classes))
        shares = self.weights / np.maximum(self.weights.sum(axis=1, keepdims=True), 1e-300)
        for tree in range(len(self.roots)):
            total += shares[self.route(x, tree)]
        return total / len(self.roots)

    def importances(self, features: int) -> np.ndarray:
        """Decrease of impurity by feature, each tree summing to one, averaged."""
        size = self.weights.sum(axis=1)
        impurity = size - (self.weights**2).sum(axis=1) / np.maximum(size, 1e-300)
        out = np.zeros(features)
        for root in self.roots:
            gains, open_ = np.zeros(features), [root]
            while open_:
                node = open_.pop()
                if (at := self.left[node]) >= 0:
                    gains[self.feature[node]] += impurity[node] - impurity[at] - impurity[at + 1]
                    open_ += [at, at + 1]
            out += gains / (gains.sum() or 1.0)
        return out / len(self.roots)


def draws(seed: int, nodes: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Two uniform numbers for each node and feature, the same whoever asks: the features' order, and the threshold."""
    pairs = [np.random.default_rng((seed, int(n))).random((2, features)) for n in nodes]
    both = np.array(pairs).reshape(len(nodes), 2, features)
    return both[:, 0], both[:, 1]


def draw_splits(seed: int, nodes: np.ndarray, low: np.ndarray, high: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node up to ``most`` features that vary in it, -1 where there are fewer, and their thresholds."""
    order, place = draws(seed, nodes, low.shape[1])
    varies = high > low
    first = np.argsort(np.where(varies, order, 2.0), axis=1, kind="stable")[:, :most]
    take = np.take_along_axis
    low, high, place = take(low, first, 1), take(high, first, 1), take(place, first, 1)
    with np.errstate(invalid="ignore"):  # features without any value have ends of plus and minus infinity
        threshold = np.minimum(low + place * (high - low), np.nextafter(high, -np.inf))  # never the upper end: both sides get rows
    return np.where(take(varies, first, 1), first, -1), threshold


def best_splits(total: np.ndarray, left: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """The drawn split with the purest children by node, -1 where none parts its rows; ties to the one drawn first."""
    right = total[:, None, :] - left
    n_left, n_right = left.sum(axis=2), right.sum(axis=2)
    usable = (drawn >= 0) & (n_left > 0) & (n_right > 0)
    purity = (left**2).sum(axis=2) / np.where(usable, n_left, 1) + (right**2).sum(axis=2) / np.where(usable, n_right, 1)
    best = np.where(usable, purity, -np.inf).argmax(axis=1)
    return np.where(usable.any(axis=1), best, -1)


def _sums(names: list[str], classes: int, sent, job):
    """Per task, ``job(slots, x, label, weight)`` summed over its rows, a line for each slot that has any."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, group, extra = sent.value
        slot_of = np.full(len(forest.left), -1)
        slot_of[group] = np.arange(len(group))
        kept = None
        for pdf in batches:
            x, label, weight = pdf[names].to_numpy(float), pdf["_label"].to_numpy(int), pdf["_weight"].to_numpy(float)
            for tree in range(len(forest.roots)):
                slots = slot_of[forest.route(x, tree)]
                rows = np.flatnonzero(slots >= 0)
                if len(rows):
                    kept = job(kept, len(group), slots[rows], x[rows], label[rows], weight[rows], extra)
        if kept is not None:
            seen = np.flatnonzero(kept[0].sum(axis=1) > 0)
            yield pd.DataFrame(np.hstack([part[seen].reshape(len(seen), -1) for part in kept])).assign(slot=seen)

    return run


def _ends(classes: int):
    def job(kept, n, slots, x, label, weight, _):
        if kept is None:
            kept = (np.zeros((n, classes)), np.full((n, x.shape[1]), np.inf), np.full((n, x.shape[1]), -np.inf))
        kept[0].reshape(-1)[:] += np.bincount(slots * classes + label, weight, n * classes)
        order = np.argsort(slots, kind="stable")
        first = np.flatnonzero(np.diff(slots[order], prepend=-1))
        at, known = slots[order][first], np.isnan(x[order])
        kept[1][at] = np.minimum(kept[1][at], np.minimum.reduceat(np.where(known, np.inf, x[order]), first))
        kept[2][at] = np.maximum(kept[2][at], np.maximum.reduceat(np.where(known, -np.inf, x[order]), first))
        return kept

    return job


def _lefts(classes: int):
    def job(kept, n, slots, x, label, weight, extra):
        drawn, threshold = extra
        if kept is None:
            kept = (np.zeros((n, classes)), np.zeros((n, drawn.shape[1], classes)))
        cell = slots * classes + label
        kept[0].reshape(-1)[:] += np.bincount(cell, weight, n * classes)
        for j in range(drawn.shape[1]):
            value = x[np.arange(len(x)), np.maximum(drawn[slots, j], 0)]
            left = ~(value > threshold[slots, j]) & (drawn[slots, j] >= 0)
            kept[1][:, j] += np.bincount(cell[left], weight[left], n * classes).reshape(n, classes)
        return kept

    return job


def _gather(rows: DataFrame, names: list[str], forest: Forest, group: np.ndarray, extra, job, columns: list[str]) -> dict[int, np.ndarray]:
    """The sums of all tasks by slot; ``columns`` says how each is combined."""
    sent = rows.sparkSession.sparkContext.broadcast((forest, group, extra))
    names_out = [f"s{i}" for i in range(len(columns))]

    def named(batches):
        for pdf in _sums(names, forest.classes, sent, job)(batches):
            yield pdf.set_axis([*names_out, "slot"], axis=1)

    partial = rows.mapInPandas(named, ", ".join([*(f"{c} double" for c in names_out), "slot int"]))
    how = {"sum": F.sum, "min": F.min, "max": F.max}
    total = partial.groupBy("slot").agg(*[how[h](c).alias(c) for h, c in zip(columns, names_out)])
    found = {r[0]: np.array(r[1:]) for r in total.collect()}  # one line a node of the group
    sent.unpersist()
    return found


def grow(rows: DataFrame, names: list[str], classes: int, trees: int, depth: int, most: int, seed: int, group_cells: int = GROUP_CELLS) -> Forest:
    """Grow ``trees`` trees of at most ``depth`` levels on ``rows`` (``names``, ``_label``, ``_weight``).

    ``rows`` are read twice a level and group of nodes, so they should be a written table. A node with one
    class or without a feature that varies is a leaf. Rows with a weight of zero take no part.
    """
    rows = rows.where(F.col("_weight") > 0)
    forest, width = Forest.planted(trees, classes), len(names)
    open_ = np.arange(trees)
    per_group = max(1, group_cells // (classes * (most + 1) + 2 * width))
    ends = ["sum"] * classes + ["min"] * width + ["max"] * width
    for level in range(depth + 1):
        splits = []
        for at in range(0, len(open_), per_group):
            group = open_[at : at + per_group]
            found = _gather(rows, names, forest, group, None, _ends(classes), ends)
            if not found:
                continue
            slots = np.array(sorted(found))
            stats = np.array([found[s] for s in slots])
            total, low, high = stats[:, :classes], stats[:, classes : classes + width], stats[:, classes + width :]
            forest.weights[group[slots]] = total
            mixed = ((total > 0).sum(axis=1) > 1) & (high > low).any(axis=1)
            if level == depth or not mixed.any():
                continue
            group, total, low, high = group[slots][mixed], total[mixed], low[mixed], high[mixed]
            drawn, threshold = draw_splits(seed, group, low, high, most)
            found = _gather(rows, names, forest, group, (drawn, threshold), _lefts(classes), ["sum"] * (classes * (1 + drawn.shape[1])))
            left = np.array([found[s][classes:] for s in range(len(group))]).reshape(len(group), drawn.shape[1], classes)
            best = best_splits(total, left, drawn)
            some = np.flatnonzero(best >= 0)
            splits.append((group[some], drawn[some, best[some]], threshold[some, best[some]]))
        if not splits:
            break
        nodes, features, thresholds = (np.concatenate(p) for p in zip(*splits))
        before = len(forest.left)
        forest.add_children(nodes, features, thresholds)
        open_ = np.arange(before, len(forest.left))
    return forest


class ExtraTreesModel:
    """A fitted forest as a member of a classifier: adds ``_probability`` as an array."""

    def __init__(self, forest: Forest, features: int):
        self.forest, self.features = forest, features

    @property
    def importances(self) -> list[float]:
        return self.forest.importances(self.features).tolist()

    def probability(self) -> Column:
        sent = SparkSession.getActiveSession().sparkContext.broadcast(self.forest)

        @F.pandas_udf("array<double>")
        def of(x: pd.DataFrame) -> pd.Series:
            return pd.Series(list(sent.value.probabilities(x.to_numpy(float))))

        return of(F.struct(*[F.col(f"_f{i}") for i in range(self.features)]))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_probability", self.probability())

    def save(self, path: str) -> None:
        f, spark = self.forest, SparkSession.getActiveSession()
        nodes = pd.DataFrame({"node": np.arange(len(f.left)), "feature": f.feature, "threshold": f.threshold, "left": f.left, "weights": f.weights.tolist()})
        spark.createDataFrame(nodes).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = json.dumps({"classes": f.classes, "trees": len(f.roots), "features": self.features})
        spark.createDataFrame([(facts,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")

    @staticmethod
    def load(path: str) -> ExtraTreesModel:
        spark = SparkSession.getActiveSession()
        facts = json.loads(spark.read.text(f"{path}/facts").first()["value"])
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values("node")
        weights = np.array(nodes["weights"].tolist()).reshape(-1, facts["classes"])
        forest = Forest(facts["classes"], np.arange(facts["trees"]), nodes["feature"].to_numpy(), nodes["threshold"].to_numpy(), nodes["left"].to_numpy(), weights)
        return ExtraTreesModel(forest, facts["features"])

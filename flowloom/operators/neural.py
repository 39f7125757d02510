"""A small neural regressor trained on all rows at once, gradients summed over the tasks."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import col

SEED = 42
# Pairs that the quasi-Newton step remembers, and halvings of a step before it is given up.
MEMORY, HALVINGS = 10, 20
# Rows that go through the network at a time, which bounds a task's memory.
CHUNK = 4096


def shapes(width: int, hidden: tuple[int, ...]) -> list[tuple[int, int]]:
    sizes = [width, *hidden, 1]
    return list(zip(sizes[:-1], sizes[1:]))


def unpack(weights: np.ndarray, layers: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix and bias of each layer, as views of the flat weights."""
    out, at = [], 0
    for a, b in layers:
        out.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def initial(layers: list[tuple[int, int]], seed: int = SEED) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.concatenate([np.append(rng.uniform(-1, 1, a * b) * math.sqrt(6 / (a + b)), np.zeros(b)) for a, b in layers])


def predict(weights: np.ndarray, layers: list[tuple[int, int]], x: np.ndarray) -> np.ndarray:
    for i, (w, b) in enumerate(parts := unpack(weights, layers)):
        x = x @ w + b
        if i < len(parts) - 1:
            x = np.maximum(x, 0)
    return x[:, 0]


def loss_and_gradient(weights: np.ndarray, layers: list[tuple[int, int]], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Half the sum of squared errors and its gradient."""
    parts, seen = unpack(weights, layers), [x]
    for i, (w, b) in enumerate(parts):
        x = x @ w + b
        if i < len(parts) - 1:
            x = np.maximum(x, 0)
        seen.append(x)
    gradient = np.zeros_like(weights)
    back = seen[-1] - y[:, None]
    loss = 0.5 * float((back**2).sum())
    for i in range(len(parts) - 1, -1, -1):
        gw, gb = unpack(gradient, layers)[i]
        gw += seen[i].T @ back
        gb += back.sum(axis=0)
        if i:
            back = (back @ parts[i][0].T) * (seen[i] > 0)
    return loss, gradient


def _partials(names: list[str], layers, sent, buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        weights = sent.value
        loss, gradient, n = 0.0, np.zeros_like(weights), 0
        for pdf in batches:
            values = pdf.to_numpy(float)
            for at in range(0, len(values), CHUNK):
                part = values[at : at + CHUNK]
                one, some = loss_and_gradient(weights, layers, part[:, :-1], part[:, -1])
                loss, gradient, n = loss + one, gradient + some, n + len(part)
        yield pd.DataFrame({"bucket": [TaskContext.get().partitionId() % buckets], "loss": [loss], "n": [n], "gradient": [gradient.tobytes()]})

    return run


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(g) for g in pdf["gradient"]], axis=0)
    return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "loss": [pdf["loss"].sum()], "n": [pdf["n"].sum()], "gradient": [total.tobytes()]})


def total_gradient(rows: DataFrame, names: list[str], layers, weights: np.ndarray, decay: float) -> tuple[float, np.ndarray]:
    """Mean loss and gradient over all ``rows`` (``names`` and ``_y``), with weight decay.

    The tasks' sums are added up in about the root of their number of groups, and those by the driver.
    """
    sent = rows.sparkSession.sparkContext.broadcast(weights)
    buckets = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    schema = "bucket int, loss double, n long, gradient binary"
    partial = rows.select(*names, "_y").mapInPandas(_partials(names, layers, sent, buckets), schema)
    found = partial.groupBy("bucket").applyInPandas(_summed, schema).collect()
    sent.unpersist()
    n = sum(r["n"] for r in found)
    loss = sum(r["loss"] for r in found) / n + 0.5 * decay * float(weights @ weights) / n
    return loss, np.sum([np.frombuffer(r["gradient"]) for r in found], axis=0) / n + decay * weights / n


def minimise(evaluate, weights: np.ndarray, rounds: int, tolerance: float = 1e-6) -> np.ndarray:
    """Limited-memory quasi-Newton steps with halving; every evaluation is one pass over the rows."""
    loss, gradient = evaluate(weights)
    pairs: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=MEMORY)
    for _ in range(rounds):
        step, alphas = -gradient, []
        for s, y in reversed(pairs):
            alphas.append(a := (s @ step) / (s @ y))
            step = step - a * y
        if pairs:
            s, y = pairs[-1]
            step = step * ((s @ y) / (y @ y))
        else:
            step = step / max(1.0, float(np.linalg.norm(gradient)))
        for (s, y), a in zip(pairs, reversed(alphas)):
            step = step + s * (a - (y @ step) / (s @ y))
        slope, size = float(gradient @ step), 1.0
        for _ in range(HALVINGS):
            new = weights + size * step
            new_loss, new_gradient = evaluate(new)
            if new_loss <= loss + 1e-4 * size * slope:
                break
            size /= 2
        else:
            return weights
        s, y = new - weights, new_gradient - gradient
        if s @ y > 1e-12:
            pairs.append((s, y))
        done = loss - new_loss <= tolerance * max(abs(loss), 1e-12)
        weights, loss, gradient = new, new_loss, new_gradient
        if done:
            break
    return weights


@dataclass(frozen=True)
class NeuralRegressor:
    """Hidden layers of rectified units; inputs and target are standardised by the training rows."""

    hidden: tuple[int, ...] = (32, 16)
    rounds: int = 100
    decay: float = 1e-4
    seed: int = SEED

    def fit(self, rows: DataFrame, names: list[str]) -> NeuralModel:
        """Fit on ``names`` and ``_y``, none of them null; ``rows`` are read once a step, so freeze them."""
        facts = rows.agg(F.count("*"), *[f(c) for c in [*names, "_y"] for f in (F.avg, F.stddev_pop)]).first()
        layers = shapes(len(names), self.hidden)
        if not facts[0]:
            return NeuralModel(layers, np.zeros(len(initial(layers))), np.zeros(len(names)), np.ones(len(names)), 0.0, 1.0)
        mean = np.array([facts[1 + 2 * i] for i in range(len(names) + 1)])
        spread = np.array([facts[2 + 2 * i] or 1.0 for i in range(len(names) + 1)])
        scaled = rows.select(*[((F.col(c) - F.lit(float(m))) / F.lit(float(s))).alias(c) for c, m, s in zip([*names, "_y"], mean, spread)])
        weights = minimise(lambda w: total_gradient(scaled, names, layers, w, self.decay), initial(layers, self.seed), self.rounds)
        return NeuralModel(layers, weights, mean[:-1], spread[:-1], float(mean[-1]), float(spread[-1]))


@dataclass(frozen=True)
class NeuralModel:
    layers: list[tuple[int, int]]
    weights: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    y_mean: float
    y_spread: float

    def transform(self, df: DataFrame, names: list[str], out: str = "prediction") -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def of(x: pd.DataFrame) -> pd.Series:
            m = sent.value
            return pd.Series(m.y_mean + m.y_spread * predict(m.weights, m.layers, (x.to_numpy(float) - m.mean) / m.spread))

        return df.withColumn(out, of(F.struct(*[col(c).cast("double").alias(c) for c in names])))

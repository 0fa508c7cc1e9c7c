"""Linear neurons and perceptrons fitted by Spark aggregates.

``mode="batch"`` sums the gradient over all rows in one aggregate per epoch.
``mode="ordered"`` updates row by row in a global order and equals a loop on one machine
(``rowwise``); linear neurons only.
``mode="mixing"`` lets every task pass over its own rows with updates row by row and
averages the task weights by row count after each epoch; per-row updates depend on
the row order, so this agrees with a one-machine loop in quality, not in digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riffle.functions.vectors import dot
from riffle.operators.ordering import global_index
from riffle.operators.sampling import permuted_place
from riffle.plans.rowwise import ordered_map, update_rows
from riffle.session import discard, materialize

Rule = Callable[[np.ndarray, dict], np.ndarray]
# Above this many features a sum per feature makes the generated code too long, and the
# gradient is added up batch by batch in the tasks instead.
WIDE = 24


def sgd(lr: float = 0.01) -> Rule:
    return lambda g, s: -lr * g


def momentum(lr: float = 0.01, mu: float = 0.9) -> Rule:
    def move(g, s):
        s["v"] = mu * s.get("v", 0.0) - lr * g
        return s["v"]

    return move


def nesterov(lr: float = 0.01, mu: float = 0.9, new_velocity: bool = False) -> Rule:
    """Look-ahead momentum: mu^2 * v - (1 + mu) * lr * g with the velocity from before the
    step; ``new_velocity`` takes the one after it."""

    def move(g, s):
        old = s.get("v", np.zeros_like(g))
        s["v"] = mu * old - lr * g
        return mu * mu * (s["v"] if new_velocity else old) - (1 + mu) * lr * g

    return move


def adagrad(lr: float = 0.01, eps: float = 1e-7) -> Rule:
    def move(g, s):
        s["h"] = s.get("h", 0.0) + g * g
        return -lr * g / (np.sqrt(s["h"]) + eps)

    return move


def rmsprop(lr: float = 0.01, decay: float = 0.99, eps: float = 1e-7) -> Rule:
    def move(g, s):
        s["h"] = decay * s.get("h", 0.0) + (1 - decay) * g * g
        return -lr * g / (np.sqrt(s["h"]) + eps)

    return move


def adam(lr: float = 0.001, beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-7) -> Rule:
    """Bias correction is folded into the rate."""

    def move(g, s):
        s["t"] = s.get("t", 0) + 1
        s["m"] = beta1 * s.get("m", 0.0) + (1 - beta1) * g
        s["v"] = beta2 * s.get("v", 0.0) + (1 - beta2) * g * g
        rate = lr * np.sqrt(1 - beta2 ** s["t"]) / (1 - beta1 ** s["t"])
        return -rate * s["m"] / (np.sqrt(s["v"]) + eps)

    return move


@dataclass
class LinearModel:
    """``weights[0]`` is the intercept; ``history`` holds one metric per epoch: half the
    squared error (batch), mean cost (ordered), mean cost or number of updates (mixing)."""

    features: list[str]
    weights: np.ndarray
    history: list[float] = field(default_factory=list)

    def net(self) -> Column:
        if len(self.features) > WIDE:
            x = F.array(*[F.col(c).cast("double") for c in self.features])
            w = F.array(*[F.lit(float(v)) for v in self.weights[1:]])
            return F.lit(float(self.weights[0])) + dot(x, w)
        out = F.lit(float(self.weights[0]))
        for c, w in zip(self.features, self.weights[1:], strict=True):
            out = out + F.col(c) * float(w)
        return out

    def predict(self) -> Column:
        return F.when(self.net() >= 0, 1).otherwise(-1)


def gradient(df: DataFrame, model: LinearModel, label: str, kind: str = "adaline") -> tuple[np.ndarray, float]:
    """(gradient of the half squared error, its value); one aggregate, one row back.

    For the perceptron the error is label minus predicted class, and the value counts
    the misclassified rows.
    """
    if len(model.features) > WIDE:
        return _wide_gradient(df, model, label, kind)
    output = model.net() if kind == "adaline" else model.predict()
    e = F.col("_e")
    metric = F.sum(e * e) / 2 if kind == "adaline" else F.sum(F.when(e != 0, 1.0).otherwise(0.0))
    row = df.withColumn("_e", F.col(label) - output).agg(
        F.sum(e).alias("_0"), *[F.sum(e * F.col(c)).alias(f"_{i}") for i, c in enumerate(model.features, 1)],
        metric.alias("_metric"),
    ).first()
    sums = [row[f"_{i}"] or 0.0 for i in range(len(model.features) + 1)]
    return -np.array(sums, dtype=float), float(row["_metric"] or 0.0)


def _wide_gradient(df: DataFrame, model: LinearModel, label: str, kind: str) -> tuple[np.ndarray, float]:
    """Same as ``gradient``; every task adds up its batches and gives one short row set."""
    features, weights = list(model.features), model.weights

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros(len(features) + 2)
        for b in batches:
            x = b[features].to_numpy(dtype=float)
            net = x @ weights[1:] + weights[0]
            y = b[label].to_numpy(dtype=float)
            e = y - net if kind == "adaline" else y - np.where(net >= 0, 1.0, -1.0)
            acc[0] += e.sum()
            acc[1:-1] += x.T @ e
            acc[-1] += e @ e / 2 if kind == "adaline" else (e != 0).sum()
        yield pd.DataFrame({"i": np.arange(len(acc)), "v": acc})

    parts = df.select(*features, label).mapInPandas(partial, "i long, v double")
    sums = np.array([r["v"] for r in parts.groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()])
    return -sums[:-1], float(sums[-1])


def _pass_over(
    features: Sequence[str], label: str, weights: np.ndarray, classes: Sequence, kind: str, eta: float, seed: int
):
    """One pass of per-row updates in a task; a row of weights per class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, rows, cost = weights.copy(), 0, 0.0
        rng = np.random.default_rng(seed)
        marks = np.asarray(classes)
        for b in batches:
            x = np.column_stack([np.ones(len(b)), b[list(features)].to_numpy(dtype=float)])
            raw = b[label].to_numpy()
            y = np.where(raw[:, None] == marks[None, :], 1.0, -1.0) if len(marks) else raw[:, None].astype(float)
            turn = rng.permutation(len(b))
            cost += update_rows(w, x[turn], y[turn], kind, eta)
            rows += len(b)
        if rows:
            yield pd.DataFrame({"w": [w.ravel()], "n": [rows], "cost": [cost]})

    return run


def _mixed_epoch(df, features, label, weights, classes, kind, eta, seed) -> tuple[np.ndarray, int, float]:
    parts = df.select(*features, label).mapInPandas(
        _pass_over(features, label, weights, classes, kind, eta, seed), "w array<double>, n long, cost double"
    )
    cells = parts.select("n", "cost", F.posexplode("w").alias("i", "v"))
    sums = cells.groupBy("i").agg(
        F.sum(F.col("v") * F.col("n")).alias("v"), F.sum("n").alias("n"), F.sum("cost").alias("cost")
    )
    found = sums.orderBy("i").collect()
    if not found:
        return weights, 0, 0.0
    rows = found[0]["n"]
    return np.array([r["v"] / rows for r in found]).reshape(weights.shape), rows, found[0]["cost"]


def _fit_ordered(df, features, label, eta, epochs, seed, start, order, shuffle) -> LinearModel:
    weights = np.zeros(len(features) + 1) if start is None else np.array(start, dtype=float)
    model = LinearModel(features, weights)
    rows = df.dropna(subset=[*features, label])
    ranked, found = None, None
    if shuffle:
        numbered = global_index(rows.select(*features, label, *[F.col(c).alias(f"_by{j}") for j, c in enumerate(order)]),
                                [*[f"_by{j}" for j in range(len(order))], *features, label], "_rank")
        ranked = materialize(numbered.select(*features, label, "_rank"))
        n = max(ranked.count(), 1)
    for e in range(epochs):
        if shuffle:
            turned = ranked.withColumn("_place", permuted_place(F.col("_rank"), n, seed + e))
            found = ordered_map(turned, features, label, ["_place"], eta)
        elif e == 0:
            found = ordered_map(rows, features, label, order, eta)
        if found is None:
            break
        move, cost, count = found
        state = np.append(model.weights, 1.0)
        model.history.append(float(state @ cost @ state) / count)
        model.weights = (move @ state)[:-1]
    if shuffle:
        discard(ranked)
    return model


def fit_linear(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str = "adaline",
    mode: str = "batch",
    rule: Rule | None = None,
    eta: float = 0.01,
    epochs: int = 20,
    seed: int = 1,
    start: np.ndarray | None = None,
    order: Sequence[str] | None = None,
    shuffle: bool = False,
) -> LinearModel:
    """Fit on labels -1 and +1.

    ``rule`` turns the summed gradient into a step in batch mode (default: plain
    descent with rate ``eta``).  ``order`` names the columns that order the rows in mode
    "ordered"; with ``shuffle`` each epoch takes its own permutation of that order, which
    ``seed`` repeats.  There a row with a null in a feature or the label is left out, and
    a table without rows leaves the weights as they are.
    """
    if mode == "ordered":
        if kind != "adaline" or not order:
            raise ValueError("mode 'ordered' needs kind 'adaline' and order columns")
        return _fit_ordered(df, list(features), label, eta, epochs, seed, start, list(order), shuffle)
    data = df.select(*features, label).persist()
    weights = np.zeros(len(features) + 1) if start is None else np.array(start, dtype=float)
    model = LinearModel(list(features), weights)
    step, state = rule or sgd(eta), {}
    try:
        for n in range(epochs):
            if mode == "batch":
                grad, metric = gradient(data, model, label, kind)
                model.weights = model.weights + step(grad, state)
            else:
                mixed, rows, cost = _mixed_epoch(
                    data, features, label, model.weights[None, :], [], kind, eta, seed + n
                )
                model.weights = mixed[0]
                metric = cost / rows if kind == "adaline" and rows else cost
            model.history.append(metric)
            if kind == "perceptron" and metric == 0:
                break
    finally:
        data.unpersist()
    return model


@dataclass
class OneVsRest:
    """A weight row per class; the class with the largest output wins."""

    features: list[str]
    classes: list
    weights: np.ndarray
    history: list[float]

    def predict(self) -> Column:
        nets = [LinearModel(self.features, w).net() for w in self.weights]
        best = F.greatest(*nets) if len(nets) > 1 else nets[0]
        out = F.lit(self.classes[-1])
        for net, c in list(zip(nets, self.classes, strict=True))[-2::-1]:
            out = F.when(net == best, F.lit(c)).otherwise(out)
        return out


def fit_one_vs_rest(
    df: DataFrame, features: Sequence[str], label: str, eta: float = 0.1, epochs: int = 40, seed: int = 1,
    max_classes: int = 10_000,
) -> OneVsRest:
    """One perceptron per class, all trained in the same pass over the rows."""
    found = df.select(label).distinct().limit(max_classes + 1).collect()
    if len(found) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    classes = sorted(r[0] for r in found)
    weights = np.zeros((len(classes), len(features) + 1))
    data = df.select(*features, label).persist()
    history = []
    try:
        for n in range(epochs):
            weights, _, cost = _mixed_epoch(data, features, label, weights, classes, "perceptron", eta, seed + n)
            history.append(cost)
            if cost == 0:
                break
    finally:
        data.unpersist()
    return OneVsRest(list(features), classes, weights, history)


def spread_array(df: DataFrame, col: str, size: int, prefix: str = "x") -> DataFrame:
    """An array column as ``size`` double columns, the form the fits read."""
    return df.select("*", *[F.col(col)[j].cast("double").alias(f"{prefix}{j}") for j in range(size)])

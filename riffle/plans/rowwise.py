"""Row-by-row updates of linear neurons in blocks, and exact fits in a global row order.

One update of a linear neuron, ``w += eta * (y - x w) * x``, is an affine map of the
weights, and so is any run of updates: the errors of a block follow from one triangular
system with the inner products of its rows, and maps of neighbouring runs multiply.  Each
task therefore turns its range of the rows into one small matrix without knowing the
weights, the matrices are multiplied in order in groups, and the result equals a loop over
all rows on one machine, at one job for all epochs with the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 128
FAN = 16
MAPS = "part long, n long, move array<double>, cost array<double>"


def block_errors(x: np.ndarray, targets: np.ndarray, eta: float) -> np.ndarray:
    """Error of each row at the moment of its own update, for ``targets`` less the outputs of the weights before the block."""
    return np.linalg.solve(np.eye(len(x)) + eta * np.tril(x @ x.T, -1), targets)


def block_map(x: np.ndarray, y: np.ndarray, eta: float) -> tuple[np.ndarray, np.ndarray]:
    """What the updates of a block do to ``h = (w, 1)``: ``h' = move @ h``, and half the squared errors are ``h @ cost @ h``."""
    size = x.shape[1]
    errors = block_errors(x, np.column_stack([-x, y]), eta)
    move = np.eye(size + 1)
    move[:size] += eta * x.T @ errors
    return move, errors.T @ errors / 2


def after(first: tuple[np.ndarray, np.ndarray], then: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The map of two runs in a row."""
    return then[0] @ first[0], first[1] + first[0].T @ then[1] @ first[0]


def _blocks(batches: Iterator[pd.DataFrame], columns: Sequence[str]) -> Iterator[np.ndarray]:
    """Rows of all batches in blocks of ``BLOCK``; the last one may be shorter."""
    rest = np.zeros((0, len(columns)))
    for b in batches:
        rest = np.vstack([rest, b[list(columns)].to_numpy(dtype=float)])
        full = len(rest) // BLOCK * BLOCK
        for at in range(0, full, BLOCK):
            yield rest[at : at + BLOCK]
        rest = rest[full:]
    if len(rest):
        yield rest


def _range_map(columns: Sequence[str], eta: float) -> Callable:
    size = len(columns)  # features and the label, so also features and the intercept

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = 0

        def noted() -> Iterator[pd.DataFrame]:
            nonlocal part
            for b in batches:
                if len(b):
                    part = int(b["_part"].iloc[0])
                    yield b

        whole, n = (np.eye(size + 1), np.zeros((size + 1, size + 1))), 0
        for rows in _blocks(noted(), columns):
            x = np.column_stack([np.ones(len(rows)), rows[:, :-1]])
            whole, n = after(whole, block_map(x, rows[:, -1], eta)), n + len(rows)
        if n:
            yield pd.DataFrame({"part": [part], "n": [n], "move": [whole[0].ravel()], "cost": [whole[1].ravel()]})

    return run


def _joined_maps(group: pd.DataFrame) -> pd.DataFrame:
    """The maps of at most ``FAN`` neighbouring ranges as one."""
    group = group.sort_values("part")
    side = int(round(len(group["move"].iloc[0]) ** 0.5))
    whole = None
    for move, cost in zip(group["move"], group["cost"], strict=True):
        one = np.asarray(move).reshape(side, side), np.asarray(cost).reshape(side, side)
        whole = one if whole is None else after(whole, one)
    return pd.DataFrame(
        {"part": [int(group["part"].iloc[0]) // FAN], "n": [int(group["n"].sum())], "move": [whole[0].ravel()], "cost": [whole[1].ravel()]}
    )


def ordered_map(
    df: DataFrame, features: Sequence[str], label: str, order: Sequence[str], eta: float
) -> tuple[np.ndarray, np.ndarray, int] | None:
    """(move, cost, rows) of one pass over all rows by ``order``; None if there are no rows.

    Rows that agree on ``order`` go by their features and label, so the result does not
    depend on how the table is cut.  The driver gets one matrix.
    """
    columns = [*features, label]
    rows = df.select(*[F.col(c).alias(f"_o{j}") for j, c in enumerate(order)], *[F.col(c).cast("double").alias(c) for c in columns])
    keys = [*[f"_o{j}" for j in range(len(order))], *columns]
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    maps = placed.select(*columns, F.spark_partition_id().alias("_part")).mapInPandas(_range_map(columns, eta), MAPS)
    while ranges > 1:
        maps = maps.groupBy(F.expr(f"part div {FAN}").alias("_group")).applyInPandas(_joined_maps, MAPS)
        ranges = -(-ranges // FAN)
    found = maps.first()
    if found is None:
        return None
    side = len(columns) + 1
    return np.array(found["move"]).reshape(side, side), np.array(found["cost"]).reshape(side, side), found["n"]


def update_rows(weights: np.ndarray, x: np.ndarray, y: np.ndarray, kind: str, eta: float) -> float:
    """Update ``weights`` (a row per class) in place by the rows of ``x`` in their order; the cost of the pass.

    ``y`` has a column per class.  Linear neurons take a block by one triangular system.
    Perceptrons change on mistakes alone: the outputs of a block are kept up to date by
    its inner products, and a step goes from one mistake to the next.
    """
    cost = 0.0
    for at in range(0, len(x), BLOCK):
        rows, marks = x[at : at + BLOCK], y[at : at + BLOCK]
        net = rows @ weights.T
        if kind == "adaline":
            errors = block_errors(rows, marks - net, eta)
            cost += 0.5 * float((errors * errors).sum())
            weights += eta * errors.T @ rows
            continue
        inner, r = rows @ rows.T, 0
        while r < len(rows):
            wrong = ((net[r:] >= 0) != (marks[r:] > 0)).any(axis=1)
            if not wrong.any():
                break
            r += int(wrong.argmax())
            error = marks[r] - np.where(net[r] >= 0, 1.0, -1.0)
            cost += float((error != 0).sum())
            weights += eta * np.outer(error, rows[r])
            net += eta * np.outer(inner[:, r], error)
            r += 1
    return cost

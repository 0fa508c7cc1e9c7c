"""Update a linear model from a stream without starting over."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riffle.plans.linear import LinearModel, gradient

_STATE = "weights array<double>, rows long, cost double"


def _state_path(folder: str, batch_id: int) -> str:
    return f"{folder.rstrip('/')}/weights/batch={batch_id}"


def load_state(spark: SparkSession, folder: str, batch_id: int) -> np.ndarray:
    """Weights after the given batch."""
    row = spark.read.schema(_STATE).parquet(_state_path(folder, batch_id)).first()
    return np.array(row["weights"])


def partial_fit(
    df: DataFrame, model: LinearModel, label: str, eta: float = 0.01, average: bool = True, rows: int | None = None
) -> LinearModel:
    """One step on new rows, from the weights the model has.

    The step is ``eta`` times the mean gradient, so it does not grow with the batch; ``average=False``
    takes the sum.  ``rows`` saves the count if it is known.
    """
    grad, cost = gradient(df, model, label)
    if average:
        grad = grad / max(1, df.count() if rows is None else rows)
    return LinearModel(model.features, model.weights - eta * grad, [*model.history, cost])


def apply_batch(
    batch: DataFrame, batch_id: int, start: np.ndarray, folder: str, features: Sequence[str], label: str, eta: float,
    average: bool = True,
) -> None:
    """Step from the weights of the batch before and store the result under this batch id.

    A replayed batch starts from the same weights and overwrites the same place, so it
    never counts twice.
    """
    spark = batch.sparkSession
    before = start if batch_id == 0 else load_state(spark, folder, batch_id - 1)
    model = LinearModel(list(features), before)
    data = batch.persist()
    rows = data.count()
    if rows:
        model = partial_fit(data, model, label, eta, average, rows)
    data.unpersist()
    cost = model.history[-1] if model.history else 0.0
    spark.createDataFrame([(model.weights.tolist(), rows, cost)], _STATE).coalesce(1).write.mode(
        "overwrite"
    ).parquet(_state_path(folder, batch_id))


def partial_fit_stream(
    stream: DataFrame,
    features: Sequence[str],
    label: str,
    folder: str,
    start: np.ndarray | None = None,
    eta: float = 0.01,
    available_now: bool = True,
    average: bool = True,
) -> StreamingQuery:
    """Start the stream; weights per batch and the stream's checkpoint live in ``folder``."""
    first = np.zeros(len(features) + 1) if start is None else np.asarray(start, dtype=float)
    writer = stream.writeStream.option("checkpointLocation", f"{folder.rstrip('/')}/checkpoint").foreachBatch(
        lambda batch, batch_id: apply_batch(batch, batch_id, first, folder, features, label, eta, average)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def weights_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    """All stored weights, rows (batch, weights, rows, cost)."""
    return spark.read.schema(_STATE + ", batch long").parquet(f"{folder.rstrip('/')}/weights").select(
        F.col("batch"), "weights", "rows", "cost"
    )

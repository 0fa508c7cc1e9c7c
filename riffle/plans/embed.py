"""Fixed-length vectors for texts, and several vectors of one item side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Encoder = Callable[[pd.Series], np.ndarray]
TEXT_SIZE = 768


def embed_column(
    df: DataFrame, col: str, out: str = "vector", encoder: Encoder | None = None, size: int = TEXT_SIZE
) -> DataFrame:
    """Add a vector of ``size`` values for the whole text of ``col``.

    With an ``encoder`` (Arrow batches of texts to a matrix) it runs inside the tasks.
    Without one the vector holds hashed term counts weighted by inverse document
    frequency.
    """
    if encoder is not None:
        schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])

        def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b):
                    continue
                matrix = np.asarray(encoder(b[col].fillna("")), dtype=np.float32)
                if matrix.shape != (len(b), size):
                    raise ValueError(f"encoder gave {matrix.shape}, expected {(len(b), size)}")
                yield b.assign(**{out: list(matrix)})

        return df.mapInPandas(encode, schema)
    words = df.withColumn(
        "_words", F.filter(F.split(F.lower(F.coalesce(F.col(col), F.lit(""))), r"\s+"), lambda w: w != "")
    )
    stages = [
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=size),
        IDF(inputCol="_tf", outputCol="_vec"),
    ]
    weighted = Pipeline(stages=stages).fit(words).transform(words)
    return weighted.select(*df.columns, vector_to_array("_vec", "float32").alias(out))


def combine_vectors(df: DataFrame, cols: Sequence[str], out: str = "combined") -> DataFrame:
    """One array holding the vectors of ``cols`` in order."""
    return df.withColumn(out, F.concat(*[F.col(c) for c in cols]))

"""Sinks: delimited text, predictions, sparse text, folders by label, chunked JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str, sep: str = "|", encoding: str = "UTF-8") -> None:
    df.write.option("header", True).option("sep", sep).option("encoding", encoding).csv(path)


def write_predictions(df: DataFrame, path: str, col: str = "target") -> None:
    """CSV with the prediction written to five decimals."""
    text = F.format_string("%.5f", F.col(col).cast("double")).alias(col)
    df.select(*[text if c == col else F.col(c) for c in df.columns]).write.option("header", True).csv(path)


def write_sparse_text(df: DataFrame, path: str) -> None:
    """All columns of a row on one line, space separated, without header."""
    df.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.text(path)


def write_by_label(df: DataFrame, path: str, label: str) -> None:
    """One folder per label.

    Rows are not gathered by label first: every task writes its own file per label,
    so a label with a third of all rows is written by many tasks.
    """
    df.write.partitionBy(label).parquet(path)


def write_json_chunks(df: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    df.write.option("maxRecordsPerFile", rows_per_file).json(path)

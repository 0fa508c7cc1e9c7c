"""Reads: typed text files, JSON maps, keyed table splits, file listings, XML fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    date_format: str = "yyyyMMdd",
    header: bool = True,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV by an explicit schema, matched by position; the header line is only skipped.

    Encodings outside Spark's default list (such as GBK) need
    ``spark.sql.legacy.javaCharsets=true`` in the session.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("dateFormat", date_format)
        .csv(path)
    )


def manifest_from_json_map(df: DataFrame, col: str) -> DataFrame:
    """JSON object {path: label} to (path, label) rows with an integer label."""
    pairs = df.select(F.explode(F.from_json(F.col(col), "map<string,string>")).alias("path", "label"))
    return pairs.select("path", F.col("label").try_cast("int").alias("label"))


def read_partitioned(
    spark: SparkSession, options: Mapping[str, str], key: str, n: int
) -> DataFrame:
    """Read a database table or query in ``n`` key ranges instead of offset pages.

    ``options`` holds url, dbtable and credentials from the caller, and the bounds
    ``lowerBound`` and ``upperBound`` of the key (rows outside are read as well).
    """
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("partitionColumn", key)
        .option("numPartitions", n)
        .load()
    )


def file_manifest(
    spark: SparkSession, root: str, dir_name: str | None = None, exts: Sequence[str] = ()
) -> DataFrame:
    """Path, size and time of all files below ``root``; contents are not read.

    Only files with a parent folder called ``dir_name`` and one of the extensions.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    if dir_name:
        files = files.filter(F.element_at(F.split("path", "/"), -2) == dir_name)
    if exts:
        files = files.filter(F.lower(F.regexp_extract("path", r"\.[^./]+$", 0)).isin(*exts))
    return files


def read_xml_fields(spark: SparkSession, path: str, xpaths: Mapping[str, str]) -> DataFrame:
    """One row per document: its path and, per name, the list of texts an XPath finds."""
    found: list[Column] = [F.xpath("value", F.lit(x)).alias(n) for n, x in xpaths.items()]
    docs = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return docs.select(F.col("_metadata.file_path").alias("path"), *found)

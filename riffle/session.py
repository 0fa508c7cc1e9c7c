"""Session set-up and the place where intermediate tables are kept."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Bytes of files whose rows one task of a large join sorts; some 700,000 narrow rows.
BYTES_PER_TASK = 16 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Where a local session without ``spark.checkpoint.dir`` keeps its tables; made on first use.
_local_folder: str | None = None


def local_session(name: str = "riffle", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.legacy.javaCharsets", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, reachable from every executor.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a temporary folder, since there all tasks share one machine.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_folder is None or not os.path.isdir(_local_folder):
        _local_folder = tempfile.mkdtemp(prefix="riffle-")
    return _local_folder


def spread_small(df: DataFrame) -> DataFrame:
    """Deal the rows of a table that is smaller than one scan task a core evenly to all cores.

    A file is read by as many tasks as it has row groups, so a small table may keep one
    core busy with all that follows.  Larger tables are left as they lie, without a shuffle.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        return df
    return df.repartition(cores)


def dealt(df: DataFrame, *keys: str, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """``df`` dealt by ``keys`` for a join, if the files it comes from need more tasks than ``spark.sql.shuffle.partitions``.

    A sort or hash table of a task then stays as large as the table grows.  Smaller tables are left to Spark, which
    may broadcast their partners.  Sources of unknown size do not count.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size())]
    tasks = -(-sum(s for s in sizes if s < 1 << 60) // bytes_per_task)
    return df.repartition(tasks, *keys) if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def unless_large(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for a join, kept from being broadcast if its ``rows`` are above Spark's limit.

    Spark takes the size of the files, and that of a table with repeating values, or of rows that are spread, is many times larger.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    width = df._jdf.schema().defaultSize() + 16
    return df.hint("merge") if 0 <= limit < rows * width else df


def materialize(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives later joins
    the true size of the table, so Spark's own broadcast limit is applied to a
    measured number.  ``rows_per_file`` cuts large files, so that more tasks may read them (0: no limit).
    The shuffle files of the write are deleted when it ends; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/riffle-tables/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._riffle_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once nothing reads them any more; other DataFrames are left alone."""
    for table in tables:
        path = getattr(table, "_riffle_path", None)
        if path is None:
            continue
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

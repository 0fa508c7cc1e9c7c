"""Where intermediate tables go, and that they can be deleted."""

import os
import time

import pytest
from pyspark.sql import functions as F

from riffle import session


class _Settings:
    def __init__(self, folder):
        self.folder = folder

    def get(self, name, default=None):
        return self.folder or default


class _Session:
    def __init__(self, master, folder=None):
        self.conf = _Settings(folder)
        self.sparkContext = type("Context", (), {"master": master})()


def test_local_session_without_a_setting_gets_one_folder():
    first = session.shared_folder(_Session("local[2]"))
    assert os.path.isdir(first) and session.shared_folder(_Session("local[8]")) == first


def test_setting_comes_first():
    assert session.shared_folder(_Session("local[2]", "file:///shared/")) == "file:///shared"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_cluster_needs_the_setting(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(_Session(master))


def test_written_tables_can_be_deleted(spark):
    table = session.materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    path = table._riffle_path.removeprefix("file://")
    assert table.count() == 10 and os.path.isdir(path)
    session.discard(table, spark.range(3))
    assert not os.path.exists(path)


def test_small_tables_are_dealt_to_all_cores_and_large_ones_left(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    small = spark.read.parquet(str(tmp_path / "t"))
    dealt = session.spread_small(small)
    counts = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == spark.sparkContext.defaultParallelism and sum(counts) == 1000 and max(counts) < 300
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        assert session.spread_small(small) is small
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(n).getName() for n in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_written(spark):
    before = _shuffle_files(spark)
    table = session.materialize(spark.range(1000).repartition(4, "id"))
    for _ in range(20):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert table.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_many_rows_in_a_small_file_are_not_broadcast(spark):
    table = session.materialize(spark.range(200_000).select(F.lit("the same text in every row").alias("k"), (F.col("id") % 3).alias("v")))
    asked = session.materialize(spark.range(3).withColumnRenamed("id", "v"))

    def plan(rows):
        return asked.join(session.unless_large(table, rows), "v", "left")._jdf.queryExecution().executedPlan().toString()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        assert "BroadcastHashJoin" in plan(3) and "BroadcastHashJoin" not in plan(table.count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

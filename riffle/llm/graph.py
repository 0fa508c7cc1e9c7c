"""Connected components by contraction; links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riffle.llm.common import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id of a link: the smallest id it can reach, itself included.

    Each round hooks every node to its smallest neighbour, shortens the chains by pointer
    jumps (their number is the logarithm of the length), and contracts the links to those between
    the trees found.  Every round at least halves the nodes that still have links.  Groups are
    reduced by ``min`` before the shuffle, so a node with very many links is no burden.
    Links with a null end and loops are left out; no links give an empty table.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    links = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = None
    while found is None or not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tree = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")))
        while True:
            up = tree.select(F.col("id").alias("component"), F.col("component").alias("higher"))
            jumped = materialize(tree.join(up, "component", "left").select("id", F.coalesce("higher", "component").alias("component"), (F.col("higher") < F.col("component")).alias("moved")))
            tree = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = tree
        else:
            up = tree.select(F.col("id").alias("component"), F.col("component").alias("higher"))
            found = materialize(found.join(up, "component", "left").select("id", F.coalesce("higher", "component").alias("component")))
        left = links
        for end in ("a", "b"):
            up = tree.select(F.col("id").alias(end), F.col("component").alias("to"))
            left = left.join(up, end).drop(end).withColumnRenamed("to", end)
        left = left.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links = materialize(left.distinct())
    return found

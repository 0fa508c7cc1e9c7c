"""Closed routes: length, fitness, ranking and weighted picks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riffle.operators.ordering import global_index, last_before, running_total
from riffle.session import materialize


def tour_length(
    routes: DataFrame, dist: DataFrame, route: str = "route", pos: str = "pos", stop: str = "stop", out: str = "length"
) -> DataFrame:
    """Length of each closed route; a leg without a distance makes it infinite.

    ``pos`` counts 0, 1, ... within a route.  The next stop is found by an equi join
    on (route, pos + 1), and the way back from two grouped values, so a route with
    very many stops is spread over all tasks.
    """
    here = routes.select(route, F.col(stop).alias("a"), (F.col(pos) + 1).alias(pos))
    onward = here.join(routes.select(route, pos, F.col(stop).alias("b")), [route, pos]).select(route, "a", "b")
    back = routes.groupBy(route).agg(F.max_by(stop, pos).alias("a"), F.min_by(stop, pos).alias("b"))
    legs = onward.unionByName(back)
    edges = dist.groupBy("a", "b").agg(F.min("d").alias("d"))
    leg = F.coalesce(F.col("d"), F.lit(float("inf")))
    return legs.join(edges, ["a", "b"], "left").groupBy(route).agg(F.sum(leg).alias(out))


def fitness(lengths: DataFrame, length: str = "length", out: str = "fitness") -> DataFrame:
    """1 / length; 0 for infinite routes."""
    return lengths.withColumn(out, F.when(F.col(length) > 0, 1 / F.col(length)))


def rank_routes(scored: DataFrame, score: str = "fitness", tie: str = "route", out: str = "rank") -> DataFrame:
    """1-based rank by falling score over the whole table."""
    ranked = global_index(scored, [F.col(score).desc(), F.col(tie)], out)
    return ranked.withColumn(out, F.col(out) + 1)


def elite(scored: DataFrame, k: int, score: str = "fitness", tie: str = "route") -> DataFrame:
    """The ``k`` best rows."""
    return scored.orderBy(F.col(score).desc(), F.col(tie)).limit(k)


def roulette_sample(df: DataFrame, weight: str, order: list, picks: DataFrame, pick: str = "pick") -> DataFrame:
    """For every pick in [0, 1) the row whose share interval [start, end) holds it.

    The intervals follow each other, so the row is the last one that starts at or before the pick; both
    sides are sorted together once (``ordering.last_before``), whatever their sizes.  Rows may be drawn
    repeatedly; rows without a positive weight never are.
    """
    shares = materialize(running_total(df, order, {"_end": weight}, {"_begin": weight}))
    whole = shares.agg(F.max("_end")).scalar()
    spans = shares.withColumn("_hi", F.col("_end") / whole).withColumn("_lo", F.col("_begin") / whole)
    drawn = last_before(picks, spans.filter(F.col(weight) > 0), pick, "_lo", "_row_drawn")
    held = F.col("_row_drawn")
    return drawn.filter(F.col(pick) < held["_hi"]).select(*picks.columns, *[held[c].alias(c) for c in df.columns])


def random_picks(spark, n: int, seed: int) -> DataFrame:
    """``n`` uniform draws."""
    return spark.range(n).select(F.col("id").alias("pick_id"), F.rand(seed).alias("pick"))

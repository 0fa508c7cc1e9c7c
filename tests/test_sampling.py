"""Permutations, parts of exact size and samples per group."""

import pytest
from pyspark.sql import functions as F

from riffle.operators import sampling as P


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_places_are_a_permutation_for_any_size(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"))
    for seed in (0, 7):
        places = [r["place"] for r in P.shuffled(df, ["k"], seed).orderBy("k").collect()]
        assert sorted(places) == list(range(n))
    if n == 1000:
        assert places != sorted(places)
        fixed = sum(p == k for k, p in enumerate(places))
        assert fixed < 10 and 400 < sum(p < 500 for p in places[:500]) / 500 * 1000 < 600


def test_places_do_not_depend_on_partitions_and_do_on_the_seed(spark):
    df = spark.range(300).select(F.col("id").alias("k"))

    def places(d, seed):
        return {r["k"]: r["place"] for r in P.shuffled(d, ["k"], seed).collect()}

    assert places(df.repartition(1), 3) == places(df.repartition(7), 3) != places(df, 4)


def test_parts_have_exact_sizes(spark):
    df = spark.range(101).select(F.col("id").alias("k"))
    sizes = {r["part"]: r["count"] for r in P.split_parts(df, ["k"], [0.5, 0.25], 1).groupBy("part").count().collect()}
    assert sizes == {0: 51, 1: 25, -1: 25}
    assert P.split_parts(df.limit(0), ["k"], [1.0], 1).count() == 0
    with pytest.raises(ValueError):
        P.split_parts(df, ["k"], [0.9, 0.2], 1)


def test_group_samples(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), (None, 2), ("b", None)], "g string, i int")
    got = P.group_sample(df, ["g"], "i", 3, 1)
    assert {r["g"]: r["count"] for r in got.groupBy("g").count().collect()} == {"a": 3, "b": 2, None: 1}
    again = P.group_sample(df.repartition(5), ["g"], "i", 3, 1)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, again.collect()))

"""Repeatable order and samples of exact size, the same on every engine and for every partitioning.

Places come from a keyed permutation of 0 .. n-1 that needs no table: each round pairs a place x with
``(k - x) mod n`` and a bit of the pair says whether they change sides.  Every round is its own inverse, so any
number of rounds is a permutation for any n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riffle.operators.aggregates import top_n
from riffle.operators.ordering import global_index

#: Modulus and factor of the generator behind round keys and bits (fixed values: the prime 2**31 - 1 and a factor that spreads neighbours).
PRIME, FACTOR = 2_147_483_647, 630_360_016
ROUNDS = 24


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    out, x = [], (seed * 2 + 1) % PRIME or 1
    for _ in range(rounds):
        x = x * FACTOR % PRIME
        out.append(x)
    return out


def permuted_place(place: Column, n: int, seed: int, rounds: int = ROUNDS) -> Column:
    """Where a place below ``n`` goes."""
    keys = F.array(*[F.lit(k).cast("long") for k in round_keys(seed, rounds)])

    def turn(x: Column, k: Column) -> Column:
        other = F.pmod(k - x, F.lit(n).cast("long"))
        pair = F.greatest(x, other) % PRIME
        y = (pair + k) % PRIME * FACTOR % PRIME
        return F.when(y * y % PRIME * 2 < PRIME, other).otherwise(x)

    return F.aggregate(keys, place.cast("long"), turn)


def shuffled(df: DataFrame, order: Sequence[str], seed: int, out: str = "place") -> DataFrame:
    """Rows with their place in a random order that depends on the seed and on the rank by ``order`` alone.

    ``order`` should tell rows apart; rows that agree on it share their places in no defined way.
    """
    n = df.count()
    ranked = global_index(df, order, "_rank")
    return ranked.withColumn(out, permuted_place(F.col("_rank"), max(n, 1), seed)).drop("_rank")


def split_parts(df: DataFrame, order: Sequence[str], shares: Sequence[float], seed: int, out: str = "part") -> DataFrame:
    """Rows with ``place`` and the number of their part: parts have exactly the rounded cumulated share of all rows.

    Shares add up to 1 at most; what is left over has the number -1.
    """
    if any(s < 0 for s in shares) or sum(shares) > 1 + 1e-9:
        raise ValueError("shares are at least 0 and add up to 1 at most")
    n = df.count()
    ends = [int(sum(shares[: i + 1]) * n + 0.5) for i in range(len(shares))]
    part = F.lit(-1)
    for i in reversed(range(len(ends))):
        part = F.when(F.col("place") < ends[i], i).otherwise(part)
    return shuffled(df, order, seed).withColumn(out, part)


def group_sample(df: DataFrame, groups: Sequence[str], id_col: str, k: int, seed: int) -> DataFrame:
    """``k`` rows of every group, all of smaller ones: those whose id has the smallest md5 after the seed.

    Every task keeps its own ``k`` per group before anything is shuffled, so a group with a third of all rows is no burden.
    """
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return top_n(df.withColumn("_mark", mark), list(groups), [F.col("_mark"), F.col(id_col)], k, "_rank").drop("_mark", "_rank")

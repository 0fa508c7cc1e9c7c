"""Joins that keep their shape when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riffle.session import materialize


def hot_keys(fact: DataFrame, on: Sequence[str], rows_per_split: int) -> DataFrame:
    """Keys above ``rows_per_split`` rows and how many splits each one needs.

    At most rows / rows_per_split keys can pass, so the table stays short.
    """
    return (
        fact.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_split)
        .select(*on, F.ceil(F.col("_n") / rows_per_split).cast("int").alias("_splits"))
    )


def add_salt(fact: DataFrame, hot: DataFrame, on: Sequence[str], salt: str = "_salt") -> DataFrame:
    """Number the split of every row; rows of a key that is not hot get 0.

    The salt mixes a hash of the row with the number of the task that read it:
    copies of one row are spread too, and a task that runs twice salts alike.
    """
    mixed = F.xxhash64(*[F.col(c) for c in fact.columns]) + F.spark_partition_id()
    return (
        fact.withColumn("_mixed", mixed)
        .join(hot, list(on), "left")
        .withColumn(salt, F.coalesce(F.pmod("_mixed", "_splits").cast("int"), F.lit(0)))
        .drop("_splits", "_mixed")
    )


def spread_rows(dim: DataFrame, hot: DataFrame, on: Sequence[str], salt: str = "_salt") -> DataFrame:
    """Repeat the rows of hot keys once per split; all others stay single."""
    last = F.coalesce(F.col("_splits"), F.lit(1)) - 1
    return (
        dim.join(hot, list(on), "left")
        .withColumn(salt, F.explode(F.sequence(F.lit(0), last)))
        .drop("_splits")
    )


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | str,
    how: str = "left",
    rows_per_split: int | None = None,
) -> DataFrame:
    """Bring the columns of ``dim`` (one row per key) to ``fact``.

    Spark broadcasts ``dim`` when its measured size is below its limit and
    otherwise splits hot partitions at run time.  Where a later step needs the
    partitioning of the join, the run-time split does not happen; then pass
    ``rows_per_split`` and hot keys are salted in the plan.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if rows_per_split is None:
        return fact.join(dim, keys, how)
    hot = hot_keys(fact, keys, rows_per_split)
    salted = add_salt(fact, hot, keys)
    return salted.join(spread_rows(dim, hot, keys), [*keys, "_salt"], how).drop("_salt")


def enrich(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], rows_per_split: int | None = None
) -> DataFrame:
    """Star join: left join every ``(dimension, key)`` to the fact table."""
    for dim, key in dims:
        fact = lookup_join(fact, dim, key, "left", rows_per_split)
    return fact


def questions_with_knowledge(
    questions: DataFrame,
    links: DataFrame,
    knowledge: DataFrame,
    question_key: str,
    knowledge_key: str,
    condition: Column,
    how: str = "left",
) -> DataFrame:
    """Left joins where ``condition`` belongs to ON, so it never removes left rows.

    ``how="inner"`` narrows the result to rows that meet the condition.
    """
    wanted = knowledge.filter(condition)
    return questions.join(links, question_key, how).join(wanted, knowledge_key, how)


def candidate_counts(
    left: DataFrame, right: DataFrame, keys: tuple[str, str], out: str = "candidates"
) -> DataFrame:
    """For every left row, how many right rows share the first **or** the second key.

    Counted as |A| + |B| - |A and B|.  The right side is read once and kept as counts
    per key pair; no pair of rows is ever formed, so two keys with millions of rows on
    both sides cost no more than two lookups.
    """
    a, b = keys
    both = materialize(right.groupBy(a, b).agg(F.count(F.lit(1)).alias("_ab")))
    counts = (
        left.join(both.groupBy(a).agg(F.sum("_ab").alias("_a")), a, "left")
        .join(both.groupBy(b).agg(F.sum("_ab").alias("_b")), b, "left")
        .join(both, [a, b], "left")
    )
    zero = F.lit(0).cast("long")
    total = F.coalesce("_a", zero) + F.coalesce("_b", zero) - F.coalesce("_ab", zero)
    return counts.select(*left.columns, total.alias(out))


def prefix_join(
    names: DataFrame, ids: DataFrame, scope: str, name: str, prefix: str
) -> DataFrame:
    """Names that start with an id of the same scope.

    A name yields its prefixes, but only in lengths that occur among the ids, and
    these are matched by an equi join.  The set of lengths is one short array (never
    longer than the longest id), so a scope with a third of all rows needs no
    nested loop.
    """
    wanted = ids.select(scope, prefix).filter(F.length(prefix) > 0).distinct()
    lengths = wanted.agg(F.collect_set(F.length(prefix))).scalar()
    fits = F.array_intersect(F.sequence(F.lit(1), F.length(name)), lengths)
    expanded = names.filter(F.length(name) > 0).withColumn("_len", F.explode(fits)).withColumn(
        prefix, F.substring(F.col(name), F.lit(1), F.col("_len"))
    )
    return expanded.drop("_len").join(wanted, [scope, prefix])


def pair_within(left: DataFrame, right: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Pair every left row with the value that is last in its group on the right.

    All pairings of a group followed by "last one wins" leave exactly this row, so
    the pairings themselves are not built.
    """
    last = right.groupBy(key).agg(F.max_by(value, order).alias(value))
    return left.join(last, key)


def missing_assets(refs: DataFrame, manifest: DataFrame, path: str) -> DataFrame:
    """Referenced paths without a copy; each path once."""
    return refs.select(path).filter(F.col(path).isNotNull()).distinct().join(
        manifest.select(path).distinct(), path, "left_anti"
    )


def popularity(
    rows: DataFrame, train: DataFrame, test: DataFrame, key: str, out: str,
    rows_per_split: int | None = None,
) -> DataFrame:
    """Count of ``key`` in train; where it is absent, in test; else 0."""
    seen = train.groupBy(key).agg(F.count(F.lit(1)).alias("_train"))
    later = test.groupBy(key).agg(F.count(F.lit(1)).alias("_test"))
    counts = seen.join(later, key, "full").select(
        key, F.coalesce("_train", "_test").alias(out)
    )
    joined = lookup_join(rows, counts, key, "left", rows_per_split)
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("long")))

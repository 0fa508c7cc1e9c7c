"""Counts, summaries, metrics and first/last/top rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riffle.operators.ordering import running_total
from riffle.session import materialize


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Rows per present value of ``col``."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))


def tag_counts(df: DataFrame, col: str, sep: str = ",", tag: str = "tag", out: str = "n") -> DataFrame:
    """Rows per part of a separated text column; ``sep`` is a regular expression."""
    return value_counts(df.select(F.explode(F.split(F.col(col), sep)).alias(tag)), tag, out)


def distribution_summary(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, exact quartiles and box-plot whiskers of a numeric column.

    Quartiles interpolate between ranks.  The ranks are found on the running count
    of distinct values, so no task holds all values.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = materialize(running_total(counts, [col], {"_upto": "_n"}))
    moments = ranked.agg(
        F.sum("_n").alias("n"),
        (F.sum(F.col(col) * F.col("_n")) / F.sum("_n")).alias("mean"),
    )
    total = moments.select("n").scalar()
    at = {}
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        place = (total - 1) * F.lit(share)
        low = F.min(F.when(F.col("_upto") > F.floor(place), F.col(col)))
        high = F.min(F.when(F.col("_upto") > F.ceil(place), F.col(col)))
        at[name] = (low + (high - low) * (place - F.floor(place))).alias(name)
    quartiles = materialize(ranked.agg(*at.values()))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fences = quartiles.select((F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))
    low_fence, high_fence = fences.select("lo").scalar(), fences.select("hi").scalar()
    return ranked.agg(
        F.sum("_n").alias("n"),
        (F.sum(F.col(col) * F.col("_n")) / F.sum("_n")).alias("mean"),
        *[F.max(quartiles.select(q).scalar()).alias(q) for q in ("q1", "median", "q3")],
        F.min(F.when(F.col(col) >= low_fence, F.col(col))).alias("whisker_low"),
        F.max(F.when(F.col(col) <= high_fence, F.col(col))).alias("whisker_high"),
    )


def interaction_counts(df: DataFrame, user: str, item: str, out: str = "num") -> DataFrame:
    """Rows per (user, item)."""
    return df.groupBy(user, item).agg(F.count(F.lit(1)).alias(out))


def flatten_lists(df: DataFrame, texts: str, images: str) -> DataFrame:
    """Join a text list without separator, an image list with a comma before each part."""
    joined = F.when(F.size(images) > 0, F.concat(F.lit(","), F.array_join(images, ","))).otherwise("")
    return df.withColumn(texts, F.array_join(texts, "")).withColumn(images, joined)


def last_by(df: DataFrame, key: str | Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Values of the row with the largest ``order`` per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key.  Spark cuts each task to one row per key before the shuffle."""
    return top_n(df, keys, order, 1)


def top_n(
    df: DataFrame, part: Sequence[str], order: Sequence[str | Column], n: int, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows per key; Spark applies the limit before the shuffle as well."""
    name = rank or "_rank"
    w = Window.partitionBy(*part).orderBy(*order)
    cut = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return cut if rank else cut.drop(name)


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_std") -> DataFrame:
    """(x - mean) / population deviation; 0 for a constant column."""
    out = df
    for c in cols:
        mean, dev = df.agg(F.avg(c)).scalar(), df.agg(F.stddev_pop(c)).scalar()
        out = out.withColumn(c + suffix, F.when(dev == 0, F.lit(0.0)).otherwise((F.col(c) - mean) / dev))
    return out


def scale_unit(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(x - min + 1) / (max - min + 1), which lies in (0, 1]."""
    low, high = df.agg(F.min(col)).scalar(), df.agg(F.max(col)).scalar()
    return df.withColumn(out or col, (F.col(col) - low + 1) / (high - low + 1))


def below_mean(df: DataFrame, col: str, out: str) -> DataFrame:
    """1 where the value is strictly below the mean, else 0."""
    mean = df.agg(F.avg(col)).scalar()
    return df.withColumn(out, F.when(F.col(col) < mean, 1).otherwise(0))


def mean_bucket(df: DataFrame, col: str, out: str, low: int = 1, high: int = 2) -> DataFrame:
    """``low`` up to and with the mean, ``high`` above it; null stays null."""
    mean = df.agg(F.avg(col)).scalar()
    value = F.when(F.col(col) <= mean, low).when(F.col(col) > mean, high)
    return df.withColumn(out, value)


def user_skill(df: DataFrame, user: str, num: str, form: str = "ratio", limit: int = 60) -> DataFrame:
    """Skill per user from (user, item, num) rows.

    ``ratio``: item count scaled to (0, 1] over the mean scaled ``num``, after the
    filter ``num < limit``.  ``smoothed``: (count + 1) / (mean num + 1) on all rows,
    then scaled to (0, 1].
    """
    if form == "ratio":
        kept = scale_unit(df.filter(F.col(num) < limit), num, "_scaled")
        per_user = kept.groupBy(user).agg(F.count(F.lit(1)).alias("_n"), F.avg("_scaled").alias("_m"))
        scaled = scale_unit(per_user, "_n")
        return scaled.select(user, (F.col("_n") / F.col("_m")).alias("su"))
    if form == "smoothed":
        per_user = df.groupBy(user).agg(
            ((F.count(F.lit(1)) + 1) / (F.avg(num) + 1)).alias("su")
        )
        return scale_unit(per_user, "su")
    raise ValueError(f"unknown form {form!r}")


def rmse(df: DataFrame, y: str, yhat: str, out: str = "rmse") -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(y) - F.col(yhat), 2))).alias(out))


def accuracy(df: DataFrame, y: str, yhat: str, out: str = "accuracy") -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias(out))


def auc(df: DataFrame, label: str, score: str, out: str = "auc") -> DataFrame:
    """Area under the ROC curve; ties count half.

    Rows are first reduced to one row per score, then the negatives below each
    score come from a running total over score ranges.
    """
    per_score = df.groupBy(score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_neg"),
    )
    ranked = running_total(per_score, [score], {"_upto": "_neg"})
    wins = F.col("_pos") * (F.col("_upto") - F.col("_neg") / 2)
    return ranked.agg(
        F.try_divide(F.sum(wins), F.sum("_pos").cast("double") * F.sum("_neg")).alias(out)
    )


def hash_split(df: DataFrame, keys: Sequence[str], share: float, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Repeatable split: (rows with the given share, the rest), by a hash of the keys."""
    u = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(1_000_000)) / 1_000_000.0
    marked = df.withColumn("_u", u)
    first = marked.filter(F.col("_u") < share).drop("_u")
    return first, marked.filter(F.col("_u") >= share).drop("_u")


def shuffle_rows(df: DataFrame, seed: int) -> DataFrame:
    """Random order that is the same for the same seed and rows."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]))

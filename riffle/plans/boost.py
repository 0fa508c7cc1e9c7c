"""Gradient-boosted trees on wide mixed features.

Categories with more values than the trees have bins go in as ordered target statistics: a row's code is the
smoothed mean label of the rows with the same category that come before it in a repeatable random order.  So no row's code
has seen its own label.  Rows scored later get the mean over all training rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.operators.aggregates import auc
from riffle.operators.ordering import running_total
from riffle.session import materialize, shared_folder


#: Training rows of one task: the trees keep every row in memory, several times as large as it is on disk.
ROWS_PER_TASK = 500_000


@dataclass(frozen=True)
class TargetCodes:
    """Smoothed mean label of every value of some columns: rows (col, value, code), and the code of a value never seen."""

    table: DataFrame
    columns: tuple[str, ...]
    prior: float


@dataclass(frozen=True)
class Boosted:
    """Trees, and the codes of the columns too wide for them."""

    trees: PipelineModel
    codes: TargetCodes | None


@contextmanager
def _small_scans(spark: SparkSession, wanted: bool):
    """Scans of few row groups a task; the setting is given back."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        if wanted:
            spark.conf.set(name, str(4 << 20))
        yield
    finally:
        spark.conf.set(name, before)


def _value(c: str):
    """Category as text; a missing one is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("?"))


def ordered_target_codes(
    df: DataFrame, columns: Sequence[str], label: str, order: Sequence[str], weight: float = 1.0, seed: int = 1
) -> tuple[DataFrame, TargetCodes]:
    """``df`` with a column ``<c>_code`` for each of ``columns``, and what codes later rows.

    The code is (sum of the labels before + weight * prior) / (rows before + weight) among rows of the same value, where the
    prior is the mean label of all.  ``order`` names columns that tell rows apart; their md5 after the seed is the order.
    Running sums are made over ranges of (value, order), so a value of a third of all rows lies in many tasks.
    """
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]))
    # sixteen bytes sort like the thirty-two characters, and every sort and join below moves them
    out = materialize(df.withColumn("_mark", F.unhex(mark)))
    prior = float(out.agg(F.avg(label)).first()[0] or 0.0)
    tables = []
    for c in columns:
        rows = out.withColumn("_value", _value(c)).withColumn("_one", F.lit(1).cast("long")).withColumn("_y", F.col(label).cast("long"))
        summed = materialize(running_total(rows, ["_value", "_mark"], {}, before={"_n": "_one", "_s": "_y"}))
        # a value's rows lie side by side, and sums never fall: the smallest is that of all values before
        first = materialize(summed.groupBy("_value").agg(F.min("_n").alias("_n0"), F.min("_s").alias("_s0"), F.sum("_one").alias("_all"), F.sum("_y").alias("_hits")))
        code = (F.col("_s") - F.col("_s0") + weight * prior) / (F.col("_n") - F.col("_n0") + weight)
        kept = [x for x in out.columns if x != "_mark" or c != columns[-1]]
        out = materialize(summed.join(first, "_value").select(*kept, code.alias(f"{c}_code")), ROWS_PER_TASK)
        tables.append(first.select(F.lit(c).alias("col"), F.col("_value").alias("value"), ((F.col("_hits") + weight * prior) / (F.col("_all") + weight)).alias("code")))
    table = tables[0]
    for t in tables[1:]:
        table = table.unionByName(t)
    return out.drop("_mark"), TargetCodes(materialize(table), tuple(columns), prior)


def coded(df: DataFrame, codes: TargetCodes) -> DataFrame:
    """``df`` with the codes of its values; values never seen in training get the prior."""
    for c in codes.columns:
        own = codes.table.where(F.col("col") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"{c}_code"))
        df = df.withColumn("_value", _value(c)).join(own, "_value", "left").drop("_value")
        df = df.withColumn(f"{c}_code", F.coalesce(f"{c}_code", F.lit(codes.prior)))
    return df


def fit_gbt(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    rounds: int = 100,
    rate: float = 0.2,
    depth: int = 7,
    row_share: float = 0.95,
    feature_share: float = 0.9,
    bins: int = 256,
    seed: int = 1,
    missing: float = -1.0,
    order: Sequence[str] = (),
) -> Boosted:
    """Boosted trees for a 0/1 label.

    Large tables are read by tasks of at most ``ROWS_PER_TASK`` rows, without a shuffle: their files hold no more.  A table
    that ``materialize`` wrote is read as it is, so write it with that limit.

    Missing numbers become ``missing``, missing categories a value of their own.  A categorical column with more values than
    fit ``bins`` becomes a number by ordered target statistics; ``order`` names columns that tell rows apart (default: all).
    """
    codes = None
    sizes = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_distinct(c).alias(c) for c in categorical]).first().asDict()
    if categorical:
        wide = [c for c in categorical if sizes[c] > bins - 2]
        if wide:
            df, codes = ordered_target_codes(df, wide, label, order or df.columns, seed=seed)
            numeric = [*numeric, *[f"{c}_code" for c in wide]]
            categorical = [c for c in categorical if c not in wide]
    sc = df.sparkSession.sparkContext
    large = sizes["_rows"] > ROWS_PER_TASK * sc.defaultParallelism
    if large and not hasattr(df, "_riffle_path") and not codes:
        df = materialize(df, ROWS_PER_TASK)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    index = [
        StringIndexer(inputCol=c, outputCol=f"_ix_{c}", handleInvalid="keep", stringOrderType="alphabetAsc")
        for c in categorical
    ]
    filled = ", ".join(f"coalesce(cast({c} as double), {missing}) as _n_{c}" for c in numeric)
    fill = SQLTransformer(statement=f"select *, {filled} from __THIS__")
    gather = VectorAssembler(
        inputCols=[*[f"_n_{c}" for c in numeric], *[f"_ix_{c}" for c in categorical]], outputCol="_features"
    )
    trees = GBTClassifier(
        labelCol=label, featuresCol="_features", maxIter=rounds, stepSize=rate, maxDepth=depth,
        subsamplingRate=row_share, featureSubsetStrategy=str(feature_share), maxBins=bins, seed=seed,
    )
    with _small_scans(df.sparkSession, large):
        return Boosted(Pipeline(stages=[*index, fill, gather, trees]).fit(df), codes)


def score(model: Boosted, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of label 1 next to the columns of ``df``."""
    scored = model.trees.transform(coded(df, model.codes) if model.codes else df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(out))


def holdout_auc(model: Boosted, df: DataFrame, label: str) -> float | None:
    """Area under the curve over rows the model has not seen; null if they are all of one class."""
    return auc(score(model, df, "_score"), label, "_score").first()[0]


def best_per_id(scored: DataFrame, key: str, value: str) -> DataFrame:
    """Largest score per id, since tag rows repeat an id."""
    return scored.groupBy(key).agg(F.max(value).alias(value))

"""Global order without a one-task window.

A window without ``partitionBy`` moves the whole table to one task.  Here the rows
are range partitioned, each range is numbered or summed on its own, and only one
row per range (the range total) is added up in a single task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riffle.operators.joins import lookup_join
from riffle.session import materialize

_RANGE = "_range"
_ROW = "_row"
_TIE = "_tie"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sorted_ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows cut to ordered ranges: ``_range`` is the range, ``_row`` the place in it.

    The task that read a row is the last sort key, so rows with equal keys can still be
    cut into several ranges.  The result is written to the shared folder, so range
    numbers stay the same however often the table is read.
    """
    tied = df.withColumn(_TIE, F.spark_partition_id())
    keys = [*[_col(c) for c in order], F.col(_TIE)]
    ranged = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_TIE)
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialize(
        ranged.withColumn(_RANGE, F.spark_partition_id()).withColumn(_ROW, in_range)
    )


def _offsets(totals: DataFrame, value: str, out: str) -> DataFrame:
    """Sum of all earlier ranges; one row per range, so one task and a broadcast are safe."""
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        totals.select(_RANGE, F.coalesce(F.sum(value).over(before), F.lit(0)).alias(out))
    )


def global_index(df: DataFrame, order: Sequence[str | Column], out: str) -> DataFrame:
    """0-based position of each row in the order over the whole table."""
    ranged = sorted_ranges(df, order)
    counts = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_n"))
    return (
        ranged.join(_offsets(counts, "_n", "_before"), _RANGE)
        .withColumn(out, F.col("_before") + F.col(_ROW))
        .drop(_RANGE, _ROW, "_before")
    )


def running_total(
    df: DataFrame,
    order: Sequence[str | Column],
    values: dict[str, str],
    before: dict[str, str] | None = None,
) -> DataFrame:
    """Running sums over the whole table; ``values`` maps output name to input column.

    ``before`` maps names to input columns whose sum up to, but without, the row is
    wanted; it equals the running sum of the row ahead to the last bit.
    """
    ranged = sorted_ranges(df, order)
    cols = sorted({*values.values(), *(before or {}).values()})
    totals = ranged.groupBy(_RANGE).agg(
        F.max(_ROW).alias("_last"), *[F.sum(c).alias(f"_s_{c}") for c in cols]
    )
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    upto_range = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = F.broadcast(
        totals.select(
            _RANGE,
            "_last",
            *[F.coalesce(F.sum(f"_s_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in cols],
            *[F.sum(f"_s_{c}").over(upto_range).alias(f"_t_{c}") for c in cols],
        )
    )
    in_range = Window.partitionBy(_RANGE).orderBy(_ROW)
    upto = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = in_range.rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.select(
        "*",
        *[F.sum(c).over(upto).alias(f"_i_{o}") for o, c in values.items()],
        *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"_i_{o}") for o, c in (before or {}).items()],
    ).join(offsets, _RANGE)
    closing = F.col(_ROW) == F.col("_last")
    return summed.select(
        *df.columns,
        *[
            F.when(closing, F.col(f"_t_{c}")).otherwise(F.col(f"_b_{c}") + F.col(f"_i_{o}")).alias(o)
            for o, c in values.items()
        ],
        *[(F.col(f"_b_{c}") + F.col(f"_i_{o}")).alias(o) for o, c in (before or {}).items()],
    )


def last_before(points: DataFrame, marks: DataFrame, point: str, mark: str, out: str = "found") -> DataFrame:
    """``points`` with ``out``, a struct of the last row of ``marks`` whose ``mark`` is not above ``point``; null if none.

    Both sides are sorted together and cut into ranges.  Within a range the last mark is carried along, and
    the last mark of all earlier ranges is carried in, one row per range.  The cost is that of one sort of both
    tables, wherever the points lie: many points between two marks are cut into several ranges.  Points and
    marks that are null meet nothing; of equal marks any one is taken.
    """
    names = [F.col(c).alias(f"m{n}") for n, c in enumerate(marks.columns)]
    held = F.struct(*names)
    left = points.select(F.col(point).cast("double").alias("_at"), F.lit(1).alias("_kind"), F.struct(*points.columns).alias("_p"))
    right = marks.filter(F.col(mark).isNotNull()).select(F.col(mark).cast("double").alias("_at"), F.lit(0).alias("_kind"), held.alias("_m"))
    both = left.unionByName(right, allowMissingColumns=True)
    ranged = sorted_ranges(both, ["_at", "_kind"])
    ends = ranged.groupBy(_RANGE).agg(F.max_by("_m", F.when(F.col("_m").isNotNull(), F.col(_ROW))).alias("_m"))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.broadcast(ends.select(_RANGE, F.last("_m", ignorenulls=True).over(earlier).alias("_carried")))
    upto = Window.partitionBy(_RANGE).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = ranged.withColumn("_m", F.last("_m", ignorenulls=True).over(upto)).filter(F.col("_kind") == 1).join(carried, _RANGE)
    last = F.when(F.col("_at").isNotNull(), F.coalesce("_m", "_carried"))
    return met.withColumn("_m", last).select(
        *[F.col("_p")[c].alias(c) for c in points.columns],
        F.when(F.col("_m").isNotNull(), F.struct(*[F.col("_m")[f"m{n}"].alias(c) for n, c in enumerate(marks.columns)])).alias(out),
    )


def positions(
    df: DataFrame, key: str, order: Sequence[str | Column], out: str = "pos", rows_per_split: int | None = None
) -> DataFrame:
    """0-based position of each row within its key.

    The rows of one key are contiguous in the global order, so the position is the
    global index minus the smallest index of the key.  A key that holds a third of
    the table is spread over many ranges.
    """
    indexed = materialize(global_index(df, [key, *order], "_idx"))
    first = indexed.groupBy(key).agg(F.min("_idx").alias("_first"))
    return (
        lookup_join(indexed, first, key, "inner", rows_per_split)
        .withColumn(out, F.col("_idx") - F.col("_first"))
        .drop("_idx", "_first")
    )


def vocabulary(values: DataFrame, col: str, code: str = "code") -> DataFrame:
    """Distinct present values of ``col`` with their 0-based rank in sorted order."""
    distinct = values.select(col).filter(F.col(col).isNotNull()).distinct()
    return global_index(distinct, [col], code)


def _field_values(values: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Distinct (field, number, value) of several columns or tag arrays, read in one pass."""
    types = {f.name: f.dataType for f in values.select(*[c.alias(n) for n, c in fields.items()]).schema.fields}

    def entry(name: str, value: Column, numeric: bool) -> Column:
        number = value.cast("double") if numeric else F.lit(None).cast("double")
        return F.struct(F.lit(name).alias("field"), number.alias("number"), value.cast("string").alias("value"))

    single, lists = [], []
    for name, c in fields.items():
        if types[name].typeName() == "array":
            entries = F.transform(c, _entry_of(entry, name))
            lists.append(F.coalesce(entries, F.array().cast("array<struct<field:string,number:double,value:string>>")))
        else:
            single.append(entry(name, c, types[name].typeName() != "string"))
    listed = F.concat(F.array(*single), *lists) if single else F.concat(*lists)
    return values.select(F.explode(listed).alias("s")).select("s.*").filter("value is not null").distinct()


def _entry_of(entry: Callable[[str, Column, bool], Column], name: str) -> Callable[[Column], Column]:
    return lambda x: entry(name, x, False)


def vocabularies(sources: Sequence[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Vocabularies of many fields with one sort: rows (field, value, code).

    Every source names its fields as columns or arrays of tags; a field may come from
    several sources.  Values are text; numbers keep their numeric order.
    """
    parts = [_field_values(df, fields) for df, fields in sources]
    distinct = parts[0] if len(parts) == 1 else reduce(DataFrame.unionAll, parts).distinct()
    indexed = materialize(global_index(distinct, ["field", "number", "value"], "_idx"))
    first = F.broadcast(indexed.groupBy("field").agg(F.min("_idx").alias("_first")))
    return indexed.join(first, "field").select("field", "value", (F.col("_idx") - F.col("_first")).alias("code"))


def label_encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each column by the rank of its value among the distinct values."""
    out = df
    for c in cols:
        vocab = vocabulary(df, c, "_code")
        out = out.join(vocab, c, "left").withColumn(c, F.col("_code")).drop("_code")
    return out.select(*df.columns)


def encode_ids(df: DataFrame, col: str, vocab: DataFrame, out: str, code: str = "code") -> DataFrame:
    """1-based place of ``col`` in ``vocab``; null where the value is unknown."""
    lookup = vocab.select(F.col(vocab.columns[0]).alias(col), (F.col(code) + 1).alias(out))
    return df.join(lookup, col, "left")


def cumulative_share(
    df: DataFrame, weight: str, order: Sequence[str | Column], total_out="cum_sum", share_out="cum_pct"
) -> DataFrame:
    """Running sum of ``weight`` and the same as per cent of the whole."""
    summed = running_total(df, order, {total_out: weight})
    whole = df.agg(F.sum(weight)).scalar()
    return summed.withColumn(share_out, F.col(total_out) * 100 / whole)

"""Column functions for song, member and log fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Delimiters of multi-value fields, placeholder artist names and the
# language codes behind the language flag.
SPLIT_ALL = r"[/\\;|&]"
COUNT_SEPS = r"[|/\\;]"
GENRE_SEP = r"\|"
ARTIST_MARKS = ("and", ",", "feat", "&")
UNKNOWN_ARTISTS = ("no_artist", "佚名", "群星")
FLAGGED_LANGUAGES = ("17.0", "45.0")


def isrc_year(c: Column) -> Column:
    """Year from characters 6-7 of a recording code: above 17 is 19xx, else 20xx."""
    yy = F.substring(c, 6, 2).try_cast("int")
    return F.when(yy > 17, yy + 1900).when(yy <= 17, yy + 2000)


def isrc_area(c: Column) -> Column:
    return F.substring(c, 1, 2)


def writer_count(c: Column, missing: str | None = None) -> Column:
    """Number of names in a multi-value field; 0 for null or the missing marker."""
    absent = c.isNull() if missing is None else c.isNull() | (c == missing)
    return F.when(absent, 0).otherwise(F.regexp_count(c, F.lit(COUNT_SEPS)) + 1)


def is_featured(c: Column) -> Column:
    return F.coalesce(c.contains("feat").cast("int"), F.lit(0))


def artist_count(c: Column) -> Column:
    """Joining marks in an artist name; 0 for null and placeholder names."""
    marks = sum((F.regexp_count(c, F.lit(m)) for m in ARTIST_MARKS), F.lit(0))
    return F.when(c.isNull() | c.isin(*UNKNOWN_ARTISTS), 0).otherwise(marks)


def same_value(first: Column, *others: Column) -> Column:
    """1 where all columns are present and equal, else 0."""
    test = F.lit(True)
    for other in others:
        test = test & (first == other)
    return F.coalesce(test.cast("int"), F.lit(0))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    test = F.lit(False)
    for w in words:
        test = test | c.contains(w)
    return F.coalesce(test.cast("int"), F.lit(0))


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def date_parts(c: Column, prefix: str) -> list[Column]:
    return [
        F.year(c).alias(f"{prefix}_year"),
        F.month(c).alias(f"{prefix}_month"),
        F.dayofmonth(c).alias(f"{prefix}_day"),
    ]


def tags(c: Column, sep: str = SPLIT_ALL) -> Column:
    return F.split(c, sep)


def normalize_tags(c: Column) -> Column:
    """All delimiters written as a bar."""
    return F.array_join(tags(c), "|")


def explode_tags(
    df: DataFrame, col: str, out: str, keep_missing: bool = True, sep: str = SPLIT_ALL
) -> DataFrame:
    """One row per tag; a missing field keeps its row with a null tag if asked."""
    make = F.explode_outer if keep_missing else F.explode
    return df.select("*", make(tags(F.col(col), sep)).alias(out))


def first_tag(c: Column, sep: str = SPLIT_ALL) -> Column:
    return F.element_at(tags(c, sep), 1)


def map_codes(c: Column, codes: Mapping[str, int], default: int) -> Column:
    value = F.lit(default)
    for k, v in codes.items():
        value = F.when(c == k, v).otherwise(value)
    return value


def signed_label(c: Column, negative_value) -> Column:
    """-1 for one class, +1 for every other."""
    return F.when(c == negative_value, -1).otherwise(1)


def close_to(a: Column, b: Column, tol: float) -> Column:
    """Both present and not zero, and less than ``tol`` apart."""
    return F.coalesce((a != 0) & (b != 0) & (F.abs(a - b) < tol), F.lit(False))


def equal_present(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def shares_tag(a: Column, b: Column, sep: str = SPLIT_ALL) -> Column:
    return F.coalesce(F.arrays_overlap(tags(a, sep), tags(b, sep)), F.lit(False))


def drop_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every named column is present and not the empty string."""
    keep = F.lit(True)
    for c in cols:
        keep = keep & F.col(c).isNotNull()
        if df.schema[c].dataType.simpleString() == "string":
            keep = keep & (F.col(c) != "")
    return df.filter(keep)


def fill_missing(df: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column; a rule may be a constant or a Column."""
    value = {c: v if isinstance(v, Column) else F.lit(v) for c, v in rules.items()}
    return df.select(
        *[
            F.coalesce(F.col(f.name), value[f.name].cast(f.dataType)).alias(f.name)
            if f.name in value
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def cast_by_type(df: DataFrame, from_: str, to: str) -> DataFrame:
    """Cast every column of one type to another."""
    return df.select(
        *[
            F.col(f.name).cast(to).alias(f.name) if f.dataType.simpleString() == from_ else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def sparse_features(groups: Sequence[Sequence[tuple[int, Column]]], target: Column) -> Column:
    """``target n1 n2 n3 index:value ...`` with the absent values left out.

    Every group is a list of (index, value); a null value is absent.  The counts in
    front tell how many values of each group are present.
    """
    kept = [
        F.filter(
            F.array(*[F.when(v.isNotNull(), F.concat(F.lit(f"{i}:"), v.cast("string"))) for i, v in g]),
            lambda x: x.isNotNull(),
        )
        for g in groups
    ]
    return F.concat_ws(
        " ", target.cast("string"), *[F.size(k).cast("string") for k in kept], *kept
    )


def indexed_features(cols: Sequence[tuple[int, Column]]) -> list[Column]:
    """Each value written as ``index:value``."""
    return [F.concat(F.lit(f"{i}:"), c.cast("string")) for i, c in cols]


def asset_path(c: Column, marker: str, prefix_len: int) -> tuple[Column, Column]:
    """(local path from ``marker`` on, remote path without the fixed prefix).

    A backslash anywhere in the local path costs it its last character.
    """
    local = F.regexp_extract(c, f"({marker}.*)", 1)
    local = F.when(local.contains("\\"), F.left(local, F.length(local) - 1)).otherwise(local)
    return local, F.substring(c, F.lit(prefix_len + 1), F.length(c))


def char_after(c: Column, word: str) -> Column:
    return F.nullif(F.regexp_extract(c, f"{word}(.)", 1), F.lit(""))


def file_extension(c: Column) -> Column:
    return F.regexp_extract(c, r"\.[^./]+$", 0)

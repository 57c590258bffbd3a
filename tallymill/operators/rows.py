"""Row-level operators: filters, renames, fills, duplicates, set difference, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def open_range(column: Column, low, high) -> Column:
    """low < x < high, compared as typed values (midnight of the `low` day is outside)."""
    return (column > low) & (column < high)


def _top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    `row_number() = 1` lets Spark keep one row per key in every map task before the shuffle
    (WindowGroupLimit), so a key that holds much of the data sends one row per task. Sorting by a
    64-bit hash of the key first settles nearly every comparison on the sort prefix.
    """
    window = Window.partitionBy("_kh", *keys).orderBy(*(order or [F.lit(0)]))
    hashed = df.withColumn("_kh", F.xxhash64(*keys))
    return hashed.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn", "_kh")


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by all remaining columns, nulls first."""
    return _top_per_key(df, keys, [F.col(c).asc_nulls_first() for c in df.columns if c not in keys])


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the highest version per key, ties broken by the remaining columns."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys and c != version]
    return _top_per_key(df, keys, [F.col(version).desc_nulls_last(), *rest])


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` plus a column that filters above it read instead of repeating.

    A filter on a computed column is normally rewritten in terms of the columns below it, down to
    the scan, so a payload parsed once is parsed again for every mention in the filter. Passing the
    value through a one-element explode keeps the filter above it.
    """
    computed = df.select("*", F.struct(value.alias(name)).alias("_once"))
    return computed.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array("_once")))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of `left` that are not in `right`.

    Both sides are reduced to distinct rows first: that combines on the map side, so copies of one
    row never meet in one task.
    """
    return left.distinct().subtract(right.distinct())


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.exceptAll(right)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dev_limit(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """First n rows in a total order for development runs; everything when n is None."""
    return df if n is None else df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)

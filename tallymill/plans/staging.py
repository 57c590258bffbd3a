"""Staging: one row per site, date and time, typed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.keys import surrogate_key
from tallymill.functions.times import parse_date, parse_time_of_day
from tallymill.operators.rows import dev_limit, first_per_key

# Direction, path and mode are deliberately not part of the key; pass other keys to keep them apart.
KEYS = ("UnqID", "Date", "Time")


def to_int(text: Column, strict: bool = False) -> Column:
    return text.cast("int") if strict else text.try_cast("int")


def stage(
    raw: DataFrame,
    keys: Sequence[str] = KEYS,
    source: str | None = None,
    strict: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Staged counts from raw all-string records in batch names.

    Rows without a site go; of the rows that share the keys one stays. With `source`, duplicates are
    only sought within one source, so many yearly sources are staged in one pass.
    """
    within = [source] if source else []
    kept = first_per_key(raw.where(F.col("UnqID").isNotNull()), [*within, *keys])
    staged = kept.select(
        *within,
        surrogate_key(*keys).alias("cyclingid"),
        F.col("Year").alias("year"),
        F.col("UnqID").alias("unqid"),
        parse_date(F.col("Date"), strict=strict).alias("date"),
        parse_time_of_day(F.col("Time"), strict=strict).alias("time"),
        F.col("Weather").alias("weather"),
        F.col("Day").alias("day"),
        F.col("Round").alias("round"),
        F.col("Dir").alias("dir"),
        F.col("Path").alias("path"),
        F.col("Mode").alias("mode"),
        to_int(F.col("Count"), strict).alias("count"),
    )
    return dev_limit(staged, limit, ["unqid", "date", "time", "cyclingid"])

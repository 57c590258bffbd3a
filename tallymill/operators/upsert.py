"""Keyed inserts, updates and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.operators.rows import latest_per_key


def new_keys(incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the target lacks."""
    return incoming.join(target.select(*keys), list(keys), "left_anti")


def newer_rows(incoming: DataFrame, target: DataFrame, keys: Sequence[str], version: Column, current: str) -> DataFrame:
    """Incoming rows whose key exists with an older version. Matched by key, not by position."""
    held = target.select(*keys, F.col(current).alias("_held"))
    return (
        incoming.withColumn("_version", version)
        .join(held, list(keys))
        .where(F.col("_held") < F.col("_version"))
        .drop("_held", "_version")
    )


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """`target` with `incoming` set on top, by key.

    Only the columns that `incoming` carries are overwritten, and a null it carries overwrites too.
    New keys get null in the other columns. With `version`, several incoming rows of one key are
    first reduced to the latest; without it their keys must be unique.
    """
    if version:
        incoming = latest_per_key(incoming, keys, version)
    # the marker must not be a bare literal: it has to be null on rows the join leaves unmatched
    given = incoming.select("*", F.lit(True).alias("_given")).alias("n")
    held = target.alias("o")
    joined = held.join(given, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        elif c in incoming.columns:
            out.append(F.when(F.col("n._given"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}"))
    out += [F.col(f"n.{c}") for c in incoming.columns if c not in target.columns]
    return joined.select(*out)


def sync(target: DataFrame, incoming: DataFrame, keys: Sequence[str], version: Column, current: str) -> DataFrame:
    """Insert unknown keys and apply newer rows; older or equal rows leave the target alone.

    Of several incoming rows of one key the newest counts. Columns that only `incoming` has are kept,
    with null for target rows that no row replaces. One full outer join does both, so the two sides
    shuffle once.
    """
    given = latest_per_key(incoming.withColumn("_version", version), keys, "_version").alias("n")
    held = target.withColumns({"_held": F.col(current), "_there": F.lit(True)}).alias("o")
    take = F.col("o._there").isNull() | F.coalesce(F.col("o._held") < F.col("n._version"), F.lit(False))
    joined = held.join(given, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in incoming.columns:
            out.append(F.when(take, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}"))
    out += [F.when(take, F.col(f"n.{c}")).alias(c) for c in incoming.columns if c not in target.columns]
    return joined.select(*out)

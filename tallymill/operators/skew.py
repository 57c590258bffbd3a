"""Joining a per-key lookup back to rows whose keys may be badly skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000


def attach_counts(rows: DataFrame, counts: DataFrame, key: str, count: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """`rows` plus the `count` of its key from `counts` (one row per key); null where the key is absent.

    The `hot_keys` biggest keys are read off a broadcast of at most that many rows, so every key
    left for the shuffle holds less than 1/hot_keys of the rows. Rows already answered, and rows
    with a null key, stay in the same join but are spread by their map partition instead of their
    key. The partition number is the same when a lost task runs again.
    """
    hot = (
        counts.where(F.col(key).isNotNull())
        .orderBy(F.desc(count), F.col(key))
        .limit(hot_keys)
        .select(F.col(key).alias("_hk"), F.col(count).alias("_hn"))
    )
    near = rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left").drop("_hk")
    answered = F.col("_hn").isNotNull() | F.col(key).isNull()
    near = near.withColumn("_spread", F.when(answered, F.spark_partition_id()).otherwise(-1))
    far = counts.select(F.col(key).alias("_fk"), F.col(count).alias("_fn"), F.lit(-1).alias("_fs"))
    joined = near.join(far, (F.col(key) == F.col("_fk")) & (F.col("_spread") == F.col("_fs")), "left")
    return joined.withColumn(count, F.coalesce("_hn", "_fn")).drop("_hn", "_fk", "_fn", "_fs", "_spread")

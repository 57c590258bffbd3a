"""Distributions and quantiles for profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def categorical(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value. The total comes from the counted groups, not from a second pass."""
    groups = df.groupBy(column).agg(F.count("*").alias("n_rows"))
    total = groups.agg(F.sum("n_rows")).scalar()
    return groups.withColumn("share", F.col("n_rows") / total)


def temporal(df: DataFrame, column: str, unit: str) -> DataFrame:
    """Rows per calendar bucket (`day`, `month`, `quarter`, `year`...)."""
    bucket = F.date_trunc(unit, F.col(column)).cast("timestamp_ntz")
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_rows"))


def quantiles(
    df: DataFrame, keys: Sequence[str], value: Column, points: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """(keys, quantile, value): exact discrete quantiles, the smallest value that the share of rows reaches.

    A mergeable sketch of bounded size brackets each quantile within 2/accuracy of its rank. A second
    pass counts the rows below the bracket and each value inside; both are combined on the map side,
    and only the bracket's values are ordered. `accuracy` is a matter of cost, not of the result.
    """
    rows = df.select(*keys, value.alias("_v")).where(F.col("_v").isNotNull())
    edges = [min(max(p + d, 0.0), 1.0) for p in points for d in (-2 / accuracy, 2 / accuracy)]
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("_v", edges, accuracy).alias("_e"), F.count("*").alias("_n"))
    brackets = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("quantile"),
                F.get("_e", 2 * i).alias("_low"),
                F.get("_e", 2 * i + 1).alias("_high"),
                F.greatest(F.ceil(F.col("_n") * F.lit(float(p))), F.lit(1)).alias("_rank"),
            )
            for i, p in enumerate(points)
        ]
    )
    asked = sketch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.inline(brackets))
    same = [rows[k].eqNullSafe(asked[f"_k{i}"]) for i, k in enumerate(keys)]
    met = rows.join(asked, same) if keys else rows.crossJoin(F.broadcast(asked))  # as many rows as points
    inside = met.where(F.col("_v") <= F.col("_high")).withColumn("_v", F.when(F.col("_v") >= F.col("_low"), F.col("_v")))
    counted = inside.groupBy(*keys, "quantile", "_rank", "_v").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*keys, "quantile").orderBy(F.col("_v").asc_nulls_first()))
    reached = counted.withColumn("_upto", upto).where(F.col("_v").isNotNull() & (F.col("_upto") >= F.col("_rank")))
    return reached.groupBy(*keys, "quantile").agg(F.min("_v").alias("value"))

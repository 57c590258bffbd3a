"""Fact and marts.

No join here is forced to broadcast: Spark broadcasts the locations when their size, estimated or
measured by AQE, is under its threshold, and otherwise merges and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.text import wave_quarter, wave_year
from tallymill.schemas import LOCATION


def dim_locations(locations: DataFrame) -> DataFrame:
    return locations.select(*LOCATION.fieldNames())


def fact(staged: DataFrame, locations: DataFrame) -> DataFrame:
    """Staged counts with their location; sites without a location drop."""
    f, d = staged.alias("f"), locations.alias("d")
    return f.join(d, F.col("f.unqid") == F.col("d.site_id")).select("f.*", "d.*")


def total_by(staged: DataFrame, locations: DataFrame, by: dict[str, Column]) -> DataFrame:
    """Sum of the counts of the fact by `by` (output name -> expression over the fact's columns).

    The counts are summed per site before the join, so the join sees one row per site and group
    instead of every count. A site listed twice still counts twice, as in the fact.
    """
    per_site = {n: c for n, c in by.items() if n not in locations.columns}
    small = staged.groupBy("unqid", *[c.alias(f"_{n}") for n, c in per_site.items()]).agg(F.sum("count").alias("_sum"))
    joined = small.join(locations, F.col("unqid") == F.col("site_id"))
    keys = [(F.col(f"_{n}") if n in per_site else by[n]).alias(n) for n in by]
    return joined.groupBy(*keys).agg(F.sum("_sum").alias("total_count"))


def by_borough_road(staged: DataFrame, locations: DataFrame) -> DataFrame:
    return total_by(staged, locations, {"borough": F.col("borough"), "road_type": F.col("road_type")})


def by_day_type(staged: DataFrame, locations: DataFrame, weekend_only: bool = False) -> DataFrame:
    """Totals per day type. Both types by default; `weekend_only` keeps the weekend."""
    rows = staged.where(F.col("day") == "Weekend") if weekend_only else staged
    return total_by(rows, locations, {"day": F.col("day")})


def by_quarter(staged: DataFrame, locations: DataFrame) -> DataFrame:
    """Totals per year and quarter, both derived from the wave text."""
    return total_by(
        staged, locations, {"year": wave_year(F.col("year")), "quarter": wave_quarter(F.col("year"))}
    )

"""File manifests: from a listing, against the last known state, and what to fetch next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.functions.text import contains_ci
from tallymill.sources.versions import VersionedTable

CELLS = ["name", "last_modified", "size", "type", "description"]


CHUNK = 1024  # row numbers whose levels are looked at together


def listing_to_manifest(listing: DataFrame, by: str | None = None) -> DataFrame:
    """CSV files of the first folder in a listing table (row_no, data_level, five text cells).

    The block starts at the first level-2 row and ends before the first later row whose level is
    neither 2 nor 3; rows without a level end nothing. Both ends come from one pass over the rows
    that are no files, within chunks of row numbers first and over the chunks of a listing then, so
    a listing is never sorted or gathered. `by` names a column that tells several listings apart.
    """
    keys = [by] if by else ["_all"]
    listing = listing if by else listing.withColumn("_all", F.lit(1))
    level, row = F.col("data_level"), F.col("row_no")
    bounds = _block(listing.where(level != 3).select(*keys, row, level), keys)
    inside = listing.join(bounds if by else F.broadcast(bounds), keys)
    inside = inside.where((row > F.col("_start")) & (F.col("_end").isNull() | (row < F.col("_end"))))
    cells = [F.trim(c).alias(c) for c in CELLS]
    return inside.where((level == 3) & (F.trim(F.col("type")) == "CSV file")).select(
        *([by] if by else []), "row_no", *cells
    )


def _block(marks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _start, _end): the first level-2 row, and the first row of another level after it, if any."""
    level, row = F.col("data_level"), F.col("row_no")
    chunks = marks.groupBy(*keys, F.floor(row / CHUNK).alias("_chunk")).agg(
        F.min(F.when(level == 2, row)).alias("_folder"),
        F.min(F.when(level != 2, row)).alias("_stop"),
        F.collect_set(F.when(level != 2, row)).alias("_stops"),
    )
    later = F.array_min(F.filter("_stops", lambda r: r > F.col("_folder")))
    everywhere = Window.partitionBy(*keys)
    chunks = chunks.withColumn("_later", later).withColumn("_start", F.min("_folder").over(everywhere))
    end = F.when(F.col("_folder") == F.col("_start"), F.col("_later")).when(F.col("_stop") > F.col("_start"), F.col("_stop"))
    return chunks.where("_start is not null").groupBy(*keys).agg(F.min("_start").alias("_start"), F.min(end).alias("_end"))


def classify(manifest: DataFrame, state: DataFrame) -> DataFrame:
    """Every known or listed file with its status: new, updated, unchanged or missing.

    `manifest` is (name, last_modified); `state` is (name, create_timestamp, update_timestamp). The
    result carries the timestamps the state gets once the manifest is stored.
    """
    m, s = manifest.alias("m"), state.alias("s")
    both = m.join(s, F.col("m.name") == F.col("s.name"), "full_outer")
    status = (
        F.when(F.col("s.name").isNull(), "new")
        .when(F.col("m.name").isNull(), "missing")
        .when(F.col("s.update_timestamp") < F.col("m.last_modified"), "updated")
        .otherwise("unchanged")
    )
    return both.select(
        F.coalesce(F.col("m.name"), F.col("s.name")).alias("name"),
        status.alias("status"),
        F.coalesce(F.col("s.create_timestamp"), F.col("m.last_modified")).alias("create_timestamp"),
        F.when(status.isin("new", "updated"), F.col("m.last_modified"))
        .otherwise(F.col("s.update_timestamp"))
        .alias("update_timestamp"),
    )


def to_fetch(manifest: DataFrame, fetched: DataFrame, version: str, place: str | None = None) -> DataFrame:
    """Files never fetched, or fetched in another version; optionally those of one place only.

    `fetched` holds one row per file name with the version last fetched.
    """
    wanted = manifest if place is None else manifest.where(contains_ci(F.col("name"), place))
    last = fetched.select("name", F.col(version).alias("_seen"), F.lit(True).alias("_there"))
    changed = F.col("_there").isNull() | ~F.col(version).eqNullSafe(F.col("_seen"))
    return wanted.join(last, "name", "left").where(changed).drop("_seen", "_there")


def mark_fetched(files: DataFrame) -> DataFrame:
    """State rows after a fetch: the create timestamp catches up with the update timestamp."""
    return files.withColumn("create_timestamp", F.col("update_timestamp"))


class FetchLog:
    """What was fetched, as rows that are only ever added; the last one of a name counts.

    `columns` are the columns of a row besides `name`. Every write is one commit of a versioned
    table, numbered by the fetch, so a fetch that is repeated after a failure is written once.
    """

    def __init__(self, spark: SparkSession, path: str, columns: str):
        self.table = VersionedTable(spark, path)
        self.schema = T.StructType.fromDDL(f"name string, {columns}, fetch bigint")

    def fetches(self) -> int:
        """The number of fetches that were written."""
        return self.table.state().batches.get("fetch", -1) + 1

    def write(self, files: DataFrame, fetch: int) -> bool:
        """Add the rows of a fetch (`fetches()` before it); False if they are there."""
        rows = files.withColumn("fetch", F.lit(fetch).cast("bigint"))
        return self.table.append(rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]), "fetch", fetch)

    def latest(self) -> DataFrame:
        """One row per name, as last written; of rows of one fetch the largest."""
        if not self.table.version():
            return self.table.spark.createDataFrame([], self.schema)
        rest = [f.name for f in self.schema if f.name != "name"]
        newest = self.table.read().groupBy("name").agg(F.max(F.struct("fetch", *[c for c in rest if c != "fetch"])).alias("_row"))
        return newest.select("name", *[F.col(f"_row.{c}").alias(c) for c in rest])

    def compact(self) -> None:
        """Keep the last row of each name only. A fetch written meanwhile is a conflict, and nothing is lost."""
        at = self.table.version()
        if at:
            self.table.replace(self.latest().select(*self.schema.fieldNames()), expect=at)

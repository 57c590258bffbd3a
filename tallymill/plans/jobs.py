"""Whole jobs: compositions of the operators, one entry point each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.functions.text import normalise_name, wave_quarter, wave_year
from tallymill.functions.times import parse_date, parse_time_of_day, parse_timestamp
from tallymill.operators.contract import require_contract
from tallymill.operators.rows import distinct_rows, lower_names, open_range
from tallymill.plans import marts, staging
from tallymill.session import folders_side_by_side, setting, small_partitions
from tallymill.sources.files import is_complete, read_counts
from tallymill.sources.manifest import FetchLog, mark_fetched, to_fetch
from tallymill.sources.tables import Models, overwrite_and_read
from tallymill.sources.topics import as_messages, parse_payload, replay_topics
from tallymill.sources.versions import VersionedTable
from tallymill.streaming.land import land_once


def clean_counts(raw: DataFrame) -> DataFrame:
    """Distinct rows, unknown paths named, wave split into year and quarter, date and time parsed."""
    small_partitions(raw.sparkSession)
    rows = distinct_rows(raw).na.fill("Unknown", ["Path"])
    return rows.withColumns(
        {
            "Quarter": wave_quarter(F.col("Year")),
            "Year": wave_year(F.col("Year")).try_cast("int"),
            "Date": parse_date(F.col("Date")),
            "Time": F.date_format(parse_time_of_day(F.col("Time")), "HH:mm:ss"),
        }
    )


def clean_files(spark: SparkSession, root: str, out: str, schema: T.StructType) -> DataFrame:
    """All count files under `root` cleaned in one job and stored by year and quarter.

    Duplicates are sought within a file. The rows carry the table name their file stands for.
    """
    raw = read_counts(spark, root, schema)
    fields = schema.fieldNames()
    cleaned = clean_counts(raw.select(*fields, "file_name", "file_year"))
    table = F.regexp_replace(normalise_name(F.col("file_name")), "-", "_")
    named = cleaned.withColumn("table_name", F.regexp_replace(table, r"\.csv$", ""))
    # rebalance: few files per folder, and a quarter that holds most rows is still split over tasks
    spread = named.hint("rebalance", "file_year", "Quarter")
    with folders_side_by_side(spark):
        spread.write.mode("overwrite").partitionBy("file_year", "Quarter").parquet(out)
    return spark.read.schema(named.schema).parquet(out)


def clean_trips(raw: DataFrame, drop: list[str], stamp: str) -> DataFrame:
    """Drop columns, lower-case the names, parse the start time."""
    lowered = lower_names(raw.drop(*drop))
    return lowered.withColumn(stamp.lower(), parse_timestamp(F.col(stamp.lower()), "%m/%d/%Y %H:%M"))


def trips_between(trips: DataFrame, stamp: str, low: str, high: str) -> DataFrame:
    bounds = [F.lit(b).cast("timestamp_ntz") for b in (low, high)]
    return trips.where(open_range(F.col(stamp), *bounds))


def reload_trips(raw: DataFrame, drop: list[str], stamp: str, low: str, high: str, out: str) -> DataFrame:
    """Clean, keep the open time range, replace the stored table."""
    return overwrite_and_read(trips_between(clean_trips(raw, drop, stamp), stamp.lower(), low, high), out)


def validate_and_load(raw: DataFrame, schema: T.StructType, out: str) -> DataFrame:
    """Replace the versioned table at `out`; a row that breaks the contract fails the write and nothing is replaced.

    Rows are checked as they are written, once, to the folder of a version that only the commit
    after the last row makes visible.
    """
    return VersionedTable(raw.sparkSession, out).replace(require_contract(raw, schema))


def warehouse(spark: SparkSession, raw_by_source: DataFrame, locations: DataFrame, root: str | None = None) -> Models:
    """Staging view, location and fact tables, and the three marts, as named models.

    The order in which they are added does not matter; `build_all` builds each after what it reads.
    """
    models = Models(spark, root)

    def from_fact(*keys):
        return lambda s: s.table("fact_counts").groupBy(*keys).agg(F.sum("count").alias("total_count"))

    models.add("mart_borough_road", from_fact("borough", "road_type"), "table")
    models.add("mart_day", from_fact("day"), "table")
    models.add(
        "mart_quarter",
        from_fact(wave_year(F.col("year")).alias("year"), wave_quarter(F.col("year")).alias("quarter")),
        "table",
    )
    models.add(
        "fact_counts", lambda s: marts.fact(s.table("stg_counts").drop("source"), s.table("dim_locations")), "table"
    )
    models.add("dim_locations", lambda s: marts.dim_locations(locations), "table")
    models.add("stg_counts", lambda s: staging.stage(raw_by_source, source="source"))
    return models


def ingest(
    listed: DataFrame,
    rows: DataFrame,
    log: FetchLog,
    version: str,
    at: Column,
    fields: list[str],
    schema: T.StructType,
    topic: str,
    out: str,
) -> int:
    """Fetch what is new: pick files, publish their rows, land them from the topic, and log the fetch.

    `listed` has `name` and `version`; `rows` carries `file_name`. Files that the log does not know in
    their version are picked, and logged at the end with `at` as the time of the fetch. Returns the
    number of files fetched. Whichever step a run breaks in, the next one takes up the same fetch:
    a topic folder that is complete is kept, a batch that was landed is not landed again, and a
    fetch is logged once. The topic is a folder of messages here; with a broker, publish to it and
    read it with `read_topics` instead.
    """
    # names that fit are looked up in hash tables, so that the rows need no sort by name
    with setting(rows.sparkSession, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m"):
        return _ingest(listed, rows, log, version, at, fields, schema, topic, out)


def _ingest(
    listed: DataFrame,
    rows: DataFrame,
    log: FetchLog,
    version: str,
    at: Column,
    fields: list[str],
    schema: T.StructType,
    topic: str,
    out: str,
) -> int:
    spark, fetch = rows.sparkSession, log.fetches()
    # the pick is kept, so that a run that takes up a broken fetch works on the same files
    picks = VersionedTable(spark, f"{out}/picked")
    fresh = to_fetch(listed, log.latest(), version).select("name", version, F.lit(fetch).cast("bigint").alias("fetch"))
    picks.append(fresh, "fetch", fetch)
    picked = picks.read().where(F.col("fetch") == fetch).drop("fetch")
    count = picked.count()
    if count:
        folder = f"{out}/topic/{fetch:08d}"
        message = T.StructType([T.StructField("topic", T.StringType()), T.StructField("value", T.StringType())])
        if not is_complete(spark, folder):
            wanted = rows.join(picked.select(F.col("name").alias("file_name")), "file_name", "left_semi")
            as_messages(wanted, F.lit(topic), fields).write.mode("overwrite").parquet(folder)
        arriving = replay_topics(spark, f"{out}/topic/*", message, "parquet")
        land_once(parse_payload(arriving, schema), f"{out}/landed", "ingest", f"{out}/checkpoint")
    log.write(mark_fetched(picked.withColumn("update_timestamp", at)), fetch)
    return count

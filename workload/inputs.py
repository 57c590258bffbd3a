"""Count records, locations, messages and metrics derived from the generated tables.

Each input exists twice: as a DataFrame, and as the text of a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.schemas import STREAM_FIELDS, to_batch_names
from tallymill.sources.topics import encode


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stream_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The same table as a file stream. The pattern matches a single file as well as a folder."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/[{name[0]}]{name[1:]}.parquet")


def _site(key: str):
    text = F.col(key).cast("string")
    return F.concat(F.lit("ML"), F.lpad(text, F.greatest(F.lit(4), F.length(text)), F.lit("0")))


def raw_stream(lineitem: DataFrame, *keep: str) -> DataFrame:
    """Count records in stream names, with faults at fixed order keys, the yearly `source`, and `keep`."""
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    day = F.col("l_shipdate")
    wave = F.element_at(
        F.array(*[F.lit(x) for x in (" Q1 (Jan-Mar)", " Q2 spring (Apr-Jun)", " Q3 (Jul-Sep)", " Q4 autumn (Oct-Dec)")]),
        F.quarter(day),
    )
    hour = F.lpad((F.col("l_linenumber") + 6).cast("string"), 2, "0")
    minute = F.lpad((part % 4 * 15).cast("string"), 2, "0")
    return lineitem.select(
        F.concat(F.year(day).cast("string"), wave).alias("Wave"),
        F.when(order % 97 != 0, _site("l_suppkey")).alias("SiteID"),
        F.when(order % 89 == 0, "31/02/2018").otherwise(F.date_format(day, "dd/MM/yyyy")).alias("Date"),
        F.when(order % 71 != 0, F.when(F.col("l_returnflag") == "R", "Wet").otherwise("Dry")).alias("Weather"),
        F.concat(hour, F.lit(":"), minute, F.lit(":00")).alias("Time"),
        F.when(F.dayofweek(day).isin(1, 7), "Weekend").otherwise("Weekday").alias("Day"),
        F.col("l_linestatus").alias("Round"),
        F.when(order % 73 == 0, "North")
        .when(part % 2 == 0, "Northbound")
        .otherwise("Southbound")
        .alias("Direction"),
        F.when(order % 67 != 0, F.when(part % 3 == 0, "Carriageway").otherwise("Cycle lane")).alias("Path"),
        F.when(supp % 2 == 0, "Private cycles").otherwise("Cycle hire").alias("Mode"),
        F.when(order % 79 == 0, "n/a")
        .when(order % 83 == 0, "-1")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("Count"),
        F.year(day).cast("string").alias("source"),
        *keep,
    )


RAW = """raw AS (
 SELECT cast(year(l_shipdate) AS varchar) || CASE quarter(l_shipdate) WHEN 1 THEN ' Q1 (Jan-Mar)'
          WHEN 2 THEN ' Q2 spring (Apr-Jun)' WHEN 3 THEN ' Q3 (Jul-Sep)' ELSE ' Q4 autumn (Oct-Dec)' END AS "Wave",
        CASE WHEN l_orderkey % 97 <> 0 THEN 'ML' || lpad(cast(l_suppkey AS varchar),
          cast(greatest(4, length(cast(l_suppkey AS varchar))) AS integer), '0') END AS "SiteID",
        CASE WHEN l_orderkey % 89 = 0 THEN '31/02/2018' ELSE strftime(l_shipdate, '%d/%m/%Y') END AS "Date",
        CASE WHEN l_orderkey % 71 <> 0 THEN CASE WHEN l_returnflag = 'R' THEN 'Wet' ELSE 'Dry' END END AS "Weather",
        lpad(cast(l_linenumber + 6 AS varchar), 2, '0') || ':' ||
          lpad(cast(l_partkey % 4 * 15 AS varchar), 2, '0') || ':00' AS "Time",
        CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS "Day",
        l_linestatus AS "Round",
        CASE WHEN l_orderkey % 73 = 0 THEN 'North' WHEN l_partkey % 2 = 0 THEN 'Northbound'
          ELSE 'Southbound' END AS "Direction",
        CASE WHEN l_orderkey % 67 <> 0 THEN CASE WHEN l_partkey % 3 = 0 THEN 'Carriageway'
          ELSE 'Cycle lane' END END AS "Path",
        CASE WHEN l_suppkey % 2 = 0 THEN 'Private cycles' ELSE 'Cycle hire' END AS "Mode",
        CASE WHEN l_orderkey % 79 = 0 THEN 'n/a' WHEN l_orderkey % 83 = 0 THEN '-1'
          ELSE cast(cast(l_quantity AS integer) AS varchar) END AS "Count",
        cast(year(l_shipdate) AS varchar) AS source,
        l_orderkey, l_suppkey, l_linenumber, l_shipdate
 FROM lineitem)"""

STREAM_COLUMNS = '"Wave","SiteID","Date","Weather","Time","Day","Round","Direction","Path","Mode","Count"'
BATCH_COLUMNS = (
    '"Wave" AS "Year","SiteID" AS "UnqID","Date","Weather","Time","Day","Round","Direction" AS "Dir","Path","Mode","Count"'
)

STAGED = f"""{RAW}, numbered AS (
 SELECT *, row_number() OVER (PARTITION BY source, "SiteID", "Date", "Time" ORDER BY "Wave" NULLS FIRST,
   "Weather" NULLS FIRST, "Day" NULLS FIRST, "Round" NULLS FIRST, "Direction" NULLS FIRST, "Path" NULLS FIRST,
   "Mode" NULLS FIRST, "Count" NULLS FIRST) AS rn
 FROM raw WHERE "SiteID" IS NOT NULL), stg AS (
 SELECT md5("SiteID" || '-' || "Date" || '-' || "Time") AS cyclingid, "Wave" AS "year", "SiteID" AS unqid,
        cast(try_strptime("Date", '%d/%m/%Y') AS date) AS "date",
        try_strptime("Time", '%H:%M:%S') + INTERVAL 70 YEAR AS "time",
        "Weather" AS weather, "Day" AS "day", "Round" AS "round", "Direction" AS dir, "Path" AS "path",
        "Mode" AS "mode", try_cast("Count" AS integer) AS "count"
 FROM numbered WHERE rn = 1)"""


def raw_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Stream names, without the source."""
    return raw_stream(table(spark, sf, "lineitem")).drop("source")


def raw_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Batch names, with the source."""
    return to_batch_names(raw_stream(table(spark, sf, "lineitem")))


PLACES = ("Central", "Inner", "Outer", "Cycleways")


def locations(spark: SparkSession, sf: str) -> DataFrame:
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    key = F.col("s_suppkey")
    area = F.element_at(F.array(*[F.lit(a) for a in PLACES]), (key % 4 + 1).cast("int"))
    road = F.element_at(F.array(*[F.lit(r) for r in ("A Road", "B Road", "Cycleway")]), (key % 3 + 1).cast("int"))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _site("s_suppkey").alias("site_id"),
        F.col("s_name").alias("location_description"),
        F.col("n_name").alias("borough"),
        area.alias("functional_area_for_monitoring"),
        road.alias("road_type"),
        F.concat(F.lit("L"), key.cast("string")).alias("old_site_id_legacy"),
        (key * 10 + 500000).cast("double").alias("easting_uk_grid"),
        (key * 10 + 180000).cast("double").alias("northing_uk_grid"),
        (key.cast("double") / 1000 + 51).alias("latitude"),
        (key.cast("double") / 1000 - 1).alias("longitude"),
        F.col("s_acctbal").alias("balance"),
    )


LOCATIONS = """locations AS (
 SELECT 'ML' || lpad(cast(s_suppkey AS varchar),
          cast(greatest(4, length(cast(s_suppkey AS varchar))) AS integer), '0') AS site_id,
        s_name AS location_description, n_name AS borough,
        CASE s_suppkey % 4 WHEN 0 THEN 'Central' WHEN 1 THEN 'Inner' WHEN 2 THEN 'Outer'
          ELSE 'Cycleways' END AS functional_area_for_monitoring,
        CASE s_suppkey % 3 WHEN 0 THEN 'A Road' WHEN 1 THEN 'B Road' ELSE 'Cycleway' END AS road_type,
        'L' || cast(s_suppkey AS varchar) AS old_site_id_legacy,
        cast(s_suppkey * 10 + 500000 AS double) AS easting_uk_grid,
        cast(s_suppkey * 10 + 180000 AS double) AS northing_uk_grid,
        cast(s_suppkey AS double) / 1000 + 51 AS latitude, cast(s_suppkey AS double) / 1000 - 1 AS longitude,
        s_acctbal AS balance
 FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

LOCATION_COLUMNS = (
    "site_id, location_description, borough, functional_area_for_monitoring, road_type, old_site_id_legacy, "
    "easting_uk_grid, northing_uk_grid, latitude, longitude"
)


def messages(lineitem: DataFrame) -> DataFrame:
    """Count records as JSON messages on four topics; payloads of some orders are cut short."""
    raw = raw_stream(lineitem, "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    key, text = F.col("l_suppkey"), F.col("text")
    cut = F.left(text, F.length(text) - 5)
    return raw.withColumn("text", encode(raw, STREAM_FIELDS)).select(
        F.element_at(F.array(*[F.lit(p) for p in PLACES]), (key % 4 + 1).cast("int")).alias("topic"),
        (key % 8).cast("int").alias("partition"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("offset"),
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("l_orderkey") % 50 == 0, cut).otherwise(text).alias("value"),
    )


MESSAGES = f"""{RAW}, encoded AS (
 SELECT *, cast(to_json(struct_pack("Wave" := "Wave", "SiteID" := "SiteID", "Date" := "Date", "Weather" := "Weather",
   "Time" := "Time", "Day" := "Day", "Round" := "Round", "Direction" := "Direction", "Path" := "Path",
   "Mode" := "Mode", "Count" := "Count")) AS varchar) AS text FROM raw), messages AS (
 SELECT CASE l_suppkey % 4 WHEN 0 THEN 'Central' WHEN 1 THEN 'Inner' WHEN 2 THEN 'Outer' ELSE 'Cycleways' END AS topic,
        cast(l_suppkey % 8 AS integer) AS "partition", l_orderkey * 10 + l_linenumber AS "offset",
        l_shipdate AS "timestamp", l_orderkey % 50 = 0 AS broken,
        CASE WHEN l_orderkey % 50 = 0 THEN left(text, length(text) - 5) ELSE text END AS "value",
        {STREAM_COLUMNS}, source
 FROM encoded)"""

"""Staging, marts, row operators, scalar functions and jobs over the count records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.functions import text, times
from tallymill.functions.keys import surrogate_key
from tallymill.operators import distribution, rows
from tallymill.plans import jobs, marts, staging
from tallymill.schemas import string_schema, to_batch_names
from tallymill.session import folders_side_by_side, work_path
from tallymill.sources.versions import VersionedTable
from tallymill.sources import files, tables
from workload.inputs import (
    BATCH_COLUMNS,
    LOCATION_COLUMNS,
    LOCATIONS,
    RAW,
    STAGED,
    STREAM_COLUMNS,
    locations,
    raw_batch,
    raw_counts,
    raw_stream,
    table,
)
from workload.registry import query


def staged(spark, sf):
    return staging.stage(raw_batch(spark, sf), source="source").drop("source")


@query("stg_counts", f"WITH {STAGED} SELECT * FROM stg")
def stg_counts(spark, sf):
    return staged(spark, sf)


@query("union_years", f"WITH {STAGED} SELECT * FROM stg")
def union_years(spark, sf):
    """One folder per year that the table has, united first and staged once; each keeps its own duplicates apart."""
    raw = raw_stream(table(spark, sf, "lineitem"))
    root = work_path(spark, "years")
    raw.hint("rebalance", "source").write.partitionBy("source").parquet(root)
    stored = spark.read.schema(raw.schema).parquet(root)
    years = [year for (year,) in stored.select("source").distinct().collect()]
    yearly = [stored.where(F.col("source").eqNullSafe(F.lit(year))) for year in sorted(years, key=str)]  # reads its folder only
    return staging.stage(to_batch_names(rows.union_all(yearly)), source="source").drop("source")


@query("dim_locations", f"WITH {LOCATIONS} SELECT {LOCATION_COLUMNS} FROM locations")
def dim_locations(spark, sf):
    return marts.dim_locations(locations(spark, sf))


@query("fact_counts", f"WITH {STAGED}, {LOCATIONS} SELECT stg.*, {LOCATION_COLUMNS} FROM stg JOIN locations ON unqid = site_id")
def fact_counts(spark, sf):
    return marts.fact(staged(spark, sf), marts.dim_locations(locations(spark, sf)))


@query(
    "agg_borough_road",
    f"""WITH {STAGED}, {LOCATIONS} SELECT borough, road_type, cast(sum("count") AS bigint) AS total_count
    FROM stg JOIN locations ON unqid = site_id GROUP BY borough, road_type""",
)
def agg_borough_road(spark, sf):
    return marts.by_borough_road(staged(spark, sf), marts.dim_locations(locations(spark, sf)))


@query(
    "agg_day_type",
    f"""WITH {STAGED}, {LOCATIONS} SELECT "day", cast(sum("count") AS bigint) AS total_count
    FROM stg JOIN locations ON unqid = site_id GROUP BY "day" """,
)
def agg_day_type(spark, sf):
    return marts.by_day_type(staged(spark, sf), marts.dim_locations(locations(spark, sf)))


@query(
    "agg_weekend",
    f"""WITH {STAGED}, {LOCATIONS} SELECT "day", cast(sum("count") AS bigint) AS total_count
    FROM stg JOIN locations ON unqid = site_id WHERE "day" = 'Weekend' GROUP BY "day" """,
)
def agg_weekend(spark, sf):
    return marts.by_day_type(staged(spark, sf), marts.dim_locations(locations(spark, sf)), weekend_only=True)


@query(
    "agg_quarter",
    f"""WITH {STAGED}, {LOCATIONS} SELECT split_part("year", ' ', 1) AS "year",
      split_part(split_part("year", ' ', 2), '(', 1) AS "quarter", cast(sum("count") AS bigint) AS total_count
    FROM stg JOIN locations ON unqid = site_id GROUP BY 1, 2""",
)
def agg_quarter(spark, sf):
    return marts.by_quarter(staged(spark, sf), marts.dim_locations(locations(spark, sf)))


@query("agg_count_star", "SELECT count(*) AS n_rows FROM lineitem")
def agg_count_star(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("counts_view")
    return spark.sql("SELECT count(*) AS n_rows FROM counts_view")


@query(
    "limit_dev",
    f"""WITH {STAGED} SELECT * FROM stg
    ORDER BY unqid NULLS FIRST, "date" NULLS FIRST, "time" NULLS FIRST, cyclingid NULLS FIRST LIMIT 100""",
)
def limit_dev(spark, sf):
    raw = raw_batch(spark, sf).drop("source")
    return staging.stage(raw.withColumn("source", F.substring("Year", 1, 4)), source="source", limit=100).drop("source")


@query("filter_gt", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 25")
def filter_gt(spark, sf):
    return table(spark, sf, "lineitem").where(F.col("l_quantity") > 25).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "filter_open_range",
    """SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > TIMESTAMP '1998-05-23' AND o_orderdate < TIMESTAMP '1999-06-03'""",
)
def filter_open_range(spark, sf):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1998-05-23", "1999-06-03"))
    return table(spark, sf, "orders").where(rows.open_range(F.col("o_orderdate"), low, high)).select(
        "o_orderkey", "o_orderdate"
    )


@query("filter_contains_ci", "SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'ring')")
def filter_contains_ci(spark, sf):
    return table(spark, sf, "part").where(text.contains_ci(F.col("p_name"), "RING")).select(
        "p_partkey", "p_name", "p_brand"
    )


@query(
    "fill_unknown",
    f"""WITH {RAW} SELECT l_orderkey, l_linenumber, coalesce("Path", 'Unknown') AS "Path" FROM raw""",
)
def fill_unknown(spark, sf):
    raw = raw_stream(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    return raw.select("l_orderkey", "l_linenumber", "Path").na.fill("Unknown", ["Path"])


def trips(spark, sf):
    """Trip records as they arrive: mixed-case names, a column nobody needs, month-first times as text."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("region_id"),
        F.col("event_id").alias("Trip_ID"),
        F.date_format("ts", "MM/dd/yyyy HH:mm").alias("Started_At"),
        F.col("event_type").alias("Trip_Type"),
        F.col("value").alias("Distance"),
    )


TRIPS = """trips AS (SELECT event_id AS trip_id, date_trunc('minute', ts) AS started_at, event_type AS trip_type,
  value AS distance FROM events)"""


@query("clean_columns", f"WITH {TRIPS} SELECT * FROM trips")
def clean_columns(spark, sf):
    return jobs.clean_trips(trips(spark, sf), ["region_id"], "Started_At")


@query(
    "job_reload_trips",
    f"""WITH {TRIPS} SELECT * FROM trips
    WHERE started_at > TIMESTAMP '2024-01-08' AND started_at < TIMESTAMP '2024-01-20'""",
)
def job_reload_trips(spark, sf):
    return jobs.reload_trips(
        trips(spark, sf), ["region_id"], "Started_At", "2024-01-08", "2024-01-20", work_path(spark, "trips")
    )


@query("dedup_exact", f"WITH {RAW} SELECT DISTINCT {STREAM_COLUMNS} FROM raw")
def dedup_exact(spark, sf):
    return rows.distinct_rows(raw_counts(spark, sf))


@query(
    "set_except",
    f"""WITH {RAW} SELECT {STREAM_COLUMNS} FROM raw
    EXCEPT SELECT {STREAM_COLUMNS} FROM raw WHERE "Path" IS NULL OR "Count" = '-1'""",
)
def set_except(spark, sf):
    raw = raw_counts(spark, sf)
    return rows.except_distinct(raw, raw.where(F.col("Path").isNull() | (F.col("Count") == "-1")))


@query(
    "dist_categorical",
    f"""WITH {RAW} SELECT "Weather", count(*) AS n_rows, count(*) / sum(count(*)) OVER () AS share
    FROM raw GROUP BY "Weather" """,
)
def dist_categorical(spark, sf):
    return distribution.categorical(raw_counts(spark, sf), "Weather")


@query(
    "dist_temporal",
    "SELECT cast(date_trunc('month', l_shipdate) AS timestamp) AS bucket, count(*) AS n_rows FROM lineitem GROUP BY 1",
)
def dist_temporal(spark, sf):
    return distribution.temporal(table(spark, sf, "lineitem"), "l_shipdate", "month")


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST, o_totalprice DESC NULLS LAST) AS rn FROM orders)
    WHERE rn = 1""",
)
def latest_per_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return rows.latest_per_key(orders, ["o_custkey"], "o_orderdate")


# ---- scalar functions


@query(
    "fn_wave_parts",
    f"""WITH {RAW} SELECT "Wave", split_part("Wave", ' ', 1) AS "year",
      split_part(split_part("Wave", ' ', 2), '(', 1) AS "quarter",
      try_cast(split_part("Wave", ' ', 1) AS integer) AS year_no, count(*) AS n_rows FROM raw GROUP BY ALL""",
)
def fn_wave_parts(spark, sf):
    wave = F.col("Wave")
    parts = raw_counts(spark, sf).select(
        "Wave",
        text.wave_year(wave).alias("year"),
        text.wave_quarter(wave).alias("quarter"),
        text.wave_year(wave).try_cast("int").alias("year_no"),
    )
    return parts.groupBy(*parts.columns).agg(F.count("*").alias("n_rows"))


@query(
    "fn_time_of_day",
    f"""WITH {RAW} SELECT l_orderkey, l_linenumber, try_strptime("Time", '%H:%M:%S') + INTERVAL 70 YEAR AS "time",
      cast(try_strptime("Date", '%d/%m/%Y') AS date) AS "date" FROM raw""",
)
def fn_time_of_day(spark, sf):
    raw = raw_stream(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    return raw.select(
        "l_orderkey",
        "l_linenumber",
        times.parse_time_of_day(F.col("Time")).alias("time"),
        times.parse_date(F.col("Date")).alias("date"),
    )


# `Nov 18th 2024, 10:05:07 AM`, from the event's second
ORDINAL = """strftime(ts, '%b ') || cast(day(ts) AS varchar) || CASE WHEN day(ts) IN (11, 12, 13) THEN 'th'
  WHEN day(ts) % 10 = 1 THEN 'st' WHEN day(ts) % 10 = 2 THEN 'nd' WHEN day(ts) % 10 = 3 THEN 'rd' ELSE 'th' END
  || strftime(ts, ' %Y, %I:%M:%S %p')"""


def ordinal(ts):
    day = F.dayofmonth(ts)
    suffix = (
        F.when(day.isin(11, 12, 13), "th")
        .when(day % 10 == 1, "st")
        .when(day % 10 == 2, "nd")
        .when(day % 10 == 3, "rd")
        .otherwise("th")
    )
    return F.concat(
        F.date_format(ts, "MMM "), day.cast("string"), suffix, F.date_format(ts, " yyyy, hh:mm:ss a")
    )


@query(
    "fn_ordinal_date",
    f"SELECT event_id, {ORDINAL} AS listed, date_trunc('second', ts) AS parsed FROM events",
)
def fn_ordinal_date(spark, sf):
    listed = table(spark, sf, "events").select("event_id", ordinal(F.col("ts")).alias("listed"))
    return listed.withColumn("parsed", times.parse_listing_time(F.col("listed")))


@query(
    "fn_casts",
    f"""WITH {RAW} SELECT l_orderkey, l_linenumber, try_cast("Count" AS integer) AS n,
      try_cast("Count" AS double) AS x, cast(l_orderkey AS varchar) AS order_text FROM raw""",
)
def fn_casts(spark, sf):
    raw = raw_stream(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    return raw.select(
        "l_orderkey",
        "l_linenumber",
        staging.to_int(F.col("Count")).alias("n"),
        F.col("Count").try_cast("double").alias("x"),
        F.col("l_orderkey").cast("string").alias("order_text"),
    )


@query(
    "fn_surrogate_key",
    f"""WITH {RAW} SELECT l_orderkey, l_linenumber, md5(coalesce("SiteID", '_dbt_utils_surrogate_key_null_') || '-' ||
      coalesce("Date", '_dbt_utils_surrogate_key_null_') || '-' || coalesce("Time", '_dbt_utils_surrogate_key_null_'))
      AS cyclingid FROM raw""",
)
def fn_surrogate_key(spark, sf):
    raw = raw_stream(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    return raw.select("l_orderkey", "l_linenumber", surrogate_key("SiteID", "Date", "Time").alias("cyclingid"))


# ---- file names

NAMES = """names AS (SELECT cast(year(l_shipdate) AS varchar) || ' Q' || cast(quarter(l_shipdate) AS varchar) ||
  CASE quarter(l_shipdate) WHEN 2 THEN ' spring' WHEN 4 THEN ' autumn' ELSE '' END ||
  CASE quarter(l_shipdate) WHEN 1 THEN ' (Jan-Mar)' WHEN 2 THEN ' (Apr-Jun)' WHEN 3 THEN ' (Jul-Sep)'
    ELSE ' (Oct-Dec)' END || '-' ||
  CASE l_suppkey % 4 WHEN 0 THEN 'Central' WHEN 1 THEN 'Inner' WHEN 2 THEN 'Outer' ELSE 'Cycleways' END || '.csv'
  AS file_name, l_quantity FROM lineitem)"""


def file_names(spark, sf):
    """The published file each count would be found in."""
    day, key = F.col("l_shipdate"), F.col("l_suppkey")
    q = F.quarter(day)
    season = F.when(q == 2, "spring").when(q == 4, "autumn")
    months = F.element_at(F.array(*[F.lit(m) for m in ("(Jan-Mar)", "(Apr-Jun)", "(Jul-Sep)", "(Oct-Dec)")]), q)
    places = F.array(*[F.lit(p) for p in ("Central", "Inner", "Outer", "Cycleways")])
    name = text.file_name(
        F.year(day).cast("string"),
        F.concat(F.lit("Q"), q.cast("string")),
        season,
        months,
        F.element_at(places, (key % 4 + 1).cast("int")),
    )
    return table(spark, sf, "lineitem").select(name.alias("file_name"), "l_quantity")


@query(
    "file_name_dims",
    f"""WITH {NAMES} SELECT file_name, regexp_extract(file_name, '^(\\d+)', 1) AS "year",
      regexp_extract(file_name, ' (Q[1-4])', 1) AS "quarter",
      nullif(regexp_extract(file_name, ' Q[1-4] ([a-z]+) ', 1), '') AS season,
      regexp_extract(file_name, '(\\(.*\\))', 1) AS months, regexp_extract(file_name, '\\)-(.*)\\.csv', 1) AS place,
      regexp_extract(file_name, '^(\\d+)', 1) || '/' || regexp_extract(file_name, ' (Q[1-4])', 1) || '-' ||
        regexp_extract(file_name, '(\\(.*\\))', 1) AS dir_path,
      count(*) AS n_rows, cast(sum(cast(l_quantity AS bigint)) AS bigint) AS quantity FROM names GROUP BY ALL""",
)
def file_name_dims(spark, sf):
    per_file = file_names(spark, sf).groupBy("file_name").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    return per_file.withColumns(text.file_name_parts(F.col("file_name")))


@query(
    "fn_normalise_name",
    f"""WITH {NAMES} SELECT file_name, replace(replace(replace(file_name, ' ', '_'), '(', ''), ')', '') AS table_name,
      replace(file_name, ' ', '%20') AS url_name, count(*) AS n_rows FROM names GROUP BY ALL""",
)
def fn_normalise_name(spark, sf):
    name = F.col("file_name")
    named = file_names(spark, sf).select(
        "file_name", text.normalise_name(name).alias("table_name"), text.quote_spaces(name).alias("url_name")
    )
    return named.groupBy(*named.columns).agg(F.count("*").alias("n_rows"))


# ---- files and tables


@query("src_csv_roundtrip", f"WITH {RAW} SELECT {STREAM_COLUMNS} FROM raw")
def src_csv_roundtrip(spark, sf):
    raw = raw_counts(spark, sf)
    path = work_path(spark, "csv")
    files.write_csv(raw, path)
    return files.read_csv(spark, path, raw.schema)


@query("sink_overwrite_readback", f"WITH {RAW} SELECT {STREAM_COLUMNS} FROM raw WHERE \"Day\" = 'Weekend'")
def sink_overwrite_readback(spark, sf):
    raw = raw_counts(spark, sf)
    path = work_path(spark, "overwrite")
    tables.overwrite_and_read(raw, path)
    return tables.overwrite_and_read(raw.where(F.col("Day") == "Weekend"), path)


@query(
    "src_doc_filter_project",
    "SELECT doc_id, source, lang, n_chars FROM documents WHERE lang = 'en' AND n_chars > 1000",
)
def src_doc_filter_project(spark, sf):
    wanted = (F.col("lang") == "en") & (F.col("n_chars") > 1000)
    return tables.fetch(table(spark, sf, "documents"), wanted, ["doc_id", "source", "lang", "n_chars"])


# ---- jobs


@query(
    "job_clean_counts",
    f"""WITH {RAW} SELECT DISTINCT try_cast(split_part("Wave", ' ', 1) AS integer) AS "Year", "SiteID" AS "UnqID",
      cast(try_strptime("Date", '%d/%m/%Y') AS date) AS "Date", "Weather", "Time", "Day", "Round", "Direction" AS "Dir",
      coalesce("Path", 'Unknown') AS "Path", "Mode", "Count",
      split_part(split_part("Wave", ' ', 2), '(', 1) AS "Quarter"
    FROM raw""",
)
def job_clean_counts(spark, sf):
    # '31/02/2018' is the only date that does not parse, so distinct raw rows stay distinct
    return jobs.clean_counts(raw_batch(spark, sf).drop("source"))


@query(
    "job_etl_by_quarter",
    f"""WITH {RAW}, cleaned AS (SELECT DISTINCT {BATCH_COLUMNS} FROM raw)
    SELECT try_cast(split_part("Year", ' ', 1) AS integer) AS "Year",
      split_part(split_part("Year", ' ', 2), '(', 1) AS "Quarter", count(*) AS n_rows,
      cast(count(try_strptime("Date", '%d/%m/%Y')) AS bigint) AS n_dates FROM cleaned GROUP BY 1, 2""",
)
def job_etl_by_quarter(spark, sf):
    """The count files of all years, each year in a few CSVs, cleaned and stored by year and quarter.

    Rows that are alike lie in one file, where the job seeks duplicates.
    """
    root, out = work_path(spark, "etl-files"), work_path(spark, "etl")
    raw = raw_batch(spark, sf)
    part = F.pmod(F.xxhash64(*raw.columns), F.lit(64))
    with folders_side_by_side(spark):
        raw.repartition("source", part).write.partitionBy("source").option("header", True).csv(root)
    stored = jobs.clean_files(spark, root, out, raw.drop("source").schema)
    return stored.groupBy("Year", "Quarter").agg(F.count("*").alias("n_rows"), F.count("Date").alias("n_dates"))


ORDER_TEXT = """SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey, o_orderstatus,
  o_orderpriority FROM orders"""


@query("job_validate_load", ORDER_TEXT)
def job_validate_load(spark, sf):
    """Loaded twice: the first load stands when the second breaks on orders without a status."""
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    raw = table(spark, sf, "orders").select(*[F.col(n).cast("string") for n in names])
    out = work_path(spark, "validated")
    loaded = jobs.validate_and_load(raw, string_schema(names), out)
    broken = raw.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    try:
        jobs.validate_and_load(broken, string_schema(names), out)
    except Exception as error:
        if "o_orderstatus is missing" not in str(error):
            raise
        loaded = VersionedTable(spark, out).read()
    return loaded


@query(
    "job_warehouse",
    f"""WITH {STAGED}, {LOCATIONS}, fact AS (SELECT * FROM stg JOIN locations ON unqid = site_id)
    SELECT 'borough_road' AS mart, borough || '/' || road_type AS "key", cast(sum("count") AS bigint) AS total_count
      FROM fact GROUP BY 2
    UNION ALL SELECT 'day', "day", cast(sum("count") AS bigint) FROM fact GROUP BY 2
    UNION ALL SELECT 'quarter', split_part("year", ' ', 1) || '/' || split_part(split_part("year", ' ', 2), '(', 1),
      cast(sum("count") AS bigint) FROM fact GROUP BY 2""",
)
def job_warehouse(spark, sf):
    """All models of the warehouse, built in the order of what they read; the three marts in one."""
    models = jobs.warehouse(spark, raw_batch(spark, sf), locations(spark, sf), work_path(spark, "warehouse"))
    models.build_all()
    keys = {
        "mart_borough_road": F.concat("borough", F.lit("/"), "road_type"),
        "mart_day": F.col("day"),
        "mart_quarter": F.concat("year", F.lit("/"), "quarter"),
    }
    parts = [
        spark.table(mart).select(F.lit(mart[5:]).alias("mart"), key.alias("key"), "total_count") for mart, key in keys.items()
    ]
    return rows.union_all(parts)

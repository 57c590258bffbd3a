"""Manifests, keyed inserts and updates, incremental pickup."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.functions.times import parse_timestamp
from tallymill.operators import upsert
from tallymill.plans import jobs
from tallymill.schemas import RAW_STREAM, STREAM_FIELDS
from tallymill.session import work_path
from tallymill.sources.versions import VersionedTable
from tallymill.sources import manifest
from workload.inputs import RAW, STREAM_COLUMNS, raw_stream, table
from workload.registry import query

NAME_SQL = """'file-' || cast({0} AS varchar) || CASE {0} % 4 WHEN 0 THEN '-Central' WHEN 1 THEN '-Inner'
  WHEN 2 THEN '-Outer' ELSE '-Cycleways' END || '.csv'"""


def file_of(key: str):
    places = F.array(*[F.lit(p) for p in ("-Central", "-Inner", "-Outer", "-Cycleways")])
    place = F.element_at(places, (F.col(key) % 4 + 1).cast("int"))
    return F.concat(F.lit("file-"), F.col(key).cast("string"), place, F.lit(".csv"))


def listed(spark, sf):
    """One file per order that has lines; modified when its last line shipped."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_modified"), F.count("*").alias("n")
    )
    return lines.select(file_of("l_orderkey").alias("name"), "last_modified", "n")


def known(spark, sf):
    """The state as of the start of 2000: every order placed by then, last seen 60 days after."""
    orders = table(spark, sf, "orders").where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return orders.select(
        file_of("o_orderkey").alias("name"),
        F.col("o_orderdate").alias("create_timestamp"),
        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("update_timestamp"),
    )


LISTED = f"""listed AS (SELECT {NAME_SQL.format("l_orderkey")} AS "name", max(l_shipdate) AS last_modified,
  count(*) AS n FROM lineitem GROUP BY l_orderkey)"""
KNOWN = f"""known AS (SELECT {NAME_SQL.format("o_orderkey")} AS "name", o_orderdate AS create_timestamp,
  o_orderdate + INTERVAL 60 DAY AS update_timestamp FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"""


@query(
    "manifest_classify",
    f"""WITH {LISTED}, {KNOWN}, pair AS (SELECT coalesce(l."name", k."name") AS "name", l.last_modified,
      create_timestamp, update_timestamp, CASE WHEN k."name" IS NULL THEN 'new' WHEN l."name" IS NULL THEN 'missing'
        WHEN update_timestamp < last_modified THEN 'updated' ELSE 'unchanged' END AS status
      FROM listed l FULL JOIN known k ON l."name" = k."name")
    SELECT "name", status, coalesce(create_timestamp, last_modified) AS create_timestamp,
      CASE WHEN status IN ('new', 'updated') THEN last_modified ELSE update_timestamp END AS update_timestamp FROM pair""",
)
def manifest_classify(spark, sf):
    return manifest.classify(listed(spark, sf).select("name", "last_modified"), known(spark, sf))


@query("sync_new_keys", f'WITH {LISTED}, {KNOWN} SELECT * FROM listed WHERE "name" NOT IN (SELECT "name" FROM known)')
def sync_new_keys(spark, sf):
    return upsert.new_keys(listed(spark, sf), known(spark, sf), ["name"])


@query(
    "sync_updates",
    f"""WITH {LISTED}, {KNOWN} SELECT l.* FROM listed l JOIN known k ON l."name" = k."name"
    WHERE update_timestamp < last_modified""",
)
def sync_updates(spark, sf):
    return upsert.newer_rows(listed(spark, sf), known(spark, sf), ["name"], F.col("last_modified"), "update_timestamp")


@query(
    "upsert_by_key",
    """WITH incoming AS (SELECT c_custkey AS "key", CASE WHEN c_acctbal >= 0 THEN c_name END AS "name",
      c_acctbal AS balance FROM customer)
    SELECT coalesce(i."key", s_suppkey) AS "key", CASE WHEN i."key" IS NOT NULL THEN i."name" ELSE s_name END AS "name",
      s_nationkey AS nation, CASE WHEN i."key" IS NOT NULL THEN i.balance ELSE s_acctbal END AS balance
    FROM supplier FULL JOIN incoming i ON i."key" = s_suppkey""",
)
def upsert_by_key(spark, sf):
    """Customers set on suppliers by number: known numbers are overwritten, the others are added."""
    target = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    incoming = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    return upsert.upsert(target, incoming, ["key"])


@query(
    "upsert_latest",
    """WITH incoming AS (SELECT o_custkey AS "key", o_orderdate AS seen, o_totalprice AS price FROM (SELECT *,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC) AS rn FROM orders)
      WHERE rn = 1)
    SELECT coalesce(i."key", c_custkey) AS "key", c_name AS "name", seen, price
    FROM customer FULL JOIN incoming i ON i."key" = c_custkey""",
)
def upsert_latest(spark, sf):
    """Many incoming rows per key: the latest one is set, its new columns are added."""
    target = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    incoming = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderdate").alias("seen"), F.col("o_totalprice").alias("price")
    )
    return upsert.upsert(target, incoming, ["key"], version="seen")


def rules(spark, sf, stamp):
    """Rule rows as a catalogue file holds them: stamps are text."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("rule_key"),
        F.concat_ws("_", "p_brand", "p_type").alias("rule_name"),
        stamp.alias("update_timestamp"),
    )


@query(
    "sync_rules",
    """WITH old AS (SELECT l_partkey AS rule_key, max('rule ' || l_returnflag) AS rule_name,
      strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS update_timestamp FROM lineitem
      WHERE l_returnflag <> 'N' AND l_quantity > 45 GROUP BY 1),
    new AS (SELECT p_partkey AS rule_key, p_brand || '_' || p_type AS rule_name,
      strftime(TIMESTAMP '1997-01-01' + to_days(cast(p_size * 20 AS integer)), '%Y-%m-%d %H:%M:%S') AS update_timestamp
      FROM part)
    SELECT coalesce(o.rule_key, n.rule_key) AS rule_key,
      CASE WHEN o.rule_key IS NULL OR o.update_timestamp < n.update_timestamp THEN n.rule_name ELSE o.rule_name END
        AS rule_name,
      CASE WHEN o.rule_key IS NULL OR o.update_timestamp < n.update_timestamp THEN n.update_timestamp
        ELSE o.update_timestamp END AS update_timestamp
    FROM old o FULL JOIN new n ON o.rule_key = n.rule_key""",
)
def sync_rules(spark, sf):
    """Rules of all parts synced into a store that knows the parts with large returned or late lines."""
    lines = table(spark, sf, "lineitem").where((F.col("l_returnflag") != "N") & (F.col("l_quantity") > 45))
    target = lines.groupBy(F.col("l_partkey").alias("rule_key")).agg(
        F.max(F.concat(F.lit("rule "), "l_returnflag")).alias("rule_name"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("update_timestamp"),
    )
    day = F.date_add(F.lit("1997-01-01").cast("date"), F.col("p_size") * 20).cast("timestamp_ntz")
    incoming = rules(spark, sf, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    version = parse_timestamp(F.col("update_timestamp"))
    typed = target.withColumn("_at", parse_timestamp(F.col("update_timestamp")))
    return upsert.sync(typed, incoming, ["rule_key"], version, "_at").drop("_at")


LISTING = """listing AS (SELECT o_custkey AS listing, o_orderkey AS row_no,
    CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 1 ELSE 3 END AS data_level,
    ' order ' || cast(o_orderkey AS varchar) || ' ' AS "name", strftime(o_orderdate, '%Y-%m-%d') AS last_modified,
    cast(cast(floor(o_totalprice) AS bigint) AS varchar) || ' B' AS size,
    CASE WHEN o_orderstatus = 'F' THEN 'CSV file ' ELSE 'Folder' END AS "type", o_orderpriority AS description
  FROM orders)"""


@query(
    "listing_to_manifest",
    f"""WITH {LISTING}, started AS (SELECT *, min(CASE WHEN data_level = 2 THEN row_no END)
        OVER (PARTITION BY listing) AS first_row FROM listing),
      ended AS (SELECT *, min(CASE WHEN row_no > first_row AND data_level NOT IN (2, 3) THEN row_no END)
        OVER (PARTITION BY listing) AS last_row FROM started)
    SELECT listing, row_no, trim("name") AS "name", last_modified, size, trim("type") AS "type", description FROM ended
    WHERE row_no > first_row AND (last_row IS NULL OR row_no < last_row) AND data_level = 3
      AND trim("type") = 'CSV file'""",
)
def listing_to_manifest(spark, sf):
    """One listing per customer, one row per order."""
    level = F.when(F.col("o_orderpriority") == "1-URGENT", 2).when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(3)
    listing = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("listing"),
        F.col("o_orderkey").alias("row_no"),
        level.alias("data_level"),
        F.concat(F.lit(" order "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_modified"),
        F.concat(F.floor("o_totalprice").cast("bigint").cast("string"), F.lit(" B")).alias("size"),
        F.when(F.col("o_orderstatus") == "F", "CSV file ").otherwise("Folder").alias("type"),
        F.col("o_orderpriority").alias("description"),
    )
    return manifest.listing_to_manifest(listing, by="listing")


def versions(lines):
    """A version mark per file that changes with its lines."""
    mark = F.md5(F.concat_ws("/", F.count("*").cast("string"), F.date_format(F.max("l_shipdate"), "yyyy-MM-dd")))
    return lines.groupBy("l_orderkey").agg(mark.alias("etag")).select(file_of("l_orderkey").alias("name"), "etag")


def _versions_sql(where: str) -> str:
    return f"""SELECT {NAME_SQL.format("l_orderkey")} AS "name",
      md5(cast(count(*) AS varchar) || '/' || strftime(max(l_shipdate), '%Y-%m-%d')) AS etag
      FROM lineitem {where} GROUP BY l_orderkey"""


FETCH = f"""now AS ({_versions_sql("")}), fetched AS ({_versions_sql("WHERE l_shipdate < TIMESTAMP '2000-06-01'")}),
  picked AS (SELECT now.* FROM now LEFT JOIN fetched f ON now."name" = f."name" WHERE now.etag IS DISTINCT FROM f.etag)"""


def pickup(spark, sf, place=None):
    lines = table(spark, sf, "lineitem")
    before = lines.where(F.col("l_shipdate") < F.lit("2000-06-01").cast("timestamp_ntz"))
    return manifest.to_fetch(versions(lines), versions(before), "etag", place)


@query("incremental_files", f"WITH {FETCH} SELECT * FROM picked")
def incremental_files(spark, sf):
    """Files that are new or changed since the last fetch, at the start of June 2000."""
    return pickup(spark, sf)


@query("incremental_files_place", f"""WITH {FETCH} SELECT * FROM picked WHERE lower("name") LIKE '%central%'""")
def incremental_files_place(spark, sf):
    return pickup(spark, sf, "CENTRAL")


@query(
    "job_ingest",
    f"""WITH {FETCH}, {RAW} SELECT {STREAM_COLUMNS} FROM raw
    WHERE {NAME_SQL.format("l_orderkey")} IN (SELECT "name" FROM picked)""",
)
def job_ingest(spark, sf):
    """New and changed files picked up, their rows published as messages, and landed from the topic.

    The log holds what was fetched up to June 2000. A second run finds nothing new, also after the
    log was compacted, and lands nothing.
    """
    lines = table(spark, sf, "lineitem")
    rows = raw_stream(lines, "l_orderkey").withColumn("file_name", file_of("l_orderkey"))
    out = work_path(spark, "ingest")
    log = manifest.FetchLog(spark, f"{out}/log", "etag string, update_timestamp timestamp_ntz, create_timestamp timestamp_ntz")
    day = F.lit("2000-06-01").cast("timestamp_ntz")
    before = versions(lines.where(F.col("l_shipdate") < day))
    log.write(manifest.mark_fetched(before.withColumn("update_timestamp", day)), log.fetches())
    now = F.lit("2024-12-01").cast("timestamp_ntz")
    for _ in range(2):
        jobs.ingest(versions(lines), rows, log, "etag", now, STREAM_FIELDS, RAW_STREAM, "Central", out)
        log.compact()
    return VersionedTable(spark, f"{out}/landed").read()

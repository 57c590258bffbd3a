"""Streams over the count records as messages: landing, routing, dead letters, checks, resuming."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.operators import suite
from tallymill.operators.checks import Check
from tallymill.plans.count_checks import CATALOGUE, COUNT_CHECKS, IN_LIST
from tallymill.schemas import RAW_STREAM
from tallymill.session import work_path
from tallymill.sources import topics
from tallymill.sources.versions import VersionedTable
from tallymill.streaming import dead_letters, land, quality
from workload.inputs import MESSAGES, RAW, STREAM_COLUMNS, messages, raw_stream, stream_table, table
from workload.quality import CONDITIONS, KEY_TEXT, NAMES, REPORT_COLUMNS, counts_sql
from workload.registry import query

KEPT = ", ".join(f"CASE WHEN NOT broken THEN {c} END AS {c}" for c in STREAM_COLUMNS.split(","))


@query("encode_messages", f'WITH {MESSAGES} SELECT topic, "offset", "value" FROM messages')
def encode_messages(spark, sf):
    """Records as JSON text with nulls written out; the broken ones as they would arrive."""
    return messages(table(spark, sf, "lineitem")).select("topic", "offset", "value")


@query("parse_json_payload", f"WITH {MESSAGES} SELECT {KEPT} FROM messages")
def parse_json_payload(spark, sf):
    return topics.parse_payload(messages(table(spark, sf, "lineitem")), RAW_STREAM)


@query("src_topic_replay", f"WITH {MESSAGES} SELECT topic, {KEPT} FROM messages")
def src_topic_replay(spark, sf):
    arriving = messages(stream_table(spark, sf, "lineitem"))
    parsed = topics.parse_payload(arriving, RAW_STREAM, keep=["topic"])
    out = work_path(spark, "replay")
    land.land(parsed, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(parsed.schema).parquet(f"{out}/rows")


@query("stream_parquet_land", f"WITH {RAW} SELECT {STREAM_COLUMNS} FROM raw")
def stream_parquet_land(spark, sf):
    arriving = raw_stream(stream_table(spark, sf, "lineitem")).drop("source")
    out = work_path(spark, "land")
    land.land(arriving, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(RAW_STREAM).parquet(f"{out}/rows")


@query("stream_csv_sink", f"WITH {RAW} SELECT {STREAM_COLUMNS} FROM raw")
def stream_csv_sink(spark, sf):
    arriving = raw_stream(stream_table(spark, sf, "lineitem")).drop("source")
    out = work_path(spark, "csv-sink")
    land.land(arriving, f"{out}/rows", f"{out}/checkpoint", fmt="csv", header="true")
    return spark.read.schema(RAW_STREAM).option("header", True).csv(f"{out}/rows")


@query(
    "stream_route_topics",
    f"""WITH {MESSAGES} SELECT topic, count(*) AS n_rows, count("SiteID") FILTER (WHERE NOT broken) AS n_sites,
      cast(sum(CASE WHEN NOT broken THEN try_cast("Count" AS integer) END) AS bigint) AS total FROM messages GROUP BY topic""",
)
def stream_route_topics(spark, sf):
    """All topics in one stream, stored in one folder per topic and batch."""
    parsed = topics.parse_payload(messages(stream_table(spark, sf, "lineitem")), RAW_STREAM, keep=["topic"])
    out = work_path(spark, "route")
    land.land_batches(parsed, f"{out}/rows", f"{out}/checkpoint", by=["topic"])
    stored = quality.stored(spark, out, "rows")
    return stored.groupBy("topic").agg(
        F.count("*").alias("n_rows"),
        F.count("SiteID").alias("n_sites"),
        F.sum(F.col("Count").try_cast("int")).alias("total"),
    )


def _landed(spark, sf, name):
    out = work_path(spark, name)
    good, dead = f"{out}/good", f"{out}/dead"
    arriving = messages(stream_table(spark, sf, "lineitem"))
    dead_letters.land_or_reject(arriving, RAW_STREAM, good, dead, f"{out}/checkpoint")
    return quality.stored(spark, out, "good"), quality.stored(spark, out, "dead").drop("batch_id")


DEAD = """SELECT topic, "value" AS original_message, 'payload does not parse' AS error_message, "timestamp",
  "partition", "offset", '{0}' AS dlq_retry, '3' AS dlq_retry_max FROM messages WHERE broken"""


def _headers(df):
    names = (dead_letters.RETRY, dead_letters.RETRY_MAX)
    return df.withColumns({n: F.col("headers")[n] for n in names}).drop("headers")


@query("stream_dlq", f"WITH {MESSAGES} {DEAD.format(0)}")
def stream_dlq(spark, sf):
    return _headers(_landed(spark, sf, "dlq")[1])


@query("stream_dlq_good", f"WITH {MESSAGES} SELECT topic, {STREAM_COLUMNS} FROM messages WHERE NOT broken")
def stream_dlq_good(spark, sf):
    return _landed(spark, sf, "dlq-good")[0].select("topic", *RAW_STREAM.fieldNames())


@query("dlq_retry", f"WITH {MESSAGES} {DEAD.format(2)}")
def dlq_retry(spark, sf):
    """Dead letters tried twice more; they still do not parse, so they come back with two tries used."""
    parsed = messages(table(spark, sf, "lineitem"))
    dead = dead_letters.split(parsed, RAW_STREAM)[1]
    for _ in range(2):
        dead = dead_letters.split(dead_letters.retry(dead), RAW_STREAM)[1]
    return _headers(dead)


@query(
    "stream_retry_loop",
    f"""WITH {MESSAGES} SELECT topic, CASE WHEN broken THEN 'exhausted' ELSE 'good' END AS ended, CASE WHEN broken THEN 3 ELSE 0 END AS tries,
      count(*) AS n_messages FROM messages GROUP BY ALL
    UNION ALL SELECT topic, 'back' AS ended, t AS tries, count(*) FROM messages, range(1, 4) AS r(t) WHERE broken GROUP BY ALL""",
)
def stream_retry_loop(spark, sf):
    """Every message ends as a row or with its tries spent; dead letters come back on a topic of their own."""
    out = work_path(spark, "retries")
    dead_letters.land_with_retries(messages(stream_table(spark, sf, "lineitem")), RAW_STREAM, out, f"{out}/checkpoint")
    good = quality.stored(spark, out, "good").select("topic", F.lit("good").alias("ended"), F.lit(0).cast("bigint").alias("tries"))
    tries = F.col("headers")[dead_letters.RETRY].cast("bigint").alias("tries")
    spent = quality.stored(spark, out, "exhausted").select("topic", F.lit("exhausted").alias("ended"), tries)
    back = spark.read.option("recursiveFileLookup", True).parquet(f"{out}/again")
    back = dead_letters.with_headers(back).select("topic", F.lit("back").alias("ended"), tries)
    return good.unionByName(spent).unionByName(back).groupBy("topic", "ended", "tries").agg(F.count("*").alias("n_messages"))


@query("stream_append_once", f"WITH {RAW} SELECT {STREAM_COLUMNS} FROM raw")
def stream_append_once(spark, sf):
    """A stream into a versioned table, started over with an empty checkpoint: its batch is known and not added again."""
    out = work_path(spark, "once")
    for checkpoint in ("first", "second"):
        arriving = raw_stream(stream_table(spark, sf, "lineitem")).drop("source")
        land.land_once(arriving, f"{out}/rows", "counts", f"{out}/{checkpoint}")
    return VersionedTable(spark, f"{out}/rows").read()


# what the stream sees: the parsed messages, all null where the payload is broken
PARSED = f"{MESSAGES}, parsed AS (SELECT topic, {KEPT} FROM messages)"


@query(
    "stream_dq",
    f"""WITH {PARSED}, {counts_sql("topic", "parsed")}
    SELECT topic, {REPORT_COLUMNS}, TIMESTAMP '2024-12-01 00:00:00' AS run_time, 0 AS batch_id FROM counts""",
)
def stream_dq(spark, sf):
    """The suite on a stream of four topics: the report of its one batch, per topic."""
    return quality.stored(spark, _checked(spark, sf), "report")


FAILED_LIST = f"""list_filter([{", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in zip(NAMES, CONDITIONS))}],
  lambda x: x IS NOT NULL)"""


@query(
    "stream_dq_split",
    f"""WITH {PARSED} SELECT topic, {STREAM_COLUMNS}, array_to_string({FAILED_LIST}, ',') AS failed_checks,
      CASE WHEN len({FAILED_LIST}) = 0 THEN 'clean' ELSE 'quarantine' END AS status FROM parsed""",
)
def stream_dq_split(spark, sf):
    rows = quality.stored(spark, _checked(spark, sf), "rows").drop("batch_id")
    return rows.withColumn(suite.FAILED, F.concat_ws(",", suite.FAILED))


@query(
    "stream_dq_audit",
    f"""WITH {PARSED} SELECT topic, {STREAM_COLUMNS}, array_to_string({FAILED_LIST}, ',') AS failed_checks,
      count(*) AS n_copies, md5({KEY_TEXT}) AS row_id, 0 AS batch_id
    FROM parsed WHERE len({FAILED_LIST}) > 0 GROUP BY ALL""",
)
def stream_dq_audit(spark, sf):
    return quality.stored(spark, _checked(spark, sf), "audit")


def _checked(spark, sf):
    out = work_path(spark, "checked")
    arriving = topics.parse_payload(messages(stream_table(spark, sf, "lineitem")), RAW_STREAM, keep=["topic"])
    quality.land_checked(arriving, COUNT_CHECKS, out, f"{out}/checkpoint", "2024-12-01 00:00:00")
    return out


# Cycle hire is not expected here, which fails the topics that report it; a missing site only holds its rows back.
JOB_CHECKS = [*COUNT_CHECKS, Check("Mode", IN_LIST, "Validity", {"value_set": ["Private cycles"]})]
JOB_ACTIONS = {rule: "R" if action == "F" else action for _, rule, _, _, action in CATALOGUE} | {JOB_CHECKS[-1].name: "F"}
JOB_FAILED = f"""list_filter([{", ".join(f"CASE WHEN {cond} THEN '{c.name}' END" for c, cond in zip(
  JOB_CHECKS, [*CONDITIONS, '"Mode" IS NOT NULL AND "Mode" <> \'Private cycles\'']))}], lambda x: x IS NOT NULL)"""
HELD_BACK = ", ".join(f"'{name}'" for name, action in JOB_ACTIONS.items() if action == "R")


@query(
    "job_stream_checked",
    f"""WITH {MESSAGES}, flagged AS (SELECT *, {JOB_FAILED} AS failed FROM messages WHERE NOT broken),
      bad AS (SELECT DISTINCT topic FROM flagged WHERE list_contains(failed, '{JOB_CHECKS[-1].name}'))
    SELECT topic, {STREAM_COLUMNS}, array_to_string(failed, ',') AS failed_checks, NULL AS original_message,
      CASE WHEN topic IN (FROM bad) THEN 'held' WHEN list_has_any(failed, [{HELD_BACK}]) THEN 'quarantined'
        ELSE 'accepted' END AS part FROM flagged
    UNION ALL SELECT topic, {", ".join("NULL" for _ in STREAM_COLUMNS.split(","))}, NULL, "value", 'dead' FROM messages WHERE broken""",
)
def job_stream_checked(spark, sf):
    """Where every message ends: among the dead letters, held with its topic's batch, quarantined or accepted."""
    out = work_path(spark, "job-checked")
    arriving = messages(stream_table(spark, sf, "lineitem"))
    quality.land_routed(arriving, RAW_STREAM, JOB_CHECKS, JOB_ACTIONS, out, f"{out}/checkpoint", "2024-12-01 00:00:00")
    rows = quality.settled(spark, out).drop("batch_id").withColumn(suite.FAILED, F.concat_ws(",", suite.FAILED))
    dead = quality.stored(spark, out, "dead").select("topic", "original_message", F.lit("dead").alias("part"))
    return rows.unionByName(dead, allowMissingColumns=True)


def _arrivals(spark, sf, out):
    """Messages of the years up to 1998 arrive first, the others later."""
    arrived = messages(table(spark, sf, "lineitem"))
    later = F.col("timestamp") >= F.lit("1999-01-01").cast("timestamp_ntz")
    return [arrived.where(~later), arrived.where(later)], f"{out}/topic"


@query(
    "stream_incremental",
    f"""WITH {MESSAGES} SELECT CASE WHEN "timestamp" < TIMESTAMP '1999-01-01' THEN 1 ELSE 2 END AS run,
      count(*) AS n_rows, count("SiteID") FILTER (WHERE NOT broken) AS n_sites FROM messages GROUP BY 1
    UNION ALL SELECT 3, 0, 0""",
)
def stream_incremental(spark, sf):
    """Three runs of one query: the first files, the files that came since, and nothing new."""
    out = work_path(spark, "incremental")
    parts, topic = _arrivals(spark, sf, out)
    schema = parts[0].schema

    def run(number):
        arriving = topics.replay_topics(spark, topic, schema, "parquet")
        parsed = topics.parse_payload(arriving, RAW_STREAM).withColumn("run", F.lit(number))
        land.land(parsed, f"{out}/rows", f"{out}/checkpoint")

    for number, part in enumerate(parts, start=1):
        part.write.mode("append").parquet(topic)
        run(number)
    run(3)
    landed = spark.read.parquet(f"{out}/rows").groupBy("run").agg(
        F.count("*").alias("n_rows"), F.count("SiteID").alias("n_sites")
    )
    runs = spark.range(1, 4).select(F.col("id").cast("int").alias("run"))
    return runs.join(landed, "run", "left").na.fill(0)


@query(
    "stream_resume",
    f"""WITH {MESSAGES} SELECT topic, count(*) AS n_rows, count("SiteID") FILTER (WHERE NOT broken) AS n_sites
    FROM messages GROUP BY topic""",
)
def stream_resume(spark, sf):
    """A batch that fails after its write runs again on restart and replaces what it had written."""
    out = work_path(spark, "resume")
    parts, topic = _arrivals(spark, sf, out)
    schema = parts[0].schema

    def start(fail):
        def handle(batch, batch_id):
            land.write_batch(batch, f"{out}/rows", batch_id)
            if fail:
                raise RuntimeError("lost after the write, before the commit")

        parsed = topics.parse_payload(topics.replay_topics(spark, topic, schema, "parquet"), RAW_STREAM, ["topic"])
        land.each_batch(parsed, handle, f"{out}/checkpoint")

    parts[0].write.mode("append").parquet(topic)
    try:
        start(fail=True)
    except Exception as error:
        if "lost after the write" not in str(error):
            raise
    parts[1].write.mode("append").parquet(topic)
    start(fail=False)
    return spark.read.parquet(f"{out}/rows").groupBy("topic").agg(
        F.count("*").alias("n_rows"), F.count("SiteID").alias("n_sites")
    )


"""Column checks, reports, splits, audit, contracts and rule routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.operators import contract, suite
from tallymill.operators.checks import UNIQUE, Check
from tallymill.plans.count_checks import CATALOGUE, COUNT_CHECKS, catalogue
from tallymill.schemas import RAW_STREAM
from workload.inputs import LOCATIONS, RAW, STREAM_COLUMNS, locations, raw_counts, raw_stream, table
from workload.registry import query

# Faults for the checks that the count records pass, or fail on one kind only, at fixed orders and lines.
FAULTS = {
    "Wave": ("CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN substr(`Wave`, 1, 7) ELSE `Wave` END"),
    "SiteID": ("CASE WHEN l_orderkey % 107 = 0 THEN 'site ' || `SiteID` ELSE `SiteID` END"),
    "Date": ("CASE WHEN l_orderkey % 109 = 0 THEN NULL ELSE `Date` END"),
    "Time": ("CASE WHEN l_orderkey % 113 = 0 THEN NULL WHEN l_orderkey % 127 = 0 THEN '25:61:00' WHEN l_orderkey % 131 = 0 THEN 'noon' ELSE `Time` END"),
    "Day": ("CASE WHEN l_orderkey % 137 = 0 THEN 'Holiday' ELSE `Day` END"),
    "Count": ("CASE WHEN l_orderkey % 139 = 0 THEN NULL ELSE `Count` END"),
}
FAULTY = (
    RAW.replace("raw AS (", "sound AS (", 1)
    + ", raw AS (SELECT * REPLACE ("
    + ", ".join(f'{sql.replace("`", chr(34))} AS "{column}"' for column, sql in FAULTS.items())
    + ") FROM sound)"
)


def faulty(spark, sf, *keep):
    """Count records with faults for all checks of the suite, in stream names, and `keep`."""
    raw = raw_stream(table(spark, sf, "lineitem"), "l_orderkey", *[k for k in keep if k != "l_orderkey"])
    return raw.withColumns({c: F.expr(sql) for c, sql in FAULTS.items()}).select(*RAW_STREAM.fieldNames(), *keep)


# The SQL condition of each check in COUNT_CHECKS, in the same order.
CONDITIONS = [
    '"Wave" IS NULL',
    """"Wave" IS NOT NULL AND NOT regexp_matches("Wave", '^[0-9]{4} Q[1-4] \\(Jan-Mar|Apr-Jun|Jul-Sep|Oct-Dec\\)$')""",
    '"SiteID" IS NULL',
    """"SiteID" IS NOT NULL AND NOT regexp_matches("SiteID", '^ML[0-9]{4}$')""",
    '"Date" IS NULL',
    """"Date" IS NOT NULL AND try_strptime("Date", '%d/%m/%Y') IS NULL""",
    '"Weather" IS NULL',
    '"Time" IS NULL',
    """"Time" IS NOT NULL AND try_strptime("Time", '%H:%M:%S') IS NULL""",
    """"Day" IS NOT NULL AND "Day" NOT IN ('Weekday', 'Weekend')""",
    """"Direction" IS NOT NULL AND "Direction" NOT IN ('Northbound', 'Southbound', 'Eastbound', 'Westbound')""",
    '"Path" IS NULL',
    '"Count" IS NULL',
    '"Count" IS NOT NULL AND (try_cast("Count" AS double) IS NULL OR try_cast("Count" AS double) < 0)',
]

NAMES = [c.name for c in COUNT_CHECKS]

FLAGGED = f"""{FAULTY}, flagged AS (SELECT *, list_filter([{
    ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in zip(NAMES, CONDITIONS))
}], lambda x: x IS NOT NULL) AS failed FROM raw)"""



def counts_sql(by: str = "", source: str = "raw") -> str:
    lead, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    parts = " UNION ALL ".join(
        f"""SELECT {lead}{i} AS check_no, '{c.name}' AS check_name, '{c.column}' AS "column", '{c.dimension}' AS dimension,
          count(*) AS element_count, count(*) FILTER (WHERE {cond}) AS unexpected_count FROM {source}{group}"""
        for i, (c, cond) in enumerate(zip(COUNT_CHECKS, CONDITIONS))
    )
    return f"counts AS ({parts})"


COUNTS = counts_sql()

# Report names of the rules, as they must appear.
TYPES = {
    "check_if_not_null": "expect_column_values_to_not_be_null",
    "check_if_values_in_list": "expect_column_values_to_be_in_set",
    "check_if_matches_regex": "expect_column_values_to_match_regex",
    "check_if_valid_date_format": "expect_column_values_to_match_strftime_format",
    "check_if_valid_time_format": "expect_column_values_to_match_strftime_format",
    "check_if_greater_than_or_equal_to": "expect_column_values_to_be_between",
}
TYPE_CASE = "CASE check_no " + " ".join(f"WHEN {i} THEN '{TYPES[c.rule]}'" for i, c in enumerate(COUNT_CHECKS)) + " END"

REPORT_COLUMNS = f""""column", dimension, CASE WHEN unexpected_count = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
  {TYPE_CASE} AS expectation_type, unexpected_count, element_count,
  cast(unexpected_count AS double) / element_count * 100 AS unexpected_percent,
  100 - cast(unexpected_count AS double) / element_count * 100 AS percent"""
REPORT = f"SELECT {REPORT_COLUMNS} FROM counts"


def one_check(index):
    """Rows of the count records that violate one check, with their order line."""

    def run(spark, sf):
        check = COUNT_CHECKS[index]
        raw = faulty(spark, sf, "l_orderkey", "l_linenumber")
        return suite.quarantine(raw, [check]).select(
            "l_orderkey", "l_linenumber", F.col(check.column).alias("value")
        )

    return run


for key, index in [
    ("dq_not_null", 2), ("dq_wave_regex", 1), ("dq_date_format", 5), ("dq_in_set", 10), ("dq_ge", 13),
]:
    query(
        key,
        f"""WITH {FAULTY} SELECT l_orderkey, l_linenumber, "{COUNT_CHECKS[index].column}" AS "value" FROM raw
        WHERE {CONDITIONS[index]}""",
    )(one_check(index))


@query("dq_regex", "SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https://[a-z.-]+/(en|fr)/')")
def dq_regex(spark, sf):
    check = Check("url", "check_if_matches_regex", "Validity", {"regex_pattern": "^https://[a-z.-]+/(en|fr)/"})
    return suite.quarantine(table(spark, sf, "pages").select("page_id", "url"), [check]).drop(suite.FAILED)


@query(
    "dq_time_format",
    """WITH clock AS (SELECT event_id, CASE event_type WHEN 'error' THEN strftime(ts, '%H:%M')
      WHEN 'view' THEN strftime(ts, '%H:%M:') || cast(second(ts) + 30 AS varchar)
      ELSE strftime(ts, '%H:%M:%S') END AS clock FROM events)
    SELECT event_id, clock FROM clock WHERE try_strptime(clock, '%H:%M:%S') IS NULL""",
)
def dq_time_format(spark, sf):
    """Times of errors lack their seconds; those of views may have more than 59."""
    late = F.concat(F.date_format("ts", "HH:mm:"), (F.second("ts") + 30).cast("string"))
    clock = (
        F.when(F.col("event_type") == "error", F.date_format("ts", "HH:mm"))
        .when(F.col("event_type") == "view", late)
        .otherwise(F.date_format("ts", "HH:mm:ss"))
    )
    events = table(spark, sf, "events").select("event_id", clock.alias("clock"))
    check = Check("clock", "check_if_valid_time_format", "Validity", {"time_format": "%H:%M:%S"})
    return suite.quarantine(events, [check]).drop(suite.FAILED)


@query(
    "dq_unique",
    """SELECT o_orderkey, CASE WHEN count(*) OVER (PARTITION BY o_orderkey) > 1 THEN 'o_orderkey_check_if_unique,'
       ELSE '' END || CASE WHEN count(*) OVER (PARTITION BY o_totalprice) > 1 THEN 'o_totalprice_check_if_unique,'
       ELSE '' END || CASE WHEN count(*) OVER (PARTITION BY o_orderpriority) > 1
       THEN 'o_orderpriority_check_if_unique,' ELSE '' END AS failed FROM orders""",
)
def dq_unique(spark, sf):
    """A unique column, one with some repeats, and one that holds five values only."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    flagged = suite.flag(orders, [Check(c, UNIQUE, "Uniqueness") for c in orders.columns])
    ended = F.transform(suite.FAILED, lambda name: F.concat(name, F.lit(",")))
    return flagged.select("o_orderkey", F.concat_ws("", ended).alias("failed"))


@query(
    "dq_unique_report",
    """SELECT 'o_orderkey' AS "column", count(*) - count(*) FILTER (WHERE n = 1) AS unexpected_count,
      count(*) AS element_count FROM (SELECT count(*) OVER (PARTITION BY o_orderkey) AS n FROM orders)
    UNION ALL SELECT 'o_totalprice', count(*) - count(*) FILTER (WHERE n = 1), count(*)
      FROM (SELECT count(*) OVER (PARTITION BY o_totalprice) AS n FROM orders)""",
)
def dq_unique_report(spark, sf):
    checks = [Check(c, UNIQUE, "Uniqueness") for c in ("o_orderkey", "o_totalprice")]
    orders = table(spark, sf, "orders")
    return suite.report(orders, checks).select("column", "unexpected_count", "element_count")


@query(
    "dq_suite",
    f"WITH {FAULTY}, {COUNTS} SELECT check_name, unexpected_count, element_count, unexpected_count = 0 AS success FROM counts",
)
def dq_suite(spark, sf):
    return suite.suite_counts(faulty(spark, sf), COUNT_CHECKS)


@query("dq_report", f"WITH {FAULTY}, {COUNTS} {REPORT}")
def dq_report(spark, sf):
    return suite.report(faulty(spark, sf), COUNT_CHECKS)


@query(
    "dq_run_log",
    f"WITH {FAULTY}, {COUNTS} SELECT *, cast(7 AS bigint) AS batch_id, TIMESTAMP '2024-12-01 00:00:00' AS run_time FROM ({REPORT})",
)
def dq_run_log(spark, sf):
    return suite.run_log(suite.report(faulty(spark, sf), COUNT_CHECKS), 7, "2024-12-01 00:00:00")


@query(
    "dq_by_dimension",
    f"""WITH {FAULTY}, {COUNTS}, report AS ({REPORT}) SELECT dimension, count(*) AS n_checks,
      count(*) FILTER (WHERE status = 'FAILED') AS n_failed, round(avg(percent), 9) AS avg_percent,
      min(percent) AS min_percent FROM report GROUP BY dimension""",
)
def dq_by_dimension(spark, sf):
    rolled = suite.by_dimension(suite.report(faulty(spark, sf), COUNT_CHECKS))
    return rolled.withColumn("avg_percent", F.round("avg_percent", 9))


@query("dq_violations", f"WITH {FLAGGED} SELECT {STREAM_COLUMNS}, unnest(failed) AS check_name FROM flagged")
def dq_violations(spark, sf):
    return suite.violations(faulty(spark, sf), COUNT_CHECKS)


@query(
    "dq_violations_all",
    f"""WITH {FLAGGED.replace(FAULTY, RAW)}, failing AS (SELECT count(DISTINCT name) AS n FROM (SELECT unnest(failed) AS name FROM flagged))
    SELECT {STREAM_COLUMNS} FROM flagged WHERE len(failed) = (SELECT n FROM failing) AND len(failed) > 0""",
)
def dq_violations_all(spark, sf):
    return suite.violating_all(raw_counts(spark, sf), COUNT_CHECKS)


EACH_COLUMN = [6, 11, 12]  # checks that one row may fail together
_EACH = " AND ".join(f"({CONDITIONS[i]})" for i in EACH_COLUMN)


@query("dq_violations_all_columns", f"WITH {FAULTY} SELECT {STREAM_COLUMNS} FROM raw WHERE {_EACH}")
def dq_violations_all_columns(spark, sf):
    """Counts without weather, path and count: what three checks of three columns have in common."""
    lines = faulty(spark, sf, "l_orderkey")
    return suite.violating_all(lines, [COUNT_CHECKS[i] for i in EACH_COLUMN]).drop("l_orderkey")


@query("dq_clean", f"WITH {FLAGGED} SELECT {STREAM_COLUMNS} FROM flagged WHERE len(failed) = 0")
def dq_clean(spark, sf):
    return suite.clean(faulty(spark, sf), COUNT_CHECKS)


@query(
    "dq_quarantine",
    f"""WITH {FLAGGED} SELECT {STREAM_COLUMNS}, array_to_string(failed, ',') AS failed_checks FROM flagged
    WHERE len(failed) > 0""",
)
def dq_quarantine(spark, sf):
    held = suite.quarantine(faulty(spark, sf), COUNT_CHECKS)
    return held.withColumn(suite.FAILED, F.concat_ws(",", suite.FAILED))


KEY_TEXT = " || '-' || ".join(
    f"coalesce({c}, '_dbt_utils_surrogate_key_null_')" for c in STREAM_COLUMNS.split(",")
)


@query(
    "dq_audit",
    f"""WITH {FLAGGED} SELECT {STREAM_COLUMNS}, array_to_string(failed, ',') AS failed_checks, count(*) AS n_copies,
      md5({KEY_TEXT}) AS row_id, 'Central' AS topic, cast(1 AS bigint) AS batch_id FROM flagged
    WHERE len(failed) > 0 GROUP BY ALL""",
)
def dq_audit(spark, sf):
    held = suite.quarantine(faulty(spark, sf), COUNT_CHECKS)
    return suite.audit_rows(held.withColumn("topic", F.lit("Central")), 1)


VALUE_CASE = "CASE check_name " + " ".join(f"""WHEN '{c.name}' THEN "{c.column}" """ for c in COUNT_CHECKS) + " END"


@query(
    "dq_samples",
    f"""WITH {FLAGGED}, long AS (SELECT *, unnest(failed) AS check_name FROM flagged), per_value AS (
      SELECT check_name, {VALUE_CASE} AS "value", count(*) AS n_rows FROM long GROUP BY ALL)
    SELECT check_name, "value", n_rows FROM (SELECT *, row_number() OVER (PARTITION BY check_name
      ORDER BY n_rows DESC, "value" ASC NULLS FIRST) AS rn FROM per_value) WHERE rn <= 20""",
)
def dq_samples(spark, sf):
    return suite.samples(faulty(spark, sf), COUNT_CHECKS)


@query(
    "contract_check",
    f"WITH {RAW} "
    + " UNION ALL ".join(
        f"""SELECT '{f}' AS field, count(*) FILTER (WHERE "{f}" IS NULL OR "{f}" = '') AS n_bad, count(*) AS n_rows
        FROM raw"""
        for f in RAW_STREAM.fieldNames()
    ),
)
def contract_check(spark, sf):
    return contract.contract_report(raw_counts(spark, sf), RAW_STREAM)


@query(
    "dq_relationships",
    f"""WITH {RAW}, {LOCATIONS} SELECT "SiteID" AS "key", count(*) AS n_rows, 'warn' AS severity FROM raw
    WHERE "SiteID" IS NOT NULL AND "SiteID" NOT IN (SELECT site_id FROM locations WHERE balance > 0) GROUP BY 1""",
)
def dq_relationships(spark, sf):
    """Sites counted but not among the monitored locations (those in credit)."""
    monitored = locations(spark, sf).where(F.col("balance") > 0)
    return contract.orphan_keys(raw_counts(spark, sf), "SiteID", monitored, "site_id")


CATALOGUE_SQL = "catalogue AS (SELECT * FROM (VALUES " + ", ".join(
    f"({key}, '{rule}', '{risk}', '{action}')" for key, rule, _, risk, action in CATALOGUE
) + ") AS t(rule_key, rule_name, risk_level, action))"


@query(
    "dq_rule_actions",
    f"""WITH {FAULTY}, {COUNTS}, {CATALOGUE_SQL} SELECT check_name, rule_key, risk_level, action, unexpected_count,
      CASE WHEN unexpected_count = 0 THEN 'none' WHEN action = 'R' THEN 'quarantine_rows'
        WHEN action = 'F' THEN 'fail_batch' ELSE 'accept_and_log' END AS outcome
    FROM counts JOIN catalogue ON check_name = rule_name""",
)
def dq_rule_actions(spark, sf):
    return suite.route_actions(faulty(spark, sf), COUNT_CHECKS, catalogue(spark))


def _listed(action: str) -> str:
    return "[" + ", ".join(f"'{rule}'" for _, rule, _, _, a in CATALOGUE if a == action) + "]"


@query(
    "dq_routed",
    f"""WITH {FLAGGED} SELECT {STREAM_COLUMNS}, array_to_string(failed, ',') AS failed_checks,
      CASE WHEN list_has_any(failed, {_listed("F")}) THEN 'fail' WHEN list_has_any(failed, {_listed("R")})
        THEN 'quarantine' ELSE 'accept' END AS route FROM flagged""",
)
def dq_routed(spark, sf):
    actions = {rule: action for _, rule, _, _, action in CATALOGUE}
    routed = suite.routed(faulty(spark, sf), COUNT_CHECKS, actions)
    return routed.withColumn(suite.FAILED, F.concat_ws(",", suite.FAILED))

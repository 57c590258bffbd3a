"""The check suite and rule catalogue of the count records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.operators.checks import Check

NOT_NULL = "check_if_not_null"
REGEX = "check_if_matches_regex"
IN_LIST = "check_if_values_in_list"

# The checks of a count record, in report order. The wave pattern is as published: its alternatives
# are not grouped, so any text that holds `Apr-Jun` passes.
WAVE_PATTERN = r"^[0-9]{4} Q[1-4] \(Jan-Mar|Apr-Jun|Jul-Sep|Oct-Dec\)$"
SITE_PATTERN = r"^ML[0-9]{4}$"
DAYS = ["Weekday", "Weekend"]
DIRECTIONS = ["Northbound", "Southbound", "Eastbound", "Westbound"]

COUNT_CHECKS = [
    Check("Wave", NOT_NULL, "Completeness"),
    Check("Wave", REGEX, "Validity", {"regex_pattern": WAVE_PATTERN}),
    Check("SiteID", NOT_NULL, "Completeness"),
    Check("SiteID", REGEX, "Validity", {"regex_pattern": SITE_PATTERN}),
    Check("Date", NOT_NULL, "Completeness"),
    Check("Date", "check_if_valid_date_format", "Validity", {"date_format": "%d/%m/%Y"}),
    Check("Weather", NOT_NULL, "Completeness"),
    Check("Time", NOT_NULL, "Completeness"),
    Check("Time", "check_if_valid_time_format", "Validity", {"time_format": "%H:%M:%S"}),
    Check("Day", IN_LIST, "Validity", {"value_set": DAYS}),
    Check("Direction", IN_LIST, "Validity", {"value_set": DIRECTIONS}),
    Check("Path", NOT_NULL, "Completeness"),
    Check("Count", NOT_NULL, "Completeness"),
    Check("Count", "check_if_greater_than_or_equal_to", "Validity", {"min_value": 0}),
]

# The rule catalogue (key, rule, type, risk level, action); all rules are active, category I.
CATALOGUE = [
    (1, "Wave_check_if_not_null", "W", "3", "F"),
    (2, "Wave_check_if_matches_regex", "E", "3", "R"),
    (3, "SiteID_check_if_not_null", "W", "3", "F"),
    (4, "SiteID_check_if_matches_regex", "E", "3", "R"),
    (5, "Date_check_if_not_null", "W", "3", "A"),
    (6, "Date_check_if_valid_date_format", "E", "3", "R"),
    (7, "Weather_check_if_not_null", "W", "3", "A"),
    (8, "Time_check_if_not_null", "W", "3", "A"),
    (9, "Time_check_if_valid_time_format", "E", "3", "R"),
    (10, "Day_check_if_values_in_list", "E", "3", "R"),
    (11, "Direction_check_if_values_in_list", "E", "3", "R"),
    (12, "Path_check_if_not_null", "W", "3", "A"),
    (13, "Count_check_if_not_null", "E", "3", "R"),
    (14, "Count_check_if_greater_than_or_equal_to", "E", "5", "R"),
]


def catalogue(spark: SparkSession) -> DataFrame:
    names = ("rule_key", "rule_name", "rule_type", "rule_category", "risk_level", "status", "action")
    rules = [(key, rule, kind, "I", risk, "A", action) for key, rule, kind, risk, action in CATALOGUE]
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))

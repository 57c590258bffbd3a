"""The column checks: each one is an expression that is true for a violating row.

Null is a violation of the not-null check only. New checks are added with `register_check`.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tallymill.functions.times import spark_pattern

UNIQUE = "check_if_unique"


@dataclass(frozen=True)
class Check:
    """One rule on one column. `name` is `<column>_<rule>`, and `_2`, `_3`... for further checks of that pair."""

    column: str
    rule: str
    dimension: str
    params: dict[str, Any] = field(default_factory=dict, hash=False)
    number: int = 1

    @property
    def name(self) -> str:
        return f"{self.column}_{self.rule}" + (f"_{self.number}" if self.number > 1 else "")


def _required(check: Check, key: str) -> Any:
    value = check.params.get(key)
    if value is None or value == "":
        raise ValueError(f"{check.name} needs {key!r} in add_info")
    return value


def _not_null(col: Column, check: Check) -> Column:
    return col.isNull()


def _in_list(col: Column, check: Check) -> Column:
    if "value_set" not in check.params:
        raise KeyError(f"{check.name} needs 'value_set' in add_info")
    allowed = [v for v in check.params["value_set"] if v is not None]
    return col.isNotNull() & ~col.isin(allowed)


def _regex(col: Column, check: Check) -> Column:
    return col.isNotNull() & ~col.rlike(_required(check, "regex_pattern"))


def _date_format(col: Column, check: Check) -> Column:
    return col.isNotNull() & F.try_to_date(col, spark_pattern(_required(check, "date_format"))).isNull()


def _time_format(col: Column, check: Check) -> Column:
    pattern = F.lit(spark_pattern(_required(check, "time_format")))
    return col.isNotNull() & F.try_to_timestamp(col, pattern).isNull()


def _at_least(col: Column, check: Check) -> Column:
    number = col.try_cast("double")
    return col.isNotNull() & (number.isNull() | (number < float(_required(check, "min_value"))))


@dataclass(frozen=True)
class Rule:
    """How a rule is named in reports, and its violation expression (None: counted per value)."""

    expectation_type: str
    violation: Callable[[Column, Check], Column] | None


# Rule names as written in configs, and expectation types as written in reports.
RULES: dict[str, Rule] = {
    "check_if_not_null": Rule("expect_column_values_to_not_be_null", _not_null),
    UNIQUE: Rule("expect_column_values_to_be_unique", None),
    "check_if_values_in_list": Rule("expect_column_values_to_be_in_set", _in_list),
    "check_if_matches_regex": Rule("expect_column_values_to_match_regex", _regex),
    "check_if_valid_date_format": Rule("expect_column_values_to_match_strftime_format", _date_format),
    "check_if_valid_time_format": Rule("expect_column_values_to_match_strftime_format", _time_format),
    "check_if_greater_than_or_equal_to": Rule("expect_column_values_to_be_between", _at_least),
}


def register_check(rule: str, expectation_type: str, violation: Callable[[Column, Check], Column]) -> None:
    """Add a user rule; `violation(column, check)` must be true for violating rows."""
    RULES[rule] = Rule(expectation_type, violation)


def rule_of(check: Check) -> Rule:
    if check.rule not in RULES:
        raise KeyError(f"unknown rule {check.rule!r}; known rules: {sorted(RULES)}")
    return RULES[check.rule]


def violation(check: Check) -> Column:
    """The violation expression, never null."""
    build = rule_of(check).violation
    if build is None:
        raise ValueError(f"{check.name} is counted over the whole column, not row by row")
    return F.coalesce(build(F.col(check.column), check), F.lit(False))


def read_json(path: str, spark: SparkSession | None = None) -> Any:
    """A small JSON file, such as a suite config, read where Spark reads its files."""
    spark = spark or SparkSession.active()
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def checks_from_config(config: dict[str, Any]) -> list[Check]:
    """Checks in config order; a column whose rule list is null or empty has none.

    Checks with the same column and rule are numbered, so that no two share a name.
    """
    found: list[Check] = []
    for column in config["columns"]:
        for rule in column["dq_rule(s)"] or []:
            name, kind = column["column_name"], rule["rule_name"]
            number = 1 + sum((c.column, c.rule) == (name, kind) for c in found)
            check = Check(name, kind, rule["rule_dimension"], rule.get("add_info") or {}, number)
            rule_of(check)
            found.append(check)
    return found


def load_checks(path: str, spark: SparkSession | None = None) -> list[Check]:
    return checks_from_config(read_json(path, spark))

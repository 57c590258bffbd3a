"""Running a list of checks: report, violations, clean/quarantine split, audit rows, samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.keys import surrogate_key
from tallymill.operators.checks import UNIQUE, Check, rule_of, violation
from tallymill.operators.rows import evaluate_once, union_all
from tallymill.operators.skew import attach_counts
from tallymill.session import small_partitions, work_path

FAILED = "failed_checks"


def _row_checks(checks: Sequence[Check]) -> list[tuple[int, Check]]:
    return [(i, c) for i, c in enumerate(checks) if c.rule != UNIQUE]


def _unique_checks(checks: Sequence[Check]) -> list[tuple[int, Check]]:
    return [(i, c) for i, c in enumerate(checks) if c.rule == UNIQUE]


def check_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_no, unexpected_count, element_count), one row per check.

    All row checks share one aggregation over one scan. Each unique check adds one group-by of its
    column, whose copies combine on the map side.
    """
    parts = []
    by_row = _row_checks(checks)
    if by_row:
        totals = df.agg(
            F.count("*").alias("element_count"),
            *[F.count_if(violation(c)).alias(f"v{i}") for i, c in by_row],
        )
        per_check = F.array(
            *[F.struct(F.lit(i).alias("check_no"), F.col(f"v{i}").alias("unexpected_count")) for i, _ in by_row]
        )
        parts.append(totals.select(F.inline(per_check), "element_count"))
    for i, check in _unique_checks(checks):
        repeated = F.col(check.column).isNotNull() & (F.col("n") > 1)
        counts = df.groupBy(check.column).agg(F.count("*").alias("n"))
        parts.append(
            counts.agg(
                F.lit(i).alias("check_no"),
                F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("unexpected_count"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("element_count"),
            )
        )
    return union_all(parts)


def _by_check_no(values: Sequence[str], check_no: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), check_no + 1)


def suite_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Per check: name, violations, rows, and whether it passed."""
    counts = check_counts(df, checks)
    return counts.select(
        _by_check_no([c.name for c in checks], F.col("check_no")).alias("check_name"),
        "unexpected_count",
        "element_count",
        (F.col("unexpected_count") == 0).alias("success"),
    )


def report_rows(counts: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """Turn (by..., check_no, unexpected_count, element_count) into the eight report columns, config order."""
    no = F.col("check_no")
    # one short row per check fits one partition and keeps the config order; with `by` there may be many
    placed = counts if by else counts.coalesce(1)
    bad_percent = F.when(
        F.col("element_count") > 0, F.col("unexpected_count") / F.col("element_count") * 100
    ).otherwise(0.0)
    return (
        placed.sortWithinPartitions(*by, "check_no").select(
            *by,
            _by_check_no([c.column for c in checks], no).alias("column"),
            _by_check_no([c.dimension for c in checks], no).alias("dimension"),
            F.when(F.col("unexpected_count") == 0, "PASSED").otherwise("FAILED").alias("status"),
            _by_check_no([rule_of(c).expectation_type for c in checks], no).alias("expectation_type"),
            "unexpected_count",
            "element_count",
            bad_percent.alias("unexpected_percent"),
            (F.lit(100.0) - bad_percent).alias("percent"),
        )
    )


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    return report_rows(check_counts(df, checks), checks)


def run_log(report_df: DataFrame, batch_id: int, run_time: str) -> DataFrame:
    """Report rows tagged with the batch and the time of the run, ready to append to a log table."""
    return report_df.withColumns(
        {"batch_id": F.lit(batch_id).cast("bigint"), "run_time": F.lit(run_time).cast("timestamp_ntz")}
    )


def _tested(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, list[Column]]:
    """Rows with what the tests need, and one violation expression per check."""
    rows, tests = df, {}
    for i, check in _unique_checks(checks):
        counts = df.groupBy(check.column).agg(F.count("*").alias(f"_n{i}")).where(f"_n{i} > 1")
        rows = attach_counts(rows, counts, check.column, f"_n{i}")
        tests[i] = F.col(check.column).isNotNull() & F.coalesce(F.col(f"_n{i}") > 1, F.lit(False))
    for i, check in _row_checks(checks):
        tests[i] = violation(check)
    return rows, [tests[i] for i in range(len(checks))]


def _failed(checks: Sequence[Check], tests: Sequence[Column]) -> Column:
    # array_remove rather than a lambda filter: it stays inside generated code
    names = [F.when(test, F.lit(c.name)).otherwise("") for c, test in zip(checks, tests)]
    return F.array_remove(F.array(*names).cast("array<string>"), "").alias(FAILED)


def _own(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def flag(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Every row with the names of the checks it fails, in config order, in `failed_checks`."""
    rows, tests = _tested(df, checks)
    return rows.select(*_own(df), _failed(checks, tests))


def _flagged_once(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows, tests = _tested(df, checks)
    return evaluate_once(rows, FAILED, _failed(checks, tests))


def clean(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows that fail nothing; copies stay."""
    return _flagged_once(df, checks).where(F.size(FAILED) == 0).select(*_own(df))


def quarantine(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows that fail something, with `failed_checks`."""
    return _flagged_once(df, checks).where(F.size(FAILED) > 0).select(*_own(df), FAILED)


def violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per row and failed check."""
    return quarantine(df, checks).withColumn("check_name", F.explode(FAILED)).drop(FAILED)


BITS = 62  # checks per word


def _bits(checks: Sequence[Check]) -> list[Column]:
    """Which checks a row fails, one bit each, in words of `BITS`."""
    words = []
    for start in range(0, len(checks), BITS):
        bits = [F.when(F.array_contains(FAILED, c.name), 1 << i).otherwise(0) for i, c in enumerate(checks[start : start + BITS])]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), bits).cast("bigint").alias(f"_bits{start // BITS}"))
    return words


def violating_all(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows that violate every check that fails anywhere; none when every check passes.

    The rows that fail something are stored in the one pass over `df`, with their failed checks as
    bits; the bits of all of them, or-ed together, are the checks that fail anywhere.
    """
    spark, path = df.sparkSession, work_path(df.sparkSession, "violating")
    held = quarantine(df, checks)
    words = _bits(checks)
    marked = held.select(*_own(df), *words)
    marked.write.parquet(path)
    stored = spark.read.schema(marked.schema).parquet(path)
    names = [f"_bits{i}" for i in range(len(words))]
    total = stored.agg(*[F.coalesce(F.bit_or(n), F.lit(0)).alias(n) for n in names]).first()
    for n in names:
        stored = stored.where(F.col(n) == total[n])
    return stored.drop(*names)


def samples(df: DataFrame, checks: Sequence[Check], k: int = 20) -> DataFrame:
    """Up to k distinct failing values per check, the most frequent first."""
    value = F.lit(None).cast("string")
    for check in reversed(list(checks)):
        value = F.when(F.col("check_name") == check.name, F.col(check.column).cast("string")).otherwise(value)
    per_value = violations(df, checks).groupBy("check_name", value.alias("value")).agg(F.count("*").alias("n_rows"))
    best = Window.partitionBy("check_name").orderBy(F.desc("n_rows"), F.col("value").asc_nulls_first())
    return per_value.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= k).drop("_rn")


def by_dimension(report_df: DataFrame) -> DataFrame:
    return report_df.groupBy("dimension").agg(
        F.count("*").alias("n_checks"),
        F.count_if(F.col("status") == "FAILED").alias("n_failed"),
        F.avg("percent").alias("avg_percent"),
        F.min("percent").alias("min_percent"),
    )


def audit_rows(quarantined: DataFrame, batch_id: int) -> DataFrame:
    """Quarantined rows with their `topic` for the audit table: content key, number of copies, batch.

    Copies of one row are counted rather than numbered, so a large group of copies combines on the
    map side and none of them is lost.
    """
    small_partitions(quarantined.sparkSession)
    data = [c for c in quarantined.columns if c not in (FAILED, "topic")]
    failed = F.concat_ws(",", FAILED).alias(FAILED)
    return (
        quarantined.groupBy(*[F.col(c) for c in data], "topic", failed)
        .agg(F.count("*").alias("n_copies"))
        .withColumns({"row_id": surrogate_key(*data), "batch_id": F.lit(batch_id).cast("bigint")})
    )


def route_actions(df: DataFrame, checks: Sequence[Check], catalogue: DataFrame) -> DataFrame:
    """What the rule catalogue orders for each check of the suite, given its violations.

    `catalogue` has rule_name, status and action. Rules that are not active ('A') are skipped.
    Action R quarantines the rows, F fails the batch, A accepts and logs. A check that the catalogue
    does not list stays in the outcome, as "not_listed" if it has violations.
    """
    counts = suite_counts(df, checks)
    joined = counts.join(catalogue, counts["check_name"] == catalogue["rule_name"], "left")
    joined = joined.where(F.col("rule_name").isNull() | (F.col("status") == "A"))
    hit = F.col("unexpected_count") > 0
    outcome = (
        F.when(~hit, "none")
        .when(F.col("rule_name").isNull(), "not_listed")
        .when(F.col("action") == "R", "quarantine_rows")
        .when(F.col("action") == "F", "fail_batch")
        .otherwise("accept_and_log")
    )
    return joined.select("check_name", "rule_key", "risk_level", "action", "unexpected_count", outcome.alias("outcome"))


def routed(df: DataFrame, checks: Sequence[Check], actions: dict[str, str]) -> DataFrame:
    """Rows with a `route`: 'fail' if an F rule is violated, else 'quarantine' for R, else 'accept'.

    `actions` maps check names to R, F or A; a check that is missing or A never holds a row back.
    """
    flagged = flag(df, checks)

    def fails(action: str) -> Column:
        names = [c.name for c in checks if actions.get(c.name) == action]
        return F.arrays_overlap(F.col(FAILED), F.array(*[F.lit(n) for n in names]).cast("array<string>"))

    return flagged.withColumn(
        "route", F.when(fails("F"), "fail").when(fails("R"), "quarantine").otherwise("accept")
    )

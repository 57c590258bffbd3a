"""The check suite on a stream: per batch a report, clean and quarantined rows, and audit rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.operators import suite
from tallymill.operators.checks import Check
from tallymill.streaming import dead_letters
from tallymill.streaming.land import each_batch, write_batch


def counts_from_flags(flagged: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """(by..., check_no, unexpected_count, element_count) from rows that carry their failed checks."""
    totals = flagged.groupBy(*by).agg(
        F.count("*").alias("element_count"),
        *[F.count_if(F.array_contains(suite.FAILED, c.name)).alias(f"v{i}") for i, c in enumerate(checks)],
    )
    per_check = F.array(
        *[
            F.struct(F.lit(i).alias("check_no"), F.col(f"v{i}").alias("unexpected_count"))
            for i, _ in enumerate(checks)
        ]
    )
    return totals.select(*by, F.inline(per_check), "element_count")


def land_checked(rows: DataFrame, checks: Sequence[Check], out: str, checkpoint: str, run_time: str) -> None:
    """Per batch: rows with their failed checks, stored by topic and status; then report and audit.

    `rows` has a `topic` column, and one stream serves all topics. The checks run once per row, when
    the rows are stored; the report (per topic) and the audit read the stored flags. A unique check
    looks for copies within the batch, over all topics.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        status = F.when(F.size(suite.FAILED) == 0, "clean").otherwise("quarantine")
        flagged = suite.flag(batch, checks)
        stored_at = write_batch(flagged.withColumn("status", status), f"{out}/rows", batch_id, by=["topic", "status"])
        spark = batch.sparkSession
        kept = spark.read.schema(flagged.withColumn("status", status).schema).parquet(stored_at)
        report = suite.report_rows(counts_from_flags(kept, checks, ["topic"]), checks, ["topic"])
        write_batch(suite.run_log(report, batch_id, run_time).drop("batch_id"), f"{out}/report", batch_id)
        held = kept.where(F.col("status") == "quarantine").drop("status")
        write_batch(suite.audit_rows(held, batch_id).drop("batch_id"), f"{out}/audit", batch_id, by=["topic"])

    each_batch(rows, handle, checkpoint)


def outcomes(counts: DataFrame, checks: Sequence[Check], actions: Mapping[str, str]) -> DataFrame:
    """What each check's violations lead to, per topic: every check is listed, also those without an action."""
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("check_no") + 1)
    action = F.nullif(pick([actions.get(c.name, "") for c in checks]), F.lit(""))
    outcome = (
        F.when(F.col("unexpected_count") == 0, "none")
        .when(action.isNull(), "not_listed")
        .when(action == "R", "quarantine_rows")
        .when(action == "F", "fail_batch")
        .otherwise("accept_and_log")
    )
    name = pick([c.name for c in checks]).alias("check_name")
    return counts.select("topic", name, action.alias("action"), "unexpected_count", "element_count", outcome.alias("outcome"))


def land_routed(
    messages: DataFrame,
    schema: T.StructType,
    checks: Sequence[Check],
    actions: Mapping[str, str],
    out: str,
    checkpoint: str,
    run_time: str,
) -> None:
    """The whole job on a stream of messages: parse, dead letters, checks, rule actions, report, audit.

    Per batch, messages that do not parse go to `dead` with their text, and the others to `rows` with
    their failed checks and their route. `outcome` says per topic and check what its violations lead
    to, `report` and `audit` are those of the suite. `actions` maps check names to R, F or A. An F
    check with violations fails its topic's part of the batch, see `settled`.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with dead_letters.kept_parsed(batch, schema) as parsed:
            write_batch(dead_letters.rejected(parsed), f"{out}/dead", batch_id)
            routed = suite.routed(dead_letters.accepted(parsed, schema), checks, dict(actions))
            stored_at = write_batch(routed, f"{out}/rows", batch_id, by=["topic", "route"])
        kept = spark.read.schema(routed.schema).parquet(stored_at)
        counts = counts_from_flags(kept, checks, ["topic"])
        write_batch(outcomes(counts, checks, actions), f"{out}/outcome", batch_id)
        report = suite.report_rows(counts, checks, ["topic"])
        write_batch(suite.run_log(report, batch_id, run_time).drop("batch_id"), f"{out}/report", batch_id)
        faulty = kept.where(F.size(suite.FAILED) > 0).drop("route")
        write_batch(suite.audit_rows(faulty, batch_id).drop("batch_id"), f"{out}/audit", batch_id, by=["topic"])

    each_batch(messages, handle, checkpoint)


def settled(spark: SparkSession, out: str) -> DataFrame:
    """The rows of `land_routed` with their `part`: accepted, quarantined, or held if their topic's batch failed."""
    failed = stored(spark, out, "outcome").where("outcome = 'fail_batch'").select("batch_id", "topic").distinct()
    rows = stored(spark, out, "rows").join(failed.withColumn("_failed", F.lit(True)), ["batch_id", "topic"], "left")
    part = F.when(F.col("_failed"), "held").when(F.col("route") == "quarantine", "quarantined").otherwise("accepted")
    return rows.withColumn("part", part).drop("_failed", "route")


def stored(spark: SparkSession, out: str, part: str) -> DataFrame:
    """What `land_checked` or `land_routed` stored in one of its folders, all batches. Topics stay text, also `007`."""
    path = f"{out}/{part}"
    fields = [T.StructField(f.name, T.StringType()) if f.name == "topic" else f for f in spark.read.parquet(path).schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)

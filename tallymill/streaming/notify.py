"""Grouping and repeat suppression on a stream of firing alerts.

Two queries, each with its own checkpoint, joined by files that Spark's file sink commits by batch, so
that each interval is read once, whatever runs again. The first counts alerts per group and interval in a
watermarked window aggregation: partial counts keep a group with most alerts from meeting in one
task, and what comes late, within the lateness, is counted. The second keeps a row of state per
group: the run of intervals it is in, and what was sent last. It sees one row per group and interval,
and a timer removes the state of a group whose run is over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallymill.operators.timeseries import seconds
from tallymill.sources.topics import replay_topics
from tallymill.streaming.land import land

COUNTED = "tick bigint, n_alerts bigint, print bigint"


def land_intervals(
    firing: DataFrame,
    by: Sequence[str],
    interval: int,
    out: str,
    checkpoint: str,
    identity: Sequence[str] = (),
    lateness: str = "0 seconds",
) -> None:
    """Counts of a stream of alerts to `out`: one row per group and closed interval.

    `firing` has `by`, `identity` and `ts` without a zone. An interval may come in any number of
    batches and in any order; it is handed on once, when an alert more than `lateness` past its end
    has come, and an alert that comes after that is dropped. With `identity`, alerts that agree in
    it count once, and `print` tells sets of alerts apart. A row whose `by` are all null is a
    heartbeat: it moves time on and is no alert.
    """
    # watermarks need an instant; `ts` is read as UTC, as everywhere in the time-series operators
    at = F.timestamp_seconds(seconds(F.col("ts"))).alias("at")
    timed = firing.select(*by, *identity, at).withWatermark("at", lateness)
    window = F.window("at", f"{interval} seconds")
    if identity:
        timed = timed.select(*by, *identity, window.alias("w")).dropDuplicates([*by, *identity, "w"])
        mark = F.bit_xor(F.xxhash64(*identity))
        counted = timed.groupBy(*by, "w").agg(F.count("*").alias("n_alerts"), mark.alias("print"))
    else:
        counted = timed.groupBy(*by, window.alias("w")).agg(F.count("*").alias("n_alerts"))
        counted = counted.withColumn("print", F.lit(0).cast("bigint"))
    counted = counted.select(*by, F.unix_seconds("w.start").alias("tick"), "n_alerts", "print")
    land(counted, out, checkpoint)


def land_sent(
    counted: DataFrame, by: Sequence[str], interval: int, repeat: int, out: str, checkpoint: str, wait: int = 0
) -> None:
    """Notifications of a stream of intervals (`land_intervals`) to `out`: `by`, `since`, `sent_at`, `n_alerts`, `reason`.

    A group is sent `wait` seconds after the interval that starts a run ("new"), after an interval
    with another set of alerts than the one before ("changed"), and when nothing was sent for
    `repeat` seconds, rounded up to whole intervals ("repeat").
    """
    every = -(-repeat // interval) * interval
    fields = [counted.schema[n] for n in by]
    sent = T.StructType([*fields, *(T.StructField(n, T.LongType()) for n in ("since", "sent_at", "n_alerts")), T.StructField("reason", T.StringType())])
    names = sent.fieldNames()

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # the run is over
            state.remove()
            return
        if all(pd.isna(k) for k in key):  # heartbeats
            for _ in parts:
                pass
            return
        last, since, anchor, mark = state.get if state.exists else (None, None, None, None)
        rows = []
        for tick, n, now in pd.concat(parts).sort_values("tick")[["tick", "n_alerts", "print"]].itertuples(index=False):
            if last is None or tick != last + interval:
                since, anchor, reason = tick, tick, "new"
            elif now != mark:
                anchor, reason = tick, "changed"
            else:
                reason = "repeat" if (tick - anchor) % every == 0 else None
            last, mark = tick, now
            if reason:
                rows.append((*key, since, tick + wait, n, reason))
        state.update((int(last), int(since), int(anchor), int(mark)))
        # the next interval of the run is in the batches that bring time past its end, or nowhere
        state.setTimeoutTimestamp((int(last) + 3 * interval) * 1000)
        if rows:
            yield pd.DataFrame(rows, columns=names)

    timed = counted.withColumn("at", F.timestamp_seconds("tick")).withWatermark("at", f"{2 * interval} seconds")
    found = timed.groupBy(*by).applyInPandasWithState(
        step, sent, "last long, since long, anchor long, print long", "append", GroupStateTimeout.EventTimeTimeout
    )
    land(found, out, checkpoint)


def land_notifications(
    firing: DataFrame,
    by: Sequence[str],
    interval: int,
    repeat: int,
    out: str,
    checkpoint: str,
    wait: int = 0,
    lateness: str = "0 seconds",
    identity: Sequence[str] = (),
) -> None:
    """Stream of alerts to `out/sent`, by way of `out/intervals`; see `land_intervals` and `land_sent`.

    Without `identity` a group is only sent again when `repeat` has passed, as in
    `timeseries.notifications`.
    """
    spark = firing.sparkSession
    land_intervals(firing, by, interval, f"{out}/intervals", f"{checkpoint}/intervals", identity, lateness)
    schema = T.StructType([*(firing.schema[n] for n in by), *T.StructType.fromDDL(COUNTED).fields])
    counted = replay_topics(spark, f"{out}/intervals", schema, "parquet")
    land_sent(counted, by, interval, repeat, f"{out}/sent", f"{checkpoint}/sent", wait)


def heartbeat(spark: SparkSession, schema: T.StructType, at: datetime, interval: int, lateness: int) -> DataFrame:
    """A row that closes all intervals up to `at`, for the end of a bounded replay."""
    nothing = {f.name: None for f in schema.fields}
    closing = at + timedelta(seconds=2 * interval + lateness)
    return spark.createDataFrame([tuple({**nothing, "ts": closing}.values())], schema)

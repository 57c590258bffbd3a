"""Metric samples: label selection, evaluation grid, range functions, and joins between series.

Samples are (metric, labels map, ts, value), at most one per series and instant. `on_grid` reduces
them to one row per label set and tick; from there on a series holds at most one row per tick,
however many samples it had. Range functions cut each series into time
chunks, with the rows that reach into the next chunk copied there, so a long series is spread over
many tasks and no window needs rows outside its chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ORIGIN = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


@dataclass(frozen=True)
class Match:
    """A label condition: '=', '!=', '=~' or '!~'; patterns match the whole value."""

    label: str
    op: str
    value: str

    def column(self) -> Column:
        label = F.coalesce(F.col("labels")[self.label], F.lit(""))
        if self.op in ("=", "!="):
            same = label == self.value
        elif self.op in ("=~", "!~"):
            same = label.rlike(f"^(?:{self.value})$")
        else:
            raise ValueError(f"unknown label operator {self.op!r}")
        return ~same if self.op.startswith("!") else same


@dataclass(frozen=True)
class Selector:
    """A metric name and conditions on its labels."""

    metric: str
    matches: tuple[Match, ...] = ()

    def column(self) -> Column:
        found = F.col("metric") == self.metric
        for match in self.matches:
            found = found & match.column()
        return found


def seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of a wall-clock timestamp, free of any session time zone."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def timestamp(secs: Column) -> Column:
    """The inverse of `seconds`."""
    return F.expr(ORIGIN) + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def select(samples: DataFrame, selector: Selector, labels: Sequence[str]) -> DataFrame:
    """The samples of one selector with the wanted labels as columns."""
    return samples.where(selector.column()).select(*[F.col("labels")[n].alias(n) for n in labels], "ts", "value")


def last_values(rows: DataFrame, by: Sequence[str], inputs: Sequence[str]) -> DataFrame:
    """(by, one column per input): the last value of each input, from rows of `by`, `input`, `ts`, `value`.

    Of samples with one time the largest counts, so that a repeated run gives the same. Rows meet
    once, by group; both aggregations run there on hash tables, which hold every time of a group. The
    number of partitions is fixed: samples of a series are so alike that partitions joined up to
    Spark's size of compressed bytes would hold millions of them.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    exact = rows.repartition(parts, *by).groupBy(*by, "ts").agg(
        *[F.max(F.when(F.col("input") == n, F.col("value"))).alias(n) for n in inputs]
    )
    return exact.groupBy(*by).agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("ts"))).alias(n) for n in inputs])


def tick_of(ts: Column, step: int) -> Column:
    """The start of the step in seconds."""
    secs = seconds(ts)
    return secs - F.pmod(secs, F.lit(step))


def on_grid(samples: DataFrame, step: int, labels: Sequence[str], inputs: Mapping[str, Selector]) -> DataFrame:
    """(labels, tick, one column per input): the last value of each step, all inputs in one pass.

    `tick` is the start of the step in seconds. Series with equal labels meet in one row, so
    arithmetic and conditions between them need no join. A null value counts as no sample.
    """
    wanted = samples.where(F.col("metric").isin(sorted({s.metric for s in inputs.values()})) & F.col("value").isNotNull())
    found = F.array_compact(F.array(*[F.when(s.column(), F.lit(n)) for n, s in inputs.items()]))
    names = [F.col("labels")[n].alias(n) for n in labels]
    rows = wanted.select(*names, tick_of(F.col("ts"), step).alias("tick"), "ts", "value", F.explode(found).alias("input"))
    return last_values(rows, [*labels, "tick"], list(inputs))


def _chunks(grid: DataFrame, reach: int, chunk: int | None) -> DataFrame:
    size = max(chunk or 16 * reach, reach)
    start = F.col("tick") - F.pmod(F.col("tick"), F.lit(size))
    reaches = F.col("tick") + reach >= start + size
    return grid.withColumn("_own", start).withColumn(
        "_chunk", F.explode(F.when(reaches, F.array(start, start + size)).otherwise(F.array(start)))
    )


@dataclass(frozen=True)
class Range:
    """A function over the trailing `reach` seconds of an input, the row's own tick included.

    `increase` and `rate`: a value below its predecessor is a counter reset and counts from zero.
    Only steps between two samples inside the range count; nothing is extrapolated to its edges. The
    rate divides by the time between the first and the last sample. `slope`: least squares, per
    second; `forecast`: that line `ahead` seconds later. `min`: the smallest value. All but `min` are
    null with fewer than two samples in the range.
    """

    kind: str
    source: str
    reach: int
    ahead: int = 0


def with_ranges(grid: DataFrame, labels: Sequence[str], outputs: Mapping[str, Range], chunk: int | None = None) -> DataFrame:
    """Adds one column per range, whatever their reaches, over rows that are brought together once."""
    out = _chunks(grid, max(r.reach for r in outputs.values()), chunk)
    order = Window.partitionBy(*labels, "_chunk").orderBy("tick")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    deltas = {}
    for s in sorted({r.source for r in outputs.values() if r.kind in ("rate", "increase")}):
        value, prev = F.col(s), F.last(s, ignorenulls=True).over(before)
        deltas[f"_d_{s}"] = F.when(value >= prev, value - prev).when(value < prev, value)
    columns = {name: _range(r, order.rangeBetween(-r.reach, 0)) for name, r in outputs.items()}
    kept = out.withColumns(deltas).withColumns(columns) if deltas else out.withColumns(columns)
    return kept.where(F.col("_chunk") == F.col("_own")).select(*grid.columns, *outputs)


def _range(r: Range, inside: WindowSpec) -> Column:
    source = F.col(r.source)
    if r.kind == "min":
        return F.min(source).over(inside)
    if r.kind in ("slope", "forecast"):
        x = (F.col("tick") - F.col("_chunk")).cast("double")  # from the chunk's start, to keep the sums small
        slope = F.regr_slope(source, x).over(inside)
        return slope if r.kind == "slope" else F.regr_intercept(source, x).over(inside) + slope * (x + float(r.ahead))
    if r.kind not in ("rate", "increase"):
        raise ValueError(f"unknown range function {r.kind!r}")
    here, delta = source.isNotNull(), F.col(f"_d_{r.source}")
    first = F.first(F.when(here, F.struct(delta.alias("d"), F.col("tick").alias("t"))), True).over(inside)
    grown = F.sum(delta).over(inside) - F.coalesce(first["d"], F.lit(0.0))
    last = F.max(F.when(here, F.col("tick"))).over(inside)
    return F.when(F.count(source).over(inside) > 1, grown / (last - first["t"]) if r.kind == "rate" else grown)


def with_increase(
    grid: DataFrame, labels: Sequence[str], outputs: Mapping[str, tuple[str, str]], reach: int, chunk: int | None = None
) -> DataFrame:
    """Adds, per output name, ('increase' or 'rate', input column) over the trailing `reach` seconds."""
    return with_ranges(grid, labels, {n: Range(kind, source, reach) for n, (kind, source) in outputs.items()}, chunk)


def with_trend(
    grid: DataFrame,
    labels: Sequence[str],
    source: str,
    reach: int,
    slope: str | None = None,
    forecast: tuple[str, int] | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """Adds the least-squares slope per second and/or the value `horizon` seconds ahead, as (name, horizon)."""
    outputs = {slope: Range("slope", source, reach)} if slope else {}
    if forecast:
        outputs[forecast[0]] = Range("forecast", source, reach, forecast[1])
    return with_ranges(grid, labels, outputs, chunk)


def with_min(
    grid: DataFrame, labels: Sequence[str], source: str, reach: int, name: str, chunk: int | None = None
) -> DataFrame:
    """Adds the smallest value of the trailing range."""
    return with_ranges(grid, labels, {name: Range("min", source, reach)}, chunk)


def with_gaps(grid: DataFrame, labels: Sequence[str], step: int, lookback: int, chunk: int | None = None) -> DataFrame:
    """Adds the ticks at which a series has no sample, but has one less than `lookback` seconds before.

    The added rows hold null in every input: range functions see samples where they were taken, and
    `carried` fills in what an instant selector reads there.
    """
    size = -(-max(chunk or 16 * lookback, lookback) // step) * step
    out = _chunks(grid, lookback, size)
    following = F.lead("tick").over(Window.partitionBy(*labels, "_chunk").orderBy("tick"))
    out = out.withColumn("_next", F.coalesce(following, F.col("_chunk") + size))
    end = F.least(F.col("_next") - step, F.col("_chunk") + (size - step), F.col("tick") + (lookback - 1) // step * step)
    start = F.greatest("tick", "_chunk")
    ticks = F.when(end >= start, F.sequence(start, end, F.lit(step).cast("bigint")))
    names = [c for c in grid.columns if c not in (*labels, "tick")]
    out = out.withColumn("_at", F.explode(ticks))
    own = F.col("_at") == F.col("tick")
    return out.select(*labels, F.col("_at").alias("tick"), *[F.when(own, F.col(n)).alias(n) for n in names])


def carried(grid: DataFrame, labels: Sequence[str], inputs: Sequence[str], lookback: int, chunk: int | None = None) -> DataFrame:
    """The inputs of each tick as an instant selector reads them: the last sample less than `lookback` seconds old."""
    out = _chunks(grid, lookback, chunk)
    recent = Window.partitionBy(*labels, "_chunk").orderBy("tick").rangeBetween(1 - lookback, 0)
    filled = out.withColumns({n: F.last(n, ignorenulls=True).over(recent) for n in inputs})
    return filled.where(F.col("_chunk") == F.col("_own")).select(*grid.columns)


def aggregate(grid: DataFrame, by: Sequence[str], **values: Column) -> DataFrame:
    """`sum by (...)`, `avg by (...)`, `count by (...)`: one row per `by` and tick."""
    return grid.groupBy(*by, "tick").agg(*[v.alias(n) for n, v in values.items()])


def without(labels: Sequence[str], dropped: Sequence[str]) -> list[str]:
    return [n for n in labels if n not in dropped]


def enrich(many: DataFrame, info: DataFrame, on: Sequence[str], add: Sequence[str], value: str = "value") -> DataFrame:
    """Multiply `many` by the value of its one info row per `on` and tick, and take over its labels."""
    one = info.select(*on, "tick", *add, F.col(value).alias("_factor"))
    return many.join(one, [*on, "tick"]).withColumn(value, F.col(value) * F.col("_factor")).drop("_factor")


def and_on(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `left` that have a row in `right` with the same labels and tick."""
    return left.join(right.select(*on, "tick").distinct(), [*on, "tick"], "left_semi")


def or_on(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """`left`, and the rows of `right` whose labels and tick are not in `left`."""
    extra = right.join(left.select(*on, "tick").distinct(), [*on, "tick"], "left_anti")
    return left.unionByName(extra.select(*left.columns))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient of metric values: x/0 is infinite, and 0/0 is null since it satisfies no condition."""
    by_zero = F.when(top > 0, float("inf")).when(top < 0, float("-inf"))
    return F.when(bottom == 0, by_zero).otherwise(top / F.when(bottom != 0, bottom))


def divide(left: DataFrame, right: DataFrame, on: Sequence[str], value: str = "value") -> DataFrame:
    """Element-wise ratio of two instant vectors with equal labels."""
    below = right.select(*on, "tick", F.col(value).alias("_below"))
    return left.join(below, [*on, "tick"]).withColumn(value, ratio(F.col(value), F.col("_below"))).drop("_below")


def hold_for(active: DataFrame, labels: Sequence[str], step: int, hold: int | Column, chunk: int = 1024) -> DataFrame:
    """Adds `since`, the start of the unbroken run of ticks, and `state`: pending, or firing from `hold` on.

    `active` has one row per label set and tick at which the condition is true; a missing tick ends
    the run. Runs are found within chunks of `chunk` steps; a chunk whose last run goes on past its end
    adds one row, and only these rows, one per chunk, are scanned along a series. So no task holds
    the history of a series, and rows without labels spread like any other.
    """
    size = chunk * step
    tick, start = F.col("tick"), F.col("_chunk")
    within = Window.partitionBy(*labels, "_chunk")
    runs = active.withColumn("_chunk", tick - F.pmod(tick, F.lit(size)))
    runs = runs.withColumn("_run", tick - F.row_number().over(within.orderBy("tick")) * step)
    # ticks ascend, so the running maximum of run starts is the start of the row's own run
    begins = F.when(F.coalesce(F.col("_run") != F.lag("_run").over(within.orderBy("tick")), F.lit(True)), tick)
    runs = runs.withColumn("since", F.max(begins).over(within.orderBy("tick")))
    passes = tick == start + (size - step)
    both = F.when(passes, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    runs = runs.withColumn("_border", F.explode(both))

    along = Window.partitionBy(*labels, F.when(~F.col("_border"), start)).orderBy("_chunk")
    # a run that fills the chunk and began before has the start that the chunk before passes on
    fills = (F.col("since") == start) & F.coalesce(F.lag("_chunk").over(along) == start - size, F.lit(False))
    runs = runs.withColumn("_start", F.when(F.col("_border") & ~fills, F.col("since")))
    runs = runs.withColumn("_passed", F.when(F.col("_border"), F.last("_start", ignorenulls=True).over(along)))

    into = Window.partitionBy(*labels, F.when(F.col("_border"), start + size).otherwise(start))
    before = F.max("_passed").over(into)
    runs = runs.withColumn("since", F.when(F.col("since") == start, F.coalesce(before, F.col("since"))).otherwise(F.col("since")))
    state = F.when(tick - F.col("since") >= hold, "firing").otherwise("pending")
    return runs.where(~F.col("_border")).withColumn("state", state).select(*active.columns, "since", "state")


def notifications(firing: DataFrame, by: Sequence[str], interval: int, repeat: int, wait: int = 0) -> DataFrame:
    """When a group of alerts is sent: `wait` after an unbroken run starts, then every `repeat` seconds.

    Alerts are grouped by `by` on a grid of `interval` seconds, and counted per group before any
    window runs, so a group holds one row per interval. `repeat` is rounded up to whole intervals.
    """
    groups = firing.groupBy(
        *by, (F.col("tick") - F.pmod(F.col("tick"), F.lit(interval))).alias("tick")
    ).agg(F.count("*").alias("n_alerts"))
    runs = hold_for(groups, by, interval, 0)
    since_start = F.col("tick") - F.col("since")
    due = F.pmod(since_start, F.lit(-(-repeat // interval) * interval)) == 0
    return runs.where(due).select(*by, "since", (F.col("tick") + wait).alias("sent_at"), "n_alerts")



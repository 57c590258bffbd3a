"""Time-series operators over the events, read as samples of one metric."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.functions.text import label_replace
from tallymill.operators import distribution
from tallymill.operators import timeseries as ts
from tallymill.operators.timeseries import Match, Selector
from tallymill.plans import metric_names
from tallymill.session import work_path
from tallymill.sources import topics
from tallymill.streaming import notify
from workload.inputs import table
from workload.registry import query, single, single_sql

HOUR = 3600
SERIES = ["type", "instance", "device"]


def samples(events):
    """Every event is a sample of `event_value` on the series of its type, instance and device."""
    user = F.col("user_id")
    labels = F.create_map(
        F.lit("type"), F.col("event_type"),
        F.lit("instance"), F.concat(F.lit("host-"), (user % 5).cast("string")),
        F.lit("device"), F.concat(F.lit("dev"), (user % 3).cast("string")),
    )
    return events.select(F.lit("event_value").alias("metric"), labels.alias("labels"), "ts", "value")


SAMPLES = """samples AS (SELECT event_type AS "type", 'host-' || cast(user_id % 5 AS varchar) AS instance,
  'dev' || cast(user_id % 3 AS varchar) AS device, ts, "value",
  cast(floor(epoch(ts)) AS bigint) - cast(floor(epoch(ts)) AS bigint) % 3600 AS tick FROM events)"""
GRID = f"""{SAMPLES}, grid AS (SELECT "type", instance, device, tick, arg_max("value", ts) AS v FROM samples
  GROUP BY ALL)"""
KEYS = '"type", instance, device'
SAME = 'g."type" = s."type" AND g.instance = s.instance AND g.device = s.device'


def grid(spark, sf):
    return ts.on_grid(samples(table(spark, sf, "events")), HOUR, SERIES, {"v": Selector("event_value")})


def ranged_sql(reach: int) -> str:
    """Per grid row: samples in the range, growth between neighbours inside it, time spanned."""
    return f"""{GRID}, seq AS (SELECT *, lag(v) OVER w AS prev, lag(tick) OVER w AS prev_tick FROM grid
      WINDOW w AS (PARTITION BY {KEYS} ORDER BY tick)), ranged AS (
    SELECT g."type", g.instance, g.device, g.tick, g.v, count(*) AS n, max(s.tick) - min(s.tick) AS span,
      sum(CASE WHEN s.prev_tick >= g.tick - {reach} THEN CASE WHEN s.v >= s.prev THEN s.v - s.prev ELSE s.v END END)
        AS grown, regr_slope(s.v, s.tick - g.tick) AS slope, regr_intercept(s.v, s.tick - g.tick) AS at_now,
      min(s.v) AS lowest
    FROM grid g JOIN seq s ON {SAME} AND s.tick BETWEEN g.tick - {reach} AND g.tick GROUP BY ALL)"""


@query(
    "ts_increase",
    f"""WITH {ranged_sql(6 * HOUR)} SELECT {KEYS}, tick, CASE WHEN n > 1 THEN {single_sql('grown')} END AS increase
    FROM ranged""",
)
def ts_increase(spark, sf):
    out = ts.with_increase(grid(spark, sf), SERIES, {"increase": ("increase", "v")}, 6 * HOUR)
    return out.select(*SERIES, "tick", single(F.col("increase")).alias("increase"))


@query(
    "ts_rate",
    f"""WITH {ranged_sql(12 * HOUR)} SELECT {KEYS}, tick, CASE WHEN n > 1 THEN {single_sql('grown / span')} END AS rate
    FROM ranged""",
)
def ts_rate(spark, sf):
    out = ts.with_increase(grid(spark, sf), SERIES, {"rate": ("rate", "v")}, 12 * HOUR)
    return out.select(*SERIES, "tick", single(F.col("rate")).alias("rate"))


@query(
    "ts_deriv",
    f"""WITH {ranged_sql(24 * HOUR)} SELECT {KEYS}, tick, CASE WHEN n > 1 THEN {single_sql('slope')} END AS slope
    FROM ranged""",
)
def ts_deriv(spark, sf):
    out = ts.with_trend(grid(spark, sf), SERIES, "v", 24 * HOUR, slope="slope")
    return out.select(*SERIES, "tick", single(F.col("slope")).alias("slope"))


@query(
    "ts_predict_linear",
    f"""WITH {ranged_sql(24 * HOUR)} SELECT {KEYS}, tick,
      CASE WHEN n > 1 THEN {single_sql('at_now + slope * 100000')} END AS forecast FROM ranged""",
)
def ts_predict_linear(spark, sf):
    out = ts.with_trend(grid(spark, sf), SERIES, "v", 24 * HOUR, forecast=("forecast", 100_000))
    return out.select(*SERIES, "tick", single(F.col("forecast")).alias("forecast"))


@query("ts_min_over_time", f"WITH {ranged_sql(12 * HOUR)} SELECT {KEYS}, tick, lowest FROM ranged")
def ts_min_over_time(spark, sf):
    out = ts.with_min(grid(spark, sf), SERIES, "v", 12 * HOUR, "lowest")
    return out.select(*SERIES, "tick", "lowest")


@query(
    "ts_sum_by",
    f'WITH {GRID} SELECT instance, tick, {single_sql('sum(v)')} AS "value" FROM grid GROUP BY instance, tick',
)
def ts_sum_by(spark, sf):
    out = ts.aggregate(grid(spark, sf), ["instance"], value=F.sum("v"))
    return out.withColumn("value", single(F.col("value")))


@query(
    "ts_avg_by",
    f"""WITH {GRID} SELECT "type", device, tick, {single_sql('avg(v)')} AS "value" FROM grid GROUP BY "type", device, tick""",
)
def ts_avg_by(spark, sf):
    out = ts.aggregate(grid(spark, sf), ts.without(SERIES, ["instance"]), value=F.avg("v"))
    return out.withColumn("value", single(F.col("value")))


@query(
    "ts_count_nested",
    f"""WITH {GRID}, inner_sums AS (SELECT "type", tick, sum(v) AS total FROM grid GROUP BY "type", tick)
    SELECT tick, count(*) AS n_types FROM inner_sums GROUP BY tick""",
)
def ts_count_nested(spark, sf):
    sums = ts.aggregate(grid(spark, sf), ["type"], total=F.sum("v"))
    return ts.aggregate(sums, [], n_types=F.count("*"))


@query(
    "ts_quantiles",
    " UNION ALL ".join(
        f"""SELECT event_type AS "type", cast({q} AS double) AS quantile, quantile_disc("value", {q}) AS "value"
        FROM events GROUP BY event_type"""
        for q in (0.5, 0.9, 0.99)
    ),
)
def ts_quantiles(spark, sf):
    flat = ts.select(samples(table(spark, sf, "events")), Selector("event_value"), ["type"])
    return distribution.quantiles(flat, ["type"], F.col("value"), [0.5, 0.9, 0.99], accuracy=100_000)


def _grid_of(spark, sf, kind, labels):
    wanted = Selector("event_value", (Match("type", "=", kind),))
    return ts.on_grid(samples(table(spark, sf, "events")), HOUR, labels, {"value": wanted})


def _grid_sql(name: str, kind: str, labels: str) -> str:
    return f"""{name} AS (SELECT {labels}, tick, arg_max("value", ts) AS "value" FROM samples WHERE "type" = '{kind}'
      GROUP BY {labels}, tick)"""


@query(
    "ts_ratio",
    f"""WITH {SAMPLES}, {_grid_sql("a", "purchase", "instance, device")}, {_grid_sql("b", "click", "instance, device")}
    SELECT instance, device, tick, {single_sql('a."value" / b."value"')} AS "value" FROM a JOIN b USING (instance, device, tick)""",
)
def ts_ratio(spark, sf):
    on = ["instance", "device"]
    out = ts.divide(_grid_of(spark, sf, "purchase", on), _grid_of(spark, sf, "click", on), on)
    return out.withColumn("value", single(F.col("value")))


@query(
    "ts_enrich_labels",
    f"""WITH {SAMPLES}, {_grid_sql("a", "view", "instance, device")}, info AS (SELECT instance,
      'node-' || substr(instance, 6) AS nodename, tick FROM samples WHERE "type" = 'signup' GROUP BY ALL)
    SELECT instance, device, nodename, tick, "value" FROM a JOIN info USING (instance, tick)""",
)
def ts_enrich_labels(spark, sf):
    """Views take the node name of their instance, where it signed up in the same hour."""
    seen = _grid_of(spark, sf, "signup", ["instance"])
    name = F.concat(F.lit("node-"), F.substring("instance", 6, 99))
    info = seen.select("instance", name.alias("nodename"), "tick", F.lit(1.0).alias("value"))
    return ts.enrich(_grid_of(spark, sf, "view", ["instance", "device"]), info, ["instance"], ["nodename"])


@query(
    "ts_and_on",
    f"""WITH {SAMPLES}, {_grid_sql("a", "view", "instance, device")}, {_grid_sql("b", "error", "instance")}
    SELECT * FROM a WHERE "value" > 20 AND EXISTS (SELECT 1 FROM b WHERE b.instance = a.instance AND b.tick = a.tick
      AND b."value" > 30)""",
)
def ts_and_on(spark, sf):
    left = _grid_of(spark, sf, "view", ["instance", "device"]).where(F.col("value") > 20)
    right = _grid_of(spark, sf, "error", ["instance"]).where(F.col("value") > 30)
    return ts.and_on(left, right, ["instance"])


@query(
    "ts_or_on",
    f"""WITH {SAMPLES}, {_grid_sql("a", "view", "instance, device")}, {_grid_sql("b", "error", "instance, device")}
    SELECT * FROM a WHERE "value" > 50 UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a
      WHERE a."value" > 50 AND b.instance = a.instance AND b.device = a.device AND b.tick = a.tick)""",
)
def ts_or_on(spark, sf):
    on = ["instance", "device"]
    left = _grid_of(spark, sf, "view", on).where(F.col("value") > 50)
    return ts.or_on(left, _grid_of(spark, sf, "error", on), on)


HOST_PATTERN = r"https?://([^/]+)/.*"


@query(
    "ts_label_replace",
    f"""SELECT page_id, CASE WHEN regexp_matches(url, '^(?:{HOST_PATTERN})$')
      THEN regexp_replace(url, '^(?:{HOST_PATTERN})$', '\\1') ELSE 'unknown' END AS host FROM pages""",
)
def ts_label_replace(spark, sf):
    host = label_replace(F.lit("unknown"), F.col("url"), HOST_PATTERN, "$1")
    return table(spark, sf, "pages").select("page_id", host.alias("host"))


@query(
    "alert_threshold",
    f"""WITH {SAMPLES} SELECT instance, device, ts, "value" FROM samples WHERE regexp_matches("type", '^(?:view|error)$')
      AND NOT regexp_matches(device, '^(?:dev1.*)$') AND instance <> 'host-3' AND "value" >= 100""",
)
def alert_threshold(spark, sf):
    selector = Selector(
        "event_value",
        (Match("type", "=~", "view|error"), Match("device", "!~", "dev1.*"), Match("instance", "!=", "host-3")),
    )
    rows = ts.select(samples(table(spark, sf, "events")), selector, ["instance", "device"])
    return rows.where(F.col("value") >= 100)


HELD = f"""{GRID}, active AS (SELECT instance, device, tick, max(v) AS "value" FROM grid WHERE v > 20
    GROUP BY instance, device, tick), runs AS (SELECT *, tick - 3600 * row_number() OVER (PARTITION BY instance, device
    ORDER BY tick) AS run FROM active), held AS (SELECT instance, device, tick, "value",
    min(tick) OVER (PARTITION BY instance, device, run) AS since FROM runs)"""


def held(spark, sf):
    """Highest hourly value above 20 per instance and device; fires after two hours in a row."""
    active = grid(spark, sf).where(F.col("v") > 20)
    peaks = ts.aggregate(active, ["instance", "device"], value=F.max("v"))
    return ts.hold_for(peaks, ["instance", "device"], HOUR, 2 * HOUR)


@query(
    "alert_hold_for",
    f"WITH {HELD} SELECT *, CASE WHEN tick - since >= 7200 THEN 'firing' ELSE 'pending' END AS state FROM held",
)
def alert_hold_for(spark, sf):
    return held(spark, sf)


NOTIFIED = f"""{HELD}, groups AS (SELECT device, tick, count(*) AS n_alerts FROM held WHERE tick - since >= 7200
    GROUP BY device, tick), group_runs AS (SELECT *, tick - 3600 * row_number() OVER (PARTITION BY device ORDER BY tick)
    AS run FROM groups), started AS (SELECT *, min(tick) OVER (PARTITION BY device, run) AS since FROM group_runs)"""


@query(
    "alert_repeat_suppress",
    f"""WITH {NOTIFIED} SELECT device, since, tick + 30 AS sent_at, n_alerts FROM started
    WHERE (tick - since) % (3 * 3600) = 0""",
)
def alert_repeat_suppress(spark, sf):
    firing = held(spark, sf).where(F.col("state") == "firing")
    return ts.notifications(firing, ["device"], HOUR, 3 * HOUR, wait=30)


@query(
    "stream_repeat_suppress",
    """WITH groups AS (SELECT event_type, cast(floor(epoch(ts)) AS bigint) - cast(floor(epoch(ts)) AS bigint) % 600 AS tick,
      count(*) AS n_alerts FROM events WHERE "value" > 150 GROUP BY 1, 2), runs AS (SELECT *, tick - 600 * row_number()
      OVER (PARTITION BY event_type ORDER BY tick) AS run FROM groups), started AS (SELECT *, min(tick)
      OVER (PARTITION BY event_type, run) AS since FROM runs)
    SELECT event_type, since, tick + 30 AS sent_at, n_alerts FROM started WHERE (tick - since) % 1800 = 0""",
)
def stream_repeat_suppress(spark, sf):
    """High events as alerts, grouped by type and ten minutes; they arrive in three runs, cut inside intervals.

    At the second cut every other type's last 20 minutes come a run late, within the lateness stated.
    """
    sent = _replayed(spark, sf, table(spark, sf, "events").where(F.col("value") > 150).select("event_type", "ts"))
    return sent.select("event_type", "since", "sent_at", "n_alerts")


def _replayed(spark, sf, high, identity=()):
    """Alerts in three runs of the streams, and a heartbeat that closes what is left open."""
    out = work_path(spark, "notify")
    cuts = [F.lit(f"2024-01-{d}").cast("timestamp_ntz") for d in ("11 00:03:20", "21 12:34:56")]
    ts_col = F.col("ts")
    late = (ts_col >= cuts[1] - F.expr("INTERVAL 20 MINUTES")) & (F.pmod(F.crc32("event_type"), F.lit(2)) == 0)
    second = (ts_col >= cuts[0]) & (ts_col < cuts[1])
    end = notify.heartbeat(spark, high.schema, high.agg(F.max("ts")).first()[0], 600, 1800)
    parts = [high.where(part) for part in (ts_col < cuts[0], second & ~late, (second & late) | (ts_col >= cuts[1]))]
    for part in [*parts, end]:
        part.write.mode("append").parquet(f"{out}/arriving")
        arriving = topics.replay_topics(spark, f"{out}/arriving", high.schema, "parquet")
        notify.land_notifications(arriving, ["event_type"], 600, 1800, out, f"{out}/checkpoint", 30, "30 minutes", identity)
    return spark.read.parquet(f"{out}/sent")


@query(
    "stream_group_changes",
    """WITH groups AS (SELECT event_type, cast(floor(epoch(ts)) AS bigint) - cast(floor(epoch(ts)) AS bigint) % 600 AS tick,
      count(DISTINCT user_id % 2) AS n_alerts, string_agg(DISTINCT user_id % 2, ',' ORDER BY user_id % 2) AS hosts
      FROM events WHERE "value" > 150 GROUP BY 1, 2),
    before AS (SELECT *, lag(tick) OVER w AS prev, lag(hosts) OVER w AS prev_hosts FROM groups
      WINDOW w AS (PARTITION BY event_type ORDER BY tick)),
    marked AS (SELECT *, CASE WHEN prev IS NULL OR prev < tick - 600 THEN 'new' WHEN prev_hosts <> hosts THEN 'changed' END AS kind FROM before),
    anchored AS (SELECT *, max(tick) FILTER (WHERE kind = 'new') OVER w AS since, max(tick) FILTER (WHERE kind IS NOT NULL) OVER w AS anchor
      FROM marked WINDOW w AS (PARTITION BY event_type ORDER BY tick))
    SELECT event_type, since, tick + 30 AS sent_at, n_alerts, coalesce(kind, 'repeat') AS reason FROM anchored
    WHERE (tick - anchor) % 1800 = 0""",
)
def stream_group_changes(spark, sf):
    """The same alerts, each of one of two hosts: a group is sent at once when its set of hosts changes."""
    high = table(spark, sf, "events").where(F.col("value") > 150).select("event_type", (F.col("user_id") % 2).alias("host"), "ts")
    return _replayed(spark, sf, high, ["host"])


# ---- flat metric names

FLAT = """CASE event_type
  WHEN 'signup' THEN 'airflow.dagrun.duration.success.dag_' || cast(user_id % 7 AS string)
  WHEN 'purchase' THEN 'airflow.dag.dag_' || cast(user_id % 7 AS string) || '.task_' || cast(user_id % 3 AS string) || '.duration'
  WHEN 'error' THEN 'airflow.operator_failures_Op' || cast(user_id % 4 AS string)
  WHEN 'view' THEN 'airflow.pool.open_slots.pool_' || cast(user_id % 2 AS string)
  ELSE CASE user_id % 4 WHEN 0 THEN 'airflow.load_' || cast(user_id % 5 AS string) || '_start'
    WHEN 1 THEN 'airflow.ti.finish.dag_' || cast(user_id % 7 AS string) || '.task.failed'
    WHEN 2 THEN 'airflow.scheduler.tasks.running' ELSE 'other.name.nobody.maps' END END"""

_RULES = ", ".join(
    f"({i}, '{m.pattern}', '{m.name}', '{m.metric_type}', '{'|'.join(f'{k}:{g}' for k, g in sorted(m.labels.items()))}')"
    for i, m in enumerate(metric_names.MAPPINGS)
)
_LABEL = " || ',' || ".join
_TEXTS = " ".join(
    "WHEN {} THEN {}".format(
        i,
        _LABEL(f"'{label}=' || regexp_extract(flat, '{m.pattern}', {group})" for label, group in sorted(m.labels.items())),
    )
    for i, m in enumerate(metric_names.MAPPINGS)
)


@query(
    "metric_map",
    f"""WITH rules AS (SELECT * FROM (VALUES {_RULES}) AS t(rule_no, pattern, metric, metric_type, label_groups)),
      flat AS (SELECT {FLAT} AS flat, "value" FROM events),
      names AS (SELECT DISTINCT flat FROM flat),
      first_rule AS (SELECT flat, min(rule_no) AS rule_no FROM names, rules WHERE regexp_matches(flat, pattern) GROUP BY 1),
      mapped AS (SELECT flat, metric, metric_type, CASE rule_no {_TEXTS} END AS label_text
        FROM first_rule JOIN rules USING (rule_no))
    SELECT metric, metric_type, label_text, count(*) AS n_samples, max("value") AS highest
    FROM flat JOIN mapped USING (flat) GROUP BY metric, metric_type, label_text""",
)
def metric_map(spark, sf):
    flat = table(spark, sf, "events").select(F.expr(FLAT).alias("flat"), "value")
    mapped = metric_names.map_metrics(flat, "flat")
    entries = F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return mapped.groupBy("metric", "metric_type", F.concat_ws(",", entries).alias("label_text")).agg(
        F.count("*").alias("n_samples"), F.max("value").alias("highest")
    )

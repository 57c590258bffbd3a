"""Host and workflow alerts over metrics derived from the events.

Each event yields one sample of every host metric. The label and value expressions below are valid
in Spark SQL and in DuckDB alike, so both sides read the same text. The alerts run on a four-hour
grid with their ranges and hold times stretched alike.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.plans import monitoring
from tallymill.plans.monitoring import Alert
from workload.inputs import table
from workload.registry import query, single, single_sql

STEP, STRETCH = 14_400, 960

LABELS = {
    "instance": "'host-' || cast(user_id % 5 AS string)",
    "device": "'dev' || cast(user_id % 3 AS string)",
    "mountpoint": "CASE WHEN user_id % 2 = 0 THEN '/rootfs' ELSE '/data' END",
    "fstype": "CASE WHEN user_id % 7 = 0 THEN 'tmpfs' ELSE 'ext4' END",
    "cpu": "'cpu' || cast(user_id % 2 AS string)",
    "mode": "CASE event_type WHEN 'signup' THEN 'idle' WHEN 'purchase' THEN 'steal' WHEN 'view' THEN 'iowait'"
    " WHEN 'click' THEN 'user' ELSE 'system' END",
    "name": "'unit' || cast(user_id % 4 AS string)",
    "state": "CASE WHEN user_id % 2 = 0 THEN 'failed' ELSE 'inactive' END",
    "nodename": "'node-' || cast(user_id % 5 AS string)",
    "release": "CASE WHEN event_type = 'error' THEN '5.15.1-generic' ELSE '5.4.0-' || event_type END",
    "airflow_id": "'airflow'",
    "dag_id": "'dag_' || cast(user_id % 7 AS string)",
    "task_id": "'task_' || cast(user_id % 3 AS string)",
    "task_name": "'task_' || cast(user_id % 3 AS string)",
    "quantile": "CASE WHEN user_id % 2 = 0 THEN '0.5' ELSE '0.99' END",
}

_HOST, _DISK, _MOUNT = ("instance",), ("instance", "device"), ("instance", "device", "mountpoint")
_DAG, _TASK = ("airflow_id", "dag_id", "quantile"), ("airflow_id", "dag_id", "task_id", "quantile")


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


# metric -> (labels, value)
METRICS = {
    "node_memory_MemAvailable_bytes": (_HOST, "value * 10"),
    "node_memory_MemTotal_bytes": (_HOST, "2000"),
    "node_filesystem_avail_bytes": ((*_MOUNT, "fstype"), "value * 4"),
    "node_filesystem_size_bytes": ((*_MOUNT, "fstype"), "800"),
    "node_filesystem_readonly": ((*_MOUNT, "fstype"), _flag("event_type = 'error'")),
    "node_filesystem_files_free": ((*_MOUNT, "fstype"), "value * 3"),
    "node_filesystem_files": ((*_MOUNT, "fstype"), "600"),
    "node_filesystem_device_error": (_MOUNT, _flag("event_type = 'error'")),
    "node_memory_SwapFree_bytes": (_HOST, "value"),
    "node_memory_SwapTotal_bytes": (_HOST, "200"),
    "node_nf_conntrack_entries": (_HOST, "value"),
    "node_nf_conntrack_entries_limit": (_HOST, "100"),
    "node_systemd_unit_state": (("instance", "name", "state"), _flag("event_type = 'error'")),
    "node_md_state": ((*_DISK, "state"), _flag("event_type = 'view'")),
    "node_md_disks": ((*_DISK, "state"), _flag("event_type IN ('view', 'click')")),
    "node_edac_uncorrectable_errors_total": (_HOST, _flag("value > 100")),
    "node_edac_correctable_errors_total": (_HOST, "floor(value / 60)"),
    "node_vmstat_pgmajfault": (_HOST, "value * 300000"),
    "node_vmstat_oom_kill": (_HOST, "floor(value / 40)"),
    "node_disk_io_time_seconds_total": (_DISK, "value * 150"),
    "node_network_transmit_bytes_total": (_DISK, "value * 10000000000"),
    "node_network_receive_bytes_total": (_DISK, "value * 11000000000"),
    "node_network_speed_bytes": (_DISK, "80000000"),
    "node_disk_written_bytes_total": (_DISK, "value * 5000000000"),
    "node_cpu_seconds_total": (("instance", "cpu", "mode"), "value * 40"),
    "node_context_switches_total": (_HOST, "value * 600000"),
    "node_disk_read_time_seconds_total": (_DISK, "value * 2"),
    "node_disk_reads_completed_total": (_DISK, "abs(value - 60) * 15"),
    "node_disk_write_time_seconds_total": (_DISK, "value * 2"),
    "node_disk_writes_completed_total": (_DISK, "abs(value - 60) * 15"),
    "node_network_receive_errs_total": (_DISK, "value * 0.03"),
    "node_network_receive_packets_total": (_DISK, "abs(value - 60) * 2 + 1"),
    "node_network_transmit_errs_total": (_DISK, "value * 0.02"),
    "node_network_transmit_packets_total": (_DISK, "abs(value - 60) * 2 + 1"),
    "node_timex_offset_seconds": (_HOST, "(value - 50) / 500"),
    "node_timex_sync_status": (_HOST, _flag("event_type <> 'error'")),
    "node_timex_maxerror_seconds": (_HOST, "value"),
    "node_uname_info": (("instance", "nodename", "release"), "1"),
    "af_agg_dagrun_duration_success": (_DAG, "value"),
    "af_agg_dagrun_duration_failed": (_DAG, "CASE WHEN event_type = 'error' THEN value ELSE 0 END"),
    "af_agg_dagrun_dependency_check": (_DAG, "value / 8"),
    "af_agg_dagrun_schedule_delay": (_DAG, "value / 2"),
    "af_agg_dag_task_duration": (_TASK, "value"),
    "airflow_task_failure_count": (("dag_id", "task_name"), "floor(value / 80)"),
    "airflow_executor_queued_tasks": ((), "floor(value)"),
    "airflow_executor_running_tasks": ((), "floor(value / 2)"),
}


def host_samples(spark, sf, metrics, defined=METRICS):
    """Samples of the given metrics: every event, once per metric."""
    each = []
    for metric in metrics:
        labels, value = defined[metric]
        pairs = [x for n in labels for x in (F.lit(n), F.expr(LABELS[n]))]
        label_map = (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")
        each.append(
            F.struct(
                F.lit(metric).alias("metric"),
                label_map.alias("labels"),
                F.expr(value).cast("double").alias("value"),
            )
        )
    events = table(spark, sf, "events")
    return events.select("ts", F.inline(F.array(*each)))


def samples_sql(metrics, defined=METRICS, step=STEP) -> str:
    parts = []
    for metric in metrics:
        labels, value = defined[metric]
        columns = ", ".join(f"{LABELS[n] if n in labels else 'NULL'} AS \"{n}\"" for n in LABELS)
        parts.append(
            f"""SELECT '{metric}' AS metric, ts, cast({value} AS double) AS "value", cast(floor(epoch(ts)) AS bigint)
            - cast(floor(epoch(ts)) AS bigint) % {step} AS tick, {columns} FROM events"""
        )
    return "samples AS (" + " UNION ALL ".join(parts) + ")"


def known_metrics(alerts: list[Alert]) -> list[str]:
    """Metrics the alerts read, as far as anything emits them."""
    names = {s.metric for a in alerts for s in a.inputs.values()}
    if any(a.nodename for a in alerts):
        names.add("node_uname_info")
    return [m for m in METRICS if m in names]


# ---- the same alerts in SQL: value and condition, over the columns of the inputs and ranges

CONDITIONS = {
    "HostOutOfMemory": ("avail / size * 100", '"value" < 10'),
    "HostOutOfDiskSpace": ("avail / size * 100", '"value" < 10 AND readonly = 0'),
    "HostOutOfInodes": ("free / size * 100", '"value" < 10 AND readonly = 0'),
    "HostSwapIsFillingUp": ("(1 - free / size) * 100", '"value" > 80'),
    "HostConntrackLimit": ("entries / size", '"value" > 0.8'),
    "HostFilesystemDeviceError": ("level", '"value" = 1'),
    "HostSystemdServiceCrashed": ("level", '"value" = 1'),
    "HostRaidArrayGotInactive": ("level", '"value" > 0'),
    "HostRaidDiskFailure": ("level", '"value" > 0'),
    "HostEdacUncorrectableErrorsDetected": ("level", '"value" > 0'),
    "HostMemoryUnderMemoryPressure": ("fault_rate", '"value" > 1000'),
    "HostUnusualDiskIo": ("io_rate", '"value" > 0.5'),
    "HostOomKillDetected": ("grown", '"value" > 0'),
    "HostEdacCorrectableErrorsDetected": ("grown", '"value" > 0'),
    "HostUnusualNetworkThroughputOut": ("sum(bytes_rate) / 1024 / 1024", '"value" > 100'),
    "HostUnusualNetworkThroughputIn": ("sum(bytes_rate) / 1024 / 1024", '"value" > 100'),
    "HostHighCpuLoad": ("100 - avg(cpu_rate) * 100", '"value" > 80'),
    "HostCpuStealNoisyNeighbor": ("avg(cpu_rate) * 100", '"value" > 10'),
    "HostCpuHighIowait": ("avg(cpu_rate) * 100", '"value" > 10'),
    "HostUnusualDiskWriteRate": ("sum(bytes_rate) / 1024 / 1024", '"value" > 50'),
    "HostUnusualDiskReadLatency": (
        "busy_rate / nullif(done_rate, 0)",
        '"value" > 0.1 AND done_rate > 0',
    ),
    "HostUnusualDiskWriteLatency": ("busy_rate / nullif(done_rate, 0)", '"value" > 0.1 AND done_rate > 0'),
    "HostNetworkReceiveErrors": ("errs_rate / packets_rate", '"value" > 0.01'),
    "HostNetworkTransmitErrors": ("errs_rate / packets_rate", '"value" > 0.01'),
    "HostNetworkInterfaceSaturated": ("(rx_rate + tx_rate) / speed", '"value" > 0.8'),
    "HostContextSwitching": ("sum(switch_rate) / nullif(count(idle), 0)", '"value" > 1000'),
    "HostClockSkew": (
        '"offset"',
        '("value" > 0.05 AND drift >= 0) OR ("value" < -0.05 AND drift <= 0)',
    ),
    "HostClockNotSynchronising": ("worst", '"value" = 0 AND maxerror >= 16'),
    "HostDiskWillFillIn24Hours": ("avail / size * 100", '"value" < 10 AND later < 0 AND readonly = 0'),
    "HostInodesWillFillIn24Hours": ("free / size * 100", '"value" < 10 AND later < 0 AND readonly = 0'),
    "HostMemoryIsUnderutilized": ("100 - avail_rate / size * 100", '"value" < 20'),
    "AirflowDagFailed": ("sum(took)", '"value" > 0'),
    "AirflowTaskFailure": ("level", '"value" > 0'),
}


def _match_sql(selector) -> str:
    tests = [f"metric = '{selector.metric}'"]
    for m in selector.matches:
        label = f"coalesce(\"{m.label}\", '')"
        if m.op in ("=", "!="):
            tests.append(f"{label} {'=' if m.op == '=' else '<>'} '{m.value}'")
        else:
            tests.append(f"{'NOT ' if m.op == '!~' else ''}regexp_matches({label}, '^(?:{m.value})$')")
    return " AND ".join(tests)


def _quoted(names, prefix="") -> str:
    return ", ".join(f'{prefix}"{n}"' for n in names)


def _same(a: str, b: str, labels) -> str:
    return " AND ".join(f'{a}."{n}" IS NOT DISTINCT FROM {b}."{n}"' for n in labels)


def _ranged(grid: str, series, out: str, source: str, reach: int, result: str) -> str:
    """Rows of `grid` plus `out`: an expression over the samples of `source` in the trailing range."""
    by = _quoted(series)
    return f"""(SELECT g.*, {result} AS "{out}" FROM {grid} g LEFT JOIN (SELECT {by}, tick, "{source}" AS v,
        lag("{source}") OVER w AS prev, lag(tick) OVER w AS prev_tick FROM {grid} WHERE "{source}" IS NOT NULL
        WINDOW w AS (PARTITION BY {by} ORDER BY tick)) s
      ON {_same("g", "s", series)} AND s.tick BETWEEN g.tick - {reach} AND g.tick GROUP BY ALL)"""


def _growth(kind: str, reach: int) -> str:
    grown = f"""sum(CASE WHEN s.prev_tick >= g.tick - {reach} THEN CASE WHEN s.v >= s.prev THEN s.v - s.prev
      ELSE s.v END END)"""
    per = " / (max(s.tick) - min(s.tick))" if kind == "rate" else ""
    return f"CASE WHEN count(s.v) > 1 THEN {grown}{per} END"


def _with_gaps(steps: list[str], number: int, series, step: int, lookback: int) -> str:
    """Every tick that has a sample of the series less than `lookback` seconds before."""
    by, grid = _quoted(series), f"grid_{number}_{len(steps) - 1}"
    return f"""SELECT {_quoted(series, "t.")}, t.tick, {grid}.* EXCLUDE ({by}, tick) FROM (SELECT DISTINCT {by}, tick + i * {step} AS tick
        FROM {grid}, range(0, {-(-lookback // step)}) AS r(i)) t
      LEFT JOIN {grid} ON {_same("t", grid, series)} AND {grid}.tick = t.tick"""


def _carried(steps: list[str], number: int, series, inputs, lookback: int) -> str:
    grid = f"grid_{number}_{len(steps) - 1}"
    last = ", ".join(f'arg_max(s."{n}", s.tick) FILTER (WHERE s."{n}" IS NOT NULL) AS "{n}"' for n in inputs)
    return f"""SELECT g.* EXCLUDE ({_quoted(inputs)}), {last} FROM {grid} g LEFT JOIN {grid} s
      ON {_same("g", "s", series)} AND s.tick BETWEEN g.tick - {lookback} + 1 AND g.tick GROUP BY ALL"""


def alert_sql(alert: Alert, number: int, step: int = STEP, stretch: int = STRETCH, lookback: int = 0) -> str:
    """Common table expressions ending in `rows_<number>`: the rows of one alert."""
    series = list(alert.series or alert.labels)
    inputs = ", ".join(
        f'arg_max("value", ts) FILTER (WHERE {_match_sql(s)}) AS "{n}"' for n, s in alert.inputs.items()
    )
    used = ", ".join(sorted({f"'{s.metric}'" for s in alert.inputs.values()}))
    held = " OR ".join(f'"{n}" IS NOT NULL' for n in alert.inputs)
    steps = [f"""SELECT * FROM (SELECT {_quoted(series)}, tick, {inputs} FROM samples WHERE metric IN ({used})
        GROUP BY {_quoted(series)}, tick) WHERE {held}"""]
    if lookback:
        steps.append(f"({_with_gaps(steps, number, series, step, lookback)})")

    def add(out, source, reach, result):
        steps.append(_ranged(f"grid_{number}_{len(steps) - 1}", series, out, source, reach * stretch, result))

    for out, (kind, source, reach) in alert.ranges.items():
        add(out, source, reach, _growth(kind, reach * stretch))
    if alert.slope:
        out, source, reach = alert.slope
        add(out, source, reach, "CASE WHEN count(s.v) > 1 THEN regr_slope(s.v, s.tick - g.tick) END")
    if alert.lowest:
        out, source, reach = alert.lowest
        add(out, source, reach, "min(s.v)")
    if alert.forecast:
        out, source, reach, ahead = alert.forecast
        line = f"regr_intercept(s.v, s.tick - g.tick) + regr_slope(s.v, s.tick - g.tick) * {ahead * stretch}"
        add(out, source, reach, f"CASE WHEN count(s.v) > 1 THEN {line} END")
    if lookback:
        steps.append(f"({_carried(steps, number, series, list(alert.inputs), lookback)})")
    ctes = [f"grid_{number}_{i} AS ({'' if i == 0 else 'SELECT * FROM '}{s})" for i, s in enumerate(steps)]
    value, when = CONDITIONS[alert.name]
    labels = list(alert.labels)
    grouped = f"GROUP BY {_quoted(labels)}, tick" if alert.combine else ""
    columns = f"{_quoted(labels)}, tick" if alert.combine else "*"
    active = f"""SELECT {_quoted(labels)}, tick, "value" FROM (SELECT {columns}, {value} AS "value"
      FROM grid_{number}_{len(steps) - 1} {grouped}) WHERE {when}"""
    if alert.nodename:
        active = f"""SELECT a.*, nodename FROM ({active}) a JOIN (SELECT DISTINCT instance, nodename, tick FROM samples
          WHERE metric = 'node_uname_info') USING (instance, tick)"""
        labels.append("nodename")
    ctes.append(f"active_{number} AS ({active})")
    ctes.append(_rows_sql(number, alert.name, alert.severity, labels, alert.hold * stretch, step))
    return ", ".join(ctes)


def _rows_sql(number: int, name: str, severity: str, labels: list[str], hold: int, step: int = STEP) -> str:
    by = f"PARTITION BY {_quoted(labels)}" if labels else ""
    runs = f"PARTITION BY {_quoted([*labels, 'run'])}"
    text = " || ',' || ".join(f"""'{n}=' || coalesce("{n}", '')""" for n in labels) or "''"
    return f"""rows_{number} AS (SELECT '{name}' AS alert, '{severity}' AS severity, {text} AS labels,
      TIMESTAMP '1970-01-01' + to_seconds(tick) AS ts, {single_sql('"value"')} AS "value",
      TIMESTAMP '1970-01-01' + to_seconds(since) AS since,
      CASE WHEN tick - since >= {hold} THEN 'firing' ELSE 'pending' END AS state
    FROM (SELECT *, min(tick) OVER ({runs}) AS since FROM (SELECT *, tick - {step} * row_number() OVER ({by}
      ORDER BY tick) AS run FROM active_{number})))"""


def shape_sql(alerts: list[Alert], defined=METRICS) -> str:
    ctes = ", ".join([samples_sql(known_metrics(alerts), defined), *[alert_sql(a, i) for i, a in enumerate(alerts)]])
    return f"WITH {ctes} " + " UNION ALL ".join(f"SELECT * FROM rows_{i}" for i in range(len(alerts)))


def _shape(alerts: list[Alert], defined=METRICS):
    def run(spark, sf):
        samples = host_samples(spark, sf, known_metrics(alerts), defined)
        rows = monitoring.all_alert_rows(samples, alerts, STEP, STRETCH)
        return rows.withColumn("value", single(F.col("value")))

    return run


for _name, _alerts in {
    "alerts_ratios": monitoring.RATIOS,
    "alerts_levels": monitoring.LEVELS,
    "alerts_rates": monitoring.RATES,
    "alerts_grouped_rates": monitoring.GROUPED_RATES,
    "alerts_rate_ratios": monitoring.RATE_RATIOS,
    "alerts_rate_per_count": monitoring.RATE_PER_COUNT,
    "alerts_trends": monitoring.TRENDS,
    "alerts_forecasts": monitoring.FORECASTS,
    "alerts_workflows": monitoring.WORKFLOWS,
}.items():
    query(_name, shape_sql(_alerts))(_shape(_alerts))

# free memory that moves fast enough for its rate to matter
BUSY = {**METRICS, "node_memory_MemAvailable_bytes": (_HOST, "value * 500000")}
query("alerts_long_holds", shape_sql(monitoring.LONG_HOLDS, BUSY))(_shape(monitoring.LONG_HOLDS, BUSY))

# an hourly grid, on which most ticks of a series have no sample; each is good for a while
HOURLY, FINE, LOOKBACK = 3600, 240, 6 * 3600
LOOKED_BACK = [a for a in monitoring.ALERTS if a.name in ("HostSwapIsFillingUp", "HostConntrackLimit", "HostOutOfDiskSpace", "HostHighCpuLoad", "HostClockSkew")]


@query(
    "alerts_lookback",
    "WITH "
    + ", ".join([samples_sql(known_metrics(LOOKED_BACK), METRICS, HOURLY), *[alert_sql(a, i, HOURLY, FINE, LOOKBACK) for i, a in enumerate(LOOKED_BACK)]])
    + " "
    + " UNION ALL ".join(f"SELECT * FROM rows_{i}" for i in range(len(LOOKED_BACK))),
)
def alerts_lookback(spark, sf):
    """Alerts over samples that come at odd times: at a tick without one, the last of six hours counts."""
    samples = host_samples(spark, sf, known_metrics(LOOKED_BACK))
    rows = monitoring.all_alert_rows(samples, LOOKED_BACK, HOURLY, FINE, LOOKBACK)
    return rows.withColumn("value", single(F.col("value")))


KERNELS = f"""{samples_sql(["node_uname_info"])}, active_0 AS (SELECT tick, cast(count(DISTINCT kernel) AS double) AS "value"
  FROM (SELECT tick, regexp_replace(release, '^(?:{monitoring.KERNEL_PATTERN})$', '\\1') AS kernel FROM samples
    GROUP BY ALL) GROUP BY tick HAVING count(DISTINCT kernel) > 1)"""


@query(
    "alerts_label_versions",
    f"WITH {KERNELS}, {_rows_sql(0, *monitoring.KERNEL_ALERT[:2], [], monitoring.KERNEL_ALERT[2] * STRETCH)} SELECT * FROM rows_0",
)
def alerts_label_versions(spark, sf):
    return monitoring.kernel_alert_rows(host_samples(spark, sf, ["node_uname_info"]), STEP, STRETCH)


@query(
    "dash_dag_panels",
    f"""WITH {samples_sql(monitoring.DAG_PANELS)} SELECT metric, dag_id, ts, "value" * 1000 AS "value" FROM samples
    WHERE dag_id = 'dag_3'""",
)
def dash_dag_panels(spark, sf):
    return monitoring.dag_panel(host_samples(spark, sf, monitoring.DAG_PANELS), "dag_3")


@query(
    "dash_task_panel",
    f"""WITH {samples_sql([monitoring.TASK_PANEL])} SELECT dag_id, quantile, tick, {single_sql('sum("value") * 1000')} AS "value"
    FROM (SELECT airflow_id, dag_id, task_id, quantile, tick, arg_max("value", ts) AS "value" FROM samples GROUP BY ALL)
    GROUP BY dag_id, quantile, tick""",
)
def dash_task_panel(spark, sf):
    panel = monitoring.task_panel(host_samples(spark, sf, [monitoring.TASK_PANEL]), STEP)
    return panel.withColumn("value", single(F.col("value")))


@query("dash_executor_panel", f'WITH {samples_sql(monitoring.EXECUTOR_PANELS)} SELECT metric, ts, "value" FROM samples')
def dash_executor_panel(spark, sf):
    return monitoring.executor_panel(host_samples(spark, sf, monitoring.EXECUTOR_PANELS))


@query("dash_dag_ids", f"WITH {samples_sql(monitoring.DAG_PANELS)} SELECT DISTINCT dag_id FROM samples")
def dash_dag_ids(spark, sf):
    return monitoring.dag_ids(host_samples(spark, sf, monitoring.DAG_PANELS))



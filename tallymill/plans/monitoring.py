"""Host and workflow alerts, each a declaration over the time-series operators.

An alert names its inputs (metric selectors), the range functions over them, an optional
aggregation over finer series, the value and the condition. `evaluate_all` runs them in that order,
for any number of alerts in one pass over the samples: the alert is one more key of the grid.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.text import label_replace
from tallymill.operators import timeseries as ts
from tallymill.operators.rows import evaluate_once
from tallymill.operators.timeseries import Match, Selector

MINUTE, HOUR, DAY, WEEK = 60, 3600, 86_400, 604_800
STEP = 15  # seconds between evaluations


@dataclass(frozen=True)
class Alert:
    name: str
    severity: str
    hold: int
    labels: tuple[str, ...]
    inputs: Mapping[str, Selector]
    value: Callable[[], Column]
    when: Callable[[], Column]
    # labels of the input series, where they are finer than the labels of the alert
    series: tuple[str, ...] | None = None
    # output -> ('rate' | 'increase', input, seconds)
    ranges: Mapping[str, tuple[str, str, int]] = field(default_factory=dict)
    # (output, input, seconds)
    slope: tuple[str, str, int] | None = None
    lowest: tuple[str, str, int] | None = None
    # (output, input, seconds, seconds ahead)
    forecast: tuple[str, str, int, int] | None = None
    combine: Mapping[str, Callable[[], Column]] | None = None
    nodename: bool = False


def _m(metric: str, *matches: Match) -> Selector:
    return Selector(metric, matches)


def _c(name: str) -> Column:
    return F.col(name)


def _value_over(limit: float) -> Callable[[], Column]:
    return lambda: _c("value") > limit


def _percent(top: str, bottom: str) -> Callable[[], Column]:
    return lambda: ts.ratio(_c(top), _c(bottom)) * 100


HOST = ("instance",)
DISK = ("instance", "device")
MOUNT = ("instance", "device", "mountpoint")
MIB = 1024 * 1024

_IDLE, _STEAL, _IOWAIT = (Match("mode", "=", m) for m in ("idle", "steal", "iowait"))
_FAILED, _INACTIVE = Match("state", "=", "failed"), Match("state", "=", "inactive")
_ROOTFS = Match("mountpoint", "=", "/rootfs")
_NO_MMC = Match("device", "!~", "mmcblk.+")
_NO_TAP = Match("device", "!~", "tap.*")
_NO_TMPFS = Match("fstype", "!~", "tmpfs")
INFO = Selector("node_uname_info", (Match("nodename", "=~", ".+"),))


def _disk_latency(name: str, time_metric: str, count_metric: str, *matches: Match) -> Alert:
    return Alert(
        name, "warning", 2 * MINUTE, DISK,
        {"busy": _m(time_metric, *matches), "done": _m(count_metric, *matches)},
        value=lambda: ts.ratio(_c("busy_rate"), _c("done_rate")),
        when=lambda: (_c("value") > 0.1) & (_c("done_rate") > 0),
        ranges={"busy_rate": ("rate", "busy", MINUTE), "done_rate": ("rate", "done", MINUTE)},
    )


def _packet_errors(name: str, errors: str, packets: str) -> Alert:
    return Alert(
        name, "warning", 2 * MINUTE, DISK, {"errs": _m(errors), "packets": _m(packets)},
        value=lambda: ts.ratio(_c("errs_rate"), _c("packets_rate")), when=_value_over(0.01),
        ranges={"errs_rate": ("rate", "errs", 2 * MINUTE), "packets_rate": ("rate", "packets", 2 * MINUTE)},
    )


def _host_megabytes(name: str, metric: str, limit: float, hold: int, nodename: bool = False) -> Alert:
    return Alert(
        name, "warning", hold, HOST, {"bytes": _m(metric)}, series=DISK,
        ranges={"bytes_rate": ("rate", "bytes", 2 * MINUTE)},
        combine={"total": lambda: F.sum("bytes_rate")},
        value=lambda: _c("total") / MIB, when=_value_over(limit), nodename=nodename,
    )


def _cpu_share(name: str, mode: Match, reach: int, limit: float, idle: bool = False, nodename: bool = False) -> Alert:
    def percent() -> Column:
        share = _c("share") * 100
        return 100 - share if idle else share

    return Alert(
        name, "warning", 0, HOST, {"cpu_secs": _m("node_cpu_seconds_total", mode)}, series=("instance", "cpu"),
        ranges={"cpu_rate": ("rate", "cpu_secs", reach)}, combine={"share": lambda: F.avg("cpu_rate")},
        value=percent, when=_value_over(limit), nodename=nodename,
    )


def _level(name: str, severity: str, hold: int, labels, selector: Selector, when: Callable[[], Column]) -> Alert:
    return Alert(name, severity, hold, labels, {"level": selector}, value=lambda: _c("level"), when=when)


def _grew(name: str, severity: str, metric: str) -> Alert:
    return Alert(
        name, severity, 0, HOST, {"seen": _m(metric)}, ranges={"grown": ("increase", "seen", MINUTE)},
        value=lambda: _c("grown"), when=_value_over(0),
    )


# Alert names, severities, hold times, metric names, ranges and limits.
RATIOS = [
    Alert(
        "HostOutOfMemory", "critical", 5 * MINUTE, HOST,
        {"avail": _m("node_memory_MemAvailable_bytes"), "size": _m("node_memory_MemTotal_bytes")},
        value=_percent("avail", "size"), when=lambda: _c("value") < 10,
    ),
    Alert(
        "HostOutOfDiskSpace", "critical", 2 * MINUTE, MOUNT,
        {
            "avail": _m("node_filesystem_avail_bytes"),
            "size": _m("node_filesystem_size_bytes"),
            "readonly": _m("node_filesystem_readonly"),
        },
        value=_percent("avail", "size"), when=lambda: (_c("value") < 10) & (_c("readonly") == 0),
    ),
    Alert(
        "HostOutOfInodes", "warning", 2 * MINUTE, MOUNT,
        {
            "free": _m("node_filesystem_files_free", _ROOTFS),
            "size": _m("node_filesystem_files", _ROOTFS),
            "readonly": _m("node_filesystem_readonly", _ROOTFS),
        },
        value=_percent("free", "size"), when=lambda: (_c("value") < 10) & (_c("readonly") == 0),
    ),
    Alert(
        "HostSwapIsFillingUp", "warning", 2 * MINUTE, HOST,
        {"free": _m("node_memory_SwapFree_bytes"), "size": _m("node_memory_SwapTotal_bytes")},
        value=lambda: (1 - ts.ratio(_c("free"), _c("size"))) * 100, when=_value_over(80),
    ),
    Alert(
        "HostConntrackLimit", "warning", 5 * MINUTE, HOST,
        {"entries": _m("node_nf_conntrack_entries"), "size": _m("node_nf_conntrack_entries_limit")},
        value=lambda: ts.ratio(_c("entries"), _c("size")), when=_value_over(0.8),
    ),
]

LEVELS = [
    _level("HostFilesystemDeviceError", "critical", 0, MOUNT, _m("node_filesystem_device_error"),
           lambda: _c("value") == 1),
    _level("HostSystemdServiceCrashed", "warning", 0, ("instance", "name"), _m("node_systemd_unit_state", _FAILED),
           lambda: _c("value") == 1),
    _level("HostRaidArrayGotInactive", "critical", 0, DISK, _m("node_md_state", _INACTIVE), _value_over(0)),
    _level("HostRaidDiskFailure", "warning", 2 * MINUTE, DISK, _m("node_md_disks", _FAILED), _value_over(0)),
    _level("HostEdacUncorrectableErrorsDetected", "warning", 0, HOST, _m("node_edac_uncorrectable_errors_total"),
           _value_over(0)),
]

RATES = [
    Alert(
        "HostMemoryUnderMemoryPressure", "warning", 2 * MINUTE, HOST, {"faults": _m("node_vmstat_pgmajfault")},
        ranges={"fault_rate": ("rate", "faults", MINUTE)}, value=lambda: _c("fault_rate"), when=_value_over(1000),
    ),
    Alert(
        "HostUnusualDiskIo", "warning", 5 * MINUTE, DISK, {"io": _m("node_disk_io_time_seconds_total")},
        ranges={"io_rate": ("rate", "io", MINUTE)}, value=lambda: _c("io_rate"), when=_value_over(0.5), nodename=True,
    ),
    _grew("HostOomKillDetected", "warning", "node_vmstat_oom_kill"),
    _grew("HostEdacCorrectableErrorsDetected", "info", "node_edac_correctable_errors_total"),
]

GROUPED_RATES = [
    _host_megabytes("HostUnusualNetworkThroughputOut", "node_network_transmit_bytes_total", 100, 5 * MINUTE, True),
    _host_megabytes("HostUnusualNetworkThroughputIn", "node_network_receive_bytes_total", 100, 5 * MINUTE),
    _cpu_share("HostHighCpuLoad", _IDLE, 2 * MINUTE, 80, idle=True),
    _cpu_share("HostCpuStealNoisyNeighbor", _STEAL, 5 * MINUTE, 10),
    _cpu_share("HostCpuHighIowait", _IOWAIT, 5 * MINUTE, 10, nodename=True),
    _host_megabytes("HostUnusualDiskWriteRate", "node_disk_written_bytes_total", 50, 2 * MINUTE),
]

RATE_RATIOS = [
    _disk_latency("HostUnusualDiskReadLatency", "node_disk_read_time_seconds_total", "node_disk_reads_completed_total"),
    # the published rule names the metric with a stray letter at its end and could never fire
    _disk_latency(
        "HostUnusualDiskWriteLatency", "node_disk_write_time_seconds_total", "node_disk_writes_completed_total",
        _NO_MMC,
    ),
    _packet_errors("HostNetworkReceiveErrors", "node_network_receive_errs_total", "node_network_receive_packets_total"),
    _packet_errors(
        "HostNetworkTransmitErrors", "node_network_transmit_errs_total", "node_network_transmit_packets_total"
    ),
    Alert(
        "HostNetworkInterfaceSaturated", "warning", MINUTE, DISK,
        {
            "rx": _m("node_network_receive_bytes_total", _NO_TAP),
            "tx": _m("node_network_transmit_bytes_total", _NO_TAP),
            "speed": _m("node_network_speed_bytes", _NO_TAP),
        },
        ranges={"rx_rate": ("rate", "rx", MINUTE), "tx_rate": ("rate", "tx", MINUTE)},
        value=lambda: ts.ratio(_c("rx_rate") + _c("tx_rate"), _c("speed")), when=_value_over(0.8),
    ),
]

RATE_PER_COUNT = [
    Alert(
        "HostContextSwitching", "warning", 0, HOST,
        {"switches": _m("node_context_switches_total"), "idle": _m("node_cpu_seconds_total", _IDLE)},
        # switches have no cpu label, so they form the series whose cpu is null
        series=("instance", "cpu"), ranges={"switch_rate": ("rate", "switches", 5 * MINUTE)},
        combine={"per_host": lambda: F.sum("switch_rate"), "cpus": lambda: F.count("idle")},
        value=lambda: ts.ratio(_c("per_host"), F.nullif(_c("cpus"), F.lit(0))), when=_value_over(1000),
    ),
]

TRENDS = [
    Alert(
        "HostClockSkew", "warning", 2 * MINUTE, HOST, {"offset": _m("node_timex_offset_seconds")},
        slope=("drift", "offset", 5 * MINUTE), value=lambda: _c("offset"),
        when=lambda: ((_c("value") > 0.05) & (_c("drift") >= 0)) | ((_c("value") < -0.05) & (_c("drift") <= 0)),
    ),
    Alert(
        "HostClockNotSynchronising", "warning", 2 * MINUTE, HOST,
        {"sync": _m("node_timex_sync_status"), "maxerror": _m("node_timex_maxerror_seconds")},
        lowest=("worst", "sync", MINUTE), value=lambda: _c("worst"),
        when=lambda: (_c("value") == 0) & (_c("maxerror") >= 16),
    ),
]

FORECASTS = [
    Alert(
        "HostDiskWillFillIn24Hours", "warning", 2 * MINUTE, MOUNT,
        {
            "avail": _m("node_filesystem_avail_bytes"),
            "size": _m("node_filesystem_size_bytes"),
            "readonly": _m("node_filesystem_readonly"),
            "kept": _m("node_filesystem_avail_bytes", _NO_TMPFS),
        },
        forecast=("later", "kept", HOUR, 24 * HOUR), value=_percent("avail", "size"),
        when=lambda: (_c("value") < 10) & (_c("later") < 0) & (_c("readonly") == 0),
    ),
    Alert(
        "HostInodesWillFillIn24Hours", "warning", 2 * MINUTE, MOUNT,
        {
            "free": _m("node_filesystem_files_free", _ROOTFS),
            "size": _m("node_filesystem_files", _ROOTFS),
            "readonly": _m("node_filesystem_readonly", _ROOTFS),
        },
        forecast=("later", "free", HOUR, 24 * HOUR), value=_percent("free", "size"),
        when=lambda: (_c("value") < 10) & (_c("later") < 0) & (_c("readonly") == 0),
    ),
]

LONG_HOLDS = [
    Alert(
        "HostMemoryIsUnderutilized", "info", WEEK, HOST,
        {"avail": _m("node_memory_MemAvailable_bytes"), "size": _m("node_memory_MemTotal_bytes")},
        ranges={"avail_rate": ("rate", "avail", 30 * MINUTE)},
        value=lambda: 100 - ts.ratio(_c("avail_rate"), _c("size")) * 100, when=lambda: _c("value") < 20,
        nodename=True,
    ),
]

WORKFLOWS = [
    Alert(
        "AirflowDagFailed", "critical", MINUTE, ("dag_id",), {"took": _m("af_agg_dagrun_duration_failed")},
        series=("airflow_id", "dag_id", "quantile"), combine={"total": lambda: F.sum("took")},
        value=lambda: _c("total"), when=_value_over(0),
    ),
    _level("AirflowTaskFailure", "critical", 5 * MINUTE, ("dag_id", "task_name"), _m("airflow_task_failure_count"),
           _value_over(0)),
]

# Which kernel releases run anywhere: no labels left, so it is built on its own below.
KERNEL_ALERT = ("HostKernelVersionDeviations", "warning", 6 * HOUR)
KERNEL_PATTERN = r"([0-9]+.[0-9]+.[0-9]+).*"

ALERTS = [
    *RATIOS, *LEVELS, *RATES, *GROUPED_RATES, *RATE_RATIOS, *RATE_PER_COUNT, *TRENDS, *FORECASTS, *LONG_HOLDS,
    *WORKFLOWS,
]


_INFO = "node info"  # stands in `alert` for the rows that name hosts


def _no_text() -> Column:
    return F.lit(None).cast("string")


def _by_alert(branches: Mapping[str, Column], otherwise: Column | None = None) -> Column:
    """The expression of the row's own alert."""
    chosen = F
    for name, column in branches.items():
        chosen = chosen.when(F.col("alert") == name, column)
    return chosen if otherwise is None else chosen.otherwise(otherwise)


def _ranges_of(alert: Alert, stretch: int) -> dict[str, ts.Range]:
    found = {n: ts.Range(kind, source, reach * stretch) for n, (kind, source, reach) in alert.ranges.items()}
    if alert.slope:
        found[alert.slope[0]] = ts.Range("slope", alert.slope[1], alert.slope[2] * stretch)
    if alert.lowest:
        found[alert.lowest[0]] = ts.Range("min", alert.lowest[1], alert.lowest[2] * stretch)
    if alert.forecast:
        name, source, reach, ahead = alert.forecast
        found[name] = ts.Range("forecast", source, reach * stretch, ahead * stretch)
    return found


def evaluate_all(
    samples: DataFrame, alerts: Sequence[Alert], step: int = STEP, stretch: int = 1, lookback: int = 0
) -> DataFrame:
    """(alert, k1, k2, ..., nodename, tick, value) wherever the condition of one of the alerts is true.

    One scan serves all alerts: each sample goes to the inputs that select it, and the alert is one
    more key of the grid, of the range functions and of the aggregations. `k1`, `k2`, ... are the
    alert's labels in order, null beyond. `step` is the evaluation interval. `stretch` multiplies
    the ranges (not the rates), for metrics that are sampled less often than the alert was written
    for. With `lookback`, an instant selector reads the last sample less than so many seconds old
    at a tick without one, as long as the scrapes are late, and not only at the sample's own tick.
    """
    hosts = any(a.nodename for a in alerts)
    series = {a.name: tuple(a.series or a.labels) for a in alerts} | ({_INFO: ("instance", "nodename")} if hosts else {})
    picks = [(a.name, n, s) for a in alerts for n, s in a.inputs.items()] + ([(_INFO, "info", INFO)] if hosts else [])
    inputs = list(dict.fromkeys(n for _, n, _ in picks))
    keys = [f"k{i + 1}" for i in range(max(map(len, series.values())))]

    def pick(name: str, n: str, selector: Selector) -> Column:
        labels = [F.col("labels")[x] for x in series[name]] + [_no_text()] * (len(keys) - len(series[name]))
        fields = {"alert": F.lit(name), "input": F.lit(n), **dict(zip(keys, labels))}
        return F.when(selector.column(), F.struct(*[c.alias(k) for k, c in fields.items()]))

    wanted = samples.where(F.col("metric").isin(sorted({s.metric for _, _, s in picks})) & F.col("value").isNotNull())
    rows = wanted.select(ts.tick_of(F.col("ts"), step).alias("tick"), "ts", "value", F.inline(F.array_compact(F.array(*[pick(*p) for p in picks]))))
    by = ["alert", *keys]
    grid = ts.last_values(rows, [*by, "tick"], inputs)
    if lookback:
        grid = ts.with_gaps(grid, by, step, lookback)

    ranges = {a.name: _ranges_of(a, stretch) for a in alerts}
    specs = list(dict.fromkeys(r for own in ranges.values() for r in own.values()))
    if specs:
        grid = ts.with_ranges(grid, by, {f"_range_{i}": r for i, r in enumerate(specs)})
        outputs = dict.fromkeys(n for own in ranges.values() for n in own)
        grid = grid.withColumns(
            {n: _by_alert({a: F.col(f"_range_{specs.index(own[n])}") for a, own in ranges.items() if n in own}) for n in outputs}
        ).drop(*[f"_range_{i}" for i in range(len(specs))])
    if lookback:
        grid = ts.carried(grid, by, inputs, lookback)
    if any(a.combine for a in alerts):
        grid = _combined(grid, alerts, series, keys, ranges)

    # the conditions read the value, and the value the ranges: none is to be copied into every mention
    found = evaluate_once(grid, "value", _by_alert({a.name: a.value() for a in alerts}, F.col("info") if hosts else None))
    found = found.where(_by_alert({a.name: a.when() for a in alerts}, F.lit(hosts)))
    if hosts:
        beside = Window.partitionBy("k1", "tick")
        named = F.collect_list(F.when(F.col("alert") == _INFO, F.struct(F.col("k2").alias("nodename"), F.col("value").alias("factor")))).over(beside)
        nobody = F.array(F.struct(_no_text().alias("nodename"), F.lit(1.0).alias("factor")))
        needs = F.col("alert").isin([a.name for a in alerts if a.nodename])
        found = found.withColumn("_named", F.when(~needs, nobody).when(F.col("k1").isNotNull(), named)).where(F.col("alert") != _INFO)
        found = found.withColumn("_named", F.explode("_named")).withColumn("value", F.col("value") * F.col("_named.factor"))
    return found.select("alert", *keys, (F.col("_named.nodename") if hosts else _no_text()).alias("nodename"), "tick", "value")


def _combined(grid: DataFrame, alerts: Sequence[Alert], series: Mapping[str, tuple[str, ...]], keys: Sequence[str], ranges: Mapping[str, Mapping[str, ts.Range]]) -> DataFrame:
    """Series summed up to the labels of their alert; rows of alerts that combine nothing stay as they are."""
    places = {a.name: [series[a.name].index(x) if x in series[a.name] else None for x in a.labels] for a in alerts if a.combine}
    regrouped = {}
    for i, key in enumerate(keys):
        own = {name: F.col(keys[at[i]]) if i < len(at) and at[i] is not None else _no_text() for name, at in places.items()}
        regrouped[key] = _by_alert(own, F.col(key))
    outputs: dict[str, dict[str, Column]] = {}
    for a in alerts:
        combine = a.combine or {n: (lambda n=n: F.max(n)) for n in (*a.inputs, *ranges[a.name])}
        for n, make in combine.items():
            outputs.setdefault(n, {})[a.name] = make()
    if _INFO in series:
        outputs.setdefault("info", {})[_INFO] = F.max("info")
    return grid.withColumns(regrouped).groupBy("alert", *keys, "tick").agg(*[_by_alert(own).alias(n) for n, own in outputs.items()])


def evaluate(samples: DataFrame, alert: Alert, step: int = STEP, stretch: int = 1, lookback: int = 0) -> DataFrame:
    """(labels, tick, value) wherever the condition of the alert is true; see `evaluate_all`."""
    found = evaluate_all(samples, [alert], step, stretch, lookback)
    labels = [F.col(f"k{i + 1}").alias(n) for i, n in enumerate(alert.labels)]
    return found.select(*labels, *(["nodename"] if alert.nodename else []), "tick", "value")


def kernel_deviations(samples: DataFrame, step: int = STEP) -> DataFrame:
    """(tick, value) wherever more than one kernel release is running."""
    grid = ts.on_grid(samples, step, ["instance", "release"], {"value": Selector("node_uname_info")})
    kernel = label_replace(F.lit(""), F.col("release"), KERNEL_PATTERN, "$1")
    per_kernel = ts.aggregate(grid.withColumn("kernel", kernel), ["kernel"], value=F.sum("value"))
    return ts.aggregate(per_kernel, [], value=F.count("*").cast("double")).where(F.col("value") > 1)


def _rows(active: DataFrame, by: list[str], step: int, severity: Column, text: Column, hold: int | Column) -> DataFrame:
    held = ts.hold_for(active, by, step, hold)
    return held.select(
        "alert",
        severity.alias("severity"),
        text.alias("labels"),
        ts.timestamp(F.col("tick")).alias("ts"),
        "value",
        ts.timestamp(F.col("since")).alias("since"),
        "state",
    )


def _text(labels: Mapping[str, str]) -> Column:
    return F.concat_ws(",", *[F.concat(F.lit(f"{n}="), F.coalesce(F.col(c), F.lit(""))) for n, c in labels.items()])


def all_alert_rows(
    samples: DataFrame, alerts: Sequence[Alert], step: int = STEP, stretch: int = 1, lookback: int = 0
) -> DataFrame:
    """(alert, severity, labels, ts, value, since, state) with state pending or firing, in one pass."""
    active = evaluate_all(samples, alerts, step, stretch, lookback)
    keys = [c for c in active.columns if c not in ("tick", "value")]
    texts = {
        a.name: _text({n: f"k{i + 1}" for i, n in enumerate(a.labels)} | ({"nodename": "nodename"} if a.nodename else {}))
        for a in alerts
    }
    severity = _by_alert({a.name: F.lit(a.severity) for a in alerts})
    hold = _by_alert({a.name: F.lit(a.hold * stretch) for a in alerts})
    return _rows(active, keys, step, severity, _by_alert(texts), hold)


def alert_rows(samples: DataFrame, alert: Alert, step: int = STEP, stretch: int = 1, lookback: int = 0) -> DataFrame:
    return all_alert_rows(samples, [alert], step, stretch, lookback)


def kernel_alert_rows(samples: DataFrame, step: int = STEP, stretch: int = 1) -> DataFrame:
    name, severity, hold = KERNEL_ALERT
    active = kernel_deviations(samples, step).withColumn("alert", F.lit(name))
    return _rows(active, [], step, F.lit(severity), F.lit(""), hold * stretch)


# Dashboard panels of one workflow, in milliseconds, and of the executor.
DAG_PANELS = [
    "af_agg_dagrun_duration_success",
    "af_agg_dagrun_duration_failed",
    "af_agg_dagrun_dependency_check",
    "af_agg_dagrun_schedule_delay",
]
TASK_PANEL = "af_agg_dag_task_duration"
EXECUTOR_PANELS = ["airflow_executor_queued_tasks", "airflow_executor_running_tasks"]


def dag_panel(samples: DataFrame, dag_id: str | None = None) -> DataFrame:
    """Run durations and delays in milliseconds, of one workflow or of all."""
    rows = samples.where(F.col("metric").isin(DAG_PANELS))
    dag = F.col("labels")["dag_id"]
    rows = rows if dag_id is None else rows.where(dag == dag_id)
    return rows.select("metric", dag.alias("dag_id"), "ts", (F.col("value") * 1000).alias("value"))


def task_panel(samples: DataFrame, step: int = STEP) -> DataFrame:
    """Task durations in milliseconds, summed by workflow and quantile per tick."""
    labels = ["airflow_id", "dag_id", "task_id", "quantile"]
    grid = ts.on_grid(samples, step, labels, {"value": Selector(TASK_PANEL)})
    return ts.aggregate(grid, ["dag_id", "quantile"], value=F.sum("value") * 1000)


def executor_panel(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("metric").isin(EXECUTOR_PANELS)).select("metric", "ts", "value")


def dag_ids(samples: DataFrame) -> DataFrame:
    """The values a dashboard offers for its workflow filter."""
    return samples.select(F.col("labels")["dag_id"].alias("dag_id")).where("dag_id IS NOT NULL").distinct()

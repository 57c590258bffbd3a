import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.operators import timeseries as ts
from tallymill.operators.timeseries import Match, Selector
from tallymill.plans import metric_names, monitoring

BASE = 1704067200  # 2024-01-01


def samples(spark, data):
    """data: (metric, labels, second, value)."""
    rows = [(m, labels, s, float(v)) for m, labels, s, v in data]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, s long, value double")
    return df.select("metric", "labels", ts.timestamp(F.col("s") + BASE).alias("ts"), "value")


def test_seconds_and_timestamp_are_inverse(spark):
    df = spark.createDataFrame([(0,), (BASE + 86399,), (-5,)], "s long")
    assert [r[0] for r in df.select(ts.seconds(ts.timestamp(F.col("s")))).collect()] == [0, BASE + 86399, -5]


@pytest.mark.parametrize(
    "match, kept",
    [
        (Match("m", "=", "a"), ["a"]),
        (Match("m", "!=", "a"), ["ab", None]),
        (Match("m", "=~", "a"), ["a"]),
        (Match("m", "=~", "a.*"), ["a", "ab"]),
        (Match("m", "!~", "a.+"), ["a", None]),
        (Match("m", "=", ""), [None]),
    ],
)
def test_label_conditions_match_whole_values(spark, match, kept):
    data = [("x", {"m": v} if v else {}, i, i) for i, v in enumerate(["a", "ab", None])]
    found = ts.select(samples(spark, data), Selector("x", (match,)), ["m"]).orderBy("ts")
    assert [r["m"] for r in found.collect()] == kept


def test_grid_takes_the_last_value_of_each_step(spark, rows):
    data = [("a", {"i": "1"}, 0, 1), ("a", {"i": "1"}, 14, 2), ("a", {"i": "1"}, 15, 3), ("b", {"i": "1"}, 3, 9), ("c", {}, 0, 0)]
    grid = ts.on_grid(samples(spark, data), 15, ["i"], {"x": Selector("a"), "y": Selector("b")})
    assert rows(grid) == [("1", BASE, 2.0, 9.0), ("1", BASE + 15, 3.0, None)]


def random_grid(spark, seed=3):
    rng = random.Random(seed)
    data, value = [], 0.0
    for label in "ab":
        for tick in range(0, 900, 15):
            if rng.random() < 0.7:
                value = round(rng.random(), 2) if rng.random() < 0.1 else value + rng.randint(0, 5)
                data.append((label, tick, value if rng.random() < 0.9 else None))
    return data, spark.createDataFrame(data, "i string, tick long, v double")


def brute_growth(data, label, tick, reach):
    inside = [(t, v) for i, t, v in data if i == label and tick - reach <= t <= tick and v is not None]
    if len(inside) < 2:
        return None
    grown = sum((b - a if b >= a else b) for (_, a), (_, b) in zip(inside, inside[1:]))
    return grown, inside[-1][0] - inside[0][0], inside


@pytest.mark.parametrize("reach, chunk", [(60, None), (60, 60), (120, 300), (300, 10_000)])
def test_range_functions_against_brute_force(spark, reach, chunk):
    data, grid = random_grid(spark)
    both = {"up": ("increase", "v"), "per_s": ("rate", "v")}
    out = ts.with_increase(grid, ["i"], both, reach, chunk)
    out = ts.with_trend(out, ["i"], "v", reach, slope="slope", forecast=("later", 600), chunk=chunk)
    out = ts.with_min(out, ["i"], "v", reach, "low", chunk).collect()
    assert len(out) == len(data)
    for r in out:
        expected = brute_growth(data, r["i"], r["tick"], reach)
        if expected is None:
            assert r["up"] is None and r["per_s"] is None and r["slope"] is None and r["later"] is None
            continue
        grown, span, inside = expected
        assert r["up"] == pytest.approx(grown, abs=1e-9)
        assert r["per_s"] == pytest.approx(grown / span, abs=1e-9)
        assert r["low"] == min(v for _, v in inside)
        slope, at_zero = np.polyfit([t - r["tick"] for t, _ in inside], [v for _, v in inside], 1)
        assert r["slope"] == pytest.approx(slope, abs=1e-7)
        assert r["later"] == pytest.approx(at_zero + slope * 600, abs=1e-4)


def test_ratio_by_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    values = [r[0] for r in df.select(ts.ratio(F.col("a"), F.col("b"))).collect()]
    assert values == [0.5, float("inf"), float("-inf"), None, None]


def vector(spark, data):
    return spark.createDataFrame(data, "i string, d string, tick long, value double")


def test_joins_between_series(spark, rows):
    left = vector(spark, [("h1", "a", 0, 2.0), ("h1", "b", 0, 3.0), ("h2", "a", 0, 4.0), ("h1", "a", 15, 5.0)])
    right = vector(spark, [("h1", "a", 0, 4.0), ("h3", "a", 0, 1.0)])
    assert rows(ts.divide(left, right, ["i", "d"])) == [("h1", "a", 0, 0.5)]
    assert rows(ts.and_on(left, right, ["i"]), "i", "d") == [("h1", "a"), ("h1", "b")]
    assert rows(ts.or_on(right, left, ["i"]), "i", "tick") == [("h1", 0), ("h1", 15), ("h2", 0), ("h3", 0)]
    info = spark.createDataFrame([("h1", "node-1", 0, 1.0)], "i string, nodename string, tick long, value double")
    assert rows(ts.enrich(left, info, ["i"], ["nodename"]), "d", "value", "nodename") == [
        ("a", 2.0, "node-1"), ("b", 3.0, "node-1")
    ]


def test_hold_and_notifications(spark, rows):
    ticks = [0, 15, 30, 60, 75, 90, 105, 120, 135]
    active = spark.createDataFrame([("a", t, 1.0) for t in ticks], "i string, tick long, value double")
    held = ts.hold_for(active, ["i"], 15, 30)
    assert rows(held.where("state = 'firing'"), "tick", "since") == sorted(
        [(30, 0), (90, 60), (105, 60), (120, 60), (135, 60)], key=repr
    )
    assert held.where("state = 'firing'").count() == ts.hold_for(active, ["i"], 15, 20).where("state = 'firing'").count()
    sent = ts.notifications(active, ["i"], 15, 40, wait=30)
    assert rows(sent, "since", "sent_at") == sorted([(0, 30), (60, 90), (60, 135)], key=repr)


def test_names_map_in_order(spark, rows):
    flat = spark.createDataFrame(
        [
            ("af.dag.d1.t1.duration", 1.0),
            ("af.load_users_start", 2.0),
            ("af.operator_failures_Bash", 3.0),
            ("af.ti.finish.d1.t1.failed", 4.0),
            ("af.dagrun.dependency-check.d1", 5.0),
            ("af.dagrun.dependency-check.d1.extra", 6.0),
            ("nothing", 7.0),
        ],
        "flat string, value double",
    )
    mapped = metric_names.map_metrics(flat, "flat")
    got = {r["metric"]: (r["metric_type"], r["labels"], r["value"]) for r in mapped.collect()}
    assert got == {
        "af_agg_dag_task_duration": ("observer", {"airflow_id": "af", "dag_id": "d1", "task_id": "t1"}, 1.0),
        "af_agg_job_start": ("counter", {"airflow_id": "af", "job_name": "load_users"}, 2.0),
        "af_agg_operator_failures": ("counter", {"airflow_id": "af", "operator_name": "Bash"}, 3.0),
        "af_agg_ti_finish": ("counter", {"airflow_id": "af", "dag_id": "d1", "task_id": "t1", "state": "failed"}, 4.0),
        "af_agg_dagrun_dependency_check": ("observer", {"airflow_id": "af", "dag_id": "d1"}, 5.0),
    }
    assert len(metric_names.MAPPINGS) == 46


def alert(name):
    return next(a for a in monitoring.ALERTS if a.name == name)


def fired(spark, name, data):
    return [(r["labels"], r["state"]) for r in monitoring.alert_rows(samples(spark, data), alert(name)).orderBy("ts").collect()]


def test_memory_alert_waits_five_minutes(spark):
    data = []
    for t in range(0, 331, 15):
        data += [("node_memory_MemAvailable_bytes", {"instance": "h"}, t, 5), ("node_memory_MemTotal_bytes", {"instance": "h"}, t, 100)]
    states = fired(spark, "HostOutOfMemory", data)
    assert states[0] == ("instance=h", "pending")
    assert [s for _, s in states].index("firing") == 20
    assert len(states) == 23


def test_readonly_disks_do_not_alert(spark):
    labels = {"instance": "h", "device": "d", "mountpoint": "/"}
    data = [("node_filesystem_avail_bytes", labels, 0, 5), ("node_filesystem_size_bytes", labels, 0, 100)]
    assert fired(spark, "HostOutOfDiskSpace", data) == []
    assert len(fired(spark, "HostOutOfDiskSpace", [*data, ("node_filesystem_readonly", labels, 0, 0)])) == 1
    assert fired(spark, "HostOutOfDiskSpace", [*data, ("node_filesystem_readonly", labels, 0, 1)]) == []


def test_full_conntrack_table_of_size_zero_alerts(spark):
    data = [("node_nf_conntrack_entries", {"instance": "h"}, 0, 5), ("node_nf_conntrack_entries_limit", {"instance": "h"}, 0, 0)]
    assert fired(spark, "HostConntrackLimit", data) == [("instance=h", "pending")]


def test_rate_alert_with_node_name(spark):
    labels = {"instance": "h", "device": "sda"}
    data = [("node_disk_io_time_seconds_total", labels, t, t * 0.9) for t in range(0, 61, 15)]
    info = [("node_uname_info", {"instance": "h", "nodename": "n1", "release": "5.4.0-x"}, t, 1) for t in range(0, 61, 15)]
    assert fired(spark, "HostUnusualDiskIo", data) == []
    assert fired(spark, "HostUnusualDiskIo", data + info)[-1] == ("instance=h,device=sda,nodename=n1", "pending")


def test_context_switches_per_cpu(spark):
    data = [("node_cpu_seconds_total", {"instance": "h", "cpu": c, "mode": "idle"}, t, t) for c in "01" for t in range(0, 61, 15)]
    slow = [("node_context_switches_total", {"instance": "h"}, t, t * 1500) for t in range(0, 61, 15)]
    fast = [("node_context_switches_total", {"instance": "h"}, t, t * 2500) for t in range(0, 61, 15)]
    assert fired(spark, "HostContextSwitching", data + slow) == []
    assert len(fired(spark, "HostContextSwitching", data + fast)) == 4


def test_clock_skew_needs_a_growing_offset(spark):
    grow = [("node_timex_offset_seconds", {"instance": "h"}, t, 0.06 + t / 1e4) for t in range(0, 61, 15)]
    shrink = [("node_timex_offset_seconds", {"instance": "h"}, t, 0.09 - t / 1e4) for t in range(0, 61, 15)]
    assert len(fired(spark, "HostClockSkew", grow)) == 4
    assert fired(spark, "HostClockSkew", shrink) == []


def test_disk_that_fills_up(spark):
    labels = {"instance": "h", "device": "d", "mountpoint": "/", "fstype": "ext4"}
    data = []
    for t in range(0, 601, 15):
        data += [
            ("node_filesystem_avail_bytes", labels, t, 9 - t / 1000), ("node_filesystem_size_bytes", labels, t, 100),
            ("node_filesystem_readonly", labels, t, 0),
        ]
    assert fired(spark, "HostDiskWillFillIn24Hours", data)[-1][1] == "firing"
    tmpfs = [(m, {**lb, "fstype": "tmpfs"}, t, v) for m, lb, t, v in data]
    assert fired(spark, "HostDiskWillFillIn24Hours", tmpfs) == []


def test_slow_disk_writes_alert(spark):
    labels = {"instance": "h", "device": "sda"}
    data = []
    for t in range(0, 61, 15):
        data += [("node_disk_write_time_seconds_total", labels, t, t * 9), ("node_disk_writes_completed_total", labels, t, t)]
    assert fired(spark, "HostUnusualDiskWriteLatency", data)


def test_kernel_versions(spark):
    data = [("node_uname_info", {"instance": h, "nodename": h, "release": r}, 0, 1) for h, r in
            [("a", "5.4.0-1"), ("b", "5.4.0-2"), ("c", "5.15.1-1")]]
    assert [r["value"] for r in monitoring.kernel_deviations(samples(spark, data)).collect()] == [2.0]
    assert monitoring.kernel_deviations(samples(spark, data[:2])).count() == 0


def test_thirty_four_alerts():
    assert len(monitoring.ALERTS) + 1 == 34
    assert len({a.name for a in monitoring.ALERTS}) == 33


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 1000])
def test_runs_go_on_across_chunks(spark, rows, chunk):
    """Also over several chunks that they fill, with null labels, and without labels."""
    rng = random.Random(chunk)
    data = [(label, t * 15 - 300) for label in ("a", None) for t in range(80) if rng.random() < 0.85 or 20 <= t < 45]
    expected = []
    for label in ("a", None):
        since = last = None
        for tick in sorted(t for i, t in data if i == label):
            since = since if last is not None and tick == last + 15 else tick
            last = tick
            expected.append((label, tick, since, "firing" if tick - since >= 45 else "pending"))
    active = spark.createDataFrame(data, "i string, tick long").repartition(3)
    held = ts.hold_for(active, ["i"], 15, 45, chunk)
    assert rows(held) == sorted(expected, key=repr)
    one = ts.hold_for(active.where("i = 'a'").drop("i"), [], 15, 45, chunk)
    assert rows(one) == sorted((e[1:] for e in expected if e[0] == "a"), key=repr)
    assert "SinglePartition" not in one._jdf.queryExecution().executedPlan().toString()


def brute_last(data, label, tick, lookback):
    found = [(t, v) for i, t, v in data if i == label and tick - lookback < t <= tick and v is not None]
    return max(found)[1] if found else None


@pytest.mark.parametrize("lookback, chunk", [(60, None), (45, 45), (100, 150), (15, 90)])
def test_lookback_against_brute_force(spark, lookback, chunk):
    rng = random.Random(lookback)
    data = [(i, t, float(t) if rng.random() < 0.8 else None) for i in "ab" for t in range(0, 1500, 15) if rng.random() < 0.25]
    grid = spark.createDataFrame(data, "i string, tick long, v double")
    dense = ts.with_gaps(grid, ["i"], 15, lookback, chunk)
    found = {(r["i"], r["tick"]): r["v"] for r in ts.carried(dense, ["i"], ["v"], lookback, chunk).collect()}
    every = {(i, t) for i in "ab" for t in range(0, 1800, 15) if any(a == i and t - lookback < s <= t for a, s, _ in data)}
    assert set(found) == every and dense.count() == len(every)
    assert all(v == brute_last(data, i, t, lookback) for (i, t), v in found.items())


def test_late_scrapes_keep_an_alert_running(spark):
    """A scrape every 40 seconds or so on a grid of 15: five minutes hold only with a look-back."""
    data, rng = [], random.Random(2)
    for t in range(0, 420, 40):
        at = t + rng.randint(0, 9)
        data += [("node_memory_MemAvailable_bytes", {"instance": "h"}, at, 5), ("node_memory_MemTotal_bytes", {"instance": "h"}, at, 100)]
    memory = alert("HostOutOfMemory")
    states = lambda lookback: {r["state"] for r in monitoring.alert_rows(samples(spark, data), memory, lookback=lookback).collect()}
    assert states(0) == {"pending"} and states(300) == {"pending", "firing"}


FAMILIES = {n: getattr(monitoring, n) for n in ("RATIOS", "LEVELS", "RATES", "GROUPED_RATES", "RATE_RATIOS", "RATE_PER_COUNT", "TRENDS", "FORECASTS", "LONG_HOLDS", "WORKFLOWS", "ALERTS")}


@pytest.mark.parametrize("family", list(FAMILIES))
def test_one_scan_serves_a_family_of_alerts(spark, tmp_path, family):
    labels = {"instance": "h", "device": "d"}
    samples(spark, [("node_memory_MemTotal_bytes", labels, 0, 1)]).write.parquet(str(tmp_path / "s"))
    plan = monitoring.all_alert_rows(spark.read.parquet(str(tmp_path / "s")), FAMILIES[family])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "SortAggregate" not in plan and "SinglePartition" not in plan and "Join" not in plan


def test_all_alerts_at_once_agree_with_each_alone(spark, rows):
    data = []
    for t in range(0, 150, 15):
        for metric in sorted({s.metric for a in monitoring.ALERTS for s in a.inputs.values()}):
            labels = {n: f"{n}{t % 2}" for n in ("instance", "device", "cpu", "dag_id", "task_name", "name")} | {"mountpoint": "/rootfs", "mode": "idle", "state": "failed"}
            data.append((metric, labels, t, t * 7 % 90))
        data.append(("node_uname_info", {"instance": f"instance{t % 2}", "nodename": f"n{t % 3}", "release": "5"}, t, 1))
    source = samples(spark, data).cache()
    together = rows(monitoring.all_alert_rows(source, monitoring.ALERTS))
    assert together == sorted((r for a in monitoring.ALERTS for r in rows(monitoring.alert_rows(source, a))), key=repr)
    assert len({r[0] for r in together}) > 12


def test_last_values_are_spread_however_small_their_shuffle_is(spark):
    df = spark.range(2000).selectExpr("id % 50 AS k", "'x' AS input", "id AS ts", "cast(id AS double) AS value")
    found = ts.last_values(df, ["k"], ["x"])
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {r["k"]: r["x"] for r in found.collect()} == {k: 1950.0 + k for k in range(50)}

import json
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tallymill.operators import suite
from tallymill.operators import timeseries as ts
from tallymill.plans.count_checks import COUNT_CHECKS
from tallymill.schemas import MESSAGE, RAW_STREAM, STREAM_FIELDS, string_schema
from tallymill.sources import tables, topics
from tallymill.sources.versions import VersionedTable
from tallymill.streaming import dead_letters, land, notify, quality

GOOD = dict(zip(STREAM_FIELDS, ["2018 Q1 (Jan-Mar)", "ML0001", "01/02/2018", "Dry", "07:15:00", "Weekday", "A",
                                "Northbound", "Lane", "Bike", "3"]))


def drop_messages(path, name, payloads, topic="Central"):
    path.mkdir(exist_ok=True)
    lines = [
        json.dumps({"topic": topic, "partition": 0, "offset": i, "timestamp": "2024-01-01T00:00:00Z", "value": p})
        for i, p in enumerate(payloads)
    ]
    (path / name).write_text("\n".join(lines) + "\n")


def test_malformed_payload_is_a_row_of_nulls(spark, rows):
    df = spark.createDataFrame([(json.dumps(GOOD),), ('{"Wave": "x',), (None,)], "value string")
    parsed = topics.parse_payload(df, RAW_STREAM)
    assert parsed.columns == STREAM_FIELDS
    assert rows(parsed, "Wave") == [("2018 Q1 (Jan-Mar)",), (None,), (None,)]


def test_encoding_writes_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    message = topics.as_messages(df, F.lit("t")).first()
    assert (message["topic"], json.loads(message["value"])) == ("t", {"x": "a", "y": None})


def test_each_run_takes_only_new_files(spark, tmp_path):
    source, out = tmp_path / "topic", str(tmp_path / "out")
    sizes = []
    for name, n in [("a.json", 2), ("b.json", 3), (None, 0)]:
        if name:
            drop_messages(source, name, [json.dumps(GOOD)] * n)
        arriving = topics.replay_topics(spark, str(source), MESSAGE)
        land.land(topics.parse_payload(arriving, RAW_STREAM), out, str(tmp_path / "checkpoint"))
        sizes.append(spark.read.parquet(out).count())
    assert sizes == [2, 5, 5]


def test_batches_are_bounded_by_files(spark, tmp_path):
    source = tmp_path / "topic"
    for i in range(3):
        drop_messages(source, f"{i}.json", [json.dumps(GOOD)])
    arriving = topics.replay_topics(spark, str(source), MESSAGE, max_files=1)
    land.land_batches(arriving, str(tmp_path / "out"), str(tmp_path / "checkpoint"), by=["topic"])
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.select("batch_id").distinct().count() == 3
    assert stored.where("topic = 'Central'").count() == 3


def test_bad_messages_go_to_dead_letters(spark, tmp_path):
    source = tmp_path / "topic"
    drop_messages(source, "a.json", [json.dumps(GOOD), '{"Wave": "x', json.dumps({**GOOD, "Path": None})])
    good, dead = str(tmp_path / "good"), str(tmp_path / "dead")
    arriving = topics.replay_topics(spark, str(source), MESSAGE)
    dead_letters.land_or_reject(arriving, RAW_STREAM, good, dead, str(tmp_path / "checkpoint"))
    assert spark.read.parquet(good).count() == 2
    letters = spark.read.parquet(dead).collect()
    assert [(r["original_message"], r["offset"], r["headers"]) for r in letters] == [
        ('{"Wave": "x', 1, {"dlq_retry": "0", "dlq_retry_max": "3"})
    ]


def test_wrong_types_are_rejected(spark):
    schema = spark.createDataFrame([], "n int, s string").schema
    df = spark.createDataFrame([('{"n": 1, "s": "a"}',), ('{"n": "x", "s": "a"}',), (None,)], "value string")
    errors = [r["error_message"] for r in topics.parse_or_reject(df, schema).collect()]
    assert errors == [None, "payload does not parse", "empty message"]


def test_retries_run_out(spark):
    message = ("t", 0, 7, None, '{"Wave": "x')
    dead = dead_letters.split(spark.createDataFrame([message], MESSAGE), RAW_STREAM)[1]
    tries = []
    while dead.count() and not dead_letters.exhausted(dead).count():
        tries.append(dead.first()["headers"]["dlq_retry"])
        dead = dead_letters.split(dead_letters.retry(dead), RAW_STREAM)[1]
    assert tries == ["0", "1", "2"]
    assert dead_letters.retry(dead).count() == 0


def test_repaired_message_leaves_the_dead_letters(spark):
    dead = dead_letters.split(spark.createDataFrame([("t", 0, 7, None, "{")], MESSAGE), RAW_STREAM)[1]
    repaired = dead_letters.retry(dead).withColumn("value", F.lit(json.dumps(GOOD)))
    good, still = dead_letters.split(repaired, RAW_STREAM)
    assert good.count() == 1 and still.count() == 0


def test_checked_stream_agrees_with_the_batch_suite(spark, tmp_path):
    source, out = tmp_path / "topic", str(tmp_path / "out")
    faulty = {**GOOD, "SiteID": None}
    drop_messages(source, "a.json", [json.dumps(GOOD), json.dumps(faulty), json.dumps(faulty)])
    drop_messages(source, "b.json", [json.dumps({**GOOD, "Count": "-1"})])
    drop_messages(source, "c.json", [json.dumps(GOOD)], topic="Inner")
    arriving = topics.parse_payload(topics.replay_topics(spark, str(source), MESSAGE, max_files=1), RAW_STREAM, ["topic"])
    quality.land_checked(arriving, COUNT_CHECKS, out, str(tmp_path / "cp"), "2024-01-01 00:00:00")
    rows = quality.stored(spark, out, "rows")
    assert Counter((r["topic"], r["status"]) for r in rows.collect()) == {
        ("Central", "clean"): 1, ("Central", "quarantine"): 3, ("Inner", "clean"): 1,
    }
    report = quality.stored(spark, out, "report").where("topic = 'Central'")
    whole = suite.report(rows.where("topic = 'Central'").select(*STREAM_FIELDS), COUNT_CHECKS)
    by = ["column", "expectation_type"]
    summed = {(r[0], r[1]): r[2] for r in report.groupBy(*by).agg(F.sum("unexpected_count")).collect()}
    assert summed == {(r["column"], r["expectation_type"]): r["unexpected_count"] for r in whole.collect()}
    assert sorted(r["n_copies"] for r in quality.stored(spark, out, "audit").collect()) == [1, 2]


def test_failed_batch_replaces_itself(spark, tmp_path):
    source, out = tmp_path / "topic", str(tmp_path / "out")
    drop_messages(source, "a.json", [json.dumps(GOOD)] * 2)

    def run(fail):
        def handle(batch, batch_id):
            land.write_batch(batch, out, batch_id)
            if fail:
                raise RuntimeError("gone")

        land.each_batch(topics.replay_topics(spark, str(source), MESSAGE), handle, str(tmp_path / "cp"))

    with pytest.raises(Exception, match="gone"):
        run(True)
    run(False)
    assert spark.read.parquet(out).count() == 2


def test_bounded_run_stops_its_query(spark, tmp_path):
    source = tmp_path / "topic"
    drop_messages(source, "a.json", [json.dumps(GOOD)])
    arriving = topics.replay_topics(spark, str(source), MESSAGE)
    land.run_for(land.file_writer(arriving, str(tmp_path / "out"), str(tmp_path / "cp")), 8)
    assert not spark.streams.active
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_stream_of_notifications_agrees_with_the_batch(spark, tmp_path, rows):
    minutes = [0, 1, 2, 3, 4, 9, 10, 11, 30, 31, 32, 33, 34, 35]
    stamps = [(g, f"2024-01-01 00:{m:02d}:{s:02d}") for m in minutes for g, s in (("a", 5), ("a", 40), ("b", 30))]
    firing = spark.createDataFrame(stamps, "job string, t string").select("job", F.col("t").cast("timestamp_ntz").alias("ts"))
    grid = firing.select("job", (ts.seconds(F.col("ts"))).alias("tick"))
    expected = rows(ts.notifications(grid, ["job"], 60, 150, wait=30))
    out, source = str(tmp_path / "out"), str(tmp_path / "in")
    for low, high in [(0, 3), (3, 10), (10, 33), (33, 60)]:
        minute = F.minute("ts")
        firing.where((minute >= low) & (minute < high)).coalesce(1).write.mode("append").parquet(source)
        arriving = topics.replay_topics(spark, source, firing.schema, "parquet")
        notify.land_notifications(arriving, ["job"], 60, 150, out, str(tmp_path / "cp"), wait=30)
    end = notify.heartbeat(spark, firing.schema, firing.agg(F.max("ts")).first()[0], 60, 0)
    end.write.mode("append").parquet(source)
    notify.land_notifications(topics.replay_topics(spark, source, firing.schema, "parquet"), ["job"], 60, 150, out, str(tmp_path / "cp"), wait=30)
    assert rows(spark.read.parquet(f"{out}/sent"), "job", "since", "sent_at", "n_alerts") == expected
    assert len(expected) == 10


def replay(spark, out, parts, columns, lateness, **settings):
    """Alerts as (columns, time of day) in several runs of the stream; returns all that came."""
    made = []
    for part in parts:
        firing = spark.createDataFrame([(*r[:-1], f"2024-01-01 {r[-1]}") for r in part], f"{columns}, t string")
        firing = firing.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
        made.append(firing)
        firing.coalesce(1).write.mode("append").parquet(f"{out}/arriving")
        arriving = topics.replay_topics(spark, f"{out}/arriving", firing.schema, "parquet")
        notify.land_notifications(arriving, ["job"], 60, settings.get("repeat", 120), out, f"{out}/checkpoint", lateness=lateness, identity=settings.get("identity", ()))
    return spark.read.schema(made[0].schema).parquet(f"{out}/arriving").where("job is not null")


BASE = 1704067200


def test_intervals_may_come_in_pieces(spark, rows, tmp_path):
    """An interval that is cut by batches and comes out of order is counted once, in full."""
    parts = [[("a", "00:00:05"), ("a", "00:02:10"), ("a", "00:00:50")], [("a", "00:02:55"), ("a", "00:03:10"), ("a", "00:02:01")], [("a", "00:04:00")]]
    replay(spark, str(tmp_path), parts, "job string", "30 seconds", repeat=180)
    sent = spark.read.parquet(f"{tmp_path}/sent")
    assert rows(sent, "since", "sent_at", "n_alerts") == [(BASE, BASE, 2), (BASE + 120, BASE + 120, 3)]


def test_a_heartbeat_closes_what_is_open(spark, tmp_path, rows):
    """Also intervals of a run that began before, and alerts that came late but within the lateness."""
    parts = [[("a", "00:00:05"), ("b", "00:00:10"), ("a", "00:01:05"), ("a", "00:02:10")], [("a", "00:01:50"), ("a", "00:03:10"), ("b", "00:03:20"), ("a", "00:04:00")]]
    every = replay(spark, str(tmp_path), parts, "job string", "60 seconds")
    schema = every.schema
    end = notify.heartbeat(spark, schema, every.agg(F.max("ts")).first()[0], 60, 60)
    end.write.mode("append").parquet(f"{tmp_path}/arriving")
    arriving = topics.replay_topics(spark, f"{tmp_path}/arriving", schema, "parquet")
    notify.land_notifications(arriving, ["job"], 60, 120, str(tmp_path), f"{tmp_path}/checkpoint", lateness="60 seconds")
    expected = rows(ts.notifications(every.select("job", ts.seconds(F.col("ts")).alias("tick")), ["job"], 60, 120))
    assert rows(spark.read.parquet(f"{tmp_path}/sent").drop("reason")) == expected and len(expected) == 5


def test_a_group_is_sent_when_its_alerts_change(spark, rows, tmp_path):
    """Apart from the repetition, which counts from what was sent last; copies of an alert are one."""
    minutes = [("h1",), ("h1", "h1"), ("h1", "h2"), ("h2", "h1"), ("h1", "h2"), ("h2",), (), ("h2",), ()]
    parts = [[("a", h, f"00:{m:02d}:{s + 1:02d}") for m, hosts in enumerate(minutes) for s, h in enumerate(hosts)], [(None, None, "00:30:00")]]
    replay(spark, str(tmp_path), parts, "job string, host string", "0 seconds", identity=["host"])
    sent = spark.read.parquet(f"{tmp_path}/sent")
    assert rows(sent.select("job", ((F.col("sent_at") - BASE) / 60).cast("int"), "n_alerts", "reason")) == sorted(
        [("a", 0, 1, "new"), ("a", 2, 2, "changed"), ("a", 4, 2, "repeat"), ("a", 5, 1, "changed"), ("a", 7, 1, "new")], key=repr
    )


def test_state_ends_with_the_run(spark, tmp_path):
    """Groups that are long over leave no state behind."""
    parts = [[(f"g{i}", "00:00:05") for i in range(30)], [("a", "00:10:00")], [("a", "00:20:00")], [(None, "00:40:00")], [(None, "00:50:00")]]
    replay(spark, str(tmp_path), parts, "job string", "0 seconds")
    left = spark.read.format("statestore").load(f"{tmp_path}/checkpoint/sent")
    assert left.where("value.groupState is not null").count() <= 1
    assert spark.read.parquet(f"{tmp_path}/sent").count() == 32


def test_a_batch_is_appended_once(spark, rows, tmp_path, monkeypatch):
    """Whether it breaks before its commit or after, and also when the stream starts over."""
    source, path, cp = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp")
    spark.range(3).coalesce(1).write.parquet(source)
    arriving = lambda: topics.replay_topics(spark, source, spark.range(1).schema, "parquet")
    commit = VersionedTable._commit
    for after in (False, True):
        with monkeypatch.context() as broken:

            def fail(self, state, whole, after=after):
                if after:
                    commit(self, state, whole)
                raise RuntimeError("killed")

            broken.setattr(VersionedTable, "_commit", fail)
            with pytest.raises(Exception, match="killed"):
                land.land_once(arriving(), path, "q", cp)
    land.land_once(arriving(), path, "q", cp)
    spark.range(3, 5).coalesce(1).write.mode("append").parquet(source)
    land.land_once(arriving(), path, "q", cp)
    table = VersionedTable(spark, path)
    assert rows(table.read()) == [(0,), (1,), (2,), (3,), (4,)] and table.version() == 2
    land.land_once(arriving(), path, "q", str(tmp_path / "other"))
    assert table.version() == 2


def test_a_ledger_keeps_batches_from_a_connector(spark, tmp_path):
    source, out, ledger = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ledger")
    spark.range(3).coalesce(1).write.parquet(source)
    for checkpoint in ("a", "b"):
        arriving = topics.replay_topics(spark, source, spark.range(1).schema, "parquet")
        land.land_connector(arriving, "parquet", {"path": out}, str(tmp_path / checkpoint), ledger=ledger)
    assert spark.read.parquet(out).count() == 3


def test_messages_come_back_until_their_tries_are_spent(spark, tmp_path):
    """Headers as a connector gives them; what is mended on its way back lands."""
    broken = lambda tries: [{"key": "dlq_retry_max", "value": str(tries).encode()}, {"key": "who", "value": b"x"}]
    rows = [("t", 0, 1, None, json.dumps(GOOD), None), ("t", 0, 2, None, "{", broken(1)), ("t", 0, 3, None, "{", None), ("u", 0, 4, None, "mend me", None), ("t", 0, 5, None, None, broken(0))]
    schema = "topic string, partition int, offset long, timestamp timestamp, value string, headers array<struct<key:string,value:binary>>"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    arriving = topics.replay_topics(spark, source, spark.createDataFrame([], schema).schema, "parquet")
    mend = lambda df: df.withColumn("value", F.when(F.col("value") == "mend me", json.dumps(GOOD)).otherwise(F.col("value")))
    dead_letters.land_with_retries(arriving, RAW_STREAM, out, f"{out}/checkpoint", mend)
    assert sorted(r["topic"] for r in spark.read.parquet(f"{out}/good").collect()) == ["t", "u"]
    spent = {r["offset"]: r["headers"] for r in spark.read.parquet(f"{out}/exhausted").collect()}
    assert {o: h["dlq_retry"] for o, h in spent.items()} == {2: "1", 3: "3", 5: "0"} and spent[2]["who"] == "x"
    back = dead_letters.with_headers(spark.read.option("recursiveFileLookup", True).parquet(f"{out}/again")).collect()
    assert sorted((r["offset"], r["headers"]["dlq_retry"]) for r in back) == [(2, "1"), (3, "1"), (3, "2"), (3, "3"), (4, "1")]


def test_jdbc_append_options(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    seen = {}

    def jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties)

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    tables.append_jdbc(spark.range(1), "jdbc:x", "counts", {"user": "u"})
    assert seen == {"url": "jdbc:x", "table": "counts", "mode": "append", "properties": {"user": "u"}}


def test_connector_by_format_name(spark, rows, tmp_path):
    tables.save(spark.range(2), "parquet", "overwrite", {"path": str(tmp_path / "t")})
    assert rows(tables.load(spark, "parquet", {"path": str(tmp_path / "t")})) == [(0,), (1,)]
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topics(spark, "host:9092", ["Central"])


def test_headers_as_the_connector_gives_them(spark, rows):
    """An array of key and binary value; all of them are kept, the last of a key counts."""
    fields = "topic string, value string, partition int, offset long, timestamp timestamp, error_message string, headers array<struct<key: string, value: binary>>"
    given = [("dlq_retry", bytearray(b"1")), ("trace", bytearray(b"a")), ("trace", bytearray(b"b"))]
    messages = spark.createDataFrame([("t", "x", 0, 1, None, "bad", given), ("t", "y", 0, 2, None, "bad", None)], fields)
    dead = dead_letters.envelope(messages)
    wanted = {1: {"dlq_retry": "1", "dlq_retry_max": "3", "trace": "b"}, 2: {"dlq_retry": "0", "dlq_retry_max": "3"}}
    assert {r.offset: r.headers for r in dead.collect()} == wanted
    again = {r.offset: r.headers for r in dead_letters.retry(dead).collect()}
    assert again == {1: wanted[1] | {"dlq_retry": "2"}, 2: wanted[2] | {"dlq_retry": "1"}}


def test_topics_that_look_like_numbers(spark, tmp_path):
    spark.createDataFrame([("007", 1), ("010", 2)], "topic string, n long").write.partitionBy("topic").parquet(str(tmp_path / "rows"))
    assert {r.topic for r in quality.stored(spark, str(tmp_path), "rows").collect()} == {"007", "010"}


def test_job_routes_every_message(spark, tmp_path, rows):
    source, out = tmp_path / "topic", str(tmp_path / "out")
    drop_messages(source, "a.json", [json.dumps(GOOD), json.dumps({**GOOD, "SiteID": None}), "{broken"])
    drop_messages(source, "b.json", [json.dumps({**GOOD, "Count": "-1"}), json.dumps({**GOOD, "Path": None})], topic="007")
    drop_messages(source, "c.json", ["{broken", None], topic="Inner")
    actions = {"SiteID_check_if_not_null": "F", "Count_check_if_greater_than_or_equal_to": "R", "Path_check_if_not_null": "A"}
    arriving = topics.replay_topics(spark, str(source), MESSAGE, max_files=1)
    quality.land_routed(arriving, RAW_STREAM, COUNT_CHECKS, actions, out, str(tmp_path / "cp"), "2024-01-01 00:00:00")
    parts = Counter((r["topic"], r["part"]) for r in quality.settled(spark, out).collect())
    assert parts == {("Central", "held"): 2, ("007", "quarantined"): 1, ("007", "accepted"): 1}
    dead = quality.stored(spark, out, "dead")
    assert rows(dead, "topic", "original_message") == [("Central", "{broken"), ("Inner", "{broken"), ("Inner", None)]
    outcome = quality.stored(spark, out, "outcome").where("outcome <> 'none'")
    assert {(r["topic"], r["outcome"]) for r in outcome.collect()} == {
        ("Central", "fail_batch"), ("007", "quarantine_rows"), ("007", "accept_and_log"),
    }
    assert quality.stored(spark, out, "outcome").where("topic = '007'").count() == len(COUNT_CHECKS)


def test_ids_repeat_with_the_batch(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    first, again = (topics.with_ids(df, 7).collect() for _ in range(2))
    assert first == again and len({r.row_id for r in first}) == 2 and {r.batch_id for r in first} == {7}
    assert [r.row_id for r in topics.with_ids(df.drop("v"), 7).collect()] == [r.row_id for r in topics.with_ids(df, 7, ["k"]).collect()]


def test_one_file_per_folder_of_a_batch(spark, tmp_path):
    df = spark.range(1000, numPartitions=20).selectExpr("cast(id % 3 as string) as topic", "id")
    stored_at = land.write_batch(df, str(tmp_path), 0, by=["topic"])
    assert len(list((tmp_path / "batch_id=0").glob("topic=*/*.parquet"))) == 3
    assert spark.read.parquet(stored_at).count() == 1000


def test_parsed_messages_are_kept_without_what_only_dead_letters_need(spark):
    schema = string_schema(["a", "topic"])
    rows = [("t", 1, 10, '{"a": "x", "topic": "own"}'), ("u", 2, 20, '{"a": "y'), (None, 3, 30, None)]
    df = spark.createDataFrame(rows, 'topic string, partition int, offset bigint, value string')
    with dead_letters.kept_parsed(df, schema) as parsed:
        found = {r["topic"]: r for r in parsed.collect()}
    assert found["t"]["d"].asDict() == {"a": "x", "topic": "own"} and found["t"]["error_message"] is None
    assert [found["t"][c] for c in ("partition", "offset", "value")] == [None, None, None]
    assert [found["u"][c] for c in ("partition", "offset", "value")] == [2, 20, '{"a": "y']
    assert found[None]["error_message"] == "empty message" and found[None]["offset"] == 30


def test_a_batch_is_written_by_topic_without_a_sort(spark, tmp_path, monkeypatch, rows):
    key, seen, parquet = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def watched(self, *args, **kwargs):
        seen.append(int(spark.conf.get(key)))
        return parquet(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    df = spark.range(40).selectExpr("id", "concat('t', id % 40) AS topic")  # more folders than are written side by side
    stored_at = land.write_batch(df, str(tmp_path), 0, by=["topic"])
    assert seen == [32] and int(spark.conf.get(key)) == 0
    assert rows(spark.read.parquet(stored_at), "id", "topic") == rows(df)

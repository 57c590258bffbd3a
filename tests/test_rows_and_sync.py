import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymill.functions.times import parse_timestamp
from tallymill.operators import distribution, rows as ops, upsert
from tallymill.plans import jobs, marts, staging
from tallymill.schemas import BATCH_FIELDS, RAW_BATCH, RAW_STREAM, to_batch_names, to_stream_names
from tallymill.sources.versions import Conflict, VersionedTable
from tallymill.sources import files, manifest, tables


def test_first_per_key_against_brute_force(spark):
    rng = random.Random(7)
    pick = lambda options: rng.choice(options)
    data = [(pick("ab"), pick([1, 2, None]), pick(["x", None, "y"]), pick([3, 4, None])) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, j int, v string, w int")
    nulls_first = lambda t: tuple((x is not None, x if x is not None else 0) for x in t)
    expected = {}
    for k, j, v, w in data:
        best = expected.get((k, j))
        if best is None or nulls_first((v, w)) < nulls_first(best):
            expected[(k, j)] = (v, w)
    got = {(r["k"], r["j"]): (r["v"], r["w"]) for r in ops.first_per_key(df, ["k", "j"]).collect()}
    assert got == expected


def test_latest_per_key_breaks_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q")], "k string, t int, v string")
    assert rows(ops.latest_per_key(df, ["k"], "t")) == [("a", 2, "z"), ("b", None, "q")]


def test_set_difference(spark, rows):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    right = spark.createDataFrame([("b",), (None,)], "x string")
    assert rows(ops.except_distinct(left, right)) == [("a",)]
    assert rows(ops.except_all(left, right)) == [("a",), ("a",)]


def test_dev_limit_is_off_by_default(spark):
    df = spark.range(10)
    assert ops.dev_limit(df, None, ["id"]).count() == 10
    assert [r["id"] for r in ops.dev_limit(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_open_range_leaves_out_both_ends(spark):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2019-05-23", "2019-06-03"))
    df = spark.createDataFrame([("2019-05-23 00:00:00",), ("2019-05-23 00:00:01",), ("2019-06-03 00:00:00",)], "t string")
    kept = df.where(ops.open_range(F.col("t").cast("timestamp_ntz"), low, high))
    assert [r["t"] for r in kept.collect()] == ["2019-05-23 00:00:01"]


def test_distributions(spark, rows):
    df = spark.createDataFrame([("a", "2020-01-05"), ("a", "2020-01-31"), ("b", "2020-02-01"), (None, None)], "x string, d string")
    assert rows(distribution.categorical(df, "x")) == [("a", 2, 0.5), ("b", 1, 0.25), (None, 1, 0.25)]
    by_month = distribution.temporal(df.withColumn("d", F.col("d").cast("timestamp_ntz")), "d", "month")
    assert Counter(r["n_rows"] for r in by_month.collect()) == {2: 1, 1: 2}


def test_quantiles_are_exact_for_small_groups(spark, rows):
    df = spark.range(1, 101).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    assert rows(distribution.quantiles(df, ["g"], F.col("v"), [0.5, 0.99])) == [("g", 0.5, 50.0), ("g", 0.99, 99.0)]


def target_and_incoming(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, n int")
    incoming = spark.createDataFrame([(2, None), (3, "c")], "id int, name string")
    return target, incoming


def test_upsert_sets_only_what_is_supplied(spark, rows):
    target, incoming = target_and_incoming(spark)
    once = upsert.upsert(target, incoming, ["id"])
    assert rows(once) == [(1, "a", 10), (2, None, 20), (3, "c", None)]
    assert rows(upsert.upsert(once, incoming, ["id"])) == rows(once)


def test_new_keys_and_newer_rows(spark, rows):
    held = spark.createDataFrame([("a", 5), ("b", 5)], "k string, at int")
    incoming = spark.createDataFrame([("b", 4), ("a", 6), ("c", 1)], "k string, at int")
    assert rows(upsert.new_keys(incoming, held, ["k"])) == [("c", 1)]
    assert rows(upsert.newer_rows(incoming, held, ["k"], F.col("at"), "at")) == [("a", 6)]


def test_rule_sync_compares_typed_times(spark, rows):
    fields = "rule_key int, rule_name string, update_timestamp string"
    held = spark.createDataFrame([(1, "old", "2024-12-01 00:00:00"), (2, "kept", "2024-12-01 00:00:00")], fields)
    incoming = spark.createDataFrame(
        [(2, "same age", "2024-12-01 00:00:00"), (1, "new", "2024-12-02 00:00:00"), (3, "added", "2024-12-01 00:00:00")], fields
    )
    version = parse_timestamp(F.col("update_timestamp"))
    out = upsert.sync(held.withColumn("_at", version), incoming, ["rule_key"], version, "_at").drop("_at")
    expected = [(1, "new", "2024-12-02 00:00:00"), (2, "kept", "2024-12-01 00:00:00"), (3, "added", "2024-12-01 00:00:00")]
    assert rows(out) == expected
    empty = held.where("false").withColumn("_at", version)
    assert upsert.sync(empty, incoming, ["rule_key"], version, "_at").count() == 3


def listing(spark, data):
    cells = [(n, lv, f" {name} ", " May 1st ", "1 KB", f" {kind}", "") for n, lv, name, kind in data]
    return spark.createDataFrame(
        cells, "row_no int, data_level int, name string, last_modified string, size string, type string, description string"
    )


def test_listing_block(spark, rows):
    df = listing(
        spark,
        [
            (1, 3, "before", "CSV file"), (2, 1, "root", "Folder"), (3, 2, "counts", "Folder"), (4, 3, "a", "CSV file"),
            (5, 3, "b", "PDF file"), (6, 2, "more", "Folder"), (7, 3, "c", "CSV file"), (8, 1, "end", "Folder"),
            (9, 2, "late", "Folder"), (10, 3, "d", "CSV file"),
        ],
    )
    assert rows(manifest.listing_to_manifest(df), "name") == [("a",), ("c",)]
    open_ended = df.where("row_no < 8")
    assert rows(manifest.listing_to_manifest(open_ended), "name") == [("a",), ("c",)]


def test_listing_block_over_chunks(spark, rows, monkeypatch, tmp_path):
    """Random listings against a walk in row order; nulls in any column; the listing is read twice."""
    monkeypatch.setattr(manifest, "CHUNK", 7)
    rng = random.Random(5)
    data, expected = [], set()
    for name in ("a", "b", "c", "d", "e", "f", None):
        numbers = rng.sample(range(-20, 200), 90)
        of_listing = [(name, n, rng.choice([3] * 30 + [2, 1, None]), f"file {n}", rng.choice(["CSV file ", "Folder", None])) for n in numbers]
        of_listing.append((name, None, 3, "nowhere", "CSV file"))
        data += of_listing
        began = ended = False
        for _, n, level, cell, kind in sorted((r for r in of_listing if r[1] is not None), key=lambda r: r[1]):
            if began and level not in (2, 3, None):
                ended = True
            if began and not ended and level == 3 and kind == "CSV file " and name:
                expected.add((name, cell))
            began = began or level == 2
    data.append(("no folder", 1, 3, "x", "CSV file"))
    df = spark.createDataFrame(data, "listing string, row_no long, data_level int, name string, type string")
    df = df.withColumns({c: F.lit("") for c in ("last_modified", "size", "description")})
    df.write.parquet(str(tmp_path / "listing"))
    found = manifest.listing_to_manifest(spark.read.parquet(str(tmp_path / "listing")), by="listing")
    assert expected and {(r["listing"], r["name"]) for r in found.collect()} == expected and found.count() == len(expected)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2
    assert manifest.listing_to_manifest(df.where("false"), by="listing").count() == 0
    assert manifest.listing_to_manifest(df.where("false").drop("listing")).count() == 0


def test_manifest_is_matched_by_name(spark, rows):
    now = spark.createDataFrame([("new", 5), ("same", 3), ("changed", 9)], "name string, last_modified int")
    state = spark.createDataFrame(
        [("changed", 1, 3), ("same", 1, 3), ("gone", 2, 2)], "name string, create_timestamp int, update_timestamp int"
    )
    assert rows(manifest.classify(now, state)) == [
        ("changed", "updated", 1, 9), ("gone", "missing", 2, 2), ("new", "new", 5, 5), ("same", "unchanged", 1, 3),
    ]


def test_fetch_new_or_changed(spark, rows):
    now = spark.createDataFrame([("A-Central", "1"), ("B-Inner", "2"), ("C-central", "3")], "name string, etag string")
    seen = spark.createDataFrame([("A-Central", "1"), ("B-Inner", "0")], "name string, etag string")
    assert rows(manifest.to_fetch(now, seen, "etag"), "name") == [("B-Inner",), ("C-central",)]
    assert rows(manifest.to_fetch(now, seen, "etag", "CENTRAL"), "name") == [("C-central",)]


GOOD = ("2018 Q1 (Jan-Mar)", "ML0001", "01/02/2018", "Dry", "07:15:00", "Weekday", "A", "Northbound", "Lane", "Bike", "3")


def counts(spark, *changes):
    return spark.createDataFrame([tuple({**dict(zip(BATCH_FIELDS, GOOD)), **c}.values()) for c in changes], RAW_BATCH)


def test_staging_keeps_one_row_per_site_date_and_time(spark, rows):
    raw = counts(spark, {"Count": "5"}, {"Count": "3"}, {"Time": "07:30:00", "Count": "x"}, {"UnqID": None})
    staged = staging.stage(raw)
    assert rows(staged, "unqid", "count") == [("ML0001", 3), ("ML0001", None)]
    assert staging.stage(raw, keys=["UnqID", "Date", "Time", "Count"]).count() == 3
    assert staging.stage(raw, limit=1).count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage(raw, strict=True).collect()


def test_duplicates_are_kept_apart_by_source(spark):
    raw = counts(spark, {}, {}).withColumn("source", F.col("Count"))
    two = raw.unionByName(raw.withColumn("source", F.lit("other")))
    assert staging.stage(two, source="source").count() == 2


def test_marts_equal_sums_over_the_fact(spark, rows):
    raw = counts(
        spark, {"Count": "5"}, {"Time": "08:00:00", "Day": "Weekend", "Count": "2"}, {"UnqID": "ML0002", "Count": "7"},
        {"UnqID": "ML0009"}, {"UnqID": "ML0002", "Time": "09:00:00", "Year": "2018 Q2 spring (Apr-Jun)", "Count": "1"},
    )
    places = spark.createDataFrame(
        [("ML0001", "Camden", "A Road"), ("ML0002", "Hackney", "A Road"), ("ML0002", "Hackney", "B Road")],
        "site_id string, borough string, road_type string",
    )
    staged = staging.stage(raw)
    fact = marts.fact(staged, places)
    assert fact.count() == 6
    for mart, keys in [(marts.by_borough_road, ["borough", "road_type"]), (marts.by_day_type, ["day"])]:
        assert rows(mart(staged, places)) == rows(fact.groupBy(*keys).agg(F.sum("count").alias("total_count")))
    assert rows(marts.by_quarter(staged, places)) == [("2018", "Q1", 21), ("2018", "Q2", 2)]
    assert rows(marts.by_day_type(staged, places, weekend_only=True)) == [("Weekend", 2)]


def test_names_round_trip(spark):
    raw = counts(spark, {})
    assert to_stream_names(raw).columns == RAW_STREAM.fieldNames()
    assert to_batch_names(to_stream_names(raw)).columns == BATCH_FIELDS


def test_clean_files_by_name(spark, rows, tmp_path):
    header, line = ",".join(BATCH_FIELDS), ",".join(GOOD)
    spring = line.replace("2018 Q1 (Jan-Mar)", "2018 Q2 spring (Apr-Jun)").replace(",Lane,", ",,")
    for folder, name, lines in [
        ("2018/Q1-(Jan-Mar)", "2018 Q1 (Jan-Mar)-Central.csv", [line, line]),
        ("2018/Q2-(Apr-Jun)", "2018 Q2 spring (Apr-Jun)-Inner.csv", [spring]),
    ]:
        path = tmp_path / "in" / folder
        path.mkdir(parents=True)
        (path / name).write_text("\n".join([header, *lines]) + "\n")
    out = jobs.clean_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), RAW_BATCH)
    assert rows(out, "table_name", "Year", "Quarter", "Path", "Time") == [
        ("2018_Q1_Jan_Mar_Central", 2018, "Q1", "Lane", "07:15:00"),
        ("2018_Q2_spring_Apr_Jun_Inner", 2018, "Q2", "Unknown", "07:15:00"),
    ]


def test_csv_inference_and_literals(spark, tmp_path):
    df = files.literal_rows(spark, [("Alice", 28), ("Bob", 24), ("Cathy", 29)], "Name string, Age long")
    assert df.where(F.col("Age") > 25).count() == 2
    files.write_csv(df, str(tmp_path / "people"))
    back = files.read_csv(spark, str(tmp_path / "people"))
    assert dict(back.dtypes) == {"Name": "string", "Age": "int"}


def test_catalogue_file(spark, tmp_path):
    (tmp_path / "rules.json").write_text('[\n {"rule_key": 1,\n "rule_name": "a"},\n {"rule_key": 2, "rule_name": "b"}\n]')
    schema = spark.createDataFrame([], "rule_key int, rule_name string").schema
    assert files.read_catalogue(spark, str(tmp_path / "rules.json"), schema).count() == 2


def test_tables_and_models(spark, rows):
    tables.create_table(spark, "made_empty", RAW_BATCH)
    tables.create_table(spark, "made_empty", RAW_BATCH)
    assert spark.table("made_empty").columns == BATCH_FIELDS
    models = tables.Models(spark)
    models.add("base_view", lambda s: s.range(3).toDF("n"))
    models.add("sum_table", lambda s: s.table("base_view").agg(F.sum("n").alias("total")), "table")
    models.materialise("base_view")
    assert rows(models.materialise("sum_table")) == [(3,)]
    assert rows(models.materialise("sum_table")) == [(3,)]
    with pytest.raises(ValueError, match="materialised"):
        models.add("odd", lambda s: s.range(1), "index")


def test_a_table_is_read_where_a_view_had_its_name(spark, rows):
    spark.range(3).createOrReplaceTempView("model_of_two_kinds")
    models = tables.Models(spark)
    models.add("model_of_two_kinds", lambda s: s.range(1), "table")
    models.add("reads_it", lambda s: s.table("model_of_two_kinds"))
    assert rows(models.materialise("model_of_two_kinds")) == rows(models.materialise("reads_it")) == [(0,)]


def test_warehouse_models(spark, rows):
    raw = counts(spark, {}, {"UnqID": "ML0002"}).withColumn("source", F.lit("2018"))
    fields = ["site_id", "location_description", "borough", "functional_area_for_monitoring", "road_type", "old_site_id_legacy"]
    places = spark.createDataFrame([("ML0001", "d", "Camden", "Central", "A Road", "o")], fields)
    numbers = ["easting_uk_grid", "northing_uk_grid", "latitude", "longitude"]
    models = jobs.warehouse(spark, raw, places.withColumns({n: F.lit(1.0) for n in numbers}))
    for name in ("stg_counts", "dim_locations", "fact_counts"):
        models.materialise(name)
    assert len(spark.table("fact_counts").columns) == 22
    assert rows(models.materialise("mart_borough_road")) == [("Camden", "A Road", 3)]
    assert rows(models.materialise("mart_day")) == [("Weekday", 3)]
    assert rows(models.materialise("mart_quarter")) == [("2018", "Q1", 3)]


def test_replace_partitions_twice_changes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "parts")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    tables.replace_partitions(first, path, ["p"])
    for _ in range(2):
        tables.replace_partitions(first.where("p = 'a'").withColumn("n", F.lit(9)), path, ["p"])
    assert rows(spark.read.parquet(path), "n", "p") == [(2, "b"), (9, "a")]


def test_failed_validation_keeps_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "loaded")
    jobs.validate_and_load(counts(spark, {}), RAW_BATCH, path)
    with pytest.raises(Exception, match="field Path is missing"):
        jobs.validate_and_load(counts(spark, {}, {"Path": None}), RAW_BATCH, path)
    assert VersionedTable(spark, path).read().count() == 1
    with monkeypatch.context() as broken:  # the rows are written, the commit is not
        broken.setattr(VersionedTable, "_commit", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            jobs.validate_and_load(counts(spark, {}, {}), RAW_BATCH, path)
    table = VersionedTable(spark, path)
    assert table.version() == 1 and table.read().count() == 1
    assert jobs.validate_and_load(counts(spark, {}, {}), RAW_BATCH, path).count() == 2
    assert table.read(1).count() == 1


def test_versions_and_ledger(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="nothing was committed"):
        table.read()
    for batch in range(25):  # more commits than one whole listing apart
        assert table.append(spark.range(batch, batch + 1), "a", batch)
        assert not table.append(spark.range(batch, batch + 1), "a", batch)
    assert table.append(spark.range(100, 101), "b", 0) and not table.append(spark.range(5), "a", 3)
    assert rows(table.read()) == sorted([(i,) for i in [*range(25), 100]], key=repr)
    assert rows(table.read(3)) == [(0,), (1,), (2,)]
    with pytest.raises(ValueError, match="do not fit"):
        table.append(spark.range(1).toDF("other"), "a", 99)
    at = table.version()
    other = VersionedTable(spark, str(tmp_path / "t"))
    other.append(spark.range(200, 201), "b", 1)
    with pytest.raises(Conflict):
        table.replace(spark.range(1), expect=at)
    assert rows(table.replace(spark.range(7, 8))) == [(7,)]
    assert not table.append(spark.range(1), "b", 1)  # the ledger outlives the rows
    assert table.replace(spark.range(0)).count() == 0


def test_two_writers_of_one_version(spark, rows, tmp_path, monkeypatch):
    """The second finds its version taken, and adds its rows to what the first has committed."""
    table, state = VersionedTable(spark, str(tmp_path / "t")), VersionedTable.state
    other, raced = VersionedTable(spark, str(tmp_path / "t")), []

    def late(self, version=None):
        found = state(self, version)
        if self is table and len(raced) == 1:  # between reading the state and the commit
            raced.append(other.append(spark.range(5, 6), "other", 0))
        elif self is table:
            raced.append(None)
        return found

    monkeypatch.setattr(VersionedTable, "state", late)
    assert table.append(spark.range(1), "mine", 0) and raced[1] is True
    assert rows(table.read()) == [(0,), (5,)] and table.version() == 2


def test_models_are_built_after_what_they_read(spark, rows, tmp_path):
    models = tables.Models(spark, str(tmp_path / "models"))
    models.add("top", lambda s: s.sql("WITH x AS (SELECT n FROM middle) SELECT sum(x.n) AS total FROM x JOIN `low` USING (n)"), "table")
    models.add("middle", lambda s: s.table("low").where("n > 1"), "table")
    models.add("low", lambda s: s.range(4).toDF("n"))
    assert models.build_all() == ["low", "middle", "top"]
    assert rows(spark.table("top")) == [(5,)] and models.reads == {"low": [], "middle": ["low"], "top": ["middle", "low"]}
    models.add("low", lambda s: s.range(3).toDF("n"))
    assert models.build_all() and rows(spark.table("top")) == [(2,)]
    assert VersionedTable(spark, str(tmp_path / "models" / "top")).version() == 2
    models.add("low", lambda s: s.table("top"))
    with pytest.raises(ValueError, match="top -> middle -> low -> top"):
        models.build_all()


def test_ingest_goes_on_where_it_broke(spark, rows, tmp_path, monkeypatch):
    fields, out = ["n"], str(tmp_path / "out")
    schema = spark.createDataFrame([], "n string").schema
    listed = lambda *files: spark.createDataFrame([(f, e) for f, e in files], "name string, etag string")
    data = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), ("c", "4")], "file_name string, n string")
    log = manifest.FetchLog(spark, f"{out}/log", "etag string, update_timestamp timestamp_ntz, create_timestamp timestamp_ntz")
    run = lambda *files: jobs.ingest(listed(*files), data, log, "etag", F.lit("2024-01-01").cast("timestamp_ntz"), fields, schema, "t", out)
    landed = lambda: rows(VersionedTable(spark, f"{out}/landed").read())
    assert run(("a", "x")) == 1 and landed() == [("1",), ("2",)]
    assert run(("a", "x")) == 0 and landed() == [("1",), ("2",)]
    for step in ("as_messages", "land_once", "mark_fetched"):
        with monkeypatch.context() as broken:
            broken.setattr(jobs, step, lambda *a, **k: (_ for _ in ()).throw(OSError(step)))
            with pytest.raises(OSError, match=step):
                run(("a", "x"), ("b", "y"))
            # what is listed meanwhile waits for the next fetch
            if step != "mark_fetched":
                assert landed() == [("1",), ("2",)]
    assert run(("a", "x"), ("b", "y"), ("c", "z")) == 1 and landed() == [("1",), ("2",), ("3",)]
    assert run(("a", "x"), ("b", "y"), ("c", "z")) == 1 and landed() == [("1",), ("2",), ("3",), ("4",)]
    log.compact()
    assert run(("a", "x"), ("b", "y"), ("c", "z")) == 0
    assert rows(log.latest(), "name", "etag") == [("a", "x"), ("b", "y"), ("c", "z")]
    assert log.latest().where("create_timestamp = update_timestamp").count() == 3
    assert run(("a", "new")) == 1 and log.table.read().count() == 4 and rows(log.latest().where("name = 'a'"), "etag") == [("new",)]


def test_sync_keeps_keys_unique_and_new_columns(spark, rows):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "k long, v string, t long")
    incoming = spark.createDataFrame([(2, "old", 4, "w"), (3, "x", 1, "y"), (3, "z", 2, "q"), (1, "n", 9, "m")], "k long, v string, t long, more string")
    out = upsert.sync(target, incoming, ["k"], F.col("t"), "t")
    assert rows(out, "k", "v", "t", "more") == [(1, "n", 9, "m"), (2, "b", 5, None), (3, "z", 2, "q")]


def test_files_without_a_version_are_fetched_once(spark, rows):
    listed = spark.createDataFrame([("a", None), ("b", 1), ("c", 2)], "name string, v long")
    fetched = spark.createDataFrame([("b", 1), ("c", 1)], "name string, v long")
    assert rows(manifest.to_fetch(listed, fetched, "v"), "name") == [("a",), ("c",)]
    assert rows(manifest.to_fetch(listed, listed, "v"), "name") == []


def test_surrogate_key_follows_the_keys(spark):
    raw = spark.createDataFrame([tuple("x" if f == "UnqID" else d if f == "Dir" else "1" for f in RAW_BATCH.fieldNames()) for d in ("N", "S")], RAW_BATCH)
    out = staging.stage(raw, keys=(*staging.KEYS, "Dir"))
    assert out.count() == 2 and out.select("cyclingid").distinct().count() == 2


@pytest.mark.parametrize("accuracy", [10, 200, 100_000])
def test_quantiles_are_exact_at_any_accuracy(spark, accuracy):
    rnd = random.Random(4)
    values = {"a": [rnd.gauss(0, 1) for _ in range(5000)], "b": [rnd.randrange(5) for _ in range(999)], None: [1.0]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k string, v double").repartition(4)
    points = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {(r.k, r.quantile): r.value for r in distribution.quantiles(df, ["k"], F.col("v"), points, accuracy).collect()}
    for k, vs in values.items():
        ordered = sorted(vs)
        for p in points:
            assert got[(k, p)] == ordered[max(0, -int(-len(vs) * p // 1) - 1)]

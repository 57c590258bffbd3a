"""What the plans must look like: one scan per suite, early reduction, no forced broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

from tallymill.operators import suite
from tallymill.operators.rows import except_distinct, first_per_key
from tallymill.plans import marts, metric_names, staging
from tallymill.plans.count_checks import COUNT_CHECKS
from tallymill.schemas import RAW_STREAM, to_batch_names
from tallymill.sources import topics
from workload.inputs import locations, table

SF = "/root/testdata/sf0.001"


@pytest.fixture
def raw(spark, tmp_path):
    path = str(tmp_path / "raw")
    row = ("2018 Q1 (Jan-Mar)", "ML0001", "01/02/2018", "Dry", "07:15:00", "Weekday", "A", "Northbound", "Lane", "Bike", "3")
    spark.createDataFrame([row], RAW_STREAM).write.parquet(path)
    return spark.read.schema(RAW_STREAM).parquet(path)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_suite_is_one_scan_and_one_row_shuffle(raw):
    text = physical(suite.report(raw, COUNT_CHECKS))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1 and "Exchange SinglePartition" in text


def test_split_needs_no_shuffle(raw):
    for df in (suite.clean(raw, COUNT_CHECKS), suite.quarantine(raw, COUNT_CHECKS)):
        text = physical(df)
        assert text.count("FileScan") == 1 and "Exchange" not in text


def test_one_check_reads_one_column(raw):
    assert "ReadSchema: struct<SiteID:string>" in physical(suite.report(raw, [COUNT_CHECKS[2]]))


def test_dedup_keeps_one_row_per_key_before_the_shuffle(raw):
    text = physical(first_per_key(to_batch_names(raw), ["UnqID", "Date", "Time"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_not_null_filter_reaches_the_scan(raw):
    assert "IsNotNull(SiteID)" in re.search(r"PushedFilters: \[.*?\]", physical(staging.stage(to_batch_names(raw)))).group(0)


def test_mart_sums_per_site_before_the_join(spark, raw):
    text = physical(marts.by_borough_road(staging.stage(to_batch_names(raw)), locations(spark, SF)))
    joins = [m.start() for m in re.finditer("HashJoin|SortMergeJoin", text)]
    below = text[joins[0] :]
    assert "partial_sum" in below


def test_small_dimension_is_broadcast_by_its_size(spark, raw):
    staged = staging.stage(to_batch_names(raw))
    assert "BroadcastHashJoin" in physical(marts.fact(staged, marts.dim_locations(locations(spark, SF))))


def test_large_sides_still_join_without_broadcast(spark, raw):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = staging.stage(to_batch_names(raw))
        text = physical(marts.fact(staged, marts.dim_locations(locations(spark, SF))))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_set_difference_reduces_both_sides_first(spark):
    nation = table(spark, SF, "nation").select("n_regionkey")
    text = physical(except_distinct(nation, nation.where(F.col("n_regionkey") > 2)))
    assert text.count("HashAggregate") >= 4



def test_names_are_mapped_in_their_own_row(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.createDataFrame([("a.ti_failures", 1.0)], "flat string, value double").write.parquet(path)
    text = physical(metric_names.map_metrics(spark.read.parquet(path), "flat"))
    assert "Join" not in text and "Exchange" not in text and text.count("FileScan") == 1
    assert "isnotnull(_rule" in text


def test_filters_do_not_repeat_a_parsed_payload(spark, tmp_path):
    path = str(tmp_path / "messages")
    spark.createDataFrame([("t", "{}")], "topic string, value string").write.parquet(path)
    parsed = topics.parse_payload(spark.read.parquet(path), RAW_STREAM)
    assert physical(suite.clean(parsed, COUNT_CHECKS)).count("from_json") == 1

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymill.operators import checks, contract, suite
from tallymill.operators.checks import Check
from tallymill.operators.skew import attach_counts
from tallymill.plans.count_checks import COUNT_CHECKS, WAVE_PATTERN, catalogue
from tallymill.schemas import RAW_STREAM, STREAM_FIELDS, string_schema

# readings of probes, five a day: every seventh clock is cut, every sixth depth below ground, and so on
READINGS = [
    (
        f"P{i % 23:02d}" if i % 10 != 9 else None,
        f"2023-0{i // 5 + 1}-{28 + i % 5}",
        f"{i:02d}:30" if i % 7 == 0 else f"{i:02d}:30:00",
        None if i == 4 else str(i - 2) if i % 6 else f"-{i}.5",
        ("open", "shut", "stuck", "lost", None)[i % 5],
        f"by {('crew', 'robot')[i % 2]}-{i}" if i != 11 else "",
    )
    for i in range(25)
]

PROBE_SUITE = {
    "data_product_name": "probes",
    "columns": [
        {"column_name": "note", "dq_rule(s)": [{"rule_name": "check_if_matches_regex", "rule_dimension": "Conformity", "add_info": {"regex_pattern": "crew-[0-9]+$"}}]},
        {"column_name": "spare", "dq_rule(s)": None},
        {
            "column_name": "depth",
            "dq_rule(s)": [
                {"rule_name": "check_if_greater_than_or_equal_to", "rule_dimension": "Plausibility", "add_info": {"min_value": 0}},
                {"rule_name": "check_if_not_null", "rule_dimension": "Completeness"},
            ],
        },
        {"column_name": "clock", "dq_rule(s)": [{"rule_name": "check_if_valid_time_format", "rule_dimension": "Conformity", "add_info": {"time_format": "%H:%M:%S"}}]},
        {"column_name": "taken_on", "dq_rule(s)": [{"rule_name": "check_if_valid_date_format", "rule_dimension": "Conformity", "add_info": {"date_format": "%Y-%m-%d"}}]},
        {
            "column_name": "probe",
            "dq_rule(s)": [
                {"rule_name": "check_if_unique", "rule_dimension": "Identity", "add_info": {}},
                {"rule_name": "check_if_not_null", "rule_dimension": "Completeness", "add_info": {}},
            ],
        },
        {"column_name": "gate", "dq_rule(s)": [{"rule_name": "check_if_values_in_list", "rule_dimension": "Conformity", "add_info": {"value_set": ["open", "shut"]}}]},
    ],
}


def bad_values(spark, check, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r["x"] for r in suite.quarantine(df, [check]).collect()]


def records(spark):
    """All fields good, then one fault per row, with one row twice."""
    good = ["2018 Q1 (Jan-Mar)", "ML0001", "01/02/2018", "Dry", "07:15:00", "Weekday", "A", "Northbound", "Lane", "Bike", "3"]
    out = [good, good]
    for field, value in [
        ("Wave", "2018"), ("SiteID", None), ("SiteID", "ML1"), ("Date", "31/02/2018"), ("Weather", None),
        ("Time", "25:00:00"), ("Day", "Someday"), ("Direction", "North"), ("Path", None), ("Count", "-1"), ("Count", "n/a"),
    ]:
        row = list(good)
        row[STREAM_FIELDS.index(field)] = value
        out += [row, row] if field == "Path" else [row]
    return spark.createDataFrame([tuple(r) for r in out], RAW_STREAM)


def test_probe_report(spark, tmp_path):
    path = tmp_path / "suite.json"
    path.write_text(json.dumps(PROBE_SUITE))
    df = spark.createDataFrame(READINGS, "probe string, taken_on string, clock string, depth string, gate string, note string")
    report = suite.report(df, checks.load_checks(str(path))).collect()
    # notes: 12 odd rows are by a robot, of which row 11 is empty
    # depths: 0, 6, 12, 18 and 24 below ground, and row 1, which is at -1; row 4 has none
    # clocks: 0, 7, 14 and 21 have no seconds, and the hour of row 24 is none
    # days: 28 to 32 of each month, February (rows 5 to 9) has 28 and April (15 to 19) 30
    days = sum(not 1 <= 28 + i % 5 <= (31, 28, 31, 30, 31)[i // 5] for i in range(25))
    expected = [
        ("note", "Conformity", "match_regex", 12),
        ("depth", "Plausibility", "be_between", 6),
        ("depth", "Completeness", "not_be_null", 1),
        ("clock", "Conformity", "match_strftime_format", 4 + 1),
        ("taken_on", "Conformity", "match_strftime_format", days),
        ("probe", "Identity", "be_unique", 4),
        ("probe", "Completeness", "not_be_null", 2),
        ("gate", "Conformity", "be_in_set", 10),
    ]
    prefix = len("expect_column_values_to_")
    assert [(r[0], r[1], r["expectation_type"][prefix:], r["unexpected_count"]) for r in report] == expected
    assert {r["element_count"] for r in report} == {25} and {r["status"] for r in report} == {"FAILED"}
    assert [r["unexpected_percent"] + r["percent"] for r in report] == [100.0] * 8 and report[0]["percent"] == pytest.approx(52)
    assert suite.report(df.where("note like '%crew%'"), checks.load_checks(str(path))).collect()[0]["status"] == "PASSED"


def test_empty_data_passes_with_zero_percent(spark):
    df = spark.createDataFrame([], string_schema(["x"]))
    report = suite.report(df, [Check("x", "check_if_not_null", "C"), Check("x", "check_if_unique", "U")]).collect()
    assert [(r["status"], r["element_count"], r["unexpected_percent"], r["percent"]) for r in report] == [
        ("PASSED", 0, 0.0, 100.0)
    ] * 2


@pytest.mark.parametrize(
    "rule, params, values, bad",
    [
        ("check_if_not_null", {}, ["a", None, ""], [None]),
        ("check_if_values_in_list", {"value_set": ["a", None]}, ["a", "b", None], ["b"]),
        ("check_if_matches_regex", {"regex_pattern": "b"}, ["abc", "xyz", None], ["xyz"]),
        (
            "check_if_matches_regex",
            {"regex_pattern": WAVE_PATTERN},
            ["2018 Q1 (Jan-Mar)", "2018 Q2 spring (Apr-Jun)", "zzApr-Junzz", "2018 Q1"],
            ["2018 Q1"],
        ),
        (
            "check_if_valid_date_format",
            {"date_format": "%d/%m/%Y"},
            ["01/02/2018", "1/2/2018", "31/02/2018", "2018/01/01", None],
            ["31/02/2018", "2018/01/01"],
        ),
        ("check_if_valid_time_format", {"time_format": "%H:%M:%S"}, ["07:15:00", "7:15", None], ["7:15"]),
        ("check_if_greater_than_or_equal_to", {"min_value": 0}, ["0", "2.5", "-1", "n/a", None], ["-1", "n/a"]),
    ],
)
def test_rule_semantics(spark, rule, params, values, bad):
    assert bad_values(spark, Check("x", rule, "V", params), values) == bad


@pytest.mark.parametrize(
    "rule, key", [("check_if_matches_regex", "regex_pattern"), ("check_if_valid_date_format", "date_format"),
                  ("check_if_valid_time_format", "time_format"), ("check_if_greater_than_or_equal_to", "min_value")]
)
def test_missing_parameters_are_errors(rule, key, spark):
    with pytest.raises(ValueError, match=key):
        checks.violation(Check("x", rule, "V"))


def test_missing_value_set_and_unknown_rule(spark):
    with pytest.raises(KeyError, match="value_set"):
        checks.violation(Check("x", "check_if_values_in_list", "V"))
    with pytest.raises(KeyError, match="check_if_unique"):
        checks.violation(Check("x", "check_if_prime", "V"))


def test_registered_check_runs(spark):
    checks.register_check("check_if_short", "expect_short_values", lambda col, check: F.length(col) > check.params["n"])
    try:
        assert bad_values(spark, Check("x", "check_if_short", "V", {"n": 2}), ["ab", "abc", None]) == ["abc"]
    finally:
        del checks.RULES["check_if_short"]


def test_every_copy_of_a_repeated_value_violates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id int, x string")
    check = Check("x", "check_if_unique", "U")
    assert rows(suite.quarantine(df, [check]), "id") == [(1,), (2,)]
    assert rows(suite.suite_counts(df, [check]), "unexpected_count", "element_count") == [(2, 5)]


@pytest.mark.parametrize("hot_keys", [1, 2, 100])
def test_attach_counts_with_hot_and_null_keys(spark, rows, hot_keys):
    data = [("hot", i) for i in range(60)] + [("warm", i) for i in range(5)] + [("cold", 0), (None, 1), (None, 2)]
    df = spark.createDataFrame(data, "k string, i int").repartition(5)
    counts = df.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    out = Counter((r["k"], r["n"]) for r in attach_counts(df, counts, "k", "n", hot_keys).collect())
    assert out == {("hot", 60): 60, ("warm", 5): 5, ("cold", None): 1, (None, None): 2}


def test_split_keeps_every_row_once(spark):
    df = records(spark)
    unique = [*COUNT_CHECKS, Check("SiteID", "check_if_unique", "Uniqueness")]
    for suite_checks in (COUNT_CHECKS, unique):
        clean = [tuple(r) for r in suite.clean(df, suite_checks).collect()]
        held = [tuple(r) for r in suite.quarantine(df, suite_checks).drop(suite.FAILED).collect()]
        assert Counter(clean) + Counter(held) == Counter(tuple(r) for r in df.collect())
        assert suite.check_counts(spark.createDataFrame(clean, RAW_STREAM), COUNT_CHECKS).agg(
            F.sum("unexpected_count")
        ).first()[0] in (0, None)


def test_flags_agree_with_single_checks(spark):
    df = records(spark)
    together = Counter(r["check_name"] for r in suite.violations(df, COUNT_CHECKS).collect())
    alone = {c.name: suite.quarantine(df, [c]).count() for c in COUNT_CHECKS}
    assert dict(together) == {name: n for name, n in alone.items() if n}
    counted = {r["check_name"]: r["unexpected_count"] for r in suite.suite_counts(df, COUNT_CHECKS).collect()}
    assert counted == alone


def test_rows_that_violate_every_failing_check(spark, rows):
    df = spark.createDataFrame([(None, "z"), ("a", "z"), (None, "b")], "x string, y string")
    both = [Check("x", "check_if_not_null", "C"), Check("y", "check_if_values_in_list", "V", {"value_set": ["b"]})]
    assert rows(suite.violating_all(df, both)) == [(None, "z")]
    assert suite.violating_all(df.where("x = 'q'"), both).count() == 0


def test_audit_counts_copies(spark):
    held = suite.quarantine(records(spark), COUNT_CHECKS).withColumn("topic", F.lit("Central"))
    audit = suite.audit_rows(held, 4).collect()
    assert {r["n_copies"] for r in audit if r["Path"] is None} == {2}
    assert len({r["row_id"] for r in audit}) == len(audit)
    assert {(r["topic"], r["batch_id"]) for r in audit} == {("Central", 4)}


def test_samples_are_bounded(spark, rows):
    df = spark.createDataFrame([(v,) for v in "aabbbcd"], "x string")
    check = Check("x", "check_if_values_in_list", "V", {"value_set": ["d"]})
    assert rows(suite.samples(df, [check], 2), "value", "n_rows") == [("a", 2), ("b", 3)]


def test_actions(spark, rows):
    df = records(spark)
    outcomes = {r["check_name"]: r["outcome"] for r in suite.route_actions(df, COUNT_CHECKS, catalogue(spark)).collect()}
    assert outcomes["SiteID_check_if_not_null"] == "fail_batch"
    assert outcomes["SiteID_check_if_matches_regex"] == "quarantine_rows"
    assert outcomes["Weather_check_if_not_null"] == "accept_and_log"
    assert outcomes["Date_check_if_not_null"] == "none"
    inactive = catalogue(spark).withColumn("status", F.lit("I"))
    assert suite.route_actions(df, COUNT_CHECKS, inactive).count() == 0
    actions = {"SiteID_check_if_not_null": "F", "Count_check_if_greater_than_or_equal_to": "R", "Path_check_if_not_null": "A"}
    routes = Counter(r["route"] for r in suite.routed(df, COUNT_CHECKS, actions).collect())
    assert routes == {"fail": 1, "quarantine": 2, "accept": df.count() - 3}


def test_by_dimension(spark):
    rolled = {r["dimension"]: r for r in suite.by_dimension(suite.report(records(spark), COUNT_CHECKS)).collect()}
    assert rolled["Completeness"]["n_checks"] == 7 and rolled["Completeness"]["n_failed"] == 3
    assert rolled["Validity"]["n_checks"] == 7 and rolled["Validity"]["n_failed"] == 7


def test_contract(spark, rows):
    schema = string_schema(["a", "b"])
    df = spark.createDataFrame([("x", "y"), ("", "y"), (None, "y")], schema)
    assert rows(contract.contract_report(df, schema)) == [("a", 2, 3), ("b", 0, 3)]
    with pytest.raises(ValueError, match="c"):
        contract.contract_report(df, string_schema(["a", "c"]))
    assert contract.require_contract(df.limit(1), schema).count() == 1
    with pytest.raises(Exception, match="field a is missing"):
        contract.require_contract(df, schema).collect()


def test_typed_contract(spark, rows):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    assert rows(contract.contract_report(df, schema)) == [("n", 1, 2)]


def test_orphans(spark, rows):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(contract.orphan_keys(child, "k", parent, "id")) == [("b", 2, "warn")]


def test_checks_of_one_pair_have_names_of_their_own(spark):
    rule = {"rule_name": "check_if_matches_regex", "rule_dimension": "Validity"}
    config = {"columns": [{"column_name": "c", "dq_rule(s)": [rule | {"add_info": {"regex_pattern": p}} for p in ("^a", "b$")]}]}
    made = checks.checks_from_config(config)
    assert [c.name for c in made] == ["c_check_if_matches_regex", "c_check_if_matches_regex_2"]
    df = spark.createDataFrame([("ab",), ("ax",), ("xb",), ("zz",)], "c string")
    counts = {r.check_name: r.unexpected_count for r in suite.suite_counts(df, made).collect()}
    assert list(counts.values()) == [2, 2]
    assert [r.c for r in suite.violating_all(df, made).collect()] == ["zz"]


def test_checks_that_the_catalogue_lacks_stay(spark):
    made = [Check("c", "check_if_not_null", "Completeness"), Check("d", "check_if_not_null", "Completeness")]
    df = spark.createDataFrame([(None, None)], "c string, d string")
    listed = spark.createDataFrame([("c_check_if_not_null", 1, "A", "F", "high")], "rule_name string, rule_key long, status string, action string, risk_level string")
    got = {r.check_name: r.outcome for r in suite.route_actions(df, made, listed).collect()}
    assert got == {"c_check_if_not_null": "fail_batch", "d_check_if_not_null": "not_listed"}

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tallymill.functions import text, times
from tallymill.functions.keys import NULL_TOKEN, surrogate_key


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "strftime, pattern",
    [("%d/%m/%Y", "d/M/yyyy"), ("%H:%M:%S", "H:m:s"), ("%Y-%m-%dT%H", "yyyy-M-d'T'H"), ("100%%", "100%")],
)
def test_strftime_becomes_a_spark_pattern(strftime, pattern):
    assert times.spark_pattern(strftime) == pattern


def test_unknown_directive_is_an_error():
    with pytest.raises(ValueError, match="%Q"):
        times.spark_pattern("%Q")


@pytest.mark.parametrize(
    "value, expected",
    [
        ("01/02/2018", dt.date(2018, 2, 1)),
        ("1/2/2018", dt.date(2018, 2, 1)),
        ("31/02/2018", None),
        ("2018-02-01", None),
        ("", None),
    ],
)
def test_dates_are_day_first_and_lenient(spark, value, expected):
    assert one(spark, times.parse_date(F.lit(value))) == expected


def test_strict_parsing_raises(spark):
    with pytest.raises(Exception, match="(?i)parse"):
        one(spark, times.parse_date(F.lit("31/02/2018"), strict=True))


def test_time_of_day_is_on_the_first_day(spark):
    assert one(spark, times.parse_time_of_day(F.lit("07:15:00"))) == dt.datetime(1970, 1, 1, 7, 15)
    assert one(spark, times.parse_time_of_day(F.lit("25:00:00"))) is None


@pytest.mark.parametrize("listed, day", [("Nov 18th 2024", 18), ("Nov 1st 2024", 1), ("Nov 2nd 2024", 2), ("Nov 3rd 2024", 3)])
def test_listing_times(spark, listed, day):
    parsed = one(spark, times.parse_listing_time(F.lit(f"{listed}, 10:05:07 PM")))
    assert parsed == dt.datetime(2024, 11, day, 22, 5, 7)


def test_wave_parts(spark):
    wave = F.lit("2018 Q2 spring (Apr-Jun)")
    assert one(spark, text.wave_year(wave)) == "2018"
    assert one(spark, text.wave_quarter(wave)) == "Q2"
    assert one(spark, text.wave_quarter(F.lit("2018"))) == ""
    assert one(spark, text.wave_quarter(F.lit("2018 Q1(Jan-Mar)"))) == "Q1"


@pytest.mark.parametrize(
    "name, parts",
    [
        ("2018 Q2 spring (Apr-Jun)-Central.csv", ("2018", "Q2", "spring", "(Apr-Jun)", "Central", "2018/Q2-(Apr-Jun)")),
        ("2020 Q2 spring (synthetic)-Inner.csv", ("2020", "Q2", "spring", "(synthetic)", "Inner", "2020/Q2-(synthetic)")),
        ("2019 Q1 (Jan-Mar)-Cycleways.csv", ("2019", "Q1", None, "(Jan-Mar)", "Cycleways", "2019/Q1-(Jan-Mar)")),
        ("readme.csv", (None,) * 6),
    ],
)
def test_file_name_parts(spark, name, parts):
    found = spark.range(1).select(*[c.alias(n) for n, c in text.file_name_parts(F.lit(name)).items()]).first()
    assert tuple(found) == parts


def test_file_name_is_built_and_quoted(spark):
    name = text.file_name(F.lit("2018"), F.lit("Q4"), F.lit("autumn"), F.lit("(Oct-Dec)"), F.lit("Central"))
    assert one(spark, name) == "2018 Q4 autumn (Oct-Dec)-Central.csv"
    assert one(spark, text.quote_spaces(name)) == "2018%20Q4%20autumn%20(Oct-Dec)-Central.csv"
    assert one(spark, text.normalise_name(name)) == "2018_Q4_autumn_Oct-Dec-Central.csv"
    plain = text.file_name(F.lit("2018"), F.lit("Q1"), F.lit(None).cast("string"), F.lit("(Jan-Mar)"), F.lit("Inner"))
    assert one(spark, plain) == "2018 Q1 (Jan-Mar)-Inner.csv"


def test_label_replace_needs_a_whole_match(spark):
    pattern = r"([0-9]+.[0-9]+.[0-9]+).*"
    assert one(spark, text.label_replace(F.lit(""), F.lit("5.4.0-generic"), pattern, "$1")) == "5.4.0"
    assert one(spark, text.label_replace(F.lit("kept"), F.lit("v5.4.0"), pattern, "$1")) == "kept"


def test_surrogate_key_marks_nulls(spark):
    key = one(spark, surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(3)))
    assert key == hashlib.md5(f"a-{NULL_TOKEN}-3".encode()).hexdigest()

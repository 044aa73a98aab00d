"""Scalar expressions against worked examples."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from rowharbor.functions import text
from rowharbor.functions.cells import clean_cell
from rowharbor.functions.patterns import DEFAULT_TIME_FORMATS
from rowharbor.functions.temporal import parse_fixed, parse_floating


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_comma_split(spark):
    cases = {
        "": [], "   ": [], "a": ["a"], "  a  ": ["a"], "a,b": ["a", "b"],
        "  a  ,  b   ": ["a", "b"], "a\\,b": ["a,b"], "a\\\\,b": ["a\\", "b"], "a,": ["a", ""],
        ",": ["", ""], "a\\": ["a\\"], "a\\\\": ["a\\"], "a\nb,c": ["a\nb", "c"], "\\a": ["a"],
    }
    assert apply(spark, list(cases), text.comma_split) == list(cases.values())


def test_comma_join_and_back(spark):
    lists = [[], ["  abc  ", " def "], ["abc", "d,e"], ["a\\b", "c"]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<string>")
    joined = df.orderBy("i").select(text.comma_join(F.col("v")).alias("j"))
    assert [r.j for r in joined.collect()] == ["", "abc, def", "abc, d\\,e", "a\\\\b, c"]
    back = joined.select(text.comma_split(F.col("j"))).collect()
    assert [r[0] for r in back] == [[], ["abc", "def"], ["abc", "d,e"], ["a\\b", "c"]]


def test_ordinal(spark):
    numbers = [1, 2, 3, 4, 11, 12, 13, 21, 22, 101, 111, 0]
    want = "1st 2nd 3rd 4th 11th 12th 13th 21st 22nd 101st 111th 0th".split()
    assert apply(spark, numbers, text.ordinal, "int") == want


def test_paths_and_links(spark):
    assert apply(spark, ["a.CSV", "a.b/c.tsv", "none", ".hidden", "a."], text.file_extension) == [
        "csv", "tsv", "", "", ""]
    assert apply(spark, ["/x/y.csv", "y.csv", "/x/y/"], text.file_name) == ["y.csv", "y.csv", "y"]
    assert apply(spark, ["https://a.b/c?d", "a.b", "http://a.b:80#x"], text.url_host) == [
        "a.b", "a.b", "a.b:80"]


def test_uid_version_title(spark):
    uids = ["abcd-1234", "ABCD-1234", "abcd-123", "abcd-12345", "abcd-1234\n", None]
    assert apply(spark, uids, text.uid_valid) == [True, False, False, False, False, False]
    assert apply(spark, ["v1.5.2-b", "1.5", "x"], text.strip_version) == ["1.5.2", "1.5", ""]
    assert apply(spark, ["abc", "", "Éa"], text.capitalise_first) == ["Abc", "", "Éa"]


@pytest.mark.parametrize("trim,null,want", [
    (True, True, [None, "a", None, None]), (False, True, ["  ", "\ta ", None, None]),
    (True, False, ["", "a", "", ""]),
])
def test_clean_cell(spark, trim, null, want):
    assert apply(spark, ["  ", "\ta ", "", None], lambda c: clean_cell(c, trim, null)) == want


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_floating_does_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = ["04/30/2011", "4/3/11", "2011-04-30", "2011-04-30T10:11:12.5", "30-Apr-2011",
                  "04/30/2011 01:02:03 PM", "04/30/2011 01:02:03 PM -0800", "03/13/2011 02:30:00 AM",
                  "soon", "", None, "2011", "13/13/2011"]
        got = apply(spark, values, lambda c: parse_floating(c, DEFAULT_TIME_FORMATS))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [
        datetime(2011, 4, 30), datetime(2011, 4, 3), datetime(2011, 4, 30),
        datetime(2011, 4, 30, 10, 11, 12, 500000), datetime(2011, 4, 30),
        datetime(2011, 4, 30, 13, 2, 3), datetime(2011, 4, 30, 13, 2, 3),
        datetime(2011, 3, 13, 2, 30), None, None, None, None, None,
    ]


@pytest.mark.parametrize("session", ["UTC", "Asia/Kolkata"])
def test_fixed(spark, session):
    def at(*parts):
        return int(datetime(*parts, tzinfo=timezone.utc).timestamp() * 1_000_000)

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        values = ["2011-04-30T10:00:00Z", "2011-04-30T10:00:00+02:00", "2011-04-30 10:00:00",
                  "2011-04-30", "04/30/2011 10:00:00 AM +0100", "04/30/2011 10:00:00 AM", "no"]
        got = apply(spark, values,
                    lambda c: F.unix_micros(parse_fixed(c, DEFAULT_TIME_FORMATS, "PDT")))
        rome = apply(spark, ["2011-07-01 10:00:00", "01/01/2011"],
                     lambda c: F.unix_micros(parse_fixed(c, DEFAULT_TIME_FORMATS, "Europe/Rome")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [
        at(2011, 4, 30, 10), at(2011, 4, 30, 8), at(2011, 4, 30, 17), at(2011, 4, 30, 7),
        at(2011, 4, 30, 9), at(2011, 4, 30, 17), None,
    ]
    assert rome == [at(2011, 7, 1, 8), at(2010, 12, 31, 23)]


def test_other_patterns(spark):
    def one(value, pattern):
        return apply(spark, [value], lambda c: parse_floating(c, [pattern]))[0]

    assert one("04/2011", "MM/YYYY") == datetime(2011, 4, 1)
    assert one("20110430", "yyyyMMdd") == datetime(2011, 4, 30)
    assert one("2011-04-30T23", "yyyy-MM-dd'T'HH") == datetime(2011, 4, 30, 23)
    assert one("10:11:12.345 30/04/2011", "HH:mm:ss.SSS dd/MM/yyyy") == datetime(
        2011, 4, 30, 10, 11, 12, 345000)

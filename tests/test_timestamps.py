"""Time texts: notations, zones, policies, dirt."""

import pytest
from pyspark.sql import functions as F

from veilwright.operators.timestamps import normalise_times, with_utc_text

CASES = [
    ("2024-01-02 03:04:05", "America/New_York", "MDY", "2024-01-02T08:04:05.000000Z"),
    ("  2024-01-02T03:04:05.123456789Z\t", "America/New_York", "MDY", "2024-01-02T03:04:05.123456Z"),
    ("2024-07-02T03:04:05+05:30", None, None, "2024-07-01T21:34:05.000000Z"),
    ("2019-08-07T22:43:42+10:00[Australia/Sydney]", "UTC", "DMY", "2019-08-07T12:43:42.000000Z"),
    ("20240102030405-0500", "UTC", "DMY", "2024-01-02T08:04:05.000000Z"),
    ("20240102", "Asia/Kolkata", "DMY", "2024-01-01T18:30:00.000000Z"),
    ("02/03/2024 10:00", "UTC", "MDY", "2024-02-03T10:00:00.000000Z"),
    ("02/03/2024 10:00", "UTC", "DMY", "2024-03-02T10:00:00.000000Z"),
    ("02.03.2024 10:00:01", None, None, "2024-03-02T10:00:01.000000Z"),
    ("1/17/19 21:18", "UTC", "MDY", "2019-01-17T21:18:00.000000Z"),
    ("17-APR-2024 03:04:20", "UTC", "DMY", "2024-04-17T03:04:20.000000Z"),
    ("Sun, 31 Oct 2010 08:16:55 +0100", None, None, "2010-10-31T07:16:55.000000Z"),
    ("February 19, 2013 at 5:49 PM", "UTC", "DMY", "2013-02-19T17:49:00.000000Z"),
    ("11 Mar 2012 12:14 a.m.", "UTC", "DMY", "2012-03-11T00:14:00.000000Z"),
    ("June 3, 2017", "UTC", "DMY", "2017-06-03T00:00:00.000000Z"),
    ("1590215782988", "Australia/Sydney", "DMY", "2020-05-23T06:36:22.988000Z"),
    ("/Date(1580143787777)/", None, None, "2020-01-27T16:49:47.777000Z"),
    ("1540736339", None, None, "2018-10-28T14:18:59.000000Z"),
    ("2020-01-26 21:37:12,538", "UTC", "DMY", "2020-01-26T21:37:12.538000Z"),
    # twice: the first of the two; with the abbreviation the one it says
    ("2021-11-07 01:30:00", "America/New_York", "MDY", "2021-11-07T05:30:00.000000Z"),
    ("2021-11-07 01:30:00 EST", "America/New_York", "MDY", "2021-11-07T06:30:00.000000Z"),
    # skipped: forward by the skipped length
    ("2021-03-14 02:30:00", "America/New_York", "MDY", "2021-03-14T07:30:00.000000Z"),
    ("2021-01-01 00:00:00 CST", "Asia/Shanghai", "DMY", "2020-12-31T16:00:00.000000Z"),
    ("2021-01-01 00:00:00 CST", "America/Chicago", "MDY", "2021-01-01T06:00:00.000000Z"),
    ("2024-01-02 03:04:05", "No/Such_Zone", "DMY", "2024-01-02T03:04:05.000000Z"),
    *[(x, "UTC", "DMY", None) for x in ("", "  ", "n/a", "0000-00-00 00:00:00", "0000-00-00", "2021-02-30 10:15:00", "20231345091500", "25:61", "31/31/2022 08:00", "2019-13-05", "13 Jan 2020 13:00 pm", "2020-01-01 24:01:00", "NULL", "2021-01-01 00:00:00 XQZ", "x" * 50_000)],
    (None, "UTC", "DMY", None),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, *c, 1, 2) for i, c in enumerate(CASES)], "i int, t string, tz string, o string, want string, _t int, _p int")
    got = with_utc_text(df, "t", F.col("tz"), F.col("o")).orderBy("i").collect()
    assert [(r["t"], r["utc_ts"]) for r in got] == [(c[0], c[3]) for c in CASES]


@pytest.mark.parametrize(("a", "n", "want"), [("last", "forward", ["2021-11-07T06:30:00.000000Z", "2021-03-14T07:30:00.000000Z"]), ("null", "null", [None, None])])
def test_policies(spark, a, n, want):
    df = spark.createDataFrame([("2021-11-07 01:30:00",), ("2021-03-14 02:30:00",)], "t string").coalesce(1)
    got = with_utc_text(df, "t", F.lit("America/New_York"), F.lit("MDY"), ambiguous=a, nonexistent=n).collect()
    assert [r["utc_ts"] for r in got] == want
    with pytest.raises(ValueError, match="policy"):
        with_utc_text(df, "t", F.lit("UTC"), F.lit("MDY"), ambiguous="other")


def test_clocks_that_go_back_half_an_hour(spark):
    df = spark.createDataFrame([("2021-04-04 01:45:00",), ("2021-04-04 01:15:00",)], "t string").coalesce(1)
    got = {a: [r["utc_ts"] for r in with_utc_text(df, "t", F.lit("Australia/Lord_Howe"), F.lit("MDY"), ambiguous=a).collect()] for a in ("first", "last", "null")}
    assert got == {"first": ["2021-04-03T14:45:00.000000Z", "2021-04-03T14:15:00.000000Z"], "last": ["2021-04-03T15:15:00.000000Z", "2021-04-03T14:15:00.000000Z"], "null": [None, "2021-04-03T14:15:00.000000Z"]}


def test_operator_with_repeats_and_unknown_places(spark):
    places = spark.createDataFrame([(1, "Asia/Kolkata", "DMY"), (1, "Asia/Kolkata", "DMY"), (None, "UTC", "MDY")], "facilityid int, tz_name string, date_order string")
    rows = spark.createDataFrame([(7, "2024-01-01 00:00:00", 1), (7, "2024-01-01 00:00:00", 1), (8, "2024-01-01 00:00:00", 99), (9, None, 1), (None, "2024-01-01", None)], "id bigint, t string, facilityid int")
    got = {tuple(r) for r in normalise_times(rows, "id", "t", "facilityid", places).collect()}
    assert got == {(7, "2023-12-31T18:30:00.000000Z"), (8, "2024-01-01T00:00:00.000000Z"), (None, "2024-01-01T00:00:00.000000Z")}
    assert normalise_times(rows.limit(0), "id", "t", "facilityid", places).count() == 0

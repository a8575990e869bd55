"""Dates and times against a plain parser and the zone data of Python."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from albaran.operators.timestamps import normalise_dates

SITES = [("mad", "Europe/Madrid", "DMY"), ("nyc", "America/New_York", "MDY"), ("lim", "America/Lima", "DMY")]
CASES = [
    ("mad", "2023-02-03", "2023-02-03"),
    ("mad", "03/02/2023", "2023-02-03"),
    ("nyc", "03/02/2023", "2023-03-02"),
    ("nyc", "25/12/2022", "2022-12-25"),
    (None, "25/12/2022", "2022-12-25"),
    (None, "05/05/2023", "2023-05-05"),
    (None, "03/02/2023", None),
    ("mad", "31/02/2024", None),
    ("mad", "29/02/2024", "2024-02-29"),
    ("mad", "29/02/2023", None),
    ("mad", "2023/2/1", "2023-02-01"),
    ("mad", "18-Dec-22", "2022-12-18"),
    ("lim", "11 DE FEBRERO DE 2023", "2023-02-11"),
    ("mad", "28. März 2024", "2024-03-28"),
    ("mad", "3 août 2023", "2023-08-03"),
    ("nyc", "February 12, 2023", "2023-02-12"),
    ("mad", "Fecha: 2023-03-19", "2023-03-19"),
    ("mad", "el 23/01/2023 ", "2023-01-23"),
    ("mad", "\t2O23-O4-07", "2023-04-07"),
    ("mad", "20230201", "2023-02-01"),
    ("mad", "44920", "2022-12-25"),
    ("mad", "1676309461", "2023-02-13T17:31:01Z"),
    ("mad", "1674988257393", "2023-01-29T10:30:57Z"),
    ("mad", "2023-01-11T06:44:31Z", "2023-01-11T06:44:31Z"),
    (None, "2023-02-12T23:30:03+01:00", "2023-02-12T22:30:03Z"),
    ("mad", "Thu, 09 Feb 2023 10:59:28 -0500", "2023-02-09T15:59:28Z"),
    ("nyc", "08-Feb-2023 2:53 PM", "2023-02-08T19:53:00Z"),
    ("nyc", "08-Feb-2023 12:05 AM", "2023-02-08T05:05:00Z"),
    ("mad", "2023-01-29 04:18:31 America/Bogota", "2023-01-29T09:18:31Z"),
    (None, "2023-01-29 04:18:31[Europe/Madrid]", "2023-01-29T03:18:31Z"),
    ("lim", "2023-01-16 01:37 EST", "2023-01-16T06:37:00Z"),
    ("lim", "2023-03-30 05:28:51 UTC+1", "2023-03-30T04:28:51Z"),
    ("mad", "2024-03-31 02:30:00", "2024-03-31T01:30:00Z"),  # skipped hour moves forward
    ("mad", "2023-10-29 02:30:00", "2023-10-29T00:30:00Z"),  # earlier of two
    ("nyc", "2023-11-05 01:30:00", "2023-11-05T05:30:00Z"),
    (None, "2023-11-05 01:30:00", None),
    ("mad", "2023-02-03 25:00:00", None),
    ("mad", "20221204032614", "2022-12-04T02:26:14Z"),
    ("mad", "2023-02-03T18:05:29.280707", "2023-02-03T17:05:29Z"),
    ("mad", "Q3", None),
    ("mad", "2024", None),
    ("mad", "30 días", None),
    ("mad", "2031-01-01", None),
    ("mad", "", None),
    ("mad", None, None),
    ("mad", "x" * 20000, None),
]


@pytest.fixture(scope="module")
def sites(spark):
    return spark.createDataFrame(SITES, "site_code string, tz_name string, date_order string")


def test_cases(spark, sites):
    rows = spark.createDataFrame([(i, s, v) for i, (s, v, _) in enumerate(CASES)], "rec_id long, site_code string, v string")
    got = {r["rec_id"]: r["norm"] for r in normalise_dates(rows, "v", sites).collect()}
    wrong = [(CASES[i], got[i]) for i in range(len(CASES)) if got[i] != CASES[i][2]]
    assert not wrong


def test_every_wall_hour_of_a_year_against_zone_data(spark, sites):
    start = datetime(2024, 1, 1)
    walls = [start + timedelta(minutes=30 * i) for i in range(0, 366 * 48, 7)]
    rows = [(i, s, w.strftime("%Y-%m-%d %H:%M:%S")) for s in ("mad", "nyc") for i, w in enumerate(walls)]
    got = {(r["site_code"], r["k"]): r["norm"] for r in normalise_dates(spark.createDataFrame(rows, "k long, site_code string, v string"), "v", sites).collect()}
    zone = {s: ZoneInfo(z) for s, z, _ in SITES}
    for s in ("mad", "nyc"):
        for i, w in enumerate(walls):
            utc = w.replace(tzinfo=zone[s], fold=0).astimezone(timezone.utc)
            assert got[(s, i)] == utc.strftime("%Y-%m-%dT%H:%M:%SZ")


def test_empty_table_and_clashing_columns(spark, sites):
    rows = spark.createDataFrame([], "site_code string, v string, tz_name string, date_order string, y int")
    out = normalise_dates(rows, "v", sites)
    assert out.columns == ["site_code", "v", "tz_name", "date_order", "y", "norm"] and out.count() == 0

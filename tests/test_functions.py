import datetime as dt

import pytest
from pyspark.sql import functions as F

from boardlake.functions.dates import (board_date, idle_filter, last_updated, parse_date_arg,
                                       range_filter)
from boardlake.functions.text import member_match
from conftest import rows


def test_board_date_spellings(spark):
    names = ["S (14-Sept-2022)", "S (4-JAN-2023)", "S (14-Sep2022)", "S (archive)", "S ()", "S",
             "S (31-Feb-2023)", "S (1-march-2021) (2-Jan-2020)", None, "S (7-Jan-22)"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = dict((r[0], r[1]) for r in df.select("name", board_date("name")).collect())
    assert got["S (14-Sept-2022)"] == dt.date(2022, 9, 14)
    assert got["S (4-JAN-2023)"] == dt.date(2023, 1, 4)
    assert got["S (14-Sep2022)"] == dt.date(2022, 9, 14)
    assert got["S (1-march-2021) (2-Jan-2020)"] == dt.date(2021, 3, 1)   # first parentheses
    for bad in ["S (archive)", "S ()", "S", "S (31-Feb-2023)", None, "S (7-Jan-22)"]:
        assert got[bad] is None, bad


def _activity(spark):
    data = [(1, dt.datetime(2023, 1, 6, 0, 0)), (2, dt.datetime(2023, 1, 8, 0, 0)),
            (3, dt.datetime(2023, 1, 8, 12, 0)), (4, dt.datetime(2023, 1, 5, 23, 59)),
            (5, None)]
    return spark.createDataFrame(data, "id long, ts timestamp")


@pytest.mark.parametrize("bounds,expected", [
    ("closed_ts", [1, 2]),
    ("open_ts", []),
    ("closed_date", [1, 2, 3]),
])
def test_range_bounds(spark, bounds, expected):
    df = _activity(spark)
    got = [r[0] for r in rows(range_filter(df, "ts", "2023-01-06", "2023-01-08", bounds), "id")]
    assert got == expected


def test_range_bounds_ntz(spark):
    df = _activity(spark).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = [r[0] for r in rows(range_filter(df, "ts", "2023-01-06", "2023-01-08", "closed_date"), "id")]
    assert got == [1, 2, 3]


def test_range_optional(spark):
    df = _activity(spark)
    assert range_filter(df, "ts", "2023-01-06", None).count() == 5
    assert range_filter(df, "ts", None, "2023-01-06").count() == 5


def test_range_day_first(spark):
    df = _activity(spark)
    got = [r[0] for r in rows(range_filter(df, "ts", "06-01-2023", "08-01-2023", "closed_ts",
                                           date_format="%d-%m-%Y"), "id")]
    assert got == [1, 2]


def test_date_arg_rejects_bad_text():
    with pytest.raises(ValueError):
        parse_date_arg("2023-13-01")
    assert parse_date_arg("31-12-2022", "%d-%m-%Y") == dt.date(2022, 12, 31)


def test_range_pushes_to_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    _activity(spark).write.parquet(path)
    df = spark.read.parquet(path)
    plan = range_filter(df, "ts", "2023-01-06", "2023-01-08", "closed_date")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_idle_is_strict(spark):
    as_of = dt.datetime(2023, 1, 10)
    data = [(1, dt.datetime(2023, 1, 3)), (2, dt.datetime(2023, 1, 2, 23, 59)), (3, None)]
    df = spark.createDataFrame(data, "id long, ts timestamp")
    assert [r[0] for r in rows(idle_filter(df, "ts", 7, as_of), "id")] == [2]


def test_idle_default_now(spark):
    df = spark.createDataFrame([(1, dt.datetime(2000, 1, 1)), (2, dt.datetime(2999, 1, 1))],
                               "id long, ts timestamp")
    assert [r[0] for r in rows(idle_filter(df, "ts", 1), "id")] == [1]


def test_last_updated(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 5, 23, 30),), (None,)], "ts timestamp")
    assert rows(df.select(last_updated("ts"))) == [("05-01-2023",), (None,)]


def test_member_match(spark):
    df = spark.createDataFrame([("Ann Lee, Bob_Ray",), ("ann lee",), ("BobXRay",)], "m string")
    contains = [r[0] for r in rows(df.where(member_match("m", "Ann Lee", "contains")), "m")]
    assert contains == ["Ann Lee, Bob_Ray"]
    like = [r[0] for r in rows(df.where(member_match("m", "Bob_Ray", "like")), "m")]
    assert like == ["Ann Lee, Bob_Ray", "BobXRay"]
    lit = [r[0] for r in rows(df.where(member_match("m", "Bob_Ray", "contains")), "m")]
    assert lit == ["Ann Lee, Bob_Ray"]
    across = [r[0] for r in rows(df.where(member_match("m", "Lee, Bob", "contains")), "m")]
    assert across == ["Ann Lee, Bob_Ray"]


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_minutes = st.lists(st.integers(0, 14 * 24 * 60), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(offsets=_minutes, a=st.integers(0, 13), span=st.integers(0, 5))
def test_range_variants_nest(spark, offsets, a, span):
    """open_ts is inside closed_ts, which is inside closed_date."""
    base = dt.datetime(2023, 1, 1)
    df = spark.createDataFrame([(i, base + dt.timedelta(minutes=m)) for i, m in enumerate(offsets)],
                               "id long, ts timestamp")
    start = (base + dt.timedelta(days=a)).date().isoformat()
    end = (base + dt.timedelta(days=a + span)).date().isoformat()
    got = {b: {r[0] for r in range_filter(df, "ts", start, end, b).select("id").collect()}
           for b in ("open_ts", "closed_ts", "closed_date")}
    assert got["open_ts"] <= got["closed_ts"] <= got["closed_date"]
    lo, hi = base + dt.timedelta(days=a), base + dt.timedelta(days=a + span)
    assert got["closed_date"] == {i for i, m in enumerate(offsets)
                                  if lo <= base + dt.timedelta(minutes=m) < hi + dt.timedelta(days=1)}


def test_closed_date_with_time_zone_shift(spark):
    """With a zone other than UTC the day is taken after shifting from UTC."""
    df = spark.createDataFrame([(1, dt.datetime(2023, 1, 8, 20, 0)), (2, dt.datetime(2023, 1, 5, 20, 0))],
                               "id long, ts timestamp")
    utc = [r[0] for r in rows(range_filter(df, "ts", "2023-01-06", "2023-01-08", "closed_date"), "id")]
    kolkata = [r[0] for r in rows(range_filter(df, "ts", "2023-01-06", "2023-01-08", "closed_date",
                                               tz="Asia/Kolkata"), "id")]
    assert utc == [1]          # 01-08 20:00 UTC is on the end day
    assert kolkata == [2]      # 01-05 20:00 UTC is 01-06 01:30 in Kolkata; 01-08 20:00 is 01-09

"""Edge tables for the scalar rules."""

import datetime as dt

from pyspark.sql import functions as F

from footfall.functions import (
    default_start,
    dwell_section,
    hour_date,
    hour_of_day,
    int_or_zero,
    last_n_slices,
    needs_reset,
    recency_flags,
    slice_stamp,
    stay_range,
    until_now_slices,
)
from footfall.functions.slices import needs_reset_col, stamp_window


def _one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_int_or_zero_edges(spark):
    vals = ["", " ", None, "null", "\\N", " 7 ", "\t7\t", "x1", "-3", "+4", "2147483648", "5.0"]
    got = _one_col(spark, vals, int_or_zero)
    assert got == [0, 0, 0, 0, 0, 7, 7, None, -3, 4, None, None]


def test_dwell_band_edges(spark):
    d = [0, 1, 1800, 1801, 5400, 5401, 12600, 12601, 27000, 27001, 41400, 41401, None, -1]
    got = _one_col(spark, d, dwell_section, "bigint")
    assert got == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, None, None]


def test_recency_flag_edges(spark):
    r = [30 * 60, 30 * 60 + 1, 150 * 60, 150 * 60 + 1, 1470 * 60, 1470 * 60 + 1, -5, None]
    df = spark.createDataFrame([(v,) for v in r], "r bigint")
    got = [tuple(x) for x in df.select(*recency_flags("r")).collect()]
    assert got == [(1, 1, 1), (0, 1, 1), (0, 1, 1), (0, 0, 1), (0, 0, 1), (0, 0, 0), (1, 1, 1),
                   (0, 0, 0)]
    assert all(a <= b <= c for a, b, c in got)


def test_slice_stamp_and_calendar(spark):
    got = _one_col(spark, ["20240110000000", "20240110000459", "20240110000500", "20240110235959"],
                   slice_stamp)
    assert got == ["202401100000", "202401100000", "202401100005", "202401102355"]
    df = spark.createDataFrame([(2024013123,), (2024010100,), (0,)], "h int")
    rows = df.select(hour_date("h"), hour_of_day("h")).collect()
    assert rows[0][0] == dt.date(2024, 1, 31) and rows[0][1] == 23
    assert rows[1][1] == 0
    assert rows[2][0] is None and rows[2][1] is None


def test_last_n_slices():
    assert last_n_slices("201707040017", 3) == ["201707040015", "201707040010", "201707040005"]
    assert last_n_slices("201707040003", 2) == ["201707040000", "201707032355"]


def test_until_now_slices():
    assert until_now_slices("201707040000") == []
    assert until_now_slices("201707040003") == []
    assert until_now_slices("201707040005") == ["201707040005"]
    assert until_now_slices("201707040017") == ["201707040015", "201707040010", "201707040005"]


def test_stay_range_and_default_start():
    assert stay_range("2024010723", 3) == ["2024010723", "20240108", "20240109", "20240110"]
    # Wednesday 2024-01-17 -> Monday 2024-01-15 - 8 days = Sunday 2024-01-07
    assert default_start("202401171200") == "2024010723"
    # Sunday belongs to the week that started the Monday before
    assert default_start("202401140900") == "2023123123"
    assert default_start("202401150000") == "2024010723"


def test_reset_window_edges(spark):
    n = 3
    # minutes since midnight in [15, 30) reset
    assert [needs_reset(f"20240110{m // 60:02d}{m % 60:02d}", n) for m in (14, 15, 29, 30)] == \
        [False, True, True, False]
    assert needs_reset("202401101200", 0)
    df = spark.createDataFrame([("202401100010",), ("202401100015",), ("202401100025",),
                                ("202401100030",)], "s string")
    assert [r[0] for r in df.select(needs_reset_col("s", n)).collect()] == [False, True, True, False]


def test_stamp_window():
    lo, hi = stamp_window(["2024010723", "20240108"])
    assert lo == dt.datetime(2024, 1, 7, 23) and hi == dt.datetime(2024, 1, 9)
    lo, hi = stamp_window(last_n_slices("202401100007", 3))
    assert lo == dt.datetime(2024, 1, 9, 23, 55) and hi == dt.datetime(2024, 1, 10, 0, 10)


def test_state_day(spark):
    from footfall.functions.slices import state_day, state_day_col
    assert state_day("202401110000") == "20240110"
    assert state_day("202401110005") == "20240111"
    df = spark.createDataFrame([("202401110000",), ("202401110005",), ("202401010000",)], "s string")
    assert [r[0] for r in df.select(state_day_col("s")).collect()] == ["20240110", "20240111",
                                                                       "20231231"]

"""Daily spans and presence bitmaps against the one-pass residence table."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from footfall import params as P
from footfall import registry
from footfall.functions.slices import stay_range
from footfall.plans import residence, spans
from footfall.sources import fixtures
from tests.conftest import SF_MID, SF_SMALL
from tests.helpers import dim_df, sig_row, signal_df
from tests.test_plans import NO_AUTO, _conf, _plan


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _saved(spark, rows, dim, root, days):
    for day in days:
        spans.save_day(spans.day_spans(rows.where(F.col("slice").startswith(day)), dim, dim_broadcast=False), root, day, 4)


def test_equals_the_one_pass_table_at_every_threshold(spark, tmp_root):
    rows = fixtures.signal(spark, SF_MID, dense=True, with_stamp=True)
    dim = F.broadcast(fixtures.dim_district(spark, SF_MID))
    stamps = P.STAY_RANGE_DENSE
    _saved(spark, rows, dim, tmp_root, sorted({s[:8] for s in stamps}))
    stored, found = spans.read_days(spark, tmp_root, stamps, 4), 0
    for days, match, least in itertools.product((1, 2, 3, 4), ("exact", "at_least"), (4, 3600)):
        whole = residence.residence_table(registry.select_slices(rows, stamps).drop("slice"), dim, days, match=match,
                                          min_stay_seconds=least, dim_broadcast=False)
        part = _rows(spans.residence_from_spans(stored, days, least, match))
        assert part == _rows(whole.select(*spans.residence_from_spans(stored, days).columns))
        found += len(part)
    assert found


def _tiny(spark, rows):
    """(imsi, end time, slice): the record's own time may be of another day than its slice."""
    df = signal_df(spark, [sig_row(i, t) for i, t, _ in rows])
    stamps = spark.createDataFrame([(i, t, s) for i, t, s in rows], "imsi string, end_time string, slice string")
    return df.join(stamps, ["imsi", "end_time"]).select(*df.columns, "slice")


def test_nights_over_two_days_late_records_and_the_eve(spark, tmp_root):
    stamps = stay_range("2024010723", 2)
    rows = _tiny(spark, [
        ("night", "20240107235800", "202401072355"), ("night", "20240108000200", "202401080000"),   # one span over midnight
        ("night", "20240108235800", "202401082355"), ("night", "20240109000200", "202401090000"),
        ("eve", "20240107223000", "202401072230"), ("eve", "20240107120000", "202401071200"),       # before the range
        ("late", "20240108010000", "202401080100"), ("late", "20240108020000", "202401090300"),     # came a day later
        ("work", "20240108080000", "202401080800"), ("work", "20240108170000", "202401081700"),
        ("work", "20240109080000", "202401090800"), ("work", "20240109170000", "202401091700"),
        ("next", "20240109230000", "202401092300"), ("next", "20240109235900", "202401092355")])    # counts for the 10th
    dim = dim_df(spark, [(200, 1, 0, 1001)])
    _saved(spark, rows, dim, tmp_root, ["20240107", "20240108", "20240109"])
    stored = spans.read_days(spark, tmp_root, stamps, 4)
    for days, match in itertools.product((1, 2), ("exact", "at_least")):
        whole = residence.residence_table(registry.select_slices(rows, stamps).drop("slice"), dim, days, match=match, dim_broadcast=False)
        assert _rows(spans.residence_from_spans(stored, days, match=match)) == _rows(whole)
    names = {(r.imsi, r.user_attr) for r in spans.residence_from_spans(stored, 2).collect()}
    assert names == {("night", 1), ("work", 2)}


def test_replays_crashes_empty_and_missing_days(spark, tmp_root):
    dim, stamps = dim_df(spark, [(200, 1, 0, 1001)]), stay_range("2024010723", 1)
    rows = _tiny(spark, [("a", "20240108080000", "202401080800"), ("a", "20240108090000", "202401080900"),
                         (None, "20240108080000", "202401080800")])
    _saved(spark, rows.where("false"), dim, tmp_root, ["20240107"])
    with pytest.raises(spans.DayMissing):
        spans.read_days(spark, tmp_root, stamps, 4)
    _saved(spark, rows.where("false"), dim, tmp_root, ["20240108"])
    assert spans.residence_from_spans(spans.read_days(spark, tmp_root, stamps, 4), 1).count() == 0
    _saved(spark, rows, dim, tmp_root, ["20240108"])                       # the replay counts
    os.makedirs(f"{tmp_root}/day=20240108-0000000009-0123456789ab")        # a crashed one does not
    assert [r.imsi for r in spans.residence_from_spans(spans.read_days(spark, tmp_root, stamps, 4), 1).collect()] == ["a"]
    for wrong in (["20240107"], ["2024010722", "20240108"], stay_range("2024010723", 70)):
        with pytest.raises(ValueError):
            spans.read_days(spark, tmp_root, wrong, 4)


def test_labelling_reads_summaries_and_moves_nothing(spark):
    with _conf(spark, **NO_AUTO):
        plan = _plan(registry.queries()["residence_daily"](spark, SF_SMALL))
    assert "Exchange" not in plan and plan.count("Scan ") == plan.count("Bucketed: true") == 1, plan

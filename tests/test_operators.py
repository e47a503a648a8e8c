"""Operators on hand-made frames: bands, recency, stay rules, joins, state."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.operators.joins import district_join, drop_residents, drop_residents_outer
from footfall.plans import reports, residence, rolling
from tests.helpers import dim_df, sig_row, signal_df

T0 = dt.datetime(2024, 1, 10, 8, 0, 0)
STAMP = "202401101205"


def _dim(spark):
    return dim_df(spark, [(200, 1, 0, 1001), (200, 2, 0, 1002), (200, 3, 1, 1001)])


def test_dwell_report_bands(spark):
    rows = []
    durations = {"a": 0, "b": 1800, "c": 1801, "d": 41400, "e": 41401}
    for imsi, d in durations.items():
        rows.append(sig_row(imsi, T0))
        rows.append(sig_row(imsi, T0 + dt.timedelta(seconds=d)))
    rows.append(sig_row("x", T0, base=9))        # cell not in the dimension: dropped
    rows.append(sig_row("y", T0, latn=201))      # other city: dropped
    rows.append(sig_row(None, T0))               # null imsi: a group, not counted
    out = reports.visitor_flow_dur(signal_df(spark, rows), _dim(spark), None, STAMP, False)
    got = {(r.district_id, r.section_id): r.visitor_number for r in out.collect()}
    # the null-imsi group has duration 0 but is not counted
    assert got == {(1001, 0): 1, (1001, 1): 1, (1001, 2): 1, (1001, 5): 1, (1001, 6): 1}
    ts = out.select("timestamp").first()[0]
    assert ts == dt.datetime(2024, 1, 10, 12, 5)


def test_home_report_recency(spark):
    batch = dt.datetime(2024, 1, 10, 12, 5)
    rows = [
        sig_row("a", batch - dt.timedelta(minutes=30), province="P1", home=1),
        sig_row("b", batch - dt.timedelta(minutes=31), province="P1", home=1),
        sig_row("c", batch - dt.timedelta(minutes=151), province="P1", home=1),
        sig_row("d", batch - dt.timedelta(minutes=1471), province="P1", home=1),
        sig_row("e", batch + dt.timedelta(minutes=5), province="P2", home=2),
    ]
    out = reports.visitor_flow_home(signal_df(spark, rows), _dim(spark), None, STAMP, False)
    got = {(r.home_province, r.home_city): (r.visitor_number1, r.visitor_number2, r.visitor_number3)
           for r in out.collect()}
    assert got == {("P1", 1): (1, 2, 3), ("P2", 2): (1, 1, 1)}


def test_home_pair_stays_real(spark):
    rows = [sig_row("a", T0, province="B", home=1), sig_row("a", T0, province="A", home=9)]
    out = reports.visitor_flow_home(signal_df(spark, rows), _dim(spark), None, STAMP, False)
    assert [(r.home_province, r.home_city) for r in out.collect()] == [("A", 9)]


def _nights(imsi, days, start=dt.datetime(2024, 1, 28, 23, 0), base=1):
    """Night presence: 23:00 and 23:10 of day k (rolls to day k+1), 02:00/02:10 next day."""
    rows = []
    for k in days:
        d = start + dt.timedelta(days=k)
        rows += [sig_row(imsi, d, base=base), sig_row(imsi, d + dt.timedelta(minutes=10), base=base)]
    return rows


def test_residents_exact_vs_at_least_and_month_rollover(spark):
    dim = _dim(spark)
    # 'a': 23h on Jan 28, 29, 30, 31 -> stay dates Jan 29, 30, 31, Feb 1 (roll-over)
    rows = _nights("a", range(4)) + _nights("b", range(3)) + _nights("c", range(2))
    df = signal_df(spark, rows)
    exact = {r.imsi for r in residence.residents(df, dim, 3, dim_broadcast=False).collect()}
    at_least = {r.imsi for r in
                residence.residents(df, dim, 3, match="at_least", dim_broadcast=False).collect()}
    assert exact == {"b"} and at_least == {"a", "b"}
    unshifted = residence.residents(df, dim, 4, rollover=False, dim_broadcast=False)
    assert {r.imsi for r in unshifted.collect()} == {"a"}
    from footfall.operators.residence import daily_stays, people, tag_periods
    t = tag_periods(people(df, dim, dim_broadcast=False), staff=False)
    dates = sorted({r.stay_date for r in t.where("imsi = 'a'").collect()})
    assert dates[-1] == dt.date(2024, 2, 1)
    assert daily_stays(t).count() == 4 + 3 + 2


def test_night_and_work_hour_edges(spark):
    from footfall.operators.residence import tag_periods
    hours = [22, 23, 0, 6, 7, 8, 17, 18]
    df = spark.createDataFrame([(h, dt.date(2024, 1, 10)) for h in hours], "hour int, date date")
    got = {r.hour: (r.user_attr, r.stay_date) for r in tag_periods(df).collect()}
    d, nxt = dt.date(2024, 1, 10), dt.date(2024, 1, 11)
    assert got == {23: (1, nxt), 0: (1, d), 6: (1, d), 8: (2, d), 17: (2, d)}


def test_min_stay_seconds(spark):
    dim = _dim(spark)
    t = dt.datetime(2024, 1, 10, 9, 0)
    rows = [sig_row("a", t), sig_row("a", t + dt.timedelta(seconds=4)),
            sig_row("b", t), sig_row("b", t + dt.timedelta(seconds=3))]
    out = residence.staff(signal_df(spark, rows), dim, 1, dim_broadcast=False)
    assert [(r.imsi, r.user_attr) for r in out.collect()] == [("a", 2)]


def test_one_pass_equals_two_pass(spark):
    dim = _dim(spark)
    work = [sig_row("w", dt.datetime(2024, 1, 10 + k, 9, 0)) for k in range(2)] + \
           [sig_row("w", dt.datetime(2024, 1, 10 + k, 9, 30)) for k in range(2)]
    rows = _nights("n", range(2), start=dt.datetime(2024, 1, 9, 23)) + work + \
        _nights("w", range(2), start=dt.datetime(2024, 1, 9, 23))
    df = signal_df(spark, rows)
    one = sorted(tuple(r) for r in residence.residence_table(df, dim, 2, dim_broadcast=False).collect())
    two = sorted(tuple(r) for r in residence.residence_two_pass(df, dim, 2, dim_broadcast=False)
                 .collect())
    assert one == two
    assert {(r[0], r[5]) for r in one} == {("n", 1), ("w", 1), ("w", 2)}


def test_anti_join_equals_outer_null_filter_and_keeps_nulls(spark):
    dim = _dim(spark)
    rows = [sig_row("a", T0), sig_row("b", T0), sig_row("a", T0, base=2), sig_row(None, T0)]
    enriched = district_join(signal_df(spark, rows), dim, False)
    res = spark.createDataFrame([(1001, "a"), (1001, None)], "district_id int, imsi string")
    anti = sorted(((r.imsi, r.district_id) for r in drop_residents(enriched, res).collect()), key=str)
    outer = sorted(((r.imsi, r.district_id) for r in drop_residents_outer(enriched, res).collect()),
                   key=str)
    assert anti == outer
    assert anti == sorted([("b", 1001), ("a", 1002), (None, 1001)], key=str)


def test_dimension_fan_out(spark):
    dim = dim_df(spark, [(200, 1, 0, 1001), (200, 1, 0, 1002)])
    enriched = district_join(signal_df(spark, [sig_row("a", T0)]), dim, None)
    assert sorted(r.district_id for r in enriched.collect()) == [1001, 1002]


_row = st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 50000),
                 st.sampled_from([1, 2, 3]), st.sampled_from([0, 1]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_row, min_size=1, max_size=25))
def test_report_properties(spark, data):
    """histogram total = non-null visitors; duplicated input changes nothing;
    nested flags are ordered; raw state = aggregate state; halves merge to the whole."""
    dim = _dim(spark)
    rows = [sig_row(i, T0 + dt.timedelta(seconds=s), base=b, sector=sec, province=f"P{b}",
                    home=b) for i, s, b, sec in data]
    df = signal_df(spark, rows)
    v = reports.visits(df, dim, None, False)
    dur = reports.dwell_report(v, STAMP)
    pairs = v.where(F.col("imsi").isNotNull()).count()
    assert (dur.agg(F.sum("visitor_number")).first()[0] or 0) == pairs
    dup = reports.dwell_report(reports.visits(df.unionByName(df), dim, None, False), STAMP)
    assert sorted(map(tuple, dup.collect())) == sorted(map(tuple, dur.collect()))
    home = reports.home_report(v, STAMP).collect()
    assert all(r.visitor_number1 <= r.visitor_number2 <= r.visitor_number3 for r in home)
    half = len(rows) // 2
    a, b = signal_df(spark, rows[:half] or rows[:0]), signal_df(spark, rows[half:])
    agg_state = rolling.step(rolling.initial_state(a, dim, None, dim_broadcast=False), b, dim, None,
                             dim_broadcast=False)
    raw_state = rolling.step(rolling.initial_state(a, dim, None, "raw", False), b, dim, None, "raw",
                             dim_broadcast=False)
    for st_ in (agg_state, raw_state):
        got = reports.dwell_report(rolling.state_visits(st_), STAMP)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, dur.collect()))


_stay = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 4), st.sampled_from([2, 9, 23]),
                  st.integers(0, 50), st.sampled_from([1, 2]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_stay, min_size=1, max_size=30), st.integers(1, 3))
def test_labelling_properties(spark, data, days):
    """one pass = two passes; exact labels are a subset of at-least labels."""
    dim = _dim(spark)
    base = dt.datetime(2024, 1, 8, 0, 0)
    rows = [sig_row(i, base + dt.timedelta(days=d, hours=h, seconds=s), base=b)
            for i, d, h, s, b in data]
    df = signal_df(spark, rows)
    one = sorted(map(tuple, residence.residence_table(df, dim, days, dim_broadcast=False).collect()))
    two = sorted(map(tuple, residence.residence_two_pass(df, dim, days, dim_broadcast=False).collect()))
    assert one == two
    at_least = set(map(tuple, residence.residence_table(df, dim, days, match="at_least",
                                                        dim_broadcast=False).collect()))
    assert set(one) <= at_least


def test_empty_home_has_no_say(spark):
    from footfall.operators.visits import merge_summaries
    df = spark.createDataFrame([("a", 1, None, None, 1, 2), ("a", 1, "", 0, 1, 2), ("a", 1, "P", 7, 1, 2), ("b", 1, None, None, 1, 2)],
                               "imsi string, district_id int, home_province string, home_city int, "
                               "min_end_time bigint, max_end_time bigint")
    got = {r.imsi: (r.home_province, r.home_city) for r in merge_summaries(df).collect()}
    assert got == {"a": ("P", 7), "b": (None, None)}

"""Registered queries: one Spark callable (spark, sf_dir) -> DataFrame per operator.

Each reads the driver's tables through the fixture projection; ``footfall.oracle``
holds the equivalent DuckDB SQL under the same name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import params as P
from footfall.functions.parse import int_or_zero
from footfall.functions.slices import (
    default_start_col,
    needs_reset_col,
    prefix_predicate,
    slice_table,
    stamp_window,
    stamps_predicate,
)
from footfall.operators import explore
from footfall.operators.dwell import dwell, with_section
from footfall.operators.homeflow import recency
from footfall.operators.joins import district_join, drop_residents, drop_residents_outer
from footfall.operators.residence import (
    calendar_split,
    daily_stays,
    people,
    qualifying_stays,
    stay_day_counts,
    tag_periods,
)
from footfall.operators.visits import ALL_ATTRS
from footfall.plans import reports, residence, rolling, spans
from footfall.plans.job import run_visitor_job
from footfall.schemas import SIGNAL_COLUMNS
from footfall.session import scratch_path
from footfall.sinks.state import BUCKETS as STATE_BUCKETS
from footfall.sinks.state import latest_state, load_state, read_state, save_state
from footfall.sinks.tables import save_dim, save_residence, save_residence_bucketed, save_residence_two_pass
from footfall.sources import fixtures, fs
from footfall.sources.signal_text import (
    SLICE_SUBDIR,
    format_signal_lines,
    read_signal,
    read_signal_partitioned,
    read_signal_quarantine,
    read_signal_sliced,
    write_slices,
)
from footfall.sources.tables import read_dim, read_residence, read_residence_bucketed, seed_dim
from footfall.streaming.slices_stream import merge_batch, stamped_files, start_visitor_stream

Query = Callable[[SparkSession, str], DataFrame]


def select_slices(df: DataFrame, stamps, col: str = "slice") -> DataFrame:
    """Rows of the given slices: 12-char stamps exactly, hour/date stamps as prefixes."""
    if all(len(s) == 12 for s in stamps):
        return df.where(stamps_predicate(col, stamps))
    return df.where(prefix_predicate(col, stamps))


def slice_rows(spark: SparkSession, sf_dir: str, stamps, dense: bool = False,
               keep_stamp: bool = False) -> DataFrame:
    """Signal rows of the given slices; the time window prunes the scan, the stamp
    predicate decides."""
    sig = fixtures.signal(spark, sf_dir, dense=dense, window=stamp_window(stamps), with_stamp=True)
    rows = select_slices(sig, stamps)
    return rows if keep_stamp else rows.drop("slice")


# Tables that reports read (S5, S6) are written once per application and read by path, so a
# report's plan scans the events of its own window and nothing else.  They are written again when
# the input's files change; ``forget`` drops them.
_STORED: dict = {}


def _stored(spark, key, write) -> str:
    k = (spark.sparkContext.applicationId, key, fixtures.inputs(spark, key[1]))
    if k not in _STORED:
        path = scratch_path(spark, key[0])
        write(path)
        _STORED[k] = path
    return _STORED[k]


def forget() -> None:
    """Drops what is kept between queries (lazy frames and paths of stored tables)."""
    _STORED.clear()
    fixtures.forget()


def _seed(spark, sf_dir, path):
    save_dim(seed_dim(fixtures.dim_district_full(spark, sf_dir)).drop("update_time"), path)


def _dim_path(spark, sf_dir):
    """The dimension seeded from the cells in the data and saved."""
    return _stored(spark, ("dim", sf_dir), lambda path: _seed(spark, sf_dir, path))


def _dim(spark, sf_dir):
    """The stored dimension, marked for broadcast: it is bounded by construction
    (fixtures.DIM_MAX_ROWS), so no size check is needed.  Operators receive it with
    ``dim_broadcast=False`` (use as given)."""
    return F.broadcast(read_dim(spark, _dim_path(spark, sf_dir)))


NO_CHECK = False  # dim_broadcast value: the frame is already marked


def _residence_frame(spark, sf_dir, dense: bool, with_attrs: bool = True):
    stamps = P.STAY_RANGE_DENSE if dense else P.STAY_RANGE_SIGNAL
    days = P.RES_DAYS_DENSE if dense else P.RES_DAYS_SIGNAL
    return residence.residence_table(slice_rows(spark, sf_dir, stamps, dense), _dim(spark, sf_dir),
                                     days, dim_broadcast=NO_CHECK, with_attrs=with_attrs)


def _residence(spark, sf_dir, dense: bool):
    """(district_id, imsi) of the stored residence table (K4)."""
    path = _stored(spark, ("residence", sf_dir, dense),
                   lambda p: save_residence(_residence_frame(spark, sf_dir, dense), p))
    return read_residence(spark, path)


def _tagged(spark, sf_dir, **kw):
    rows = fixtures.signal(spark, sf_dir, dense=True)
    return tag_periods(people(rows, _dim(spark, sf_dir), dim_broadcast=NO_CHECK), **kw)


def _report_visits(spark, sf_dir, attrs):
    rows = slice_rows(spark, sf_dir, P.UNTIL_NOW)
    res = _residence(spark, sf_dir, dense=False)
    return reports.visits(rows, _dim(spark, sf_dir), res, NO_CHECK, attrs)


def _plain_visits(spark, sf_dir, attrs=ALL_ATTRS):
    return reports.visits(fixtures.signal(spark, sf_dir), _dim(spark, sf_dir), None, NO_CHECK, attrs)


# --- S* sources ------------------------------------------------------------------------

def _write_files(lines: DataFrame, root: str, stamp: str, city: str = "200") -> None:
    """Text files of the original layout, the stamp in their names."""
    (lines.select("value").write.mode("append").option("mapreduce.output.basename", f"sig_{stamp}")
     .text(f"{root}/{SLICE_SUBDIR}/{city}"))


DATA_MONTH, NO_MONTH = "202401", "209912"


def q_signal_scan(spark, sf_dir):
    """All signal rows written as text files and read back by a part of their
    names; a stamp without files adds nothing."""
    root = scratch_path(spark, "files")
    _write_files(format_signal_lines(fixtures.signal(spark, sf_dir)), root, DATA_MONTH + "010000")
    return read_signal(spark, root, [DATA_MONTH, NO_MONTH])


def q_signal_quarantine(spark, sf_dir):
    """Lines that cannot be used, listed with the reason: cut off after five fields, an
    unreadable station, or a start time in month 99."""
    v = (F.col("base_statn_id") + F.col("home_latn_id")) % 5
    sig = fixtures.signal(spark, sf_dir).withColumn("v", v).withColumns({
        "base_statn_id": F.when(F.col("v") == 1, F.lit("x")).otherwise(F.col("base_statn_id").cast("string")),
        "start_time": F.when(F.col("v") == 2, F.concat(F.substring("start_time", 1, 4), F.lit("99"),
                                                       F.substring("start_time", 7, 8))).otherwise(F.col("start_time"))})
    lines = format_signal_lines(sig, keep=("v",))
    cut = F.when(F.col("v") == 0, F.substring_index("value", "|", 5)).otherwise(F.col("value"))
    root = scratch_path(spark, "broken")
    _write_files(lines.select(cut.alias("value")), root, DATA_MONTH + "010000")
    return read_signal_quarantine(spark, root, [DATA_MONTH]).select("reason", "message_type", "imsi", "start_time")


_INT_COLS = ["type", "base_statn_id", "sector_id", "home_latn_id", "latn_id", "hour"]
_MARKERS = ["", "null", "\\N"]


def q_int_or_zero(spark, sf_dir):
    """The int rule over text with zero markers, padding and tabs."""
    sig = fixtures.signal(spark, sf_dir)
    cols = []
    for c in SIGNAL_COLUMNS:
        if c not in _INT_COLS:
            cols.append(F.col(c))
            continue
        v = (F.col("base_statn_id") + F.col("sector_id") + len(c)) % 6
        text = (F.when(v == 0, F.col(c).cast("string"))
                .when(v == 1, F.concat(F.lit("  "), F.col(c).cast("string"), F.lit(" ")))
                .when(v == 2, F.concat(F.lit("\t"), F.col(c).cast("string"), F.lit("\t")))
                .when(v == 3, F.lit(_MARKERS[0])).when(v == 4, F.lit(_MARKERS[1]))
                .otherwise(F.lit(_MARKERS[2])))
        cols.append(int_or_zero(text).alias(c))
    return sig.select(*cols)


def q_district_dim(spark, sf_dir):
    """The five columns of the stored dimension."""
    return read_dim(spark, _dim_path(spark, sf_dir))


def q_dim_seed(spark, sf_dir):
    """The full dimension seeded from the cells in the data, saved and read back."""
    path = scratch_path(spark, "seed")
    _seed(spark, sf_dir, path)
    return spark.read.orc(path).drop("update_time")


def q_residence_scan(spark, sf_dir):
    """Residents overwritten, staff appended, the two key columns read back."""
    rows = slice_rows(spark, sf_dir, P.STAY_RANGE_SIGNAL)
    dim, path = _dim(spark, sf_dir), scratch_path(spark, "two-pass")
    save_residence_two_pass(residence.residents(rows, dim, P.RES_DAYS_SIGNAL, dim_broadcast=NO_CHECK),
                            residence.staff(rows, dim, P.RES_DAYS_SIGNAL, dim_broadcast=NO_CHECK), path)
    return read_residence(spark, path)


# --- T* slices -------------------------------------------------------------------------

def _slice_query(stamps, dense=False):
    def q(spark, sf_dir):
        rows = slice_rows(spark, sf_dir, stamps, dense, keep_stamp=True)
        return rows.withColumnRenamed("slice", "slice_stamp")
    return q


def q_default_start(spark, sf_dir):
    """T4: for every day in the data, the start of the stay range a run would use."""
    ev = fixtures._read(spark, sf_dir, "events")
    d = F.to_date("ts")
    return ev.select(d.alias("run_date"), default_start_col(d).alias("default_start")).distinct()


# --- P*, A5-A7, R3-R5 -------------------------------------------------------------------

def q_city_filter(spark, sf_dir):
    return fixtures.signal(spark, sf_dir).where(F.col("latn_id") == 200)


def q_calendar_split(spark, sf_dir):
    return calendar_split(fixtures.signal(spark, sf_dir))


_PEOPLE_COLS = ["imsi", "user_number", "end_time", "hour", "city_id", "district_id",
                "district_name", "date", "user_attr", "stay_date"]


def q_night_rows(spark, sf_dir):
    return _tagged(spark, sf_dir, staff=False).select(*_PEOPLE_COLS)


def q_workday_rows(spark, sf_dir):
    return _tagged(spark, sf_dir, residents=False).select(*_PEOPLE_COLS)


def q_night_stays(spark, sf_dir):
    return qualifying_stays(daily_stays(_tagged(spark, sf_dir, staff=False)))


def q_workday_stays(spark, sf_dir):
    return qualifying_stays(daily_stays(_tagged(spark, sf_dir, residents=False)))


def q_stay_days(spark, sf_dir):
    return stay_day_counts(daily_stays(_tagged(spark, sf_dir)))


def q_residents(spark, sf_dir):
    rows = slice_rows(spark, sf_dir, P.STAY_RANGE_DENSE, dense=True)
    return residence.residents(rows, _dim(spark, sf_dir), P.RES_DAYS_DENSE, dim_broadcast=NO_CHECK)


def q_staff(spark, sf_dir):
    rows = slice_rows(spark, sf_dir, P.STAY_RANGE_DENSE, dense=True)
    return residence.staff(rows, _dim(spark, sf_dir), P.RES_DAYS_DENSE, dim_broadcast=NO_CHECK)


def q_residence_table(spark, sf_dir):
    return _residence_frame(spark, sf_dir, dense=True)


def q_residence_daily(spark, sf_dir):
    """R5 from daily summaries: one job per day reduces its slices, the label job reads no slice."""
    root, dim = scratch_path(spark, "spans"), _dim(spark, sf_dir)
    for day in sorted({s[:8] for s in P.STAY_RANGE_DENSE}):
        rows = slice_rows(spark, sf_dir, [day], dense=True, keep_stamp=True)
        spans.save_day(spans.day_spans(rows, dim, dim_broadcast=NO_CHECK), root, day)
    return spans.residence_from_spans(spans.read_days(spark, root, P.STAY_RANGE_DENSE), P.RES_DAYS_DENSE)


def q_residence_two_pass(spark, sf_dir):
    """R3 ∪ R4 as two passes (the original shape); same rows as residence_table."""
    rows = slice_rows(spark, sf_dir, P.STAY_RANGE_DENSE, dense=True)
    return residence.residence_two_pass(rows, _dim(spark, sf_dir), P.RES_DAYS_DENSE,
                                        dim_broadcast=NO_CHECK)


# --- J*, A1-A4, R1-R2 -------------------------------------------------------------------

def q_district_join(spark, sf_dir):
    return district_join(fixtures.signal(spark, sf_dir), _dim(spark, sf_dir), NO_CHECK)


def q_district_join_salted(spark, sf_dir):
    """J1 without a broadcast of the dimension: a shuffle join that spreads hot cells."""
    return district_join(fixtures.signal(spark, sf_dir), read_dim(spark, _dim_path(spark, sf_dir)), "salted")


def q_resident_anti_join(spark, sf_dir):
    rows = fixtures.signal(spark, sf_dir, dense=True)
    enriched = district_join(rows, _dim(spark, sf_dir), NO_CHECK)
    return drop_residents(enriched, _residence(spark, sf_dir, dense=True))


def q_resident_filtered_join(spark, sf_dir):
    """J2 on rows with a Bloom filter of the residence: rows it does not know are not shuffled."""
    rows = fixtures.signal(spark, sf_dir, dense=True)
    enriched = district_join(rows, _dim(spark, sf_dir), NO_CHECK)
    return drop_residents(enriched, _residence(spark, sf_dir, dense=True), "filtered")


def q_resident_outer_join(spark, sf_dir):
    """J2 as the original wrote it (left outer + null filter); same rows as the anti join."""
    rows = fixtures.signal(spark, sf_dir, dense=True)
    enriched = district_join(rows, _dim(spark, sf_dir), NO_CHECK)
    return drop_residents_outer(enriched, _residence(spark, sf_dir, dense=True))


def q_dwell(spark, sf_dir):
    return dwell(_plain_visits(spark, sf_dir))


def q_dwell_section(spark, sf_dir):
    return with_section(dwell(_plain_visits(spark, sf_dir)))


def q_visitor_flow_dur(spark, sf_dir):
    return reports.dwell_report(_report_visits(spark, sf_dir, reports.DWELL_ATTRS), P.AS_OF)


def q_recency(spark, sf_dir):
    return recency(_plain_visits(spark, sf_dir), P.AS_OF)


def q_visitor_flow_home(spark, sf_dir):
    return reports.home_report(_report_visits(spark, sf_dir, reports.HOME_ATTRS), P.AS_OF)


# --- I* rolling state -------------------------------------------------------------------

def _rolling_state(spark, sf_dir, mode):
    """The day state after the earlier runs, then one more run of the last n slices."""
    dim = _dim(spark, sf_dir)
    res = _residence(spark, sf_dir, dense=False)
    new_stamps = P.UNTIL_NOW[:P.ROLLING_N]
    old_stamps = P.UNTIL_NOW[P.ROLLING_N:]
    state = rolling.initial_state(slice_rows(spark, sf_dir, old_stamps), dim, res, mode=mode,
                                  dim_broadcast=NO_CHECK)
    return rolling.step(state, slice_rows(spark, sf_dir, new_stamps), dim, res, mode=mode,
                        dim_broadcast=NO_CHECK)


def q_rolling_step(spark, sf_dir):
    """I1 (pre-aggregate state): state of 00:05..11:55 merged with 12:00..12:05 -> R1."""
    return reports.dwell_report(rolling.state_visits(_rolling_state(spark, sf_dir, "aggregate")),
                                P.AS_OF)


def q_rolling_step_home(spark, sf_dir):
    return reports.home_report(rolling.state_visits(_rolling_state(spark, sf_dir, "aggregate")),
                               P.AS_OF)


def q_rolling_raw_step(spark, sf_dir):
    """I1 (raw-row state, the original layout) -> R1."""
    return reports.dwell_report(rolling.state_visits(_rolling_state(spark, sf_dir, "raw")), P.AS_OF)


def q_rolling_reset(spark, sf_dir):
    """For every slice in the data, whether a run there starts the day state afresh."""
    sig = fixtures.signal(spark, sf_dir, with_stamp=True)
    return (sig.select(F.col("slice").alias("slice_stamp"),
                       needs_reset_col("slice", P.ROLLING_N).alias("reset")).distinct())


def q_rolling_rebuild(spark, sf_dir):
    """n = 0 reads every slice since 00:05 and ignores any state."""
    dim = _dim(spark, sf_dir)
    res = _residence(spark, sf_dir, dense=False)
    state = rolling.initial_state(slice_rows(spark, sf_dir, P.UNTIL_NOW), dim, res,
                                  dim_broadcast=NO_CHECK)
    return reports.dwell_report(rolling.state_visits(state), P.AS_OF)


# --- K* sinks / S7 state (write to the shared checkpoint folder, read back) ------------

def q_sink_table(spark, sf_dir):
    """K4/K5: the residence table written as ORC (one overwrite) and read back."""
    path = scratch_path(spark, "residence")
    save_residence(_residence_frame(spark, sf_dir, dense=True), path)
    return spark.read.orc(path).drop("update_time")


def q_state_roundtrip(spark, sf_dir):
    """K7 + S7: the day state of 00:05..12:05 saved as a new version, found again as the
    newest complete version, read back."""
    root = scratch_path(spark, "state")
    dim = _dim(spark, sf_dir)
    res = _residence(spark, sf_dir, dense=False)
    state = rolling.initial_state(slice_rows(spark, sf_dir, P.UNTIL_NOW), dim, res,
                                  dim_broadcast=NO_CHECK, attrs=ALL_ATTRS)
    save_state(state, root, P.AS_OF)
    return load_state(spark, root, before="999912312359")


def _written_slices(spark, sf_dir):
    """The slices of the report's day (the window of the jobs that read them) as pipe text in
    the partitioned layout."""
    def write(root):
        write_slices(slice_rows(spark, sf_dir, [P.AS_OF[:8]], keep_stamp=True), root)
    return _stored(spark, ("slices", sf_dir), write)


def q_slices_missing(spark, sf_dir):
    """Slices that do not exist (a day after the data) add nothing; the run goes on."""
    root = _written_slices(spark, sf_dir)
    wanted = P.UNTIL_NOW + [f"20991231{h:02d}00" for h in range(0, 24, 6)]
    return read_signal_partitioned(spark, root, wanted).withColumnRenamed("slice", "slice_stamp")


def q_slices_pruned(spark, sf_dir):
    """The slices as a table; the scan of the partitioned layout is pruned by it at run time."""
    wanted = slice_table(spark, stamp_window(P.UNTIL_NOW))
    return read_signal_sliced(spark, _written_slices(spark, sf_dir), wanted).withColumnRenamed("slice", "slice_stamp")


def _visitor_job(spark, sf_dir):
    """The 15-minute job end to end on text slices: a rebuild at 11:50 (n = 0), then a
    regular run at 12:05 (n = 3) that merges 11:55-12:05 into the saved state."""
    root = _written_slices(spark, sf_dir)
    state_root = scratch_path(spark, "job-state")
    dim = _dim(spark, sf_dir)
    res = _residence(spark, sf_dir, dense=False)
    run_visitor_job(spark, root, P.JOB_FIRST_AS_OF, dim, res, state_root, n=0,
                    layout="partitioned", dim_broadcast=NO_CHECK)
    return run_visitor_job(spark, root, P.AS_OF, dim, res, state_root, n=P.ROLLING_N,
                           layout="partitioned", dim_broadcast=NO_CHECK)


def q_visitor_job_files(spark, sf_dir):
    """The same two runs on slice files: the stamp in the name selects, not the record's time."""
    root, state_root = scratch_path(spark, "job-files"), scratch_path(spark, "job-files-state")
    new = P.UNTIL_NOW[:P.ROLLING_N]
    _write_files(format_signal_lines(slice_rows(spark, sf_dir, P.UNTIL_NOW[P.ROLLING_N:])), root, P.JOB_FIRST_AS_OF)
    _write_files(format_signal_lines(slice_rows(spark, sf_dir, new)), root, P.AS_OF)
    dim, res = _dim(spark, sf_dir), _residence(spark, sf_dir, dense=False)
    run_visitor_job(spark, root, P.JOB_FIRST_AS_OF, dim, res, state_root, n=0, dim_broadcast=NO_CHECK)
    return run_visitor_job(spark, root, P.AS_OF, dim, res, state_root, n=P.ROLLING_N, dim_broadcast=NO_CHECK).dwell


def q_job_rerun_older(spark, sf_dir):
    """An older run repeated after newer ones reports what it reported the first time."""
    root, state_root = _written_slices(spark, sf_dir), scratch_path(spark, "rerun-state")
    dim, res = _dim(spark, sf_dir), _residence(spark, sf_dir, dense=False)
    run = lambda as_of, n: run_visitor_job(spark, root, as_of, dim, res, state_root, n=n,
                                           layout="partitioned", dim_broadcast=NO_CHECK)
    run(P.JOB_FIRST_AS_OF, 0)
    for as_of in (P.AS_OF, *P.JOB_LATER):
        run(as_of, P.ROLLING_N)
    return run(P.AS_OF, P.ROLLING_N).dwell


def _newest_report(spark, state_root):
    """The dwell report of the newest state version."""
    stamp, path = latest_state(spark, state_root)
    return reports.dwell_report(rolling.state_visits(read_state(spark, path)), stamp)


def _streamed(spark, sf_dir, batches):
    """The dwell report after micro-batches in the given order: lines with their file stamp, and the
    stamps of the batch's slices."""
    state_root = scratch_path(spark, "stream-state")
    dim, res = _dim(spark, sf_dir), _residence(spark, sf_dir, dense=False)
    for epoch, (lines, stamps) in enumerate(batches):
        files = stamped_files(spark.createDataFrame([(f"sig_{s}.txt",) for s in stamps], "file string"))
        merge_batch(lines, dim, res, state_root, epoch=epoch, files=files)
    return _newest_report(spark, state_root)


def q_stream_same_stamp(spark, sf_dir):
    """I4: two micro-batches whose newest stamp is the same (one file per city and slice)."""
    rows = slice_rows(spark, sf_dir, P.UNTIL_NOW)
    part = lambda k: format_signal_lines(rows.where(F.pmod(F.xxhash64("imsi", "end_time"), F.lit(2)) == k),
                                         keep=(F.lit(P.AS_OF).alias("slice"),))
    return _streamed(spark, sf_dir, [(part(0), [P.AS_OF]), (part(1), [P.AS_OF])])


def q_stream_late_batch(spark, sf_dir):
    """I4: the newest slices first, older ones in a late micro-batch, an early one last."""
    def lines(stamps):
        return format_signal_lines(slice_rows(spark, sf_dir, stamps, keep_stamp=True), keep=("slice",)), stamps

    n = P.ROLLING_N
    return _streamed(spark, sf_dir, [lines(P.UNTIL_NOW[:n]), lines(P.UNTIL_NOW[4 * n:]), lines(P.UNTIL_NOW[n:4 * n])])


def q_stream_restarted(spark, sf_dir):
    """I4: a stream over slice files, a few files a batch, stopped and started again from its
    checkpoint when more have come: a late slice, one whose lines are all cut off, and an empty
    one, which is the newest and names the report."""
    root, n = scratch_path(spark, "stream-files"), P.ROLLING_N
    state_root, checkpoint = f"{root}-state", f"{root}-checkpoint"
    dim, res = _dim(spark, sf_dir), _residence(spark, sf_dir, dense=False)

    def put(stamps, name):
        _write_files(format_signal_lines(slice_rows(spark, sf_dir, stamps)), root, name)

    def go():
        start_visitor_stream(spark, root, dim, res, state_root, checkpoint, max_files=6).awaitTermination()

    put(P.UNTIL_NOW[4 * n:], P.UNTIL_NOW[4 * n])
    put(P.UNTIL_NOW[:n], P.AS_OF)
    go()
    put(P.UNTIL_NOW[n:4 * n], P.UNTIL_NOW[n])
    bad, empty = P.STREAM_EXTRA
    cut = F.substring_index("value", "|", 5).alias("value")
    _write_files(format_signal_lines(slice_rows(spark, sf_dir, P.UNTIL_NOW[:n])).select(cut), root, bad)
    fs.touch(spark, f"{root}/{SLICE_SUBDIR}/200/sig_{empty}.txt")
    go()
    return _newest_report(spark, state_root)


def q_state_deltas(spark, sf_dir):
    """A whole day state, then runs that each write only what their slices add; the newest
    version read back by merging its chain."""
    root, n = scratch_path(spark, "delta-state"), P.ROLLING_N
    dim, res = _dim(spark, sf_dir), _residence(spark, sf_dir, dense=False)
    path = save_state(rolling.initial_state(slice_rows(spark, sf_dir, P.UNTIL_NOW[4 * n:]), dim, res, dim_broadcast=NO_CHECK,
                                            attrs=ALL_ATTRS), root, P.UNTIL_NOW[4 * n])
    for k in range(3, -1, -1):
        stamps = P.UNTIL_NOW[k * n:(k + 1) * n]
        path = rolling.save_step(path, slice_rows(spark, sf_dir, stamps), dim, res, root, stamps[0], dim_broadcast=NO_CHECK)
    return load_state(spark, root, before="999912312359")


def q_report_copartitioned(spark, sf_dir):
    """J2 without a shuffle: a stored state of all people against a stored residence, both
    bucketed by person and district -> R1."""
    root = scratch_path(spark, "bucketed")
    visits = reports.visits(slice_rows(spark, sf_dir, P.UNTIL_NOW), _dim(spark, sf_dir), None, NO_CHECK, reports.DWELL_ATTRS)
    path = save_state(visits, f"{root}/state", P.AS_OF)
    save_residence_bucketed(_residence_frame(spark, sf_dir, dense=False), f"{root}/residence", STATE_BUCKETS)
    stored = read_residence_bucketed(spark, f"{root}/residence", STATE_BUCKETS)
    return reports.dwell_report(drop_residents(read_state(spark, path), stored), P.AS_OF)


def q_reports_one_pass(spark, sf_dir):
    """Both reports from one scan of a saved day state."""
    root = scratch_path(spark, "one-pass-state")
    state = rolling.initial_state(slice_rows(spark, sf_dir, P.UNTIL_NOW), _dim(spark, sf_dir),
                                  _residence(spark, sf_dir, dense=False), dim_broadcast=NO_CHECK)
    return reports.both_reports(read_state(spark, save_state(state, root, P.AS_OF)), P.AS_OF)


def q_job_counts(spark, sf_dir):
    """What a run of the job counts on the way, over slices in which lines are cut off or
    hold an unreadable station, start time or end time."""
    root, state_root = scratch_path(spark, "counted"), scratch_path(spark, "counted-state")
    v = (F.col("base_statn_id") + F.col("home_latn_id")) % 7
    month_99 = lambda c: F.concat(F.substring(c, 1, 4), F.lit("99"), F.substring(c, 7, 8))
    sig = slice_rows(spark, sf_dir, P.UNTIL_NOW).withColumn("v", v).withColumns({
        "base_statn_id": F.when(F.col("v") == 1, F.lit("x")).otherwise(F.col("base_statn_id").cast("string")),
        "start_time": F.when(F.col("v") == 2, month_99("start_time")).otherwise(F.col("start_time")),
        "end_time": F.when(F.col("v") == 3, month_99("end_time")).otherwise(F.col("end_time"))})
    cut = F.when(F.col("v") == 0, F.substring_index("value", "|", 5)).otherwise(F.col("value"))
    _write_files(format_signal_lines(sig, keep=("v",)).select(cut.alias("value")), root, P.AS_OF)
    out = run_visitor_job(spark, root, P.AS_OF, _dim(spark, sf_dir), _residence(spark, sf_dir, dense=False),
                          state_root, n=P.ROLLING_N, dim_broadcast=NO_CHECK).outcome
    numbers = {**out["bad"], **{k: out[k] for k in ("lines", "found", "residents", "dwell_negative", "dwell_unknown")},
               "missing_slices": len(out["missing"])}
    return spark.createDataFrame(list(numbers.items()), "name string, n long")


def q_visitor_job(spark, sf_dir):
    return _visitor_job(spark, sf_dir).dwell


def q_visitor_job_home(spark, sf_dir):
    return _visitor_job(spark, sf_dir).home


# --- X* drafts -------------------------------------------------------------------------

def q_x_week_range(spark, sf_dir):
    lo, hi = (dt.datetime.strptime(str(h), "%Y%m%d%H") for h in explore.week_range(P.AS_OF))
    return explore.week_range_rows(fixtures.signal(spark, sf_dir, window=(lo, hi)), P.AS_OF)


def q_x_residents_unshifted(spark, sf_dir):
    rows = slice_rows(spark, sf_dir, P.STAY_RANGE_DENSE, dense=True)
    return residence.residents(rows, _dim(spark, sf_dir), P.RES_DAYS_DENSE, rollover=False,
                               dim_broadcast=NO_CHECK)


def q_x_stay_4h(spark, sf_dir):
    t = _tagged(spark, sf_dir, staff=False, rollover=False)
    counts = stay_day_counts(daily_stays(t), P.X_STAY_SECONDS)
    return counts.select("imsi", "district_id", "user_number", "city_id", "district_name",
                         "stay_days", F.when(F.col("stay_days") == 1, F.lit(1)).alias("user_attr"))


def q_x_sector_rollup(spark, sf_dir):
    return explore.sector_rollup(fixtures.dim_district_full(spark, sf_dir))


def q_x_cell_multiplicity(spark, sf_dir):
    return explore.cell_multiplicity(_dim(spark, sf_dir))


def q_x_hour_coverage(spark, sf_dir):
    return explore.hour_coverage(_tagged(spark, sf_dir, staff=False, rollover=False))


def q_x_cell_load(spark, sf_dir):
    lo = dt.datetime.strptime(str(P.CELL_LOAD_HOUR), "%Y%m%d%H")
    sig = fixtures.signal(spark, sf_dir, window=(lo, lo + dt.timedelta(hours=1)))
    return explore.cell_load(sig, P.CELL_LOAD_HOUR)


def queries() -> dict[str, Query]:
    return {
        "signal_scan": q_signal_scan,
        "int_or_zero": q_int_or_zero,
        "district_dim": q_district_dim,
        "dim_seed": q_dim_seed,
        "residence_scan": q_residence_scan,
        "slices_last_n": _slice_query(P.LAST_N_STAMPS),
        "slices_until_now": _slice_query(P.UNTIL_NOW),
        "slices_stay_range": _slice_query(P.STAY_RANGE_DENSE),
        "default_start": q_default_start,
        "city_filter": q_city_filter,
        "calendar_split": q_calendar_split,
        "night_rows": q_night_rows,
        "workday_rows": q_workday_rows,
        "night_stays": q_night_stays,
        "workday_stays": q_workday_stays,
        "stay_days": q_stay_days,
        "residents": q_residents,
        "staff": q_staff,
        "residence_table": q_residence_table,
        "residence_two_pass": q_residence_two_pass,
        "residence_daily": q_residence_daily,
        "district_join": q_district_join,
        "district_join_salted": q_district_join_salted,
        "resident_anti_join": q_resident_anti_join,
        "resident_filtered_join": q_resident_filtered_join,
        "resident_outer_join": q_resident_outer_join,
        "dwell": q_dwell,
        "dwell_section": q_dwell_section,
        "visitor_flow_dur": q_visitor_flow_dur,
        "recency": q_recency,
        "visitor_flow_home": q_visitor_flow_home,
        "rolling_step": q_rolling_step,
        "rolling_step_home": q_rolling_step_home,
        "rolling_raw_step": q_rolling_raw_step,
        "rolling_reset": q_rolling_reset,
        "rolling_rebuild": q_rolling_rebuild,
        "sink_table": q_sink_table,
        "slices_missing": q_slices_missing,
        "slices_pruned": q_slices_pruned,
        "visitor_job": q_visitor_job,
        "visitor_job_home": q_visitor_job_home,
        "state_roundtrip": q_state_roundtrip,
        "signal_quarantine": q_signal_quarantine,
        "visitor_job_files": q_visitor_job_files,
        "job_rerun_older": q_job_rerun_older,
        "stream_same_stamp": q_stream_same_stamp,
        "stream_late_batch": q_stream_late_batch,
        "stream_restarted": q_stream_restarted,
        "state_deltas": q_state_deltas,
        "report_copartitioned": q_report_copartitioned,
        "reports_one_pass": q_reports_one_pass,
        "job_counts": q_job_counts,
        "x_week_range": q_x_week_range,
        "x_residents_unshifted": q_x_residents_unshifted,
        "x_stay_4h": q_x_stay_4h,
        "x_sector_rollup": q_x_sector_rollup,
        "x_cell_multiplicity": q_x_cell_multiplicity,
        "x_hour_coverage": q_x_hour_coverage,
        "x_cell_load": q_x_cell_load,
    }

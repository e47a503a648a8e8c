"""The 15-minute visitor job (original flow, re-planned for Spark 4).

    slices -> district join -> visit summary -> residents out -> merge with day state
           -> save new state version -> both reports in one aggregate -> sinks

* The run's slices are one multi-path (or partition-pruned) read — no per-slice jobs.
* A run writes what its slices add to the state; reading merges the chain of versions.
* The state is *written* before the reports read it: the write is the lineage
  cut (the reports and the next run read the same committed files), so a lost executor
  never forces a recomputation from the raw slices, and no ``persist`` is needed.
* Both reports come from one scan of the state and are written beside it; sinks read those rows.
* What the run did not use (bad lines by reason, residents removed, visitors without a dwell
  band) is counted in these jobs; the slices are read once.
* The state is the per-visitor summary (bounded by people x districts), not raw rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from footfall.constants import DEFAULT_LAST_N
from footfall.functions.slices import batch_stamp, last_n_slices, state_day, until_now_slices
from footfall.operators.counts import RunCounts
from footfall.plans import rolling
from footfall.plans.reports import dwell_report, dwell_rows, home_report, home_rows, save_reports
from footfall.sinks.state import latest_state_path, prune_states, read_state, reports_path
from footfall.sources.signal_text import observed_outcome, read_signal, read_signal_partitioned


@dataclass
class JobResult:
    stamp: str | None
    state_path: str | None
    dwell: DataFrame
    home: DataFrame
    outcome: dict = field(default_factory=dict)  # see run_outcome


def run_outcome(spark: SparkSession, root: str, stamps, counts: RunCounts, layout: str = "files") -> dict:
    """What a run did not use: ``bad``, ``missing``, ``unread`` (sources.signal_text.slice_outcome), of the
    new slices the number of ``lines``, of visitors (rows, in the raw layout) ``found`` and of
    those removed as ``residents``, and the visitors of the reports without a dwell band:
    ``dwell_negative``, ``dwell_unknown``.  A number is None if it was not taken (see RunCounts)."""
    found, kept, dwell = counts.get("found").get("n"), counts.get("kept").get("n"), counts.get("dwell")
    gone = None if found is None or kept is None else found - kept
    return {**observed_outcome(spark, root, stamps, counts, layout), "lines": counts.get("lines").get("lines"),
            "found": found, "residents": gone,
            "dwell_negative": dwell.get("negative"), "dwell_unknown": dwell.get("unknown")}


def run_slices(as_of: str, n: int = DEFAULT_LAST_N) -> list[str]:
    """T1 for n > 0, T2 (every slice of the day so far) for n == 0."""
    return last_n_slices(as_of, n) if n else until_now_slices(as_of)


def run_visitor_job(spark: SparkSession, root: str, as_of: str, dim: DataFrame,
                    residence: DataFrame | None, state_root: str, n: int = DEFAULT_LAST_N,
                    mode: str = "aggregate", reset: str = "window", layout: str = "files",
                    refilter: bool = False, keep_days: int = 2, sink=None,
                    dim_broadcast: bool | None = None) -> JobResult:
    """One run of the visitor job at ``as_of`` (yyyyMMddHHmm) over the last ``n`` slices.

    ``sink(dwell_df, home_df, stamp)`` receives the two reports (e.g. table or JDBC
    writers).  Returns the reports as DataFrames over the committed state, and what the run
    did not use.  A run whose predecessor state was pruned raises ``StatePruned``.
    """
    stamps = run_slices(as_of, n)
    stamp = batch_stamp(stamps)
    if stamp is None:  # 00:00-00:04 with n == 0: nothing to read yet
        empty = spark.createDataFrame([], "imsi string")
        return JobResult(None, None, dwell_report(empty, None), home_report(empty, None))
    counts = RunCounts()
    if layout == "files":
        rows = read_signal(spark, root, stamps, counts=counts)
    elif layout == "partitioned":
        rows = read_signal_partitioned(spark, root, stamps, counts).drop("slice")
    else:
        raise ValueError(layout)

    old_path = None
    if rolling.use_old_state(as_of, n, reset):
        day = state_day(stamp) if reset == "by_day" else None
        old_path = latest_state_path(spark, state_root, before=stamp, day=day)
    with counts.kept(spark):
        path = rolling.save_step(old_path, rows, dim, residence, state_root, stamp, mode=mode, refilter=refilter,
                                 dim_broadcast=dim_broadcast, counts=counts)
        both = save_reports(rolling.state_visits(read_state(spark, path)), stamp, reports_path(path), counts)
    dur, home = dwell_rows(both), home_rows(both)
    if sink is not None:
        sink(dur, home, stamp)
    if keep_days:
        prune_states(spark, state_root, keep_days, protect=(path,))
    return JobResult(stamp, path, dur, home, run_outcome(spark, root, stamps, counts, layout))

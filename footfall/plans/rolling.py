"""The rolling day state carried between 15-minute runs.

Two layouts:

* ``aggregate`` (default): one row per (imsi, district) — attributes and first/last end
  time.  Merging a run is a union + re-aggregation (min of mins, max of maxes), so the
  state grows with people x districts, not with signalling records.
* ``raw``: the filtered rows themselves, as the original job kept them.  Kept as the
  oracle for the aggregate layout.

Rows are cleaned of residents/staff when they arrive; a later residence table does not
clean older state unless ``refilter=True``.

``step`` computes a whole state; ``save_step`` writes a version, as a rule only what the run's
slices add (``sinks.state``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.functions.slices import needs_reset
from footfall.operators.counts import RunCounts
from footfall.operators.joins import district_join, drop_residents
from footfall.operators.visits import merge_summaries, visit_summary
from footfall.plans.reports import HOME_ATTRS, visits, without_residents
from footfall.sinks.state import compaction_due, read_state, save_state

MODES = ("aggregate", "raw")
# What both reports read; ALL_ATTRS (footfall.operators.visits) also keeps user_number
# and district_name, which the original computed per visitor but never reported.
STATE_ATTRS = HOME_ATTRS


def initial_state(rows: DataFrame, dim: DataFrame, residence: DataFrame | None,
                  mode: str = "aggregate", dim_broadcast: bool | None = None,
                  attrs=STATE_ATTRS, counts: RunCounts | None = None) -> DataFrame:
    """State built from scratch from signal rows (I3 when the rows are all of today).  ``counts``
    gets its rows before and after the removal."""
    if mode == "aggregate":
        return visits(rows, dim, residence, dim_broadcast, attrs, counts)
    if mode == "raw":
        return without_residents(district_join(rows, dim, dim_broadcast), residence, counts)
    raise ValueError(mode)


def is_raw(state: DataFrame) -> bool:
    return "end_time" in state.columns


def _attrs(state: DataFrame) -> tuple[str, ...]:
    """The attributes that a state carries."""
    return tuple(a for a in ("user_number", "city_id", "district_name") if a in state.columns) + \
        (("home",) if "home_province" in state.columns else ())


def step(state: DataFrame | None, new_rows: DataFrame, dim: DataFrame,
         residence: DataFrame | None, mode: str = "aggregate", refilter: bool = False,
         dim_broadcast: bool | None = None, attrs=STATE_ATTRS,
         counts: RunCounts | None = None) -> DataFrame:
    """State after one run = old state ∪ the run's cleaned rows (merged).
    In the aggregate layout the new summary carries the same attributes as the state."""
    if state is not None and mode == "aggregate" and not is_raw(state):
        attrs = _attrs(state)
    new = initial_state(new_rows, dim, residence, mode, dim_broadcast, attrs, counts)
    if state is None:
        merged = new
    elif mode == "aggregate":
        merged = merge_summaries(state.unionByName(new))
    else:
        merged = state.unionByName(new)
    if refilter and residence is not None:
        merged = drop_residents(merged, residence)
    return merged


def save_step(old_path: str | None, new_rows: DataFrame, dim: DataFrame, residence: DataFrame | None,
              state_root: str, stamp: str, mode: str = "aggregate", refilter: bool = False,
              dim_broadcast: bool | None = None, epoch: int | None = None,
              counts: RunCounts | None = None) -> str:
    """``step`` as a new state version on ``old_path``: a delta with the new slices' rows only, unless
    there is no version to build on, it is of the other layout, everything is filtered anew, or
    its chain is due for compaction.  ``counts`` gets the new slices' people before and after the
    removal."""
    spark = new_rows.sparkSession
    if old_path is not None:
        old = read_state(spark, old_path)
        if not refilter and is_raw(old) == (mode == "raw") and not compaction_due(spark, old_path):
            new = initial_state(new_rows, dim, residence, mode, dim_broadcast, _attrs(old), counts)
            return save_state(new, state_root, stamp, epoch=epoch, on=old_path)
        state = step(old, new_rows, dim, residence, mode, refilter, dim_broadcast, counts=counts)
    else:
        state = step(None, new_rows, dim, residence, mode, refilter, dim_broadcast, counts=counts)
    return save_state(state, state_root, stamp, epoch=epoch)


def state_visits(state: DataFrame) -> DataFrame:
    """The per-visitor summary both reports read, from either layout."""
    return visit_summary(state) if is_raw(state) else state


def use_old_state(as_of, n: int, reset: str = "window") -> bool:
    """Whether a run at ``as_of`` reading the last ``n`` slices builds on the old state.

    ``reset='window'`` is the original rule (start afresh when n == 0 or in the first run
    of the day, minutes since midnight in [5n, 10n)); ``'by_day'`` is checked by the
    caller against the state's day instead.
    """
    if reset == "window":
        return not needs_reset(as_of, n)
    if reset == "by_day":
        return n != 0
    raise ValueError(reset)

"""The rolling day state as immutable, versioned folders.

Every run writes a *new* folder ``<root>/run=<stamp>-<number>-<id>``; Spark's job commit writes
``_SUCCESS`` last, so a run that dies half-way leaves a folder that readers ignore.  ``number``
counts the versions of the root, so of two versions with one stamp the later commit is the
newer (one writer at a time, as for the scheduled job and the stream).  Readers take the newest
complete version older than their own stamp.  Nothing is ever overwritten in place or renamed.

A version is whole, or a delta (``...-on<number>``) that holds only what its run's slices add to
the version it names.  So a run writes in proportion to its slices, not to the day.  Readers
merge a chain of deltas with its whole version; every version is bucketed by the visit key, so
the merge moves no rows.  ``compaction_due`` tells when the chain is long, or its deltas have
become as large as the whole version; the next run then writes a whole one.

The reports of a version are in ``_reports``, under its name, and go with it.

Pruning drops whole state days and leaves a mark of the newest stamp dropped: a run whose
predecessor is gone raises ``StatePruned`` instead of taking an empty or older state.  Versions
that a kept chain needs stay.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from footfall.functions.slices import state_day
from footfall.operators.visits import VISIT_KEY, merge_summaries
from footfall.sinks.bucketed import read_bucketed, save_bucketed
from footfall.sources import fs

#: Buckets of a new state root (those of an old one are in its mark ``buckets=<n>``).
BUCKETS = 16
#: Most deltas of a chain.
MAX_DELTAS = 12

_RUN = re.compile(r"^run=(\d{12})-(\d{10})-([0-9a-z]+)(?:-on(\d{10}))?$")
_PRUNED = re.compile(r"^pruned=(\d{12})$")
_BUCKETS = re.compile(r"^buckets=(\d+)$")


class StatePruned(RuntimeError):
    """The state version that a run builds on was pruned."""


def _runs(spark: SparkSession, root: str, complete: bool = True) -> list[tuple[str, int, str]]:
    """(stamp, number, folder name) of the (complete) state versions, oldest first."""
    found = [(m.group(1), int(m.group(2)), m.group(0)) for m in map(_RUN.match, fs.list_dirs(spark, root)) if m]
    return sorted(r for r in found if not complete or fs.exists(spark, f"{root}/{r[2]}/_SUCCESS"))


def _pruned(spark: SparkSession, root: str) -> str:
    """Newest stamp that was pruned ('' if none)."""
    return max([m.group(1) for m in map(_PRUNED.match, fs.list_dirs(spark, root)) if m], default="")


def _buckets(spark: SparkSession, root: str) -> int | None:
    return min([int(m.group(1)) for m in map(_BUCKETS.match, fs.list_dirs(spark, root)) if m], default=None)


def _on(name: str) -> int | None:
    """Number of the version that a delta builds on."""
    return int(on) if (on := _RUN.match(name).group(4)) else None


def _chain(spark: SparkSession, path: str) -> list[str]:
    """The paths of a version's chain, the whole version first."""
    root, name = path.rstrip("/").rsplit("/", 1)
    names = {n: x for _, n, x in _runs(spark, root)} if _on(name) is not None else {}
    chain = [name]
    while (on := _on(chain[0])) is not None:
        if on not in names:
            raise StatePruned(f"version {on}, which {chain[0]} builds on, is gone")
        chain.insert(0, names[on])
    return [f"{root}/{x}" for x in chain]


def save_state(state: DataFrame, root: str, stamp: str, fmt: str = "orc", epoch: int | None = None,
               on: str | None = None, buckets: int = BUCKETS) -> str:
    """Write a new state version for the run ``stamp``; returns its path.  ``epoch`` (of a
    stream) becomes part of the name.  ``on``: path of the version that ``state`` is a delta of."""
    root, spark = root.rstrip("/"), state.sparkSession
    known = _buckets(spark, root)
    if known is None:
        fs.make_dir(spark, f"{root}/buckets={buckets}")
    number = 1 + max([n for _, n, _ in _runs(spark, root, complete=False)], default=0)
    mark = "" if epoch is None else f"e{epoch}x"
    tail = f"-on{_RUN.match(on.rsplit('/', 1)[-1]).group(2)}" if on else ""
    path = f"{root}/run={stamp}-{number:010d}-{mark}{uuid.uuid4().hex[:12]}{tail}"
    save_bucketed(state, path, VISIT_KEY, known or buckets, fmt)
    return path


def reports_path(path: str) -> str:
    """The folder of the reports of a version."""
    root, name = path.rstrip("/").rsplit("/", 1)
    return f"{root}/_reports/{name}"


def compaction_due(spark: SparkSession, path: str, max_deltas: int = MAX_DELTAS) -> bool:
    """Whether the next version on ``path`` should be whole."""
    whole, *deltas = _chain(spark, path)
    return bool(deltas) and (len(deltas) >= max_deltas or
                             sum(fs.size(spark, p) for p in deltas) >= fs.size(spark, whole))


def latest_state(spark: SparkSession, root: str, before: str | None = None,
                 day: str | None = None) -> tuple[str, str] | None:
    """(stamp, path) of the newest complete version with stamp < ``before`` (and of state day
    ``day`` if given; see ``functions.slices.state_day``: the 00:00 slice closes the previous
    day).  Raises ``StatePruned`` if a newer one that qualified was pruned."""
    root = root.rstrip("/")
    fits = lambda s: (before is None or s < before) and (day is None or state_day(s) == day)
    runs = [r for r in _runs(spark, root) if fits(r[0])]
    gone = _pruned(spark, root)
    if gone and fits(gone) and (not runs or runs[-1][0] < gone):
        raise StatePruned(f"the state before {before or 'now'} was pruned (up to {gone}); run with n=0 to rebuild it")
    return (runs[-1][0], f"{root}/{runs[-1][2]}") if runs else None


def latest_state_path(spark: SparkSession, root: str, before: str | None = None,
                      day: str | None = None) -> str | None:
    found = latest_state(spark, root, before, day)
    return found and found[1]


def read_state(spark: SparkSession, path: str, fmt: str = "orc") -> DataFrame:
    """The state at a version: its rows, or those of its chain merged (raw rows: all of them)."""
    chain = _chain(spark, path)
    rows = read_bucketed(spark, chain, VISIT_KEY, _buckets(spark, path.rsplit("/", 1)[0]), fmt)
    return rows if len(chain) == 1 or "end_time" in rows.columns else merge_summaries(rows)


def load_state(spark: SparkSession, root: str, before: str | None = None,
               day: str | None = None, fmt: str = "orc") -> DataFrame | None:
    """The newest complete state, or None when there is none (absent -> empty)."""
    path = latest_state_path(spark, root, before, day)
    return None if path is None else read_state(spark, path, fmt)


def prune_states(spark: SparkSession, root: str, keep_days: int = 2, protect: tuple[str, ...] = ()) -> int:
    """Delete the versions of all but the newest ``keep_days`` state days, except the paths in
    ``protect`` (just written, or still read) and what kept versions build on.  Returns the
    number of folders removed."""
    root = root.rstrip("/")
    whole = _runs(spark, root)
    days = sorted({state_day(s) for s, _, _ in whole})[-keep_days:]
    if not days:
        return 0
    kept = {p.rsplit("/", 1)[-1] for p in protect if p}
    kept |= {name for s, _, name in whole if state_day(s) >= days[0]}
    for name in sorted(kept):
        if _on(name) is not None:
            kept |= {p.rsplit("/", 1)[-1] for p in _chain(spark, f"{root}/{name}")}
    old = [r for r in _runs(spark, root, complete=False) if state_day(r[0]) < days[0] and r[2] not in kept]
    if old:
        fs.make_dir(spark, f"{root}/pruned={old[-1][0]}")  # first, so a crash here hides nothing
    for _, _, name in old:
        fs.delete(spark, reports_path(f"{root}/{name}"))
    return sum(int(fs.delete(spark, f"{root}/{name}")) for _, _, name in old)

"""Time-slice selection: which 5-minute slices (file stamps) a run reads.

The calculators work on a handful of stamps on the driver (the run's parameters, not
data); the predicates apply them to a DataFrame column, and ``stamp_window`` turns a
stamp list into a [from, to) time range that can be pushed down to a columnar scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.constants import (
    DEFAULT_START_BACK_DAYS,
    DEFAULT_START_HOUR,
    SLICE_MINUTES,
)

_STAMP = "%Y%m%d%H%M"
_HOUR = "%Y%m%d%H"
_DATE = "%Y%m%d"


def parse_stamp(stamp: str) -> dt.datetime:
    return dt.datetime.strptime(stamp, _STAMP)


def floor_to_slice(t: dt.datetime) -> dt.datetime:
    return t.replace(minute=t.minute - t.minute % SLICE_MINUTES, second=0, microsecond=0)


def _as_time(as_of) -> dt.datetime:
    return parse_stamp(as_of) if isinstance(as_of, str) else as_of


def last_n_slices(as_of, n: int) -> list[str]:
    """Floor ``as_of`` to 5 minutes, then ``n`` stamps going back, newest first."""
    t = floor_to_slice(_as_time(as_of))
    step = dt.timedelta(minutes=SLICE_MINUTES)
    return [(t - i * step).strftime(_STAMP) for i in range(n)]


def until_now_slices(as_of) -> list[str]:
    """Stamps from the floored ``as_of`` back to, but excluding, 00:00 of that day."""
    t = floor_to_slice(_as_time(as_of))
    midnight = t.replace(hour=0, minute=0)
    step = dt.timedelta(minutes=SLICE_MINUTES)
    out = []
    while t > midnight:
        out.append(t.strftime(_STAMP))
        t -= step
    return out


def stay_range(start_hour: str, days: int) -> list[str]:
    """The start hour (yyyyMMddHH) followed by the next ``days`` dates (yyyyMMdd)."""
    t = dt.datetime.strptime(start_hour, _HOUR)
    return [start_hour] + [(t + dt.timedelta(days=i)).strftime(_DATE) for i in range(1, days + 1)]


def as_date(as_of) -> dt.date:
    """A date from a datetime, a date, or any stamp starting with yyyyMMdd."""
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    if isinstance(as_of, dt.date):
        return as_of
    return dt.datetime.strptime(as_of[:8], _DATE).date()


def default_start(as_of) -> str:
    """T4: Monday of the week of ``as_of`` (weeks start on Monday) minus 8 days, i.e. a
    Sunday, at 23h."""
    d = as_date(as_of)
    monday = d - dt.timedelta(days=d.weekday())
    start = monday - dt.timedelta(days=DEFAULT_START_BACK_DAYS)
    return start.strftime(_DATE) + f"{DEFAULT_START_HOUR:02d}"


def default_start_col(date_col) -> Column:
    """T4 as a column expression over a DateType column."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    start = F.date_sub(F.trunc(c, "week"), DEFAULT_START_BACK_DAYS)
    return F.concat(F.date_format(start, "yyyyMMdd"), F.lit(f"{DEFAULT_START_HOUR:02d}"))


def state_day(stamp: str) -> str:
    """The day (yyyyMMdd) whose state a slice belongs to: a day runs from its 00:05 slice
    to the 00:00 slice of the next date (T2 never reads 00:00 of its own date)."""
    return (parse_stamp(stamp) - dt.timedelta(minutes=SLICE_MINUTES)).strftime(_DATE)


def state_day_col(stamp_col) -> Column:
    """``state_day`` as a column expression over a yyyyMMddHHmm stamp column; null for text
    that is no stamp."""
    s = F.col(stamp_col) if isinstance(stamp_col, str) else stamp_col
    t = F.call_function("try_to_timestamp", s, F.lit("yyyyMMddHHmm")).cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("MINUTE", F.lit(-SLICE_MINUTES), t), "yyyyMMdd")


def batch_stamp(stamps: list[str]) -> str | None:
    """T5: the newest stamp of a run names the run; None for an empty run."""
    return max(stamps) if stamps else None


def needs_reset(as_of, n: int) -> bool:
    """The rolling state is ignored when n == 0, or when the run falls in
    [5n, 10n) minutes after midnight (the first run of the day)."""
    t = _as_time(as_of)
    minutes = t.hour * 60 + t.minute
    return n == 0 or (SLICE_MINUTES * n <= minutes < 2 * SLICE_MINUTES * n)


def needs_reset_col(stamp_col, n: int) -> Column:
    """I2 as a column expression over a yyyyMMddHHmm stamp column."""
    s = F.col(stamp_col) if isinstance(stamp_col, str) else stamp_col
    minutes = F.substring(s, 9, 2).cast("int") * 60 + F.substring(s, 11, 2).cast("int")
    if n == 0:
        return F.lit(True)
    return (minutes >= SLICE_MINUTES * n) & (minutes < 2 * SLICE_MINUTES * n)


def is_contiguous(stamps) -> bool:
    """True when the stamps are consecutive 5-minute slices (any order)."""
    ts = sorted(parse_stamp(s) for s in stamps)
    step = dt.timedelta(minutes=SLICE_MINUTES)
    return all(b - a == step for a, b in zip(ts, ts[1:]))


def stamps_predicate(stamp_col, stamps) -> Column:
    """Rows whose slice stamp is one of ``stamps`` (empty list selects nothing).
    A contiguous run (T1/T2 always are) becomes a range on the fixed-width stamp."""
    s = F.col(stamp_col) if isinstance(stamp_col, str) else stamp_col
    if not stamps:
        return F.lit(False)
    if is_contiguous(stamps):
        return s.between(min(stamps), max(stamps))
    return s.isin(list(stamps))


def prefix_predicate(stamp_col, prefixes) -> Column:
    """Rows whose stamp starts with one of ``prefixes`` (hour or date stamps, as in T3)."""
    s = F.col(stamp_col) if isinstance(stamp_col, str) else stamp_col
    cond = F.lit(False)
    for length in sorted({len(p) for p in prefixes}):
        group = [p for p in prefixes if len(p) == length]
        cond = cond | F.substring(s, 1, length).isin(group)
    return cond


def stamp_window(stamps) -> tuple[dt.datetime, dt.datetime] | None:
    """[from, to) time range covering slice stamps or hour/date prefixes."""
    if not stamps:
        return None
    lo, hi = [], []
    for s in stamps:
        if len(s) == 12:
            t = dt.datetime.strptime(s, _STAMP)
            lo.append(t)
            hi.append(t + dt.timedelta(minutes=SLICE_MINUTES))
        elif len(s) == 10:
            t = dt.datetime.strptime(s, _HOUR)
            lo.append(t)
            hi.append(t + dt.timedelta(hours=1))
        elif len(s) == 8:
            t = dt.datetime.strptime(s, _DATE)
            lo.append(t)
            hi.append(t + dt.timedelta(days=1))
        else:
            raise ValueError(f"not a stamp: {s!r}")
    return min(lo), max(hi)


def slice_table(spark: SparkSession, window: tuple[dt.datetime, dt.datetime] | None) -> DataFrame:
    """The slices of a [from, to) time range (``stamp_window``) as a table with the column ``slice``,
    made by Spark: the range's two ends are all that the plan holds.  None gives no slices."""
    lo, hi = window or (dt.datetime(1970, 1, 1),) * 2
    lo, step = floor_to_slice(lo), dt.timedelta(minutes=SLICE_MINUTES)
    first = F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
    stamp = F.date_format(F.timestamp_add("MINUTE", F.col("id") * SLICE_MINUTES, first), "yyyyMMddHHmm")
    # the filter says nothing new, but Spark prunes by a table only if it has one
    return spark.range(-(-(hi - lo) // step)).select(stamp.alias("slice")).where(F.col("slice") < hi.strftime(_STAMP))

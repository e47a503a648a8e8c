"""R3-R5 from daily summaries: the weekly labelling without reading the week's slices again.

Every day one job reduces that day's slices to spans: per (imsi, district, rule, stay date) the
first and last end time and the visitor's attributes (``day_spans``, bounded by people x
districts, not by records).  The weekly job merges the spans of its days and has, per person,
district and rule, a bitmap of the dates with a qualifying stay (``presence``: ``bit_or``); the
number of its bits decides (``bit_count``).  The result equals ``residence_table`` on the slices.

A night belongs to two days' slices, so a day's spans are partial: they are merged before the
stay threshold is applied, and only then become bits.  Spans of slices at hour 23 are told apart
(``at_23``), since the first day of a stay range begins there.  A record that comes in a later
day's slice counts for its own stay date, as in the one-pass table.

Each day is a folder of its own, bucketed by the visit key, so the merge and the labelling move no
rows.  A day that is written again (a replay, late slices) is a new folder, and the newest
complete one counts; nothing is overwritten.  One writer at a time.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.constants import DEFAULT_CITY_ID, MIN_STAY_SECONDS, NIGHT_FROM_HOUR
from footfall.operators.residence import (
    STAY_KEY,
    is_night,
    is_work,
    label,
    people,
    tag_periods,
)
from footfall.operators.visits import VISIT_KEY, time_epoch, time_key
from footfall.sinks.bucketed import read_bucketed, save_bucketed
from footfall.sources import fs

#: Buckets of a root of daily spans (all its days have the same number).
BUCKETS = 16
#: Dates that one bitmap can tell apart; a range of more is refused.
MAX_DATES = 63

_DAY = re.compile(r"^day=(\d{8})-(\d{10})-[0-9a-f]{12}$")
_ATTRS = ("user_number", "city_id", "district_name")


class DayMissing(RuntimeError):
    """A day of the range has no spans."""


def day_spans(rows: DataFrame, dim: DataFrame, city_id: int | None = DEFAULT_CITY_ID, rollover: bool = True,
              dim_broadcast: bool | None = None) -> DataFrame:
    """The spans of one day's signal rows, which carry the stamp of their slice in ``slice``.

    A hash aggregate keyed by the string attributes reduces the rows first, as in ``daily_stays``; a
    hot visitor is one row per task before the shuffle."""
    at_23 = F.substring("slice", 9, 2).cast("int") == NIGHT_FROM_HOUR
    hour_of_row = F.substring(F.col("hour").cast("string"), 9, 2).cast("int")
    used = rows.withColumn("at_23", at_23).where(is_night(hour_of_row) | is_work(hour_of_row))
    tagged = tag_periods(people(used, dim, city_id, dim_broadcast, keep=("at_23",)), rollover=rollover)
    key = [*STAY_KEY, "stay_date", "at_23"]
    reduced = tagged.groupBy(*key, "user_number", "district_name").agg(
        F.min("city_id").alias("city_id"), F.min(time_key("end_time")).alias("lo"), F.max(time_key("end_time")).alias("hi"))
    return reduced.repartition(*VISIT_KEY).groupBy(*key).agg(*_merged())


def _merged() -> list[Column]:
    return [*[F.min(a).alias(a) for a in _ATTRS], F.min("lo").alias("lo"), F.max("hi").alias("hi")]


def save_day(spans: DataFrame, root: str, day: str, buckets: int = BUCKETS) -> str:
    """The spans of ``day`` (yyyyMMdd) as its newest version; returns the folder."""
    root, spark = root.rstrip("/"), spans.sparkSession
    number = 1 + max((n for n, _ in _versions(spark, root, complete=False).get(day, ())), default=0)
    path = f"{root}/day={day}-{number:010d}-{uuid.uuid4().hex[:12]}"
    save_bucketed(spans.withColumn("day", F.lit(day)), path, VISIT_KEY, buckets)
    return path


def _versions(spark: SparkSession, root: str, complete: bool = True) -> dict[str, list[tuple[int, str]]]:
    """(number, folder) of the (complete) versions of each day, oldest first."""
    out: dict[str, list[tuple[int, str]]] = {}
    for m in sorted(filter(None, map(_DAY.match, fs.list_dirs(spark, root))), key=lambda m: m.group(0)):
        if not complete or fs.exists(spark, f"{root}/{m.group(0)}/_SUCCESS"):
            out.setdefault(m.group(1), []).append((int(m.group(2)), m.group(0)))
    return out


def read_days(spark: SparkSession, root: str, stamps, buckets: int = BUCKETS) -> DataFrame:
    """The spans of a stay range (T3: the hour 23 of its first day, then whole days), from the newest
    version of each day.  A day without spans raises ``DayMissing``: it was not summarised (a day
    without rows has an empty summary)."""
    root, found = root.rstrip("/"), _versions(spark, root.rstrip("/"))
    first, *days = stamps
    if len(first) != 10 or int(first[8:]) != NIGHT_FROM_HOUR or any(len(d) != 8 for d in days):
        raise ValueError(f"not a stay range: {stamps}")
    if len(days) >= MAX_DATES:
        raise ValueError(f"more than {MAX_DATES - 1} days")
    if absent := [d for d in (first[:8], *days) if d not in found]:
        raise DayMissing(f"no spans of {absent} in {root}")
    folders = [f"{root}/{found[d][-1][1]}" for d in (first[:8], *days)]
    rows = read_bucketed(spark, folders, VISIT_KEY, buckets)  # one table: a union would lose the buckets
    return rows.where(F.col("at_23") | (F.col("day") != first[:8])).drop("day")


def presence(spans: DataFrame, min_stay_seconds: int = MIN_STAY_SECONDS) -> DataFrame:
    """Per (imsi, district, rule) the bitmap ``dates`` of its qualifying stay dates, with the visitor's
    attributes.  The bit of a date is its day number modulo 63: a range of up to 62 days and the
    date after it (nights that begin on the last day) share no bit.  Bitmaps of disjoint
    ranges can be merged by ``bit_or``."""
    stays = spans.groupBy(*STAY_KEY, "stay_date").agg(*_merged())
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.unix_date("stay_date"), F.lit(MAX_DATES)))
    return (stays.where(time_epoch("hi") - time_epoch("lo") >= min_stay_seconds).groupBy(*STAY_KEY)
            .agg(*[F.min(a).alias(a) for a in _ATTRS], F.bit_or(bit).alias("dates")))


def residence_from_spans(spans: DataFrame, days: int, min_stay_seconds: int = MIN_STAY_SECONDS,
                         match: str = "exact") -> DataFrame:
    """``residence_table`` from the spans of its stay range."""
    counts = presence(spans, min_stay_seconds).withColumn("stay_days", F.bit_count("dates"))
    return label(counts, days, match)

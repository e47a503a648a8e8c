"""Who lives (night) or works (working hours) in a district.

One pass labels both: every row is tagged with the rule it falls under (night and
working hours do not overlap), so residents and staff share one scan, one join and one
aggregation chain instead of two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.constants import (
    ATTR_RESIDENT,
    ATTR_STAFF,
    DEFAULT_CITY_ID,
    MIN_STAY_SECONDS,
    NIGHT_FROM_HOUR,
    NIGHT_TO_HOUR,
    WORK_FROM_HOUR,
    WORK_TO_HOUR,
)
from footfall.functions.parse import hour_date, hour_of_day
from footfall.operators.joins import district_join
from footfall.operators.visits import time_epoch, time_key

PEOPLE_INPUT = ["imsi", "user_number", "latn_id", "base_statn_id", "sector_id", "end_time", "hour"]
STAY_KEY = ["imsi", "district_id", "user_attr"]
# Partitioning the daily stays by the visit key serves the stay-day count (a superset key)
# and the later removal join on (district_id, imsi) without further shuffles.
COLOCATE_KEY = ["imsi", "district_id"]
_ATTRS = ["user_number", "city_id", "district_name"]


def calendar_split(signal: DataFrame, city_id: int | None = DEFAULT_CITY_ID, keep=()) -> DataFrame:
    """Prune to 7 columns (and ``keep``), keep one serving city, split ``hour`` (yyyyMMddHH)
    into ``date`` (DateType) and ``hour`` (hour of day)."""
    s = signal.select(*PEOPLE_INPUT, *keep)
    if city_id is not None:
        s = s.where(F.col("latn_id") == city_id)
    return s.select(*[c for c in PEOPLE_INPUT if c != "hour"], *keep,
                    hour_of_day("hour").alias("hour"), hour_date("hour").alias("date"))


def people(signal: DataFrame, dim: DataFrame, city_id: int | None = DEFAULT_CITY_ID,
           dim_broadcast: bool | None = None, keep=()) -> DataFrame:
    """P1-P3 + J1: calendar-split rows of one city mapped to their districts."""
    return district_join(calendar_split(signal, city_id, keep), dim, dim_broadcast)


def is_night(hour: Column) -> Column:
    """23:00-06:59."""
    return (hour >= NIGHT_FROM_HOUR) | (hour <= NIGHT_TO_HOUR)


def is_work(hour: Column) -> Column:
    """08:00-17:59."""
    return (hour >= WORK_FROM_HOUR) & (hour <= WORK_TO_HOUR)


def tag_periods(people_df: DataFrame, residents: bool = True, staff: bool = True,
                rollover: bool = True) -> DataFrame:
    """Keep night rows (user_attr 1) and/or working-hour rows (user_attr 2) and
    give each its stay date; with ``rollover`` hour 23 counts for the next date (P5)."""
    h = F.col("hour")
    attr = None
    if residents:
        attr = F.when(is_night(h), F.lit(ATTR_RESIDENT))
    if staff:
        attr = (attr if attr is not None else F).when(is_work(h), F.lit(ATTR_STAFF))
    if attr is None:
        raise ValueError("select residents and/or staff")
    stay_date = F.col("date")
    if rollover:
        stay_date = F.when(h == NIGHT_FROM_HOUR, F.date_add("date", 1)).otherwise(F.col("date"))
    return (people_df.withColumn("user_attr", attr).where(F.col("user_attr").isNotNull())
            .withColumn("stay_date", stay_date))


def daily_stays(tagged: DataFrame, with_attrs: bool = True, colocate: bool = True) -> DataFrame:
    """Per (imsi, district, attr, stay date) the span between the first and last
    end time (seconds), with the visitor's attributes when ``with_attrs``.

    With attributes, the raw rows are reduced by a hash aggregate (times as integers,
    string attributes in the key) first.  The (reduced) output is then co-partitioned by
    (imsi, district_id), so the second stage, the stay-day count and a removal join on
    that key need no further shuffle.  Without attributes (only the keys are needed,
    e.g. to remove people) the first stage is the only aggregate."""
    key = STAY_KEY + ["stay_date"]
    times = [F.min(time_key("end_time")).alias("lo"), F.max(time_key("end_time")).alias("hi")]
    if not with_attrs:
        stage = tagged.groupBy(*key).agg(*times)
        if colocate:
            stage = stage.repartition(*COLOCATE_KEY)
        return stage.select(*key, (time_epoch("hi") - time_epoch("lo")).alias("duration"))
    stage1 = tagged.groupBy(*key, "user_number", "district_name").agg(
        F.min("city_id").alias("city_id"), *times)
    if colocate:
        stage1 = stage1.repartition(*COLOCATE_KEY)
    stage2 = stage1.groupBy(*key).agg(*[F.min(a).alias(a) for a in _ATTRS],
                                      F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return stage2.select(*key, *_ATTRS, (time_epoch("hi") - time_epoch("lo")).alias("duration"))


def qualifying_stays(stays: DataFrame, min_stay_seconds: int = MIN_STAY_SECONDS) -> DataFrame:
    """Stays of at least ``min_stay_seconds`` (the original threshold is 4 seconds)."""
    return stays.where(F.col("duration") >= min_stay_seconds)


def stay_day_counts(stays: DataFrame, min_stay_seconds: int = MIN_STAY_SECONDS) -> DataFrame:
    """P7 + A7: number of qualifying stay dates per (imsi, district, attr)."""
    attrs = [F.min(a).alias(a) for a in _ATTRS if a in stays.columns]
    return (qualifying_stays(stays, min_stay_seconds).groupBy(*STAY_KEY)
            .agg(*attrs, F.count(F.lit(1)).alias("stay_days")))


def label(counts: DataFrame, days: int, match: str = "exact") -> DataFrame:
    """Keep people present on exactly ``days`` dates (``match='at_least'``: >=)."""
    if match == "exact":
        cond = F.col("stay_days") == days
    elif match == "at_least":
        cond = F.col("stay_days") >= days
    else:
        raise ValueError(match)
    cols = [c for c in ("imsi", "user_number", "city_id", "district_id", "district_name", "user_attr")
            if c in counts.columns]
    return counts.where(cond).select(*cols)

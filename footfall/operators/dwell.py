"""A1, F1, A2: dwell time per visitor and the dwell-band histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.constants import STAMP_FORMAT
from footfall.functions.bands import dwell_section
from footfall.operators.visits import time_epoch
from footfall.schemas import VISITOR_FLOW_DUR


def batch_timestamp(stamp: str):
    """T5: the run's stamp (yyyyMMddHHmm) as a wall-clock timestamp (zone-free)."""
    return F.to_timestamp_ntz(F.lit(stamp), F.lit(STAMP_FORMAT))


def dwell_duration() -> Column:
    """Seconds from the first to the last end time of a visit summary."""
    return time_epoch("max_end_time") - time_epoch("min_end_time")


def dwell(visits: DataFrame) -> DataFrame:
    """A1: duration = last end time - first end time (seconds) per (imsi, district)."""
    keep = [c for c in ("imsi", "district_id", "user_number", "city_id", "district_name")
            if c in visits.columns]
    return visits.select(*keep, dwell_duration().alias("duration"))


def with_section(dwell_df: DataFrame) -> DataFrame:
    """dwell band 0..6 (null for null/negative durations)."""
    return dwell_df.withColumn("section_id", dwell_section("duration"))


def dwell_histogram(sectioned: DataFrame, stamp: str | None) -> DataFrame:
    """A2 + T5 + P11: visitors per (district, band), stamped with the run's time.

    ``count(imsi)`` leaves null imsi out; ``city_id`` is the smallest of the district.
    An empty run (no stamp) gives an empty report.
    """
    if stamp is None:
        return SparkSession.getActiveSession().createDataFrame([], VISITOR_FLOW_DUR)
    agg = (sectioned.groupBy("district_id", "section_id")
           .agg(F.min("city_id").alias("city_id"), F.count("imsi").alias("visitor_number")))
    return agg.select(batch_timestamp(stamp).alias("timestamp"), "city_id", "district_id",
                      "section_id", "visitor_number")

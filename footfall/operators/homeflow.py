"""A3, A4: recency per visitor and nested recency counts per home area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.constants import RECENCY_MINUTES, STAMP_FORMAT
from footfall.functions.bands import recency_flags
from footfall.functions.parse import epoch_seconds
from footfall.operators.dwell import batch_timestamp
from footfall.operators.visits import time_epoch
from footfall.schemas import VISITOR_FLOW_HOME


def recency(visits: DataFrame, stamp: str, keep=()) -> DataFrame:
    """A3: seconds from the visitor's last end time to the run's stamp (may be negative).
    ``keep``: further columns to carry."""
    own = [c for c in ("imsi", "district_id", "user_number", "city_id", "district_name",
                       "home_province", "home_city") if c in visits.columns]
    return visits.select(
        *own, *keep,
        (epoch_seconds(F.lit(stamp), STAMP_FORMAT) - time_epoch("max_end_time")).alias("duration"))


def home_counts(recency_df: DataFrame, stamp: str | None, minutes=RECENCY_MINUTES) -> DataFrame:
    """A4 + T5 + P11: per (district, home province, home city), how many visitors were
    last seen within 30 / 150 / 1470 minutes (cumulative; null recency counts 0)."""
    if stamp is None:
        return SparkSession.getActiveSession().createDataFrame([], VISITOR_FLOW_HOME)
    flags = recency_flags("duration", minutes)
    names = [f"visitor_number{i + 1}" for i in range(len(flags))]
    agg = (recency_df.select("district_id", "home_province", "home_city", "city_id",
                             *[f.alias(n) for f, n in zip(flags, names)])
           .groupBy("district_id", "home_province", "home_city")
           .agg(F.min("city_id").alias("city_id"), *[F.sum(n).cast("long").alias(n) for n in names]))
    return agg.select(batch_timestamp(stamp).alias("timestamp"), "city_id", "district_id",
                      "home_province", "home_city", *names)

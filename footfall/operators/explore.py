"""The exploratory queries that exist only as drafts in the original jobs.

Fixed values: their keys and result names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.constants import DEFAULT_CITY_ID
from footfall.functions.slices import as_date


def week_range(as_of) -> tuple[int, int]:
    """[Sunday 23h, Friday 23h) of the week before ``as_of`` (weeks start Monday),
    as yyyyMMddHH integers."""
    week_ago = as_date(as_of) - dt.timedelta(days=7)
    monday = week_ago - dt.timedelta(days=week_ago.weekday())
    friday = monday + dt.timedelta(days=4)
    sunday = monday - dt.timedelta(days=1)
    return int(sunday.strftime("%Y%m%d") + "23"), int(friday.strftime("%Y%m%d") + "23")


def week_range_rows(signal: DataFrame, as_of) -> DataFrame:
    """Signal rows with lo <= hour < hi."""
    lo, hi = week_range(as_of)
    return signal.where((F.col("hour") >= lo) & (F.col("hour") < hi))


def sector_rollup(dim_full: DataFrame, city_id: int = DEFAULT_CITY_ID) -> DataFrame:
    """One row per cell of a city with its names, ordered."""
    keys = ["city_id", "district_id", "base_statn_id", "sector_id"]
    return (dim_full.where(F.col("city_id") == city_id).groupBy(*keys)
            .agg(F.min("district_name").alias("district_name"),
                 F.min("base_statn_name").alias("base_statn_name"),
                 F.min("sector_name").alias("sector_name"))
            .orderBy("city_id", "sector_id", "district_id", "base_statn_id"))


def cell_multiplicity(dim: DataFrame, city_id: int = DEFAULT_CITY_ID) -> DataFrame:
    """Rows per cell key in the dimension (anything above 1 fans out the join)."""
    keys = ["city_id", "base_statn_id", "sector_id"]
    return (dim.where(F.col("city_id") == city_id).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n")).orderBy(*keys))


def hour_coverage(tagged: DataFrame) -> DataFrame:
    """Per (imsi, date, district) the number of distinct hours and the hour list.
    The list holds at most 24 values, so collecting it per group is bounded."""
    hours = F.array_sort(F.collect_set(F.col("hour").cast("string")))
    return (tagged.groupBy("imsi", "date", "district_id")
            .agg(F.min("hour").alias("first_hour"), F.min("user_number").alias("user_number"),
                 F.count_distinct("hour").alias("cd_hour"),
                 F.concat_ws(";", hours).alias("hours")))


def cell_load(signal: DataFrame, hour: int, city_id: int = DEFAULT_CITY_ID) -> DataFrame:
    """Records per cell for one hour and city, ordered."""
    keys = ["latn_id", "base_statn_id", "sector_id"]
    return (signal.where((F.col("latn_id") == city_id) & (F.col("hour") == hour))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys))

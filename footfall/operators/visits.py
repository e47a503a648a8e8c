"""Per-(imsi, district) visit summary shared by both reports (A1/A3 first stage).

Both reports need, per visitor and district, the first and last end_time plus the
visitor's attributes.  The original job takes ``first()`` of the attributes, which is
order-dependent; the deterministic stand-in here is ``min()`` (the home pair as one
struct so province and city stay a real pair; records without a province have no say).

Plan shape: min/max over *string* columns forces a sort-based aggregate over every raw
row, so the raw rows are first reduced by a hash aggregate keyed by the visit key *and*
the attribute values, with the times as 14-digit integers (their numeric order equals
the text order for fixed-width digits, which the scan checks).  That stage has a map-side
partial aggregate, so a hot visitor collapses to one row per task before the shuffle.
The second stage then works on about one row per visitor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.parse import epoch_seconds

VISIT_KEY = ["imsi", "district_id"]
# Attributes a summary can carry; "home" is the (home_province, home_city) pair.
ALL_ATTRS = ("user_number", "city_id", "district_name", "home")


def time_key(c) -> Column:
    """yyyyMMddHHmmss text as a bigint (null unless exactly 14 characters)."""
    e = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(e) == 14, e.try_cast("long"))


def time_text(c) -> Column:
    """Inverse of ``time_key``."""
    e = F.col(c) if isinstance(c, str) else c
    return F.lpad(e.cast("string"), 14, "0")


def time_epoch(c) -> Column:
    """Epoch seconds (session time zone) of a ``time_key`` value."""
    return epoch_seconds(time_text(c))


def visit_summary(enriched: DataFrame, attrs=ALL_ATTRS) -> DataFrame:
    """One row per (imsi, district_id): the requested attributes + min/max end time.

    Only the attributes a consumer needs should be requested: without string attributes
    this is a single hash aggregate; with them, a hash aggregate keyed by the attribute
    values reduces the rows first and a second aggregate runs on ~one row per visitor.
    """
    attrs = set(attrs)
    times = [F.min(time_key("end_time")).alias("min_end_time"),
             F.max(time_key("end_time")).alias("max_end_time")]
    num = [F.min("city_id").alias("city_id")] if "city_id" in attrs else []
    keyed = [a for a in ("user_number", "district_name") if a in attrs]
    if "home" in attrs:
        keyed += ["home_province", "home_latn_id"]
    if not keyed:
        return enriched.groupBy(*VISIT_KEY).agg(*num, *times)
    stage1 = enriched.groupBy(*VISIT_KEY, *keyed).agg(*num, *times)
    return merge_summaries(stage1.withColumnRenamed("home_latn_id", "home_city"))


def merge_summaries(parts: DataFrame) -> DataFrame:
    """Combine partial visit summaries (e.g. the day state and a new run's summary):
    min of mins, max of maxes, min of the attributes that are present."""
    cols = parts.columns
    aggs = [F.min(a).alias(a) for a in ("user_number", "city_id", "district_name") if a in cols]
    if "home_province" in cols:
        # a record without a home says nothing: a struct of nulls is not null, so leave it out
        known = F.col("home_province").isNotNull() & (F.col("home_province") != "")
        aggs.append(F.min(F.when(known, F.struct("home_province", "home_city"))).alias("_home"))
    aggs += [F.min("min_end_time").alias("min_end_time"), F.max("max_end_time").alias("max_end_time")]
    out = parts.groupBy(*VISIT_KEY).agg(*aggs)
    sel = VISIT_KEY + [a for a in ("user_number", "city_id", "district_name") if a in cols]
    if "home_province" in cols:
        sel += [F.col("_home.home_province").alias("home_province"),
                F.col("_home.home_city").alias("home_city")]
    return out.select(*sel, "min_end_time", "max_end_time")

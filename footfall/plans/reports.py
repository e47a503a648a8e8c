"""The two visitor reports as compositions of the operators.

visits = J1 (district join) -> A1/A3 first stage (visit summary) -> J2 (residents out)

J2 runs on the visit summary rather than on raw rows: its key (district_id, imsi) is
the summary's grouping key, so removing a key's rows before grouping or its group after
grouping gives the same result, while the summary is far smaller and already
hash-partitioned on the key — the residence side is the only one that moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.constants import RECENCY_MINUTES
from footfall.functions.bands import dwell_section, recency_flags
from footfall.operators.counts import RunCounts
from footfall.operators.dwell import batch_timestamp, dwell, dwell_duration, dwell_histogram, with_section
from footfall.operators.homeflow import home_counts, recency
from footfall.operators.joins import district_join, drop_residents
from footfall.operators.visits import ALL_ATTRS, visit_summary

DWELL_ATTRS = ("city_id",)
HOME_ATTRS = ("city_id", "home")


def visits(signal_rows: DataFrame, dim: DataFrame, residence: DataFrame | None = None,
           dim_broadcast: bool | None = None, attrs=ALL_ATTRS, counts: RunCounts | None = None) -> DataFrame:
    """Per-(imsi, district) visit summary of signal rows, residents/staff removed.
    ``attrs``: the attributes to carry (DWELL_ATTRS / HOME_ATTRS are what the reports
    read; the day state keeps ALL_ATTRS).  ``counts`` gets the people before and after the
    removal."""
    v = visit_summary(district_join(signal_rows, dim, dim_broadcast), attrs)
    return without_residents(v, residence, counts)


def without_residents(df: DataFrame, residence: DataFrame | None, counts: RunCounts | None = None) -> DataFrame:
    """J2, with the rows before and after it in ``counts``."""
    if counts is not None:
        df = counts.observe("found", df, n=F.count(F.lit(1)))
    out = df if residence is None else drop_residents(df, residence)
    return out if counts is None else counts.observe("kept", out, n=F.count(F.lit(1)))


def dwell_report(visits_df: DataFrame, stamp: str | None) -> DataFrame:
    """Visitors per (district, dwell band) at the run's stamp (empty without one)."""
    if stamp is None:
        return dwell_histogram(visits_df, None)
    return dwell_histogram(with_section(dwell(visits_df)), stamp)


def home_report(visits_df: DataFrame, stamp: str | None) -> DataFrame:
    """R2: nested recency counts per (district, home province, home city)."""
    return home_counts(recency(visits_df, stamp), stamp) if stamp else home_counts(visits_df, None)


def visitor_flow_dur(signal_rows, dim, residence, stamp, dim_broadcast=None) -> DataFrame:
    return dwell_report(visits(signal_rows, dim, residence, dim_broadcast, DWELL_ATTRS), stamp)


def visitor_flow_home(signal_rows, dim, residence, stamp, dim_broadcast=None) -> DataFrame:
    return home_report(visits(signal_rows, dim, residence, dim_broadcast, HOME_ATTRS), stamp)


# --- both reports in one pass (C1) ------------------------------------------------------

#: The values of ``report`` in ``both_reports``.
DWELL, HOME = "dwell", "home"
_NUMBERS = [f"visitor_number{i + 1}" for i in range(len(RECENCY_MINUTES))]


def both_reports(visits_df: DataFrame, stamp: str, counts: RunCounts | None = None) -> DataFrame:
    """R1 and R2 from one scan of the visits: one aggregate with two grouping sets, (district,
    band) and (district, home province, home city).  The rows of a report carry its name in
    ``report`` and nulls in the columns of the other; ``dwell_rows`` and ``home_rows`` pick them.
    ``counts`` gets the visitors without a band, by cause (F1)."""
    last = recency(visits_df.withColumn("_dwell", dwell_duration()), stamp, keep=("_dwell",))
    rows = last.select("imsi", "city_id", "district_id", "home_province", "home_city", F.col("_dwell"),
                       dwell_section("_dwell").alias("section_id"),
                       *[f.alias(n) for f, n in zip(recency_flags("duration"), _NUMBERS)])
    if counts is not None:
        rows = counts.observe("dwell", rows, negative=F.count_if(F.col("_dwell") < 0),
                              unknown=F.count_if(F.col("_dwell").isNull()))
    by_band, by_home = ["district_id", "section_id"], ["district_id", "home_province", "home_city"]
    agg = (rows.groupingSets([by_band, by_home], *by_band, *by_home[1:])
           .agg(F.grouping("section_id").alias("_home"), F.min("city_id").alias("city_id"),
                F.count("imsi").alias("visitor_number"),
                *[F.sum(n).cast("long").alias(n) for n in _NUMBERS]))
    home = F.col("_home") == 1
    return agg.select(F.when(home, F.lit(HOME)).otherwise(F.lit(DWELL)).alias("report"),
                      batch_timestamp(stamp).alias("timestamp"), "city_id", "district_id", "section_id",
                      "home_province", "home_city", F.when(~home, F.col("visitor_number")).alias("visitor_number"),
                      *[F.when(home, F.col(n)).alias(n) for n in _NUMBERS])


def save_reports(visits_df: DataFrame, stamp: str, path: str, counts: RunCounts | None = None) -> DataFrame:
    """Both reports in one job, written to ``path`` and read back: further use scans the few rows of
    the reports and not the state."""
    both_reports(visits_df, stamp, counts).write.mode("overwrite").parquet(path)
    return visits_df.sparkSession.read.parquet(path)


def dwell_rows(both: DataFrame) -> DataFrame:
    """R1 out of ``both_reports``."""
    return both.where(F.col("report") == DWELL).select("timestamp", "city_id", "district_id", "section_id", "visitor_number")


def home_rows(both: DataFrame) -> DataFrame:
    """R2 out of ``both_reports``."""
    return both.where(F.col("report") == HOME).select("timestamp", "city_id", "district_id", "home_province", "home_city", *_NUMBERS)

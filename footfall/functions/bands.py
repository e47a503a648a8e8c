"""Dwell bands and recency flags as native ``when`` chains (no UDF, stays in codegen)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.constants import DWELL_BAND_UPPER, RECENCY_MINUTES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dwell_section(duration) -> Column:
    """Band 0..6 of a dwell duration in seconds; null for null or negative durations."""
    d = _col(duration)
    expr = F.when(d == DWELL_BAND_UPPER[0], F.lit(0))
    for k in range(1, len(DWELL_BAND_UPPER)):
        expr = expr.when((d > DWELL_BAND_UPPER[k - 1]) & (d <= DWELL_BAND_UPPER[k]), F.lit(k))
    return expr.when(d > DWELL_BAND_UPPER[-1], F.lit(len(DWELL_BAND_UPPER)))


def recency_flags(recency, minutes=RECENCY_MINUTES) -> list[Column]:
    """0/1 flags ``recency <= m minutes`` for each threshold; 0 when recency is null.
    Thresholds are cumulative, so flag1 <= flag2 <= flag3."""
    r = _col(recency)
    return [F.when(r <= m * 60, F.lit(1)).otherwise(F.lit(0)) for m in minutes]

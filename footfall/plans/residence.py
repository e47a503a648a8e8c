"""Residents, staff and the residence table.

``residence_table`` is the one-pass plan (both rules in one scan/join/aggregation);
``residents`` and ``staff`` run one rule each, as the original job did (two passes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.constants import DEFAULT_CITY_ID, MIN_STAY_SECONDS
from footfall.operators.residence import daily_stays, label, people, stay_day_counts, tag_periods


def _label(signal_rows, dim, days, residents, staff, city_id, min_stay_seconds, match,
           rollover, dim_broadcast, with_attrs=True):
    p = people(signal_rows, dim, city_id, dim_broadcast)
    t = tag_periods(p, residents=residents, staff=staff, rollover=rollover)
    return label(stay_day_counts(daily_stays(t, with_attrs), min_stay_seconds), days, match)


def residence_table(signal_rows: DataFrame, dim: DataFrame, days: int,
                    city_id: int = DEFAULT_CITY_ID, min_stay_seconds: int = MIN_STAY_SECONDS,
                    match: str = "exact", rollover: bool = True,
                    dim_broadcast: bool | None = None, with_attrs: bool = True) -> DataFrame:
    """Residents (user_attr 1) and staff (user_attr 2) of the stay range in one pass.

    ``with_attrs=False`` returns only (imsi, district_id, user_attr) — enough to remove
    people from the reports, and cheaper (no string attributes in the aggregates)."""
    return _label(signal_rows, dim, days, True, True, city_id, min_stay_seconds, match,
                  rollover, dim_broadcast, with_attrs)


def residents(signal_rows, dim, days, city_id=DEFAULT_CITY_ID, min_stay_seconds=MIN_STAY_SECONDS,
              match="exact", rollover=True, dim_broadcast=None) -> DataFrame:
    """Night presence on ``days`` dates (hour 23 rolls over to the next date)."""
    return _label(signal_rows, dim, days, True, False, city_id, min_stay_seconds, match,
                  rollover, dim_broadcast)


def staff(signal_rows, dim, days, city_id=DEFAULT_CITY_ID, min_stay_seconds=MIN_STAY_SECONDS,
          match="exact", dim_broadcast=None) -> DataFrame:
    """Working-hour presence on ``days`` dates."""
    return _label(signal_rows, dim, days, False, True, city_id, min_stay_seconds, match,
                  True, dim_broadcast)


def residence_two_pass(signal_rows, dim, days, **kw) -> DataFrame:
    """R3 ∪ R4 as two separate passes (the original shape; kept for comparison)."""
    return residents(signal_rows, dim, days, **kw).unionByName(staff(signal_rows, dim, days, **kw))

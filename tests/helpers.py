"""Small literal signal frames for unit tests."""

import datetime as dt

from footfall.schemas import SIGNAL


def sig_row(imsi, end, start=None, base=1, sector=0, latn=200, province="P", home=7,
            user_number=None, message_type="m", typ=0):
    """One signal row; ``end``/``start`` are datetimes or yyyyMMddHHmmss strings."""
    def fmt(t):
        return t.strftime("%Y%m%d%H%M%S") if isinstance(t, dt.datetime) else t
    e = fmt(end)
    s = fmt(start) if start is not None else e
    hour = int(s[:10]) if s and s[:10].isdigit() else 0
    return (message_type, typ, imsi, user_number or f"u{imsi}", s, e, base, sector, province, home,
            latn, hour)


def signal_df(spark, rows):
    return spark.createDataFrame(rows, SIGNAL)


def dim_df(spark, cells):
    """cells: (city_id, base_statn_id, sector_id, district_id)."""
    return spark.createDataFrame(
        [(c, b, s, d, f"D{d}") for c, b, s, d in cells],
        "city_id int, base_statn_id int, sector_id int, district_id int, district_name string")

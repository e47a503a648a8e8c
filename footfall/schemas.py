"""Table schemas of the visitor-flow data model.

Fixed values: field names, types and order are the data contract.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(*fields, nullable=True):
    return StructType([StructField(n, t, nullable) for n, t in fields])


S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()

# One row per user x cell x message, as parsed from a slice file.
SIGNAL = _struct(
    ("message_type", S), ("type", I), ("imsi", S), ("user_number", S),
    ("start_time", S), ("end_time", S), ("base_statn_id", I), ("sector_id", I),
    ("home_province", S), ("home_latn_id", I), ("latn_id", I), ("hour", I),
)
SIGNAL_COLUMNS = SIGNAL.fieldNames()

# Signal rows after the cell -> district join (serving city renamed city_id).
SIGNAL_ENRICHED = _struct(
    ("message_type", S), ("type", I), ("imsi", S), ("user_number", S),
    ("start_time", S), ("end_time", S), ("home_province", S), ("home_latn_id", I),
    ("hour", I), ("city_id", I), ("base_statn_id", I), ("sector_id", I),
    ("district_id", I), ("district_name", S),
)
ENRICHED_COLUMNS = SIGNAL_ENRICHED.fieldNames()

# The five dimension columns the jobs read.
DIM_KEYS = ["city_id", "base_statn_id", "sector_id"]
DIM_COLUMNS = ["city_id", "base_statn_id", "sector_id", "district_id", "district_name"]

DIM_DISTRICT = _struct(
    ("city_id", I), ("district_id", I), ("district_name", S), ("base_statn_id", I),
    ("base_statn_name", S), ("sector_id", I), ("sector_name", S),
    ("center_longitude_baidu", D), ("center_latitude_baidu", D), ("flow_rate", I),
    nullable=False,
)

RESIDENCE = _struct(
    ("imsi", S), ("user_number", S), ("city_id", I), ("district_id", I),
    ("district_name", S), ("user_attr", I),
)

# Per-(imsi, district) summary shared by both reports and used as the rolling state.
VISITS = _struct(
    ("imsi", S), ("district_id", I), ("user_number", S), ("city_id", I),
    ("district_name", S), ("home_province", S), ("home_city", I),
    ("min_end_time", S), ("max_end_time", S),
)

VISITOR_FLOW_DUR = _struct(
    ("timestamp", TimestampNTZType()), ("city_id", I), ("district_id", I),
    ("section_id", I), ("visitor_number", L),
)

VISITOR_FLOW_HOME = _struct(
    ("timestamp", TimestampNTZType()), ("city_id", I), ("district_id", I),
    ("home_province", S), ("home_city", I), ("visitor_number1", L),
    ("visitor_number2", L), ("visitor_number3", L),
)

AUDIT_COLUMN = StructField("update_time", TimestampType(), True)

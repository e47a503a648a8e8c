"""Values that must equal the original jobs' values for results to agree.

Fixed values, stated once and in natural order.
"""

# Positions (0-based) of the signal columns inside one pipe-delimited
# line, in the order of SIGNAL_COLUMNS below; a line needs at least MIN_FIELDS fields.
SIGNAL_FIELD_POSITIONS = {
    "message_type": 0,
    "type": 1,
    "imsi": 2,
    "user_number": 13,
    "start_time": 3,
    "end_time": 4,
    "base_statn_id": 9,
    "sector_id": 10,
    "home_province": 5,
    "home_latn_id": 6,
    "latn_id": 7,
    "hour": 28,
}
MIN_FIELDS = 29
FIELD_DELIMITER = "|"

# Markers that the int rule reads as zero (after trimming).
ZERO_MARKERS = ("", "null", "\\N")

# Time formats.
TIME_FORMAT = "yyyyMMddHHmmss"      # start_time / end_time
HOUR_FORMAT = "yyyyMMddHH"          # hour column
STAMP_FORMAT = "yyyyMMddHHmm"       # slice (file) stamp
DATE_FORMAT = "yyyyMMdd"
SLICE_MINUTES = 5

# Dwell bands.  Section k covers durations d (seconds) with
# DWELL_BAND_UPPER[k-1] < d <= DWELL_BAND_UPPER[k]; section 0 is d == 0 and
# section 6 is d > 41400.  (30 min, 1 h, 2 h, 4 h, 8 h, 12 h after a 30 min offset.)
DWELL_BAND_UPPER = (0, 1800, 5400, 12600, 27000, 41400)

# Recency thresholds in minutes for visitor_number1..3.
RECENCY_MINUTES = (30, 150, 1470)

# Hours of day for the two stay rules (inclusive bounds).
NIGHT_FROM_HOUR = 23      # hour >= 23 OR hour <= 6; hour 23 counts for the next date
NIGHT_TO_HOUR = 6
WORK_FROM_HOUR = 8        # 8 <= hour <= 17
WORK_TO_HOUR = 17

# Defaults of the labelling job.
DEFAULT_CITY_ID = 200
MIN_STAY_SECONDS = 4
DEFAULT_STAY_DAYS = 5
DEFAULT_LAST_N = 3
DEFAULT_START_HOUR = 23   # default stay range starts at 23h on a Sunday
DEFAULT_START_BACK_DAYS = 8  # Monday of this week minus 8 days

# user_attr codes of the residence table.
ATTR_RESIDENT = 1
ATTR_STAFF = 2

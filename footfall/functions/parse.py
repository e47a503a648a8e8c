"""Column expressions for parsing signal text and time strings (JVM-side, codegen)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.constants import DATE_FORMAT, TIME_FORMAT, ZERO_MARKERS

# Characters a JVM String.trim() strips: every code point <= U+0020.
_JVM_TRIM_CHARS = "".join(chr(i) for i in range(0, 33))
_INT_TEXT = r"^[+-]?[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_trim(c) -> Column:
    """Trim like a JVM String.trim(): spaces, tabs, newlines and control characters."""
    return F.trim(_col(c), F.lit(_JVM_TRIM_CHARS))


def int_or_zero(c) -> Column:
    """Int-or-zero rule: trimmed '', 'null' or '\\N' (or a missing field) give 0,
    integer text gives its value, anything else gives null (see ``bad_int``)."""
    t = jvm_trim(c)
    return (F.when(t.isNull() | t.isin(*ZERO_MARKERS), F.lit(0))
            .when(t.rlike(_INT_TEXT), t.try_cast("int")))


def bad_int(c) -> Column:
    """True where ``int_or_zero`` cannot read the text (the original job fails there)."""
    return int_or_zero(c).isNull()


def epoch_seconds(c, fmt: str = TIME_FORMAT) -> Column:
    """Seconds since the epoch of a formatted time string in the session time zone;
    null for text that does not parse."""
    return F.unix_timestamp(F.try_to_timestamp(_col(c), F.lit(fmt)))


def slice_stamp(start_time) -> Column:
    """File stamp (yyyyMMddHHmm, floored to 5 minutes) of a yyyyMMddHHmmss string."""
    s = _col(start_time)
    minute = F.substring(s, 11, 2).try_cast("int")
    return F.concat(F.substring(s, 1, 10),
                    F.lpad(((minute / 5).cast("int") * 5).cast("string"), 2, "0"))


def hour_date(hour) -> Column:
    """Calendar date of a yyyyMMddHH integer (first 8 characters), null when malformed."""
    return F.try_to_date(F.substring(_col(hour).cast("string"), 1, 8), DATE_FORMAT)


def hour_of_day(hour) -> Column:
    """Hour of day of a yyyyMMddHH integer (characters 9-10), null when missing."""
    return F.substring(_col(hour).cast("string"), 9, 2).try_cast("int")

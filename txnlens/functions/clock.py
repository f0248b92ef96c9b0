"""Time arithmetic on zone-free timestamps.

Moments become microseconds through their calendar fields. Casting to a zoned timestamp (as
``unix_micros`` and ``timestampdiff`` do) would bend values around daylight-saving changes of
the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000

# The accepted timestamp text and its pattern.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def epoch_micros(moment: Column) -> Column:
    """Microseconds since 1970-01-01 00:00:00 on the clock of the value itself."""
    local = moment.cast("timestamp_ntz")
    days = F.datediff(local.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = (days * 24 + F.hour(local)) * 60 + F.minute(local)
    second_micros = (F.date_part(F.lit("SECOND"), local) * F.lit(1_000_000)).cast("long")
    return minutes * 60_000_000 + second_micros


def micros_between(start: Column, end: Column) -> Column:
    return epoch_micros(end) - epoch_micros(start)


def hours_between(start: Column, end: Column) -> Column:
    return micros_between(start, end).cast("double") / F.lit(float(MICROS_PER_HOUR))


def parse_time(text: Column, fmt: str = TIME_FORMAT) -> Column:
    """Parse text to TIMESTAMP_NTZ; null where it does not follow ``fmt``."""
    if fmt == TIME_FORMAT:
        return F.when(text.rlike(_TIME_PATTERN), text.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment).cast("long")


def day_of_week(moment: Column) -> Column:
    """Monday is 0."""
    return F.weekday(moment).cast("long")

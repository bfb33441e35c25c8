"""Time columns, as local date-times without a zone so that the session time zone cannot move them."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_of(date: Column, time: Column) -> Column:
    """``yyyy-MM-dd`` and ``HH:mm:ss`` text to a timestamp; null for an impossible or missing part."""
    complete = (F.length(date) == 10) & (F.length(time) == 8)
    return F.when(complete, F.concat_ws(" ", date, time).try_cast("timestamp_ntz"))


def hour_of(date: Column, time: Column) -> Column:
    """Start of the hour; null unless the whole time is valid.

    Cut from the text: truncating a timestamp goes through the session zone, and interval arithmetic on it costs
    more than reading the text twice.
    """
    full_hour = F.concat(F.substring(time, 1, 2), F.lit(":00:00"))
    return F.when(timestamp_of(date, time).isNotNull(), timestamp_of(date, full_hour))

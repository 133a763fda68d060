"""Event text: decoding, typed time, partition keys and routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNDATED = "undated"
_ISO_DAY = r"^\d{4}-\d{2}-\d{2}([T ]|$)"


def local_time(event_time: Column) -> Column:
    """ISO text of a naive local time as TIMESTAMP_NTZ; NULL when it is not one.

    The text has no zone, so neither has the type: no session setting can move an event to another day.
    """
    return F.when(event_time.rlike(_ISO_DAY), event_time.try_cast("timestamp_ntz"))


def utc_text(moment: Column) -> Column:
    """A moment as ISO text in UTC, whatever the time zone of the session."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def utc_moment(text: Column) -> Column:
    """The moment that utc_text wrote."""
    return F.concat(text, F.lit("Z")).try_cast("timestamp")


def event_day(event_time: Column) -> Column:
    """Day directory of an event time: yyyy-MM-dd, or NULL."""
    return event_time.cast("date").cast("string")


def zone_directory(zone: Column) -> Column:
    """Directory name of a zone: spaces become underscores."""
    return F.translate(zone, " ", "_")


def one_line(body: Column) -> Column:
    """The message text without raw line breaks, so that one event stays one line. JSON needs none outside strings,
    and inside strings they are escaped. Few messages have any, so the replacement runs for those only."""
    broken = body.contains("\n") | body.contains("\r")
    return F.when(broken, F.regexp_replace(body, r"[\r\n]+", " ")).otherwise(body)


def encode(columns: list[str | Column]) -> Column:
    """JSON text of some columns; NULL fields are kept as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

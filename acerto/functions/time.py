"""Report timestamps and local days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REPORT_TIME = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,9})$"
_SECONDS_PER_DAY = 86400


def parse_report_timestamp(text: Column) -> Column:
    """``day/month/year h:m:s.fraction`` to TIMESTAMP_NTZ; NULL where it is malformed.

    Goes through the ISO form and a plain cast: ``try_to_timestamp`` is slower,
    and its result passes through the session zone, which moves times that fall
    into a DST gap. A text that does not fit keeps its slashes and fails the cast.
    """
    iso = F.regexp_replace(text, _REPORT_TIME, "$3-$2-$1 $4")
    return F.when(F.contains(text, F.lit("/")), iso.try_cast("timestamp_ntz"))


def local_day(utc_time: Column, zone: str) -> Column:
    """Day of an unzoned UTC time in ``zone``.

    A DATE, because a truncated timestamp has no valid value on days whose
    midnight the zone skips. Equal to casting ``convert_timezone('UTC', zone,
    utc_time)``, which looks both zones up by name for every row; the session
    zone plays no part in either.
    """
    instant = F.timestamp_seconds(F.unix_timestamp(utc_time))
    local_seconds = F.unix_seconds(F.from_utc_timestamp(instant, zone))
    return F.date_from_unix_date(F.floor(local_seconds / _SECONDS_PER_DAY).cast("int"))

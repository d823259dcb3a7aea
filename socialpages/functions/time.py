"""Time helpers: parse access times and compare against an exact-hour cutoff."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialpages.functions.text import java_trim
from socialpages.constants import ACCESS_TIME_FORMAT

MICROS_PER_DAY = 86_400 * 1_000_000


def access_time(df: DataFrame, name: str, fmt: str = ACCESS_TIME_FORMAT) -> Column:
    """The access time as a timestamp.

    Text is Java-trimmed and parsed with ``fmt``; text that does not parse
    becomes NULL, which the reports read as "no access" (the original job
    falls back to 0 on any parse error).  Timestamp columns pass through.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    if isinstance(dtype, T.DateType):
        return F.col(name).cast("timestamp")
    return F.try_to_timestamp(java_trim(F.col(name).cast("string")), F.lit(fmt))


def _instant(as_of: dt.datetime | str) -> tuple[str, bool]:
    """The text of ``as_of`` and whether it names a time zone or offset."""
    if not isinstance(as_of, dt.datetime):
        try:
            as_of = dt.datetime.fromisoformat(str(as_of).strip())
        except ValueError:  # left to Spark, e.g. with a region's name at the end
            return str(as_of), not str(as_of).strip()[-1:].isdigit()
    return as_of.isoformat(sep=" "), as_of.tzinfo is not None


def before_cutoff(
    ts: Column, dtype: T.DataType, as_of: dt.datetime | str | None, days: int
) -> Column:
    """``ts`` strictly before ``as_of - days * 24 h``, counted in exact hours.

    Spark's ``ts - INTERVAL n DAYS`` is calendar-aware on zoned timestamps
    (a day across a clock change is 23 or 25 hours), so for
    ``TimestampType`` the comparison is done on epoch microseconds.  For
    ``TimestampNTZType`` (wall-clock values, no zone) plain interval
    arithmetic is already exact.  ``as_of`` defaults to the query's
    current time; a naive value is read in the session time zone, and a
    zoned one is that instant, on wall-clock columns its wall-clock time in
    the session time zone.
    """
    text, zoned = _instant(as_of) if as_of is not None else ("", False)
    if isinstance(dtype, T.TimestampNTZType):
        if as_of is None:
            now = F.localtimestamp()
        elif zoned:
            now = F.lit(text).cast("timestamp").cast("timestamp_ntz")
        else:
            now = F.lit(text).cast("timestamp_ntz")
        return ts < now - F.make_dt_interval(F.lit(days))
    now = F.current_timestamp() if as_of is None else F.lit(text).cast("timestamp")
    return F.unix_micros(ts) < F.unix_micros(now) - F.lit(days * MICROS_PER_DAY)

"""Time expressions that never depend on the session time zone.

Instants are carried as TIMESTAMP_NTZ values holding UTC wall-clock time.
Parsing goes through epoch microseconds, so the result is the same whatever
``spark.sql.session.timeZone`` the caller runs with.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# One pattern costs less than a substring per separator.
_PLAIN = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}Z\z"

# Season by UTC month, English day names by weekday() index.
SEASON_BY_MONTH = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant_micros(text) -> Column:
    """ISO-8601 text -> epoch microseconds (BIGINT), null when unparsable.

    Accepts ``Z`` or a numeric offset, with or without fractions; a value
    without offset is read as UTC, a bare date as UTC midnight. A full date
    must come first: the parser itself would complete a bare clock time with
    the day of the run, and a bare year or month. The common ``...Z`` form
    costs one parse; no regular expressions are involved.
    """
    s = F.trim(_col(text))
    dated = F.like(s, F.lit("____-__-__%"))
    zoned = F.try_to_timestamp(s)
    parsed = F.when(~dated, F.lit(None).cast("timestamp")).when(F.endswith(s, F.lit("Z")), zoned).otherwise(
        F.coalesce(
            F.try_to_timestamp(F.concat(s, F.lit("Z"))),
            F.try_to_timestamp(F.concat(s, F.lit("T00:00:00Z"))),
            zoned,
        )
    )
    return F.unix_micros(parsed)


def utc_instant(text) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ in UTC.

    The form ``2000-01-02T03:04:05Z`` is a UTC wall clock as it stands: it
    takes one cast, without zone lookup or calendar arithmetic. All other
    text, and what the cast refuses, goes through :func:`instant_micros`.
    """
    c = _col(text)
    plain = F.rlike(c, F.lit(_PLAIN))
    wall = F.when(plain, F.substring(c, 1, 19).try_cast("timestamp_ntz"))
    return F.coalesce(wall, _from_micros(instant_micros(c)))


def _from_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def utc_date(ts) -> Column:
    """Calendar date of a UTC TIMESTAMP_NTZ."""
    return _col(ts).cast("date")


def season_of(ts) -> Column:
    """Season of the UTC month."""
    month = F.month(_col(ts))
    expr = None
    for name, months in SEASON_BY_MONTH.items():
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def local_day_name(ts, zone) -> Column:
    """English day name of a UTC instant seen in an Olson zone.

    ``zone`` must already be a valid zone id (the airport dimension guards it).
    """
    local = F.convert_timezone(F.lit("UTC"), _col(zone), _col(ts))
    weekday = F.weekday(local.cast("date"))
    expr = None
    for i, name in enumerate(DAY_NAMES):
        expr = F.when(weekday == i, F.lit(name)) if expr is None else expr.when(weekday == i, F.lit(name))
    return expr


def ntz_literal(day: dt.date | dt.datetime) -> Column:
    if isinstance(day, dt.datetime):
        return F.expr(f"TIMESTAMP_NTZ'{day.isoformat(sep=' ')}'")
    return F.expr(f"TIMESTAMP_NTZ'{day.isoformat()} 00:00:00'")


def departure_window(ts, start: dt.date | None, end: dt.date | None) -> Column:
    """Inclusive UTC-date range written as a half-open instant range (F2).

    Written on the raw column so the predicate can reach a Parquet scan.
    """
    c = _col(ts)
    cond = F.lit(True)
    if start is not None:
        cond = c >= ntz_literal(start)
    if end is not None:
        upper = c < ntz_literal(end + dt.timedelta(days=1))
        cond = upper if start is None else cond & upper
    return cond

"""Calendar and bucket expressions. All assume a UTC session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts) -> Column:
    """Microseconds since the epoch: an integer axis for range frames."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def epoch_bucket(ts, seconds: int) -> Column:
    """Epoch-aligned fixed-width bucket number."""
    return F.floor(micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def day(ts) -> Column:
    return F.to_date(_col(ts))


def month_stamp(ts) -> Column:
    """Same time of day on the first of the month."""
    ts = _col(ts)
    return F.date_trunc("month", ts) + (ts - F.date_trunc("day", ts))


_PARTS = {
    "dayofweek": F.dayofweek,  # 1 = Sunday
    "hour": F.hour,
    "day": F.dayofmonth,
    "month": F.month,
    "year": F.year,
}


def date_part(name: str, ts) -> Column:
    ts = _col(ts)
    if name == "epoch":
        return F.unix_timestamp(ts)
    return _PARTS[name](ts)


def age_years(born, at) -> Column:
    """Completed years between two instants."""
    return F.timestamp_diff("YEAR", _col(born), _col(at))


def days_until(at, until) -> Column:
    """Completed days between two instants (negative once past)."""
    return F.timestamp_diff("DAY", _col(at), _col(until))


def parse_expiry(mm_yy) -> Column:
    """'MM/YY' to the first instant of that month in the 2000s."""
    s = _col(mm_yy)
    return F.to_timestamp_ntz(
        F.concat(F.lit("20"), F.substring(s, 4, 2), F.lit("-"), F.substring(s, 1, 2), F.lit("-01")),
        F.lit("yyyy-MM-dd"),
    )


def within(ts, earlier, seconds: int) -> Column:
    """True when ``ts`` lies strictly less than ``seconds`` after ``earlier``."""
    return _col(ts) < _col(earlier) + F.make_dt_interval(secs=F.lit(seconds))

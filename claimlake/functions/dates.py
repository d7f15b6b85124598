"""Date/time helpers with warehouse boundary semantics.

The warehouse DATEDIFF counts unit boundaries crossed (10:59 -> 11:01 is one
hour, 2000-12-31 -> 2024-01-01 is 24 years), unlike Spark's
``timestampdiff`` which counts whole units.  These helpers reproduce the
boundary form with truncation and plain arithmetic, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ntz(c) -> Column:
    return _col(c).cast("timestamp_ntz")


# Spellings of date parts.
UNITS = {"year": ("year", "years", "yy", "yyyy"), "quarter": ("quarter", "quarters", "qq", "q"), "month": ("month", "months", "mm"), "day": ("day", "days", "dd", "d"),
         "hour": ("hour", "hours", "hh"), "minute": ("minute", "minutes", "mi"), "second": ("second", "seconds", "ss", "s"), "millisecond": ("millisecond", "milliseconds", "ms")}


def boundary_diff(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries crossed going from ``start`` to ``end``."""
    u = unit.lower()
    a, b = _col(start), _col(end)
    if u in ("year", "years", "yy", "yyyy"):
        return (F.year(b) - F.year(a)).cast("bigint")
    if u in UNITS["quarter"]:
        return ((F.year(b) * 4 + F.quarter(b)) - (F.year(a) * 4 + F.quarter(a))).cast("bigint")
    if u in ("month", "months", "mm"):
        return ((F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))).cast("bigint")
    if u in ("day", "days", "dd", "d"):
        return F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    # Wall-clock (NTZ) values: truncate to the unit, then count whole units
    # with timestamp_diff -- no time-zone conversion, so DST cannot shift it.
    if u in ("hour", "hours", "hh"):
        return F.timestamp_diff("HOUR", F.date_trunc("hour", _ntz(a)), F.date_trunc("hour", _ntz(b))).cast("bigint")
    if u in ("minute", "minutes", "mi"):
        return F.timestamp_diff("MINUTE", F.date_trunc("minute", _ntz(a)),
                                F.date_trunc("minute", _ntz(b))).cast("bigint")
    if u in ("second", "seconds", "ss", "s"):
        return F.timestamp_diff("SECOND", F.date_trunc("second", _ntz(a)),
                                F.date_trunc("second", _ntz(b))).cast("bigint")
    if u in ("millisecond", "milliseconds", "ms"):
        return F.timestamp_diff("MILLISECOND", F.date_trunc("millisecond", _ntz(a)),
                                F.date_trunc("millisecond", _ntz(b))).cast("bigint")
    raise ValueError(f"unsupported unit {unit!r}")


def boundary_diff_sql(unit: str, start: str, end: str) -> str:
    """Spark SQL text of :func:`boundary_diff` (used by the rule text shim)."""
    u = next((name for name, spellings in UNITS.items() if unit.strip().lower() in spellings), None)
    if u == "year":
        return f"CAST(year({end}) - year({start}) AS BIGINT)"
    if u in ("quarter", "month"):
        n = 4 if u == "quarter" else 12
        return f"CAST((year({end})*{n}+{u}({end})) - (year({start})*{n}+{u}({start})) AS BIGINT)"
    if u == "day":
        return f"CAST(datediff(to_date({end}), to_date({start})) AS BIGINT)"
    if u is None:
        raise ValueError(f"unsupported unit {unit!r}")
    part = u.upper()
    return (f"CAST(timestampdiff({part}, date_trunc('{part}', CAST({start} AS TIMESTAMP_NTZ)), "
            f"date_trunc('{part}', CAST({end} AS TIMESTAMP_NTZ))) AS BIGINT)")


def age_years(dob, as_of) -> Column:
    """Warehouse age: year difference, boundary semantics (no birthday check)."""
    return boundary_diff("year", dob, as_of)


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value[:10])
    return F.lit(value).cast("date")


def as_ts(value) -> Column:
    """A TIMESTAMP_NTZ literal (``as_of`` parameters are wall-clock values)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def seconds_between(start, end) -> Column:
    """Second-boundary difference of two NTZ timestamps."""
    return boundary_diff("second", start, end)

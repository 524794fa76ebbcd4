"""Column helpers shared by operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Timestamps in the event tables are ``timestamp_ntz``; the helpers avoid any
session-time-zone conversion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNIT_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a timestamp_ntz, time-zone free."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), col(ts))


def seconds_between(start, end) -> Column:
    """Fractional seconds end - start (interval epoch), double."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)).cast("double") / F.lit(1e6)


def elapsed(start, end, unit_seconds: int) -> Column:
    """Fractional minutes/hours between two timestamps, as the oracle's
    ``EXTRACT(EPOCH FROM end - start) / unit``."""
    return seconds_between(start, end) / F.lit(float(unit_seconds))


def boundary_diff(unit: str, start, end) -> Column:
    """``DATEDIFF(unit, a, b)`` counting unit boundaries crossed, as warehouse
    SQL does (00:00:59 → 00:01:01 is one minute)."""
    u = _UNIT_MICROS[unit]
    return (F.floor(epoch_micros(end) / F.lit(u)) - F.floor(epoch_micros(start) / F.lit(u))).cast("long")


def week_start(ts) -> Column:
    """Monday 00:00 of the week holding ``ts``, as timestamp_ntz."""
    d = F.to_date(col(ts))
    monday = F.date_sub(d, ((F.dayofweek(d) + F.lit(5)) % F.lit(7)).cast("int"))
    return monday.cast("timestamp_ntz")


def day_of_week_sun0(ts) -> Column:
    """Day of week with Sunday = 0 (``EXTRACT(DOW)``)."""
    return (F.dayofweek(col(ts)) - 1).cast("int")


def pct(num, den, digits: int | None = None, half_even: bool = False) -> Column:
    """num * 100 / den in double; NULL when den is 0 or NULL."""
    d = col(den).cast("double")
    v = F.when(d == 0, F.lit(None).cast("double")).otherwise(col(num).cast("double") * F.lit(100.0) / d)
    if digits is None:
        return v
    return F.bround(v, digits) if half_even else F.round(v, digits)


def null_or_empty(c) -> Column:
    c = col(c)
    return c.isNull() | (c == F.lit(""))


def json_str(props, key: str) -> Column:
    """String value of a top-level JSON key; JSON null → NULL."""
    return F.get_json_object(col(props), f"$.{key}")


def json_int(props, key: str) -> Column:
    """Integer value of a JSON key; junk → NULL instead of a task failure."""
    return json_str(props, key).try_cast("int")


def flag(cond: Column) -> Column:
    """0/1 flag: 1 if any row satisfies cond (``COUNT(DISTINCT CASE … 1 END)``)."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))

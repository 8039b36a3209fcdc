"""Column expressions with the exact semantics the workload needs.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapflow.config import YES

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive (or UTC-converted aware) datetime.

    Built from ISO text, so neither the Python process zone nor the session
    zone can shift it.
    """
    if isinstance(value, _dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_now() -> _dt.datetime:
    """The library's clock: the wall-clock time in UTC, naive."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def round_half_away(x: ColumnOrName, digits: int) -> Column:
    """``ROUND(double, n)`` as a scaled round: round(x * 10^n) / 10^n.

    Rounding the scaled double half away from zero agrees with the engine the
    workload was written for; rounding the decimal text of ``x`` (plain
    ``F.round``) differs on values such as 0.285.
    """
    scale = float(10**digits)
    return F.round(_col(x) * F.lit(scale), 0) / F.lit(scale)


def round_half_even(x: ColumnOrName, digits: int) -> Column:
    """Banker's rounding, as Python's ``round(x, n)`` does for the insight API."""
    return F.bround(_col(x), digits)


def minute_index(ts: ColumnOrName) -> Column:
    """Whole minutes since 1970-01-01 00:00 of a TIMESTAMP_NTZ, floored.

    Built from calendar fields so no session time zone (and no DST gap) can
    shift it.
    """
    t = _col(ts)
    return (
        F.unix_date(t.cast("date")).cast("long") * F.lit(1440)
        + F.hour(t).cast("long") * F.lit(60)
        + F.minute(t).cast("long")
    )


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, zone-free."""
    t = _col(ts)
    sec_frac = F.date_part(F.lit("SECOND"), t)  # decimal(8,6): seconds + micros
    return (
        minute_index(t) * F.lit(60_000_000)
        + (sec_frac * F.lit(1_000_000)).cast("long")
    )


def minute_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    00:00:59 -> 00:01:00 counts 1, unlike an elapsed-minutes difference.
    NULL if either side is NULL.
    """
    return minute_index(end) - minute_index(start)


def yes_flag(c: ColumnOrName) -> Column:
    """Feed flag text to boolean: 'OUI' -> true, other text -> false, NULL -> NULL."""
    return _col(c) == F.lit(YES)


def pct_of_total(part: ColumnOrName, total: ColumnOrName, digits: int = 1) -> Column:
    """``100 * part / NULLIF(total, 0)`` rounded like ``ROUND(x, n)``."""
    return round_half_away(
        F.lit(100.0) * _col(part).cast("double") / F.nullif(_col(total), F.lit(0)).cast("double"),
        digits,
    )


def guarded_pct(part: ColumnOrName, total: ColumnOrName, digits: int = 1) -> Column:
    """``round(part / total * 100, n) if total else 0`` of the insight API.

    0 when total is 0 or NULL; NULL part stays NULL.
    """
    p, t = _col(part), _col(total)
    ratio = round_half_even(p.cast("double") / t.cast("double") * F.lit(100.0), digits)
    return F.when(t.isNull() | (t == 0), F.lit(0.0)).otherwise(ratio)


def duration_seconds(start: ColumnOrName, end: ColumnOrName, digits: int = 1) -> Column:
    """``round(end - start, 1)`` when both are present and non-zero, else NULL."""
    s, e = _col(start), _col(end)
    present = s.isNotNull() & e.isNotNull() & (s != 0) & (e != 0)
    return F.when(present, round_half_even(e - s, digits))


def python_datetime_text(ts: ColumnOrName) -> Column:
    """``str(datetime)`` text: seconds only, or six fraction digits when non-zero."""
    t = _col(ts)
    has_fraction = (epoch_micros(t) % F.lit(1_000_000)) != 0
    return F.when(t.isNull(), F.lit(None).cast("string")).when(
        has_fraction, F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    ).otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss"))

"""Column expressions shared by the operators. Built-ins only."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` rounded half away from zero, NULL where den is 0.

    The division runs on decimals: rounding a binary double would make the
    last digit depend on the engine.
    """
    exact = num.cast("decimal(24,4)") / F.nullif(den.cast("decimal(20,0)"), F.lit(0))
    return F.round(exact, digits).cast("double")


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole``; either side may be money."""
    exact = (part.cast("decimal(24,2)") * F.lit(100)
             / F.nullif(whole.cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)")))
    return F.round(exact, digits).cast("double")


def mean(col: Column, digits: int) -> Column:
    """Rounded average of an integer or money column, NULLs ignored."""
    return ratio(F.sum(col), F.count(col), digits)


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "month")


def month_offset(later: Column, earlier: Column) -> Column:
    """Whole months between two dates, counted by calendar month."""
    return ((F.year(later) - F.year(earlier)) * 12
            + (F.month(later) - F.month(earlier)))


def date_key(ts: Column) -> Column:
    """yyyyMMdd as an integer, without a detour through the session's zone."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def instant(value: dt.datetime) -> Column:
    """A literal without zone. Through text: a datetime literal would pass the
    session's zone and shift."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with microseconds, as an exact decimal."""
    return (end - start).cast("interval second").cast("decimal(18,6)")


def iso_weekday(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday (``dayofweek`` starts at Sunday)."""
    return F.weekday(d) + 1


def clean_place(c: Column) -> Column:
    """Lower-case, outer blanks removed, inner whitespace runs collapsed."""
    return F.lower(F.btrim(F.regexp_replace(c, r"\s+", " ")))


def clean_code(c: Column) -> Column:
    return F.upper(F.trim(c))


def is_late(delivered: Column, estimated: Column) -> Column:
    """NULL while not delivered; compares instants, so a delivery later on the
    promised day is late although it is 0 days over."""
    return F.when(delivered.isNotNull(), delivered > estimated)


def differs(*pairs: tuple[Column, Column]) -> Column:
    """True where any pair differs, NULL counting as a value."""
    out = F.lit(False)
    for a, b in pairs:
        out = out | ~a.eqNullSafe(b)
    return out

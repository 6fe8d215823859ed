"""Full-time-equivalent arithmetic, three methods.

``weeks``       program weeks counted by the calendar-week rule (default)
``continuous``  four weeks per seven days, saturating
``sheet``       plain days / 7 / program weeks, with its own fallback end
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroll.config import BillingConfig
from tallyroll.functions.dates import clamp_to


def _counted_weeks(lo: Column, hi: Column, first_week_within: Column | None = None) -> Column:
    """Monday weeks with at least three days inside [lo, hi], which must lie in one month.

    A month touches at most six Monday weeks, so the count is a sum of six terms:
    no array, no lambda, no loss of code generation. If ``first_week_within`` is
    given, the first week also needs its Sunday on or before that day.
    """
    monday = F.date_sub(lo, F.weekday(lo))
    total = F.lit(0)
    for i in range(6):
        start = F.date_add(monday, 7 * i)
        end = F.date_add(monday, 7 * i + 6)
        enough = F.datediff(F.least(hi, end), F.greatest(lo, start)) >= 2
        if i == 0 and first_week_within is not None:
            enough = enough & (end <= first_week_within)
        total = total + F.when(enough, 1).otherwise(0)
    return total


def _capped(weeks: Column, d: Column) -> Column:
    """At most four weeks a month, five in July."""
    return F.least(weeks, F.when(F.month(d) == 7, 5).otherwise(4))


def _month_index(d: Column) -> Column:
    """July = 1 ... June = 12."""
    return F.pmod(F.month(d) + 5, F.lit(12)) + 1


def student_weeks(start: Column, end: Column) -> Column:
    """Program weeks between two dates; NULL if either is missing."""
    days = F.datediff(end, start) + 1
    month_end = F.last_day(start)
    first = _capped(_counted_weeks(start, month_end, month_end), start)
    last = _capped(_counted_weeks(F.trunc(end, "MM"), end), end)
    middle = F.greatest(F.lit(0), _month_index(end) - _month_index(start) - 1) * 4
    within = _capped(_counted_weeks(start, F.least(end, month_end), month_end), start)
    return (
        F.when(days.isNull(), None)
        .when(days < 3, 0)
        .when(days == 3, 1)
        .when(_month_index(start) == _month_index(end), within)
        .otherwise(first + middle + last)
    )


def open_end(config: BillingConfig, method: str) -> date:
    """The day that stands in for a missing end."""
    return config.sheet_end_date if method == "sheet" else config.end_date


def fte(start: Column, end: Column, config: BillingConfig = BillingConfig(), method: str = "weeks") -> Column:
    """FTE in [0, 1] of an enrollment from start to end; NULL start gives NULL.

    ``end`` may be NULL (still enrolled): the method's own end date stands in.
    """
    if method not in ("weeks", "continuous", "sheet"):
        raise ValueError(f"unknown method {method!r}")
    last = F.coalesce(end, F.lit(open_end(config, method)))
    if method == "weeks":
        return F.when(start.isNotNull(), F.round(F.least(student_weeks(start, last) / config.program_weeks, F.lit(1.0)), 3))
    if method == "continuous":
        share = F.datediff(F.least(last, F.lit(config.end_date)), start) / F.lit(7) * F.lit(4) / F.lit(config.program_weeks)
        return F.when(start.isNotNull(), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)), 4))
    share = F.round(F.datediff(last, start) / F.lit(7) / F.lit(config.program_weeks), 3)
    return F.when(start.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)))


def billed_period(
    st_entry: Column, st_exit: Column, charter_entry: Column, charter_exit: Column,
    config: BillingConfig = BillingConfig(),
) -> tuple[Column, Column]:
    """(start, end): system date, else charter date; the start not before the first school day."""
    start = clamp_to(F.coalesce(st_entry, charter_entry), config.first_day)
    return start, F.coalesce(st_exit, charter_exit)


def variance(charter_fte: Column, st_fte: Column) -> Column:
    """Charter minus system, four decimals; NULL if either is missing."""
    return F.round(charter_fte - st_fte, 4)

"""Date parsing and date arithmetic.

All accepted shapes of a caller form one regular expression that rewrites the text
to year-month-day, which is then cast once. The input is named once, so long
format lists stay small expressions, and nothing on the way throws.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroll.config import WHITE_SPACE

# Accepted date shapes. y is a four-digit year, yy a two-digit one; a time follows after a blank or a T.
SHAPES = ("M/d/y", "M/d/y time", "M-d-y", "M/d/yy", "M-d-yy", "d/M/y", "d/M/yy", "y-M-d", "y-M-d time", "y-M-d T", "y/M/d", "y.M.d", "yyyyMMdd")
_PARTS = {"yyyy": r"\d{4}", "yy": r"\d{2}", "y": r"\d{4}", "MM": r"\d{2}", "M": "0?[1-9]|1[0-2]", "dd": r"\d{2}", "d": r"\d{1,2}"}
_TIME = r"(?:[01]?\d|2[0-3]):[0-5]?\d(?::(?:[0-5]?\d|6[01]))?"
# Fixed value: day zero of spreadsheet serial dates.
SERIAL_ORIGIN = "1899-12-30"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}\z"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _shape_pattern(shape: str, n: int) -> str:
    """'M/d/y time' -> pattern with the groups y<n>, M<n> and d<n>."""
    if shape not in SHAPES:
        raise ValueError(f"unknown date shape {shape!r}")
    day, _, time = shape.partition(" ")
    pattern = re.sub(r"y+|M+|d+", lambda t: f"(?<{t[0][0]}{n}>{_PARTS[t[0]]})", day.replace(".", r"\."))
    return pattern + {"": "", "time": " " + _TIME, "T": "T" + _TIME}[time]


def parse(s: Column, shapes: list[str]) -> Column:
    """The day the text names in one of the shapes; NULL for other shapes and for days that do not exist.

    The first shape that fits counts. Text of no shape is rewritten to '--', so it cannot pass the cast.
    """
    alternatives = "|".join(_shape_pattern(shape, n) for n, shape in enumerate(shapes))
    group = lambda letter: "".join(f"${{{letter}{n}}}" for n in range(len(shapes)))
    iso = F.regexp_replace(s, f"^(?s:{alternatives}|.*)$", f"{group('y')}-{group('M')}-{group('d')}")
    if any(shape.split(" ")[0].endswith("/yy") or shape.endswith("-yy") for shape in shapes):
        # Two-digit years 69-99 belong to the 1900s.
        iso = F.regexp_replace(iso, r"^([0-5]\d|6[0-8])-", "20$1-")
        iso = F.regexp_replace(iso, r"^(69|[7-9]\d)-", "19$1-")
    return iso.try_cast("date")


def parse_month_name(s: Column) -> Column:
    """14FEB2026, 14-Feb-2026 and 14-Feb-26."""
    dashed = F.regexp_replace(s, r"^(\d{1,2})-?([A-Za-z]{3})-?(\d{4})$", "$1-$2-$3")
    dashed = F.regexp_replace(dashed, r"^(\d{1,2}-[A-Za-z]{3})-([0-5]\d|6[0-8])$", "$1-20$2")
    dashed = F.regexp_replace(dashed, r"^(\d{1,2}-[A-Za-z]{3})-(\d{2})$", "$1-19$2")
    return F.when(s.rlike(r"^\d{1,2}-?[A-Za-z]{3}-?\d{2,4}$"), F.try_to_date(dashed, "d-MMM-yyyy"))


def parse_written_month(s: Column) -> Column:
    """Feb 14, 2026, February 14 2026, 14 February 2026 and 14-Feb-2026, in any case of letters.

    One test of the shape keeps all other texts away from the month names.
    """
    month = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
    name = rf"(?=(?:{month})[.,]?[ -])([a-z]{{3}})[a-z]*"
    first = rf"^(?i){name}[.]?[ -]+(\d{{1,2}}),?[ -]+(\d{{4}})$"
    later = rf"^(?i)(\d{{1,2}})[ -]+{name}[.,]?[ -]+(\d{{4}})$"
    written = s.rlike(r"^(?i)(?:[a-z]{3,9}[.]?[ -]+\d{1,2}|\d{1,2}[ -]+[a-z]{3,9}[.,]?),?[ -]+\d{4}$")
    short = F.regexp_replace(F.regexp_replace(s, first, "$2-$1-$3"), later, "$1-$2-$3")
    return F.when(written, F.try_to_date(short, "d-MMM-yyyy"))


def from_serial(s: Column, low: float | None = None, high: float | None = None) -> Column:
    """Spreadsheet serial number as text -> date, if strictly between the bounds.

    Serials beyond the year 9999 are no dates. Only text that looks like a number is
    cast: casting other text to double costs an exception each time.
    """
    n = s.try_cast("double")
    inside = s.rlike(NUMBER) & (n >= -693000.0) & (n < 2958466.0)
    if low is not None:
        inside = inside & (n > float(low))
    if high is not None:
        inside = inside & (n < float(high))
    return F.when(inside, F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), F.floor(n).cast("int")))


# Pseudo-null texts ("N/A", "none", ...) fit no shape and no number, so they need no test of their own.


def normalize_dob(c: Column) -> Column:
    """Birth date of any of the accepted shapes."""
    s = F.upper(_strip(c))
    return F.coalesce(
        parse(s, ["yyyyMMdd", "M/d/y", "y-M-d", "M-d-y", "M/d/yy", "M-d-yy", "d/M/y", "y/M/d", "y.M.d"]),
        from_serial(s, 20000, 60000),
        parse_month_name(s),
    )


def parse_billing(c: Column) -> Column:
    """Billing rosters: eight shapes, bounded serials, then Spark's own reading of the text, then written months.

    Text that is year, month and day already is cast at once: none of the later steps could read it otherwise.
    """
    s = _strip(c)
    return F.when(s.rlike(ISO_DAY), s.try_cast("date")).otherwise(F.coalesce(
        parse(s, ["M/d/y", "y-M-d", "M-d-y", "M/d/yy", "y/M/d", "y-M-d time", "M/d/y time", "y-M-d T"]),
        from_serial(s, 20000, 60000),
        F.when(~s.rlike(r"^\d{5,}$"), s.try_cast("date")),
        parse_written_month(s),
    ))


def parse_billing_mixed(c: Column) -> Column:
    """Billing rosters, other reading: any unsigned number is a serial."""
    s = _strip(c)
    return F.coalesce(
        parse(s, ["M/d/y", "y-M-d", "M/d/yy", "M-d-y", "y/M/d", "y-M-d time", "M/d/y time", "y-M-d T"]),
        F.when(s.rlike(r"^[0-9]+\.?[0-9]*$"), from_serial(s)),
    )


def parse_roster(c: Column, low: float = 20000, high: float | None = None) -> Column:
    """Unified-roster dates: month first, year first or day first with any separator; else serials between the bounds."""
    s = _strip(c)
    slashed = F.regexp_replace(s, r"[-. ]+", "/")
    return F.coalesce(parse(slashed, ["M/d/y", "M/d/yy", "y/M/d", "d/M/y", "d/M/yy"]), from_serial(s, low, high))


def parse_roster_recent(c: Column) -> Column:
    """As parse_roster, but only serials of recent years (40000-80000) count."""
    return parse_roster(c, 40000, 80000)


def diff_days(later: Column, earlier: Column) -> Column:
    """Signed days, NULL if either side is missing."""
    return F.datediff(later, earlier)


def clamp_to(d: Column, first_day: date) -> Column:
    """No day before first_day; NULL stays NULL (greatest() alone would not keep it)."""
    return F.when(d.isNotNull(), F.greatest(d, F.lit(first_day)))


def short_date(d: Column) -> Column:
    """2026-02-03 -> '2/3/26'."""
    return F.date_format(d, "M/d/yy")


def _strip(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITE_SPACE))

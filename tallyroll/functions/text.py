"""Text cleaning expressions. All stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll import config as cfg
from tallyroll.functions import dates

# White space inside a text; a non-breaking space counts as a blank.
_SPACE = r"[\s\u00a0]+"
# Integers from 20001 to 59999.
_SERIAL_TEXT = r"^0*(2000[1-9]|200[1-9][0-9]|20[1-9][0-9]{2}|2[1-9][0-9]{3}|[3-5][0-9]{4})$"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(cfg.WHITE_SPACE))


def null_tokens(c: Column, tokens: Iterable[str]) -> Column:
    """NULL where the text is one of the pseudo-null tokens."""
    return F.when(~c.isin(*tokens), c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def present(c: Column, tokens: Iterable[str] = ("",)) -> Column:
    """TRUE/FALSE, never NULL: the text has a value outside the tokens."""
    return F.coalesce(~c.isin(*tokens), F.lit(False)) if tokens else c.isNotNull()


def strip_decimal_zero(c: Column) -> Column:
    """'123.0' -> '123' (one zero), trimmed."""
    return strip(F.regexp_replace(c.cast("string"), r"\.0$", ""))


def clean_id(c: Column, tokens: Iterable[str] = cfg.NULLS_ID) -> Column:
    """Identifier as text: trimmed, spreadsheet '.0' tail removed, pseudo-nulls NULL."""
    return null_tokens(F.regexp_replace(strip(c.cast("string")), r"\.0+$", ""), tokens)


def clean_fte(c: Column) -> Column:
    """'50%' -> 50.0, '0.5' -> 0.5, anything else NULL."""
    number = F.replace(strip(c.cast("string")), F.lit("%"), F.lit(""))
    return F.when(number.rlike(dates.NUMBER), number.try_cast("double"))


def split_last(c: Column) -> Column:
    """Last name out of 'Last, First'."""
    return blank_to_null(strip(F.regexp_extract(strip(c), r"^[^,]+", 0)))


def split_first(c: Column) -> Column:
    """First name out of 'Last, First'; '' when there is no comma part."""
    return strip(F.regexp_replace(strip(c), r"^[^,]+,?\s*", ""))


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def upper_trim(c: Column) -> Column:
    return F.upper(strip(c.cast("string")))


def normalize_name(c: Column) -> Column:
    """Upper case letters and single blanks only."""
    letters = F.regexp_replace(F.upper(c.cast("string")), "[^A-Z ]", "")
    return F.trim(F.regexp_replace(letters, " +", " "))


def _cleaned(c: Column) -> Column:
    s = F.regexp_replace(null_tokens(F.upper(strip(c.cast("string"))), cfg.NULLS_AUDIT), _SPACE, " ")
    return F.regexp_replace(s, r"\.0+$|[^0-9A-Z/: \-]", "")


def _comparable(s: Column, mode: str) -> Column:
    """Cleaned text -> ISO date, plain integer, or itself."""
    if mode not in ("reference", "id_safe"):
        raise ValueError(f"unknown mode {mode!r}")
    # One test keeps identifiers away from the date patterns.
    day = F.when(s.rlike(r"^[0-9]{1,4}[/-]"), dates.parse(
        s, ["M/d/y time", "y-M-d time", "M/d/y", "y-M-d", "M-d-y", "M/d/yy", "M-d-yy"]))
    if mode == "id_safe":
        return F.coalesce(day.cast("string"), s)
    return F.coalesce(
        day.cast("string"),
        F.when(s.rlike(_SERIAL_TEXT), F.date_add(F.lit(dates.SERIAL_ORIGIN).cast("date"), s.cast("int")).cast("string")),
        F.regexp_replace(s, r"^0+(?=[0-9]+$)", ""))


def normalize_value(c: Column, mode: str = "reference") -> Column:
    """Comparable text: dates become ISO, integers lose leading zeros.

    mode="reference" also reads an integer between 20000 and 60000 as a spreadsheet
    date, which turns some five-digit identifiers into dates. mode="id_safe" keeps
    every integer (and its leading zeros) as it is; use it for identifier columns.
    """
    return _comparable(_cleaned(c), mode)


def normalize_columns(df: DataFrame, columns: Iterable[str], mode: str = "reference") -> DataFrame:
    """normalize_value over several columns, in two projections so that each cleaned text is computed once."""
    columns = list(columns)
    cleaned = df.withColumns({n: _cleaned(F.col(f"`{n}`")) for n in columns})
    return cleaned.withColumns({n: _comparable(F.col(f"`{n}`"), mode) for n in columns})


def name_key(*parts: Column) -> Column:
    """Upper/trimmed parts joined by '|'; NULL if any part is NULL, so it can never match by accident."""
    pieces = [upper_trim(parts[0])]
    for part in parts[1:]:
        pieces += [F.lit("|"), upper_trim(part)]
    return F.concat(*pieces)


def resolve_id(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor ''; '' when there is none."""
    return F.coalesce(*[blank_to_null(c) for c in candidates], F.lit(""))


def contains_any(c: Column, keywords: Iterable[str]) -> Column:
    """Lower-case substring test against any keyword; NULL text is FALSE."""
    low = F.lower(c)
    hit = F.lit(False)
    for kw in keywords:
        hit = hit | low.contains(kw)
    return F.coalesce(hit, F.lit(False))


def comparable_status(c: Column) -> Column:
    """Statuses of both systems on one scale; blanks and 'NA' NULL."""
    s = null_tokens(strip(c.cast("string")), ("", "NA"))
    return F.when(s == "Not in ST System", "Not Found-Needs Manual Review").otherwise(s)

"""Ordered rule lists as one CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(steps: list[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """The value of the first true condition, else the default.

    A NULL condition counts as false, exactly as in CASE WHEN.
    """
    expr = None
    for condition, value in steps:
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(condition, value) if expr is None else expr.when(condition, value)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def is_in(c: Column, *values: str) -> Column:
    """Membership that is FALSE, not NULL, for NULL."""
    return F.coalesce(c.isin(*values), F.lit(False))

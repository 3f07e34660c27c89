"""Column-level helpers; everything here stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL where the denominator is 0.

    A filter on the denominator is not enough under ANSI mode: the optimizer may evaluate the
    division before the filter.
    """
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def nan_to_null(column: Column) -> Column:
    """NaN marks a gap in pandas-born series; Spark would treat it as an ordinary value."""
    return F.nanvl(column, F.lit(None).cast("double"))


def strict(parsed: Column, raw: Column, what: str) -> Column:
    """``parsed``, but an error where a non-null ``raw`` did not parse.

    ANSI sessions raise on their own; this keeps the rule with ANSI switched off as well.
    """
    # coalesce parses once, a test of the parsed value beside the value itself would do it twice
    return F.coalesce(parsed, F.when(raw.isNotNull(), F.raise_error(F.concat(F.lit(f"{what}: cannot read "), raw))))


def compact_date(raw: Column, what: str = "date") -> Column:
    """A ``yyyyMMdd`` text or integer as a date; anything else fails the batch."""
    text = raw.cast("string")
    return strict(F.to_date(text, "yyyyMMdd"), text, what)


def number(raw: Column, what: str = "number") -> Column:
    """A numeric text as a double. An empty field is a missing number, other texts must parse."""
    text = F.nullif(F.trim(raw.cast("string")), F.lit(""))
    return strict(text.cast(T.DoubleType()), text, what)


def daily_yield(percent: Column) -> Column:
    """Yearly yield in percent as a daily fraction on a 360-day year."""
    return percent / 100 / 360


def discount_price(yearly: Column, days: int) -> Column:
    """Price of 100 discounted at a yearly fraction for ``days`` on a 360-day year."""
    return F.lit(100.0) / (1 + yearly * days / 360)


def position_side(quantity: Column) -> Column:
    """1 for a long position, -1 otherwise; NULL quantity counts as -1."""
    return F.when(quantity > 0, 1).otherwise(-1)

"""Benchmark and risk-free return series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.functions.columns import daily_yield, discount_price, safe_ratio
from tallyfolio.operators.filters import between_dates
from tallyfolio.operators.windows import backfill_nulls, pct_change

# A 30-day bill is bought at yesterday's yield and has 29 days left today.
_DAYS_BOUGHT = 30
_DAYS_LEFT = 29


def benchmark_return(prices: DataFrame, keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """Daily change of the adjusted close. Rows with nothing to compare with drop."""
    changed = pct_change(prices, keys, "date", "adjusted_close", "return")
    return changed.dropna(subset=["return"]).select(
        "date", *keys, "adjusted_close", "return", "dividends_per_share"
    )


def yield_lag(yields: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Add ``yield_lag``, the previous row's yield.

    Written as a lead over the descending order: the backward fill that follows needs that
    order, and one sort serves both.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    return yields.withColumn("yield_lag", F.lead("yield").over(newest_first))


def risk_free_return(
    yields: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    keys: Sequence[str] = ("series_id",),
) -> DataFrame:
    """One-day return of a 30-day bill rolled daily at the given yearly yields in percent.

    Days without a computable return take the next one. The range applies last: the lag needs the
    row before it and the fill a row after it.
    """
    fractions = yields.withColumn("yield", F.col("yield") / 100)
    lagged = yield_lag(fractions, keys)
    price = discount_price(F.col("yield"), _DAYS_LEFT)
    bought = discount_price(F.col("yield_lag"), _DAYS_BOUGHT)
    own = lagged.withColumn("return", safe_ratio(price, bought) - 1)
    filled = backfill_nulls(own, keys, "date", "return")
    return between_dates(filled, "date", start, end).select("date", *keys, "return")


def daily_yields(yields: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Yield per day as a fraction, gaps filled from the next day that has one."""
    return backfill_nulls(
        yields.select("date", *keys, daily_yield(F.col("yield")).alias("daily_yield")), keys, "date", "daily_yield"
    )

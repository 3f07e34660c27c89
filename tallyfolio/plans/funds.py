"""Daily returns per account and over all accounts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfolio.functions.columns import safe_ratio
from tallyfolio.operators.filters import between_dates
from tallyfolio.operators.sessions import on_sessions
from tallyfolio.operators.windows import last_before, last_per_key, with_previous
from tallyfolio.schemas import ACCOUNT

_LATEST = ["date", "ending_value"]
_MEASURES = ["starting_value", "ending_value", "deposits_withdrawals", "dividends"]


def nav_on_sessions(delta_nav: DataFrame, calendar: DataFrame) -> DataFrame:
    """Account values on sessions. Comes before the lag, which then goes session to session."""
    rows = delta_nav.select("date", ACCOUNT, "ending_value", "deposits_withdrawals", "dividends")
    return on_sessions(rows, calendar)


def nav_lag(nav: DataFrame) -> DataFrame:
    """Add ``starting_value``: the account's ending value one session earlier, its own if first."""
    return with_previous(nav, [ACCOUNT], "date", {"ending_value": "starting_value"})


def _returns(df: DataFrame, *keys: str) -> DataFrame:
    value = F.col("ending_value") - F.col("deposits_withdrawals")
    return df.select(
        *keys,
        value.alias("value"),
        (safe_ratio(value, F.col("starting_value")) - 1).alias("return"),
        "dividends",
    )


def _windowed_nav(
    delta_nav: DataFrame,
    calendar: DataFrame,
    start: dt.date | None,
    end: dt.date | None,
    look_back_days: int | None,
    latest: DataFrame | None,
) -> DataFrame:
    def sessions(first: dt.date | None, last: dt.date | None) -> DataFrame:
        return nav_on_sessions(between_dates(delta_nav, "date", first, last), calendar)

    in_range = sessions(start, end)
    if start is None:
        return nav_lag(in_range)
    # Of the rows before the range the lag needs one per account, and of that only two columns.
    if latest is None:
        accounts = in_range.select(ACCOUNT).distinct()
        latest = last_before(sessions, [ACCOUNT], "date", _LATEST, start, accounts, look_back_days)
    rows = in_range.unionByName(latest, allowMissingColumns=True)
    return between_dates(nav_lag(rows), "date", start, None)


def latest_accounts(
    delta_nav: DataFrame,
    calendar: DataFrame,
    day: dt.date,
    known: DataFrame | None = None,
    known_day: dt.date | None = None,
) -> DataFrame:
    """The last session's value of every account up to ``day``. ``known`` is the same of an earlier
    day, ``known_day``: only the days between are read then."""
    if known is not None and known_day == day:
        return known
    after = None if known is None else known_day + dt.timedelta(days=1)
    rows = nav_on_sessions(between_dates(delta_nav, "date", after, day), calendar).select(ACCOUNT, *_LATEST)
    if known is not None:
        rows = rows.unionByName(known)
    return last_per_key(rows, [ACCOUNT], "date", _LATEST)


def fund_returns(
    delta_nav: DataFrame,
    calendar: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    look_back_days: int | None = None,
    latest: DataFrame | None = None,
) -> DataFrame:
    """Return of each account on each session of the range.

    The day's flow counts as if it came at its end: the return is the ending value without it over
    the ending value one session earlier. Earlier history is reduced to a row per account;
    ``look_back_days`` searches that row in the days just before the range first, and may not read
    the rest at all. The result is the same. ``latest`` is ``latest_accounts`` of the day before the
    range: history is not read then.
    """
    return _returns(_windowed_nav(delta_nav, calendar, start, end, look_back_days, latest), "date", ACCOUNT)


def all_fund_returns(
    delta_nav: DataFrame,
    calendar: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    look_back_days: int | None = None,
    latest: DataFrame | None = None,
) -> DataFrame:
    """Return over all accounts: sums first, ratio after, hence weighted by value. Arguments as above."""
    nav = _windowed_nav(delta_nav, calendar, start, end, look_back_days, latest)
    totals = nav.groupBy("date").agg(*[F.sum(c).alias(c) for c in _MEASURES])
    return _returns(totals, "date")

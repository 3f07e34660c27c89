"""Returns after late corrections: only what a correction can change is computed again.

A report row of one holding and day changes, in the stored returns,

* the holding's row of that day, which may also appear or go,
* the holding's *next* row, which compares with it,
* the weights of all holdings of its account on that day.

So the changed keys are joined with their neighbours, and the plan reads the days of the corrections and those around
them. The neighbours of a key are searched ``near_days`` to either side first; the holdings for which one is missing there
are looked up in the rest of history, if there are any. What is collected on the driver are days, never keys.

An account's values work the same way: its row of the changed day and its next one, and the totals of those days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.functions.columns import safe_ratio, zero_if_null
from tallyfolio.operators.sessions import on_sessions
from tallyfolio.plans import funds, holdings
from tallyfolio.plans.holdings import HOLDING, KEY, Scope
from tallyfolio.schemas import ACCOUNT, CORE_TABLES
from tallyfolio.session import kept

GONE = "gone"
"""Marks a key whose stored row has to go."""
NEAR_DAYS = 30


def changed_keys(core: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of stage rows that core lacks or holds with other values."""
    values = [c for c in core.columns if c not in keys]
    both = stage.select(*keys, *[F.col(c).alias(f"__{c}") for c in values]).join(core.withColumn("__held", F.lit(True)), list(keys), "left")
    same = F.col("__held").isNotNull()
    for c in values:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return both.filter(~same).select(*keys)


def _days(df: DataFrame, column: str) -> list[dt.date]:
    """Distinct days: bounded by the days of history."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _around(days: Sequence[dt.date], near: int) -> list[dt.date]:
    return sorted({d + dt.timedelta(days=k) for d in days for k in range(-near, near + 1)})


def with_neighbours(touched: DataFrame, rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The touched keys with the day of the row before (``before``) and after (``after``) among ``rows``, which
    hold a key and day once. Each is NULL where there is none."""
    marked = rows.select(*keys, order).withColumns({"row": F.lit(True), "hit": F.lit(False)}).unionByName(
        touched.select(*keys, order).distinct().withColumns({"row": F.lit(False), "hit": F.lit(True)})
    )
    merged = marked.groupBy(*keys, order).agg(F.max("row").alias("row"), F.max("hit").alias("hit"))
    own = F.when(F.col("row"), F.col(order))
    up = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = merged.withColumns({"before": F.last(own, ignorenulls=True).over(up), "after": F.last(own, ignorenulls=True).over(down)})
    return found.filter("hit").select(*keys, order, "before", "after")


def _found_near(
    read: Callable[[Callable[[DataFrame, str], DataFrame]], DataFrame],
    touched: DataFrame,
    keys: Sequence[str],
    order: str,
    days: Sequence[dt.date],
    near_days: int,
) -> tuple[DataFrame, Callable[[DataFrame, str], DataFrame]]:
    """The touched keys with their neighbours, and the cut of a source that these and the rows between are in.

    ``read(cut)`` gives the rows that can be neighbours from sources cut by ``cut(df, date column)``."""
    near = _around(days, near_days)
    among = touched.select(*keys).distinct()

    def close(df: DataFrame, date: str) -> DataFrame:
        return df.filter(F.col(date).isin(near)).join(among, list(keys), "left_semi")

    found = kept(with_neighbours(touched, read(close), keys, order), "neighbours")
    # a row beyond the key's own days may have others, not read yet, in between
    apart = {"before": F.datediff(order, "before"), "after": F.datediff("after", order)}
    lacking = [
        found.filter(F.coalesce(gap > near_days, F.lit(True))).select(*keys).distinct() for gap in apart.values()
    ]
    none = [df.isEmpty() for df in lacking]
    if all(none):
        return found, close

    def whole(df: DataFrame, date: str) -> DataFrame:
        parts = [close(df, date)]
        outside = (~F.col(date).isin(near), F.col(date) < F.lit(days[-1]), F.col(date) > F.lit(days[0]))
        if not none[0]:
            parts.append(df.filter(outside[0] & outside[1]).join(lacking[0], list(keys), "left_semi"))
        if not none[1]:
            later = df.filter(outside[0] & outside[2]).join(lacking[1], list(keys), "left_semi")
            if not none[0]:  # what both find is read once
                later = later.join(lacking[0].withColumn("__early", F.lit(True)), list(keys), "left")
                later = later.filter(F.col("__early").isNull() | ~outside[1]).drop("__early")
            parts.append(later)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    return kept(with_neighbours(touched, read(whole), keys, order), "neighbours"), whole


def repair_holdings(
    stored: DataFrame,
    changed: DataFrame,
    positions: DataFrame,
    dividends: DataFrame,
    trades: DataFrame,
    calendar: DataFrame,
    scope: Scope = Scope(),
    near_days: int = NEAR_DAYS,
) -> DataFrame:
    """Rows to put into the stored holding returns, by key: those of the affected holdings and days as a full
    computation gives them, ``gone`` where it gives none. ``changed`` holds the keys (account, report_date, symbol) of
    position, trade and dividend rows that were added or changed; the sources are as corrected."""
    touched = kept(changed.select(*KEY).distinct(), "changed")
    days = _days(touched, "report_date")
    columns = [*CORE_TABLES["holding_returns"].columns, GONE]
    if not days:
        return stored.limit(0).withColumn(GONE, F.lit(False)).select(*columns)

    def read(cut: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        return holdings.holding_keys(cut(positions, "report_date"), cut(trades, "report_date"), scope)

    found, cut = _found_near(read, touched, HOLDING, "report_date", days, near_days)
    following = found.filter(F.col("after").isNotNull()).select(*HOLDING, F.col("after").alias("report_date"))
    targets = kept(touched.unionByName(following).distinct(), "targets")
    target_days = _days(targets, "report_date")

    # the rows of these holdings and days, by the steps of a full computation
    merged = holdings.holding_base_merge(*[cut(df, "report_date") for df in (positions, dividends, trades)], scope)
    lagged = holdings.holding_lag(merged).filter(F.col("report_date").isin(target_days))
    adjusted = holdings.holding_adjustments(on_sessions(lagged, calendar, "report_date").join(targets, KEY, "left_semi"))
    day_positions, day_trades = (df.filter(F.col("report_date").isin(target_days)) for df in (positions, trades))
    values = holdings.account_values(day_positions, day_trades, scope)
    fresh = kept(holdings._output(holdings.weights_of(adjusted, values)).withColumn(GONE, F.lit(False)), "repaired")

    # stored rows of these days that a full computation does not give any more, and rows whose weight alone moves
    key = CORE_TABLES["holding_returns"].key
    target_keys = targets.select(F.col("report_date").alias("date"), ACCOUNT, F.col("symbol").alias("ticker"))
    here = stored.filter(F.col("date").isin(target_days))
    gone = here.join(target_keys, list(key), "left_semi").join(fresh.select(*key), list(key), "left_anti")
    accounts = touched.select(F.col("report_date").alias("date"), ACCOUNT).distinct()
    others = stored.filter(F.col("date").isin(days)).join(accounts, ["date", ACCOUNT], "left_semi").join(target_keys, list(key), "left_anti")
    held = holdings.scoped_positions(positions.filter(F.col("report_date").isin(days)), scope)
    held = held.select(F.col("report_date").alias("date"), ACCOUNT, F.col("symbol").alias("ticker"), "shares_1")
    moved = others.join(held, list(key), "left").join(values.withColumnRenamed("report_date", "date"), ["date", ACCOUNT], "left")
    moved = moved.withColumn("weight", safe_ratio(zero_if_null(F.col("shares_1")) * F.col("price"), F.col("account_value")))
    return (
        fresh.select(*columns)
        .unionByName(gone.withColumn(GONE, F.lit(True)).select(*columns))
        .unionByName(moved.withColumn(GONE, F.lit(False)).select(*columns))
    )


def repair_accounts(
    stored: DataFrame, changed: DataFrame, delta_nav: DataFrame, calendar: DataFrame, near_days: int = NEAR_DAYS
) -> DataFrame:
    """Rows to put into the stored account returns; ``changed`` holds (date, account) of changed values."""
    touched = kept(on_sessions(changed.select("date", ACCOUNT).distinct(), calendar), "changed")
    days = _days(touched, "date")
    columns = [*CORE_TABLES["fund_returns"].columns, GONE]
    if not days:
        return stored.limit(0).withColumn(GONE, F.lit(False)).select(*columns)
    nav = funds.nav_on_sessions(delta_nav, calendar)
    found, cut = _found_near(lambda part: part(nav, "date"), touched, [ACCOUNT], "date", days, near_days)
    following = found.filter(F.col("after").isNotNull()).select(ACCOUNT, F.col("after").alias("date"))
    targets = touched.unionByName(following).distinct()
    rows = funds.nav_lag(cut(nav, "date")).join(targets, ["date", ACCOUNT], "left_semi")
    return funds._returns(rows, "date", ACCOUNT).withColumn(GONE, F.lit(False)).select(*columns)


def repair_totals(
    stored: DataFrame, fund_days: DataFrame, delta_nav: DataFrame, calendar: DataFrame, near_days: int = NEAR_DAYS
) -> DataFrame:
    """Rows to put into the stored overall returns: all accounts' totals of the days in ``fund_days`` (those that
    ``repair_accounts`` gives)."""
    days = _days(fund_days, "date")
    columns = [*CORE_TABLES["all_fund_returns"].columns, GONE]
    if not days:
        return stored.limit(0).withColumn(GONE, F.lit(False)).select(*columns)
    nav = funds.nav_on_sessions(delta_nav, calendar)
    touched = nav.filter(F.col("date").isin(days)).select("date", ACCOUNT)
    _, cut = _found_near(lambda part: part(nav, "date"), touched, [ACCOUNT], "date", days, near_days)
    rows = funds.nav_lag(cut(nav, "date")).filter(F.col("date").isin(days))
    totals = rows.groupBy("date").agg(*[F.sum(c).alias(c) for c in funds._MEASURES])
    return funds._returns(totals, "date").withColumn(GONE, F.lit(False)).select(*columns)

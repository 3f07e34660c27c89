"""Daily returns, weights and values per holding.

A holding is (account, symbol). How the work is laid out:

* Trades and dividends are reduced to one row per (account, day, symbol) first. Partial sums run
  where the rows are read, so a key that owns a large part of them is small before any shuffle.
* Positions, already one row per key, are shuffled once, by holding, together with those sums.
  The merge (an aggregation over the union, not joins) and the lag both run on that layout. A
  holding has at most three rows a day there, so no task can get an unbounded group.
* The account totals behind the weights come from a partial aggregation of the positions and are
  joined back. Adaptive execution broadcasts them if they turn out small, which saves the second
  shuffle of the holdings, and splits large account-days if not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.functions.columns import position_side, safe_ratio, zero_if_null
from tallyfolio.operators.filters import between_dates, in_scope
from tallyfolio.operators.sessions import on_sessions
from tallyfolio.operators.windows import last_before, last_per_key, with_previous
from tallyfolio.schemas import ACCOUNT, NET_SHARES, POSITION_SCOPE, SHARES, TRADE_SCOPE

KEY = [ACCOUNT, "report_date", "symbol"]
HOLDING = [ACCOUNT, "symbol"]
_ACCOUNT_DAY = [ACCOUNT, "report_date"]
_LAGGED = {"fx_rate_1": "fx_rate_0", "shares_1": "shares_0", "price_1": "price_0"}
# Later days first; on one day the position comes after the trades of the same key.
_RECENCY = "unix_date(report_date) * 2 + rank"


@dataclass(frozen=True)
class Scope:
    """Sub-categories taken from positions and dividends, and from trades."""

    positions: Sequence[str] = POSITION_SCOPE
    trades: Sequence[str] = TRADE_SCOPE

    @classmethod
    def consistent(cls) -> Scope:
        """One list for all sources, so that trades of depositary receipts count as well."""
        return cls(POSITION_SCOPE, POSITION_SCOPE)


# --- Sources, narrowed to what the returns need -----------------------------------------------


def _keyed(df: DataFrame) -> DataFrame:
    """Primary keys hold no NULL. Saying so lets the joins below share what the merge computes:
    they would otherwise add the test themselves, and the plans would differ."""
    return df.filter(" AND ".join(f"{column} IS NOT NULL" for column in KEY))


def scoped_positions(positions: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return in_scope(_keyed(positions), scope.positions).select(
        *KEY,
        F.col("fx_rate_to_base").alias("fx_rate_1"),
        F.col("quantity").alias("shares_1"),
        F.col("mark_price").alias("price_1"),
    )


def scoped_dividends(dividends: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return in_scope(_keyed(dividends), scope.positions).select(*KEY, "net_amount", "gross_rate")


def scoped_trades(trades: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return in_scope(_keyed(trades), scope.trades).select(
        *KEY,
        F.col("quantity").cast(SHARES).alias("traded"),
        (F.col("quantity") * F.col("trade_price")).cast("double").alias("notional"),
    )


# --- One source at a time ---------------------------------------------------------------------


def position_sides(positions: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Positions in scope with their side: 1 long, -1 otherwise."""
    rows = scoped_positions(positions, scope)
    return rows.select(
        *KEY,
        "fx_rate_1",
        "shares_1",
        "price_1",
        position_side(F.col("shares_1")).alias("side"),
    )


def dividends_by_holding(dividends: DataFrame, scope: Scope = Scope()) -> DataFrame:
    return (
        scoped_dividends(dividends, scope)
        .groupBy(*KEY)
        .agg(F.sum("net_amount").alias("dividends"), F.sum("gross_rate").alias("dividends_per_share"))
    )


def _net_trades(trades: DataFrame, scope: Scope) -> DataFrame:
    """Exact net shares and volume-weighted price per key; keys that net to 0 drop."""
    net = F.sum("traded").cast(NET_SHARES).alias("net")
    per_key = scoped_trades(trades, scope).groupBy(*KEY).agg(net, F.sum("notional").alias("notional"))
    price = safe_ratio(F.col("notional"), F.col("net").cast("double"))
    return per_key.filter(F.col("net") != 0).select(*KEY, "net", price.alias("average_trade_price"))


def trade_vwap(trades: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Net shares and volume-weighted price per holding and day; days that net to 0 drop."""
    return _net_trades(trades, scope).select(
        *KEY, F.col("net").cast("double").alias("shares_traded"), "average_trade_price"
    )


# --- Merge ------------------------------------------------------------------------------------


def holding_keys(positions: DataFrame, trades: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Keys with a position or with net trades."""
    held = scoped_positions(positions, scope).select(*KEY)
    return held.union(_net_trades(trades, scope).select(*KEY)).distinct()


def holding_base_merge(
    positions: DataFrame,
    dividends: DataFrame,
    trades: DataFrame,
    scope: Scope = Scope(),
    start: dt.date | None = None,
    end: dt.date | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Positions, dividends and net trades of each holding and day, side by side.

    Position columns stay NULL on days without a position; dividend and trade columns are 0.
    Dividends of a key neither held nor traded drop. ``shares_kept`` is the holding without the
    day's trades, subtracted exactly: 0 there means the day opened the holding. ``earlier`` are
    rows from before the range, taken as they are for the lag to read.
    """
    bounded = [between_dates(df, "report_date", start, end) for df in (positions, dividends, trades)]
    legs = (
        scoped_positions(bounded[0], scope)
        .withColumn("held", F.lit(True))
        .unionByName(_net_trades(bounded[2], scope), allowMissingColumns=True)
        .unionByName(dividends_by_holding(bounded[1], scope), allowMissingColumns=True)
    )
    if earlier is not None:
        legs = legs.unionByName(earlier.withColumn("held", F.lit(True)), allowMissingColumns=True)
    # Laid out by holding, which also groups by key and later serves the lag without a shuffle.
    # Each leg has one row per key, so max() just carries its values over. Trades and dividends are
    # sums per key; a position twice would be mixed up from both rows, and is counted.
    carried = [c for c in legs.columns if c not in KEY]
    merged = legs.repartition(*HOLDING).groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in carried], F.count("held").alias("n_positions")
    )
    repeated = F.raise_error(F.concat_ws(" ", F.lit("position twice:"), *[F.col(k).cast("string") for k in KEY]))
    shares = zero_if_null(F.col("shares_1"))
    # Only days with trades pay for decimal arithmetic.
    kept = F.when(F.col("net").isNull(), shares).otherwise((shares.cast(SHARES) - F.col("net")).cast("double"))
    present = F.col("held") | F.col("net").isNotNull()
    return merged.filter(F.when(F.col("n_positions") > 1, repeated.cast("boolean")).otherwise(present)).select(
        *KEY,
        "fx_rate_1",
        "shares_1",
        "price_1",
        zero_if_null(F.col("dividends")).alias("dividends"),
        zero_if_null(F.col("dividends_per_share")).alias("dividends_per_share"),
        zero_if_null(F.col("net").cast("double")).alias("shares_traded"),
        zero_if_null(F.col("average_trade_price")).alias("average_trade_price"),
        kept.alias("shares_kept"),
    )


# --- Lag and the entry, exit and trim rules -----------------------------------------------------


def _current_values(df: DataFrame) -> DataFrame:
    """Fill the position columns of days without a position, once the lags have been taken."""
    return df.withColumns(
        {
            "fx_rate_1": zero_if_null(F.col("fx_rate_1")),
            "shares_1": zero_if_null(F.col("shares_1")),
            "price_1": F.coalesce("price_1", "average_trade_price"),
        }
    )


def holding_lag(merged: DataFrame) -> DataFrame:
    """Add the holding's fx rate, shares and price of its previous row.

    The lags read the columns as merged, NULL on days without a position: the row after an exit
    has no predecessor to compare with and falls back to its own values.
    """
    return _current_values(with_previous(merged, HOLDING, "report_date", _LAGGED))


def holding_adjustments(lagged: DataFrame) -> DataFrame:
    """Shares and prices a return compares, by kind of day.

    Entry (nothing was kept): bought at the trade price. Exit (nothing is left): sold at the trade
    price. Otherwise the kept shares go from the previous price to today's. Prices come out in
    base currency.
    """
    entered = F.col("shares_kept") == 0
    exited = F.col("shares_1") == 0
    trade_price = F.col("average_trade_price") * F.col("fx_rate_0")
    return lagged.select(
        *KEY,
        "shares_0",
        "shares_1",
        "shares_traded",
        "average_trade_price",
        F.when(entered, F.col("shares_1"))
        .when(exited, F.col("shares_0"))
        .otherwise(F.col("shares_kept"))
        .alias("shares_1_adj"),
        F.when(entered, trade_price).otherwise(F.col("price_0") * F.col("fx_rate_0")).alias("price_0"),
        F.when(exited, trade_price).otherwise(F.col("price_1") * F.col("fx_rate_1")).alias("price_1"),
        "dividends",
        "dividends_per_share",
    )


# --- Weights and returns ------------------------------------------------------------------------


def account_values(
    positions: DataFrame,
    trades: DataFrame,
    scope: Scope = Scope(),
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Value of each account's positions per day in base currency, the whole a weight is a part of.

    Days without a position contribute nothing to it, so positions alone decide; only one without
    a mark price needs its trade price. Such rows are rare or absent (the null counts of the files
    then skip the scan), and the trade sums are the ones the merge computes anyway. The merge hint
    keeps these from being broadcast; adaptive execution drops the join when its left is empty.
    """
    held = scoped_positions(between_dates(positions, "report_date", start, end), scope)
    traded = _net_trades(between_dates(trades, "report_date", start, end), scope)
    marked = held.filter(F.col("price_1").isNotNull())
    unmarked = held.filter(F.col("price_1").isNull()).join(traded.hint("merge"), KEY)
    price = {"price_1": F.col("average_trade_price")}
    rows = marked.unionByName(unmarked.withColumns(price).select(*held.columns))
    value = F.col("shares_1") * (F.col("price_1") * zero_if_null(F.col("fx_rate_1")))
    return rows.groupBy(*_ACCOUNT_DAY).agg(F.sum(value).alias("account_value"))


def weights_of(adjusted: DataFrame, values: DataFrame) -> DataFrame:
    """Add ``weight``, the holding's share of ``account_value``; NULL where that is 0 or absent."""
    weight = safe_ratio(F.col("shares_1") * F.col("price_1"), F.col("account_value"))
    return adjusted.join(values, _ACCOUNT_DAY, "left").withColumn("weight", weight).drop("account_value")


def holding_weights(adjusted: DataFrame) -> DataFrame:
    """Add ``weight``, the holding's share of its account's value that day, from the rows alone.

    A window by account and day: its groups are the instruments an account holds on a day.
    """
    held = F.col("shares_1") * F.col("price_1")
    total = F.sum(held).over(Window.partitionBy(*_ACCOUNT_DAY))
    return adjusted.withColumn("weight", safe_ratio(held, total))


def _output(weighted: DataFrame) -> DataFrame:
    shares = F.when(F.col("shares_1") == 0, F.col("shares_0")).otherwise(F.col("shares_1"))
    gained = F.col("shares_1_adj") * F.col("price_1") + F.col("dividends")
    return weighted.select(
        F.col("report_date").alias("date"),
        ACCOUNT,
        F.col("symbol").alias("ticker"),
        "weight",
        shares.alias("shares"),
        F.col("price_1").alias("price"),
        (shares * F.col("price_1")).alias("value"),
        "shares_traded",
        "average_trade_price",
        (safe_ratio(gained, F.col("shares_0") * F.col("price_0")) - 1).alias("return"),
        "dividends",
        "dividends_per_share",
    )


def _held_or_traded(
    positions: DataFrame, trades: DataFrame, scope: Scope, start: dt.date | None, end: dt.date | None
) -> DataFrame:
    """The rows a lag could read, without merging them: each position (rank 1), and each key with
    net trades (rank 0), whose position columns are NULL. The latest by date and rank has the
    values of the latest row of ``holding_base_merge``."""
    held = scoped_positions(between_dates(positions, "report_date", start, end), scope)
    traded = _net_trades(between_dates(trades, "report_date", start, end), scope).select(*KEY)
    return held.withColumn("rank", F.lit(1)).unionByName(
        traded.withColumn("rank", F.lit(0)), allowMissingColumns=True
    )


def latest_holdings(
    positions: DataFrame,
    trades: DataFrame,
    day: dt.date,
    scope: Scope = Scope(),
    known: DataFrame | None = None,
    known_day: dt.date | None = None,
) -> DataFrame:
    """The last row of every holding up to ``day``, as a lag after it will want it.

    ``known`` is the same of an earlier day, ``known_day``: only the days between are read then, so
    that a daily run costs a row per holding and a day of reports, however long history is. A
    holding that is not in the result has no earlier row.
    """
    if known is not None and known_day == day:
        return known
    after = None if known is None else known_day + dt.timedelta(days=1)
    rows = _held_or_traded(positions, trades, scope, after, day)
    if known is not None:
        rows = rows.unionByName(known)
    return last_per_key(rows, HOLDING, F.expr(_RECENCY), ["report_date", *_LAGGED, "rank"])


def holding_returns(
    positions: DataFrame,
    dividends: DataFrame,
    trades: DataFrame,
    calendar: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    scope: Scope = Scope(),
    look_back: bool = True,
    look_back_days: int | None = None,
    window_weights: bool = False,
    latest: DataFrame | None = None,
) -> DataFrame:
    """Return, weight and value of each holding on each session of the range.

    ``look_back`` lets the first rows of the range see their predecessors before it; without it
    they compare with themselves, as a computation confined to the range must. History is reduced
    to a row per holding for that; ``look_back_days`` searches the days just before the range
    first and reads the rest only if a holding is missing. The result is the same.
    The calendar applies after the lag, which may have read a row between sessions.
    ``window_weights`` sums the account values in a window instead of joining them.
    ``latest`` is ``latest_holdings`` of the day before the range: history is not read at all then.
    """
    earlier = None
    if look_back and start is not None and latest is not None:
        # of all holdings ever held only those of the range; their keys are broadcast where they are few
        held = between_dates(positions, "report_date", start, end).select(*HOLDING)
        dealt = between_dates(trades, "report_date", start, end).select(*HOLDING)
        earlier = latest.drop("rank").join(held.unionByName(dealt).distinct(), HOLDING, "left_semi")
    elif look_back and start is not None:
        rows = partial(_held_or_traded, positions, trades, scope)
        wanted = rows(start, end).select(*HOLDING).distinct()
        columns = ["report_date", *_LAGGED]
        earlier = last_before(rows, HOLDING, F.expr(_RECENCY), columns, start, wanted, look_back_days)
    merged = holding_base_merge(positions, dividends, trades, scope, start, end, earlier)
    lagged = between_dates(holding_lag(merged), "report_date", start, None)
    adjusted = holding_adjustments(on_sessions(lagged, calendar, "report_date"))
    if window_weights:
        return _output(holding_weights(adjusted))
    return _output(weights_of(adjusted, account_values(positions, trades, scope, start, end)))

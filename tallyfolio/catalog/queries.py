"""Every operator as a query over the shared tables: name -> (spark, folder) -> DataFrame.

Each runs over whole tables. A narrower date range appears only where the range is the feature.
Ratios are rounded to 8 digits for comparison across engines.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfolio import jobs
from tallyfolio.catalog.fixtures import FUNDS, Views
from tallyfolio.functions import columns, exact
from tallyfolio.operators import asof, cleaning, filters, merge, sessions, windows
from tallyfolio.plans import funds, holdings, repair, series
from tallyfolio.schemas import ACCOUNT, CORE_TABLES, POSITION_SCOPE, REPORT_COLUMNS, REPORTS
from tallyfolio.session import kept, kept_in_shares, kept_while, shared_dir
from tallyfolio.sources import reports
from tallyfolio.sources import series as series_sources
from tallyfolio.sources.tables import Warehouse, conform
from tallyfolio.streaming import holdings as follow

Query = Callable[[SparkSession, str], DataFrame]

# Ranges of the queries whose feature is a range; oracles use the same.
RANGE = (dt.date(1998, 3, 2), dt.date(1998, 9, 30))
LATE_RANGE = (dt.date(2000, 6, 5), dt.date(2001, 12, 31))
SUNDAY = dt.date(1998, 3, 15)
YIELD_SERIES = "1-URGENT"
# Shares of a reload whose shuffles follow one another.
SURVIVOR_SHARES = 4

_QUERIES: dict[str, Query] = {}


def _register(build: Callable[[Views], DataFrame]) -> Query:
    @wraps(build)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Views(spark, sf_dir))

    _QUERIES[build.__name__] = query
    return query


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 8) for c in columns})


# --- Filters and cleaning -----------------------------------------------------------------------


@_register
def clean_drop_headers(v: Views) -> DataFrame:
    return cleaning.drop_header_rows(v.raw_trades()).select("TradeID", "ClientAccountID", "Quantity")


@_register
def clean_rename(v: Views) -> DataFrame:
    mapping = {"TradeID": "trade_id", "Buy/Sell": "buy_sell", "Quantity": "quantity"}
    return cleaning.pick_columns(v.raw_trades(), mapping)


@_register
def clean_parse_dates(v: Views) -> DataFrame:
    rows = cleaning.drop_header_rows(v.raw_trades())
    picked = cleaning.pick_columns(rows, {"TradeID": "trade_id", "ReportDate": "report_date"})
    return cleaning.parse_dates(picked, "report_date")


@_register
def clean_empty_to_null(v: Views) -> DataFrame:
    mapping = {"ActionID": "action_id", "ExDate": "ex_date", "PayDate": "pay_date"}
    rows = cleaning.pick_columns(v["raw_dividends"], mapping)
    return cleaning.parse_dates(cleaning.empty_to_null(rows, "ex_date", "pay_date"), "ex_date", "pay_date")


@_register
def clean_positions(v: Views) -> DataFrame:
    return cleaning.clean_positions(v["raw_positions"])


@_register
def clean_trades(v: Views) -> DataFrame:
    return cleaning.clean_trades(v.raw_trades())


@_register
def clean_dividends(v: Views) -> DataFrame:
    return cleaning.clean_dividends(v["raw_dividends"])


@_register
def clean_delta_nav(v: Views) -> DataFrame:
    return cleaning.clean_delta_nav(v["raw_delta_nav"])


@_register
def filter_asset_scope(v: Views) -> DataFrame:
    rows = filters.in_scope(v["v_trades"], POSITION_SCOPE)
    return rows.select("report_date", ACCOUNT, "symbol", "trade_id", "sub_category")


@_register
def filter_date_range(v: Views) -> DataFrame:
    return filters.between_dates(v["v_trades"], "report_date", *RANGE)


@_register
def union_partials(v: Views) -> DataFrame:
    # Two partial extracts with their columns in different orders.
    traded = v["v_traded_days"].select("report_date", ACCOUNT, "symbol", F.col("net").alias("quantity"))
    held = v["v_positions"].select("quantity", "symbol", ACCOUNT, "report_date")
    return reports.union_partials([traded, held])


@_register
def reload_union_distinct(v: Views) -> DataFrame:
    # Zones that overlap in time, as history, backfill and daily files do.
    trades = v["v_trades"]
    zones = [
        filters.between_dates(trades, "report_date", None, dt.date(1999, 12, 31)),
        filters.between_dates(trades, "report_date", dt.date(1997, 1, 1), None),
        filters.between_dates(trades, "report_date", *RANGE),
    ]
    return filters.union_distinct(zones)


# --- Accounts -------------------------------------------------------------------------------------


@_register
def nav_on_sessions(v: Views) -> DataFrame:
    return funds.nav_on_sessions(v["v_delta_nav"], v["v_calendar"])


@_register
def nav_lag(v: Views) -> DataFrame:
    return funds.nav_lag(funds.nav_on_sessions(v["v_delta_nav"], v["v_calendar"]))


@_register
def fund_returns(v: Views) -> DataFrame:
    return _rounded(funds.fund_returns(v["v_delta_nav"], v["v_calendar"]), "return")


@_register
def fund_returns_range(v: Views) -> DataFrame:
    return _rounded(funds.fund_returns(v["v_delta_nav"], v["v_calendar"], *RANGE), "return")


@_register
def fund_returns_incremental(v: Views) -> DataFrame:
    rows = funds.fund_returns(v["v_delta_nav"], v["v_calendar"], *LATE_RANGE, look_back_days=10)
    return _rounded(rows, "return")


@_register
def all_fund_returns(v: Views) -> DataFrame:
    return _rounded(funds.all_fund_returns(v["v_delta_nav"], v["v_calendar"]), "return")


@_register
def all_fund_returns_incremental(v: Views) -> DataFrame:
    rows = funds.all_fund_returns(v["v_delta_nav"], v["v_calendar"], *LATE_RANGE, look_back_days=10)
    return _rounded(rows, "return")


# --- Holdings ---------------------------------------------------------------------------------------


def _sources(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    return v["v_positions_held"], v["v_dividends"], v["v_trades"]


def _adjusted(v: Views) -> DataFrame:
    return holdings.holding_adjustments(holdings.holding_lag(holdings.holding_base_merge(*_sources(v))))


def _holding_returns(v: Views, *bounds, **options) -> DataFrame:
    rows = holdings.holding_returns(*_sources(v), v["v_calendar"], *bounds, **options)
    return _rounded(rows, "weight", "return")


@_register
def position_side(v: Views) -> DataFrame:
    return holdings.position_sides(v["v_positions_held"])


@_register
def position_side_filled(v: Views) -> DataFrame:
    # Side of every merged key; where there is no position it opposes the day's trades.
    merged = holdings.holding_base_merge(*_sources(v))
    own = F.when(F.col("shares_1").isNotNull(), columns.position_side(F.col("shares_1")).cast("double"))
    return merged.select(*holdings.KEY, F.coalesce(own, -F.signum("shares_traded")).alias("side"))


@_register
def dividends_by_holding(v: Views) -> DataFrame:
    return holdings.dividends_by_holding(v["v_dividends"])


@_register
def trade_vwap(v: Views) -> DataFrame:
    return holdings.trade_vwap(v["v_trades"])


@_register
def holding_keys(v: Views) -> DataFrame:
    return holdings.holding_keys(v["v_positions_held"], v["v_trades"])


@_register
def holding_base_merge(v: Views) -> DataFrame:
    return holdings.holding_base_merge(*_sources(v)).drop("shares_kept")


@_register
def holding_lag(v: Views) -> DataFrame:
    return holdings.holding_lag(holdings.holding_base_merge(*_sources(v))).drop("shares_kept")


@_register
def holding_adjustments(v: Views) -> DataFrame:
    return _adjusted(v)


@_register
def holding_weights(v: Views) -> DataFrame:
    rows = holdings.holding_weights(_adjusted(v))
    return _rounded(rows.select(*holdings.KEY, "weight"), "weight")


@_register
def holding_weights_joined(v: Views) -> DataFrame:
    values = holdings.account_values(v["v_positions_held"], v["v_trades"])
    rows = holdings.weights_of(_adjusted(v), values)
    return _rounded(rows.select(*holdings.KEY, "weight"), "weight")


@_register
def account_values(v: Views) -> DataFrame:
    return holdings.account_values(v["v_positions_held"], v["v_trades"])


@_register
def holding_returns(v: Views) -> DataFrame:
    return _holding_returns(v)


@_register
def holding_returns_window_weights(v: Views) -> DataFrame:
    return _holding_returns(v, window_weights=True)


@_register
def holding_returns_range(v: Views) -> DataFrame:
    return _holding_returns(v, *RANGE)


@_register
def holding_returns_literal_range(v: Views) -> DataFrame:
    return _holding_returns(v, *RANGE, look_back=False)


@_register
def holding_returns_incremental(v: Views) -> DataFrame:
    return _holding_returns(v, *LATE_RANGE, look_back_days=10)


@_register
def holding_returns_consistent_scope(v: Views) -> DataFrame:
    return _holding_returns(v, scope=holdings.Scope.consistent())


# The same over many accounts and symbols, with an account that holds a third of all.


@_register
def holding_returns_wide(v: Views) -> DataFrame:
    rows = holdings.holding_returns(v["w_positions"], v["w_dividends"], v["w_trades"], v["v_calendar"])
    return _rounded(rows, "weight", "return")


@_register
def holding_returns_wide_latest(v: Views) -> DataFrame:
    # A range whose predecessors come from the latest rows, carried on over two steps.
    middle, before = RANGE[0], LATE_RANGE[0] - dt.timedelta(days=1)
    known = holdings.latest_holdings(v["w_positions"], v["w_trades"], middle)
    latest = holdings.latest_holdings(v["w_positions"], v["w_trades"], before, known=known, known_day=middle)
    rows = holdings.holding_returns(
        v["w_positions"], v["w_dividends"], v["w_trades"], v["v_calendar"], *LATE_RANGE, latest=latest
    )
    return _rounded(rows, "weight", "return")


@_register
def fund_returns_wide(v: Views) -> DataFrame:
    return _rounded(funds.fund_returns(v["w_delta_nav"], v["v_calendar"]), "return")


@_register
def fund_returns_wide_latest(v: Views) -> DataFrame:
    latest = funds.latest_accounts(v["w_delta_nav"], v["v_calendar"], LATE_RANGE[0] - dt.timedelta(days=1))
    return _rounded(funds.fund_returns(v["w_delta_nav"], v["v_calendar"], *LATE_RANGE, latest=latest), "return")


# --- Series -----------------------------------------------------------------------------------------


@_register
def prices_wide_to_long(v: Views) -> DataFrame:
    fields = {"Close": "adjusted_close", "Dividends": "dividends_per_share"}
    return series_sources.prices_wide_to_long(v.wide_prices(), "date", fields, v.tickers())


@_register
def clean_prices(v: Views) -> DataFrame:
    return series_sources.clean_prices(v["raw_prices"])


@_register
def clean_yields(v: Views) -> DataFrame:
    return series_sources.clean_yields(v["raw_yields"])


@_register
def benchmark_return(v: Views) -> DataFrame:
    return _rounded(series.benchmark_return(v["v_prices"]), "return")


@_register
def yield_lag(v: Views) -> DataFrame:
    return series.yield_lag(v["v_yields"])


@_register
def daily_yield(v: Views) -> DataFrame:
    return _rounded(series.daily_yields(v["v_yields"]), "daily_yield")


@_register
def backfill_nulls(v: Views) -> DataFrame:
    return windows.backfill_nulls(v["v_yields"], ["series_id"], "date", "yield")


@_register
def risk_free_return(v: Views) -> DataFrame:
    return _rounded(series.risk_free_return(v["v_yields"]), "return")


@_register
def risk_free_return_range(v: Views) -> DataFrame:
    return _rounded(series.risk_free_return(v["v_yields"], *RANGE), "return")


# --- Sessions ---------------------------------------------------------------------------------------


@_register
def trading_days(v: Views) -> DataFrame:
    span = v["v_order_days"].agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    return sessions.trading_days(v.spark, span["first"], span["last"], v["v_holidays"])


@_register
def last_market_date(v: Views) -> DataFrame:
    return sessions.last_session(v["v_calendar"], SUNDAY)


@_register
def prev_session(v: Views) -> DataFrame:
    calendar = v["v_calendar"].withColumn("exchange", F.lit("NYSE"))
    return sessions.with_previous_session(calendar).select("date", "previous_date")


@_register
def session_as_of(v: Views) -> DataFrame:
    # Two thirds of the events on one day, which is a hot bin.
    events = v["events"].select("event_id", "ts", F.when(F.col("event_id") % 3 > 0, F.lit(dt.datetime(2024, 1, 6, 12))).otherwise(F.col("ts").cast("timestamp")).alias("at"))
    return asof.session_as_of(events.select("event_id", "at"), v["v_event_sessions"], "at").select("event_id", "session")


@_register
def monthly_intervals(v: Views) -> DataFrame:
    return sessions.monthly_intervals(v["v_calendar"])


# --- Merge ------------------------------------------------------------------------------------------

_HOLDING_DAY = ["report_date", ACCOUNT, "symbol"]


def _core(v: Views) -> DataFrame:
    return v["v_positions"].select(*_HOLDING_DAY, "mark_price", "quantity")


def _stage(v: Views) -> DataFrame:
    return v["v_traded_days"].select(*_HOLDING_DAY, "mark_price", F.col("net").alias("quantity"))


@_register
def upsert_update(v: Views) -> DataFrame:
    return merge.upsert_update(_core(v), _stage(v), _HOLDING_DAY)


@_register
def upsert_wide(v: Views) -> DataFrame:
    core = v["w_positions"].select(*_HOLDING_DAY, "mark_price", "quantity")
    stage = v["w_traded_days"].select(*_HOLDING_DAY, "mark_price", F.col("net").alias("quantity"))
    return merge.upsert_update(core, stage, _HOLDING_DAY)


@_register
def upsert_update_latest(v: Views) -> DataFrame:
    # One row per trade, hence many per key: the last trade of the day wins.
    trades = v["v_trades"].select(
        *_HOLDING_DAY, F.col("trade_price").alias("mark_price"), "quantity", "trade_id"
    )
    return merge.upsert_update(_core(v), trades, _HOLDING_DAY, on_duplicate="latest", order=["trade_id"])


@_register
def upsert_ignore(v: Views) -> DataFrame:
    return merge.upsert_ignore(_core(v), _stage(v), _HOLDING_DAY)


@_register
def upsert_fill(v: Views) -> DataFrame:
    # Core lacks the prices of short positions; stage has some of them.
    long_only = F.when(F.col("quantity") > 0, F.col("mark_price"))
    return merge.upsert_fill(_core(v).withColumn("mark_price", long_only), _stage(v), _HOLDING_DAY)


@_register
def upsert_trades(v: Views) -> DataFrame:
    # At the grain of single trades: yesterday's buys, then the whole day's trades.
    key = list(CORE_TABLES["trades"].key)
    trades = v["v_trades"].select(*key, "quantity", "trade_price")
    buys = v["v_trades"].filter(F.col("buy_sell") == "BUY").select(*key, -F.col("quantity"), "trade_price")
    return merge.upsert_update(buys.toDF(*trades.columns), trades, key)


@_register
def key_violations(v: Views) -> DataFrame:
    return merge.key_violations(v["lineitem"], ["l_orderkey", "l_linenumber"])


@_register
def rerun_idempotent(v: Views) -> DataFrame:
    once = merge.upsert_update(_core(v), _stage(v), _HOLDING_DAY)
    return merge.upsert_update(once, _stage(v), _HOLDING_DAY)


@_register
def returns_upsert(v: Views) -> DataFrame:
    # Returns stored by a run confined to its range, corrected by a later full run.
    key = list(CORE_TABLES["holding_returns"].key)
    stored = holdings.holding_returns(*_sources(v), v["v_calendar"], *RANGE, look_back=False)
    return _rounded(
        merge.upsert_update(stored, holdings.holding_returns(*_sources(v), v["v_calendar"]), key), "weight", "return"
    )


def _merged_positions(v: Views, warehouse: Warehouse) -> DataFrame:
    return warehouse.read("positions").select(*_HOLDING_DAY, "mark_price", "quantity")


@_register
def upsert_published(v: Views) -> DataFrame:
    # Two merges into a stored table, and one that writes its folders and is never published.
    warehouse = Warehouse(v.spark, f"{_scratch(v)}/core", grain="month")
    warehouse.merge("positions", _core(v))
    with contextlib.suppress(InterruptedError), warehouse.transaction() as unfinished:
        warehouse.merge("positions", _stage(v).withColumn("quantity", F.lit(0.0)), transaction=unfinished)
        raise InterruptedError
    warehouse.merge("positions", _stage(v))
    return _merged_positions(v, warehouse)


def _wrong(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """The rows as they were before corrections: some missing, some with another number, some in another scope."""
    draw = F.pmod(F.xxhash64(*keys), F.lit(997))
    scope = F.when(draw == 2, F.lit("ETF")).when(draw == 3, F.lit("BOND")).otherwise(F.col("sub_category"))
    shifted = F.when(draw == 1, F.col(number) + 7).otherwise(F.col(number))
    return df.filter(draw != 0).withColumns({number: shifted, "sub_category": scope})


@_register
def returns_repair(v: Views) -> DataFrame:
    # Returns stored from wrong reports, then repaired where corrected ones change them.
    tables = ("positions", "dividends", "trades")
    numbers = {"positions": "quantity", "dividends": "net_amount", "trades": "trade_price"}
    right = {t: kept(df, t) for t, df in zip(tables, _sources(v), strict=True)}
    wrong = {t: kept(_wrong(right[t], list(CORE_TABLES[t].key), numbers[t]), t) for t in tables}
    calendar = kept(v["v_calendar"], "calendar")
    stored = kept(holdings.holding_returns(*[wrong[t] for t in tables], calendar), "returns")
    changed = filters.union_all(
        repair.changed_keys(wrong[t], right[t], CORE_TABLES[t].key).select(*holdings.KEY) for t in tables
    )
    rows = repair.repair_holdings(stored, changed, *[right[t] for t in tables], calendar)
    return _rounded(merge.upsert_or_drop(stored, rows, CORE_TABLES["holding_returns"].key), "weight", "return")


@_register
def account_returns_repair(v: Views) -> DataFrame:
    nav, calendar = kept(v["v_delta_nav"], "nav"), kept(v["v_calendar"], "calendar")
    draw = F.pmod(F.xxhash64("date", ACCOUNT), F.lit(149))
    wrong = nav.filter(draw != 0).withColumn("ending_value", F.when(draw == 1, F.lit(5.0)).otherwise(F.col("ending_value")))
    stored = funds.fund_returns(wrong, calendar)
    rows = repair.repair_accounts(stored, repair.changed_keys(wrong, nav, ["date", ACCOUNT]), nav, calendar)
    return _rounded(merge.upsert_or_drop(stored, rows, ["date", ACCOUNT]), "return")


@_register
def stream_holding_returns(v: Views) -> DataFrame:
    # Day rows in three runs: some late, some corrected in the last run, some that had to go.
    root = _scratch(v)
    merged = kept(holdings.holding_base_merge(*_sources(v)), "merged")
    draw = F.pmod(F.xxhash64(*holdings.KEY), F.lit(13))
    day = {"gone": F.lit(False), "version": F.lit(0).cast("long")}
    right = merged.withColumns(day)
    wrong = right.withColumns({"shares_1": F.lit(3.0), "price_1": F.lit(5.0)})
    beside = wrong.filter(draw == 3).withColumn("report_date", F.date_add("report_date", 1))
    beside = beside.join(merged, holdings.KEY, "left_anti")
    runs = [
        right.filter(draw > 2).unionByName(wrong.filter(draw == 1)).unionByName(beside),
        right.filter(draw == 0),
        right.filter((draw == 1) | (draw == 2)).unionByName(beside.withColumn("gone", F.lit(True))),
    ]
    calendar = kept(v["v_calendar"], "calendar")
    for rows in runs:
        rows.select(*[F.col(f.name).cast(f.dataType) for f in follow.LOG.fields]).write.mode("append").parquet(f"{root}/log")
        follow.follow_holdings(v.spark, f"{root}/log", f"{root}/sink", calendar, f"{root}/checkpoint").awaitTermination()
    return _rounded(follow.followed_returns(v.spark, f"{root}/sink"), "weight", "return")


@_register
def core_schemas(v: Views) -> DataFrame:
    # A line per column of each core table, with the type its parquet files say and its non-null values.
    nav, calendar = v["v_delta_nav"], v["v_calendar"]
    one_series = v["v_yields"].filter(F.col("series_id") == YIELD_SERIES)
    frames = {
        "positions": v["v_positions_held"],
        "trades": v["v_trades"],
        "dividends": v["v_dividends"],
        "delta_nav": nav,
        "calendar": calendar,
        "benchmark": series.benchmark_return(v["v_prices"]),
        "risk_free_rate": series.risk_free_return(one_series),
        "holding_returns": holdings.holding_returns(*_sources(v), calendar),
        "fund_returns": funds.fund_returns(nav, calendar),
        "all_fund_returns": funds.all_fund_returns(nav, calendar),
    }
    root = _scratch(v)
    lines = []
    for name, df in frames.items():
        conform(df, name).write.parquet(f"{root}/{name}")
        stored = v.spark.read.parquet(f"{root}/{name}")
        columns = [
            F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"),
                     F.col(f"`{f.name}`").alias("n_values"))
            for f in stored.schema.fields
        ]
        counted = stored.agg(*[F.count(f"`{c}`").alias(c) for c in stored.columns])
        lines.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*columns))))
    return filters.union_all(lines)


# --- Files and run modes ------------------------------------------------------------------------------


def _scratch(v: Views) -> str:
    return f"{shared_dir(v.spark)}/tallyfolio/{uuid.uuid4().hex}"


_RAW_COLUMNS = {
    "trades": {
        "report_date": "ReportDate", ACCOUNT: "ClientAccountID", "sub_category": "SubCategory", "symbol": "Symbol",
        "trade_id": "TradeID", "quantity": "Quantity", "trade_price": "TradePrice", "ib_commission": "IBCommission",
        "buy_sell": "Buy/Sell",
    },
    "positions": {
        "report_date": "ReportDate", ACCOUNT: "ClientAccountID", "sub_category": "SubCategory", "symbol": "Symbol",
        "mark_price": "MarkPrice", "quantity": "Quantity", "fx_rate_to_base": "FXRateToBase",
    },
    "dividends": {
        "report_date": "ReportDate", ACCOUNT: "ClientAccountID", "sub_category": "SubCategory", "symbol": "Symbol",
        "action_id": "ActionID", "ex_date": "ExDate", "quantity": "Quantity", "gross_rate": "GrossRate",
        "gross_amount": "GrossAmount", "tax": "Tax", "fee": "Fee", "net_amount": "NetAmount",
    },
    "delta_nav": {
        "date": "ToDate", "from_date": "FromDate", ACCOUNT: "ClientAccountID", "ending_value": "EndingValue",
        "deposits_withdrawals": "DepositsWithdrawals", "dividends": "Dividends",
    },
}


def _raw(v: Views, report: str) -> DataFrame:
    """A view as raw report rows; columns the view lacks are empty."""
    view = "v_positions_held" if report == "positions" else f"v_{report}"
    rows = v[view]
    if report == "dividends":
        rows = rows.withColumn("ex_date", F.col("report_date"))
    if report == "delta_nav":
        rows = rows.withColumn("from_date", F.col("date"))
    named = {raw: F.col(core) for core, raw in _RAW_COLUMNS[report].items()}
    texts = []
    for raw in REPORT_COLUMNS[report]:
        column = named.get(raw, F.lit(None).cast("string"))
        text = F.date_format(column, "yyyyMMdd") if raw.endswith("Date") and raw in named else column.cast("string")
        texts.append(text.alias(raw))
    return rows.select(*texts)


def _span(v: Views) -> tuple[dt.date, dt.date]:
    """First and last day of any report."""
    days = v["v_order_days"].union(v["v_trades"].select("report_date"))
    return tuple(days.agg(F.min("date"), F.max("date")).first())


def _land(v: Views, path: Callable[[str, str], str], names=REPORTS) -> None:
    """Land the views fund by fund, as an extract would."""
    for report in names:
        for fund in FUNDS:
            reports.land_report(_raw(v, report).filter(F.col("ClientAccountID") == fund), path(fund, report))


def _trade_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "report_date", ACCOUNT, "sub_category", "symbol", "trade_id", "quantity", "trade_price", "ib_commission",
        "buy_sell",
    )


@_register
def scan_csv_report(v: Views) -> DataFrame:
    path = f"{_scratch(v)}/history-files/all/trades.csv"
    reports.land_report(v.raw_trades(), path)
    return reports.read_report(v.spark, path, "trades")


@_register
def scan_daily(v: Views) -> DataFrame:
    _, last = _span(v)
    landing = reports.Landing(_scratch(v))
    _land(v, lambda fund, report: landing.daily(last, fund, report), ["trades"])
    return _trade_columns(reports.read_daily(v.spark, landing, last, "trades"))


@_register
def scan_backfill(v: Views) -> DataFrame:
    first, last = _span(v)
    landing = reports.Landing(_scratch(v))
    _land(v, lambda fund, report: landing.backfill(first, last, fund, report), ["delta_nav"])
    rows = reports.read_backfill(v.spark, landing, first, last, "delta_nav")
    return rows.drop("starting_value")


@_register
def scan_all_zones(v: Views) -> DataFrame:
    # The same reports in two zones: a reload keeps one copy of each row.
    first, last = _span(v)
    landing = reports.Landing(_scratch(v))
    _land(v, lambda fund, report: landing.daily(last, fund, report), ["trades"])
    _land(v, lambda fund, report: landing.backfill(first, last, fund, report), ["trades"])
    return _trade_columns(reports.read_all_zones(v.spark, landing, "trades"))


@_register
def reload_survivors(v: Views) -> DataFrame:
    # Three zones that know different fields: a full history, newer prices alone, newer commissions alone.
    first, last = _span(v)
    landing = reports.Landing(_scratch(v))
    some = F.length("TradeID") % 3
    with kept_while(_raw(v, "trades"), "raw") as raw:
        prices = raw.filter(some == 0).withColumns({"TradePrice": F.lit("12.5"), "IBCommission": F.lit("")})
        fees = raw.filter(some < 2).withColumns({"TradePrice": F.lit(""), "Quantity": F.lit(""), "IBCommission": F.lit("0.75")})
        reports.land_report(raw, f"{landing.root}/history-files/all/trades.csv", compressed=True)
        reports.land_report(prices, landing.backfill(first, last, "all", "trades"), compressed=True)
        reports.land_report(fees, landing.daily(last, "all", "trades"), compressed=True)
    rows = _trade_columns(reports.read_all_zones(v.spark, landing, "trades", by_field=True))
    return kept_in_shares(rows, "survivors", [ACCOUNT, "symbol", "trade_id"], SURVIVOR_SHARES)


@_register
def exact_totals(v: Views) -> DataFrame:
    # Prices that no binary fraction equals.
    paid = v["lineitem"].select(F.col("l_shipdate").cast("date").alias("date"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("paid"))
    return exact.exact_sums(paid, ["date"], ["paid"]).withColumn("paid", F.round("paid", 4))


@_register
def scan_mixed_layouts(v: Views) -> DataFrame:
    # Accounts' files as their sources write them: in order, turned round, and with columns of their own.
    root = _scratch(v)
    raw = _raw(v, "trades")
    for i, fund in enumerate(FUNDS):
        own = raw.filter(F.col("ClientAccountID") == fund)
        layout = [own, own.select(*reversed(own.columns)), own.select(F.lit('a "note", quoted').alias("Note"), "*")][i % 3]
        reports.land_report(layout, f"{root}/history-files/{fund}/trades.csv")
    rows = reports.read_report(v.spark, reports.Landing(root).zone_globs("trades")[0], "trades")
    return _trade_columns(rows)


@_register
def warehouse_sql(v: Views) -> DataFrame:
    warehouse = Warehouse(v.spark, f"{_scratch(v)}/core", grain="year")
    warehouse.merge("delta_nav", v["v_delta_nav"])
    return warehouse.sql(
        """SELECT date, count(*) AS accounts, sum(ending_value) AS ending_value FROM {delta_nav}
        WHERE date >= :first AND date <= :last GROUP BY date""",
        {"first": RANGE[0], "last": RANGE[1]},
    )


@_register
def list_source_files(v: Views) -> DataFrame:
    _, last = _span(v)
    landing = reports.Landing(_scratch(v))
    _land(v, lambda fund, report: landing.daily(last, fund, report), ["delta_nav"])
    listed = reports.list_source_files(v.spark, landing.root)
    folder = F.regexp_extract("path", r"daily-files/[^/]+/([^/]+)/", 1)
    return listed.groupBy(folder.alias("fund")).agg((F.sum("n_bytes") > 0).alias("has_bytes"))


@_register
def land_partitioned(v: Views) -> DataFrame:
    root = f"{_scratch(v)}/trades"
    keyed = _raw(v, "trades").withColumns(
        {"run_date": F.substring("ReportDate", 1, 6), "fund": F.col("ClientAccountID")}
    )
    reports.land_partitioned(keyed, root)
    rows = reports.read_csv(v.spark, root)
    return _trade_columns(cleaning.clean_trades(rows))


def _inputs(v: Views, landing: reports.Landing) -> jobs.Inputs:
    return jobs.Inputs(landing, v["v_holidays"], v["v_prices"], v["v_yields"], series=YIELD_SERIES)


def _returns_table(warehouse: Warehouse, table: str) -> DataFrame:
    return _rounded(warehouse.read(table), "return")


@_register
def run_reload(v: Views) -> DataFrame:
    first, last = _span(v)
    root = _scratch(v)
    landing = reports.Landing(f"{root}/landing")
    _land(v, lambda fund, report: f"{landing.root}/history-files/{fund}/{report}.csv")
    warehouse = Warehouse(v.spark, f"{root}/core", grain="year")
    jobs.run_reload(warehouse, _inputs(v, landing), last, start=first)
    return _rounded(_returns_table(warehouse, "holding_returns"), "weight")


@_register
def run_backfill(v: Views) -> DataFrame:
    first, last = _span(v)
    root = _scratch(v)
    landing = reports.Landing(f"{root}/landing")
    _land(v, lambda fund, report: landing.backfill(first, last, fund, report))
    warehouse = Warehouse(v.spark, f"{root}/core", grain="year")
    jobs.run_backfill(warehouse, _inputs(v, landing), first, last)
    return _returns_table(warehouse, "fund_returns")


@_register
def run_backfill_resumed(v: Views) -> DataFrame:
    # Chunks of four years; a first run does one of them, a second one goes on from there.
    first, last = _span(v)
    root = _scratch(v)
    landing = reports.Landing(f"{root}/landing")
    _land(v, lambda fund, report: landing.backfill(first, last, fund, report))
    warehouse = Warehouse(v.spark, f"{root}/core", grain="year")
    for most in (1, None):
        jobs.run_backfill_by_month(warehouse, _inputs(v, landing), first, last, months=48, most=most)
    return _returns_table(warehouse, "fund_returns")


@_register
def run_daily(v: Views) -> DataFrame:
    # A day's files may hold earlier days too; all are merged, the returns are the day's.
    root = _scratch(v)
    landing = reports.Landing(f"{root}/landing")
    warehouse = Warehouse(v.spark, f"{root}/core", grain="year")
    inputs = _inputs(v, landing)
    as_of = v["v_calendar"].agg(F.max("date").alias("last")).first()["last"] + dt.timedelta(days=1)
    day = jobs.last_session_before(v.spark, inputs, as_of)
    _land(v, lambda fund, report: landing.daily(day, fund, report))
    jobs.run_daily(warehouse, inputs, as_of)
    return _rounded(_returns_table(warehouse, "holding_returns"), "weight")

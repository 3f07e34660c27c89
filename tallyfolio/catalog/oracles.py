"""SQL answers to the registered queries, written against the same tables and run elsewhere."""

from __future__ import annotations

from tallyfolio.catalog.fixtures import with_views
from tallyfolio.catalog.queries import LATE_RANGE, RANGE, SUNDAY, YIELD_SERIES

_TRADE_COLUMNS = (
    "report_date, client_account_id, sub_category, symbol, trade_id, quantity, trade_price, ib_commission, buy_sell"
)


def _between(column: str, bounds) -> str:
    return f"{column} >= DATE '{bounds[0]}' AND {column} <= DATE '{bounds[1]}'"


# --- Cleaning ---------------------------------------------------------------------------------------

_HEADER_FREE = "FROM raw_trades WHERE ClientAccountID <> 'ClientAccountID'"
_DATE = "CAST(strptime({0}, '%Y%m%d') AS DATE)"

_INSTRUMENT = (
    "ClientAccountID AS client_account_id, AssetClass AS asset_class, SubCategory AS sub_category, "
    "Description AS description, CUSIP AS cusip, ISIN AS isin, Symbol AS symbol"
)


def _doubles(**columns: str) -> str:
    return ", ".join(f"CAST(nullif({raw}, '') AS DOUBLE) AS {name}" for name, raw in columns.items())


def _cleaning() -> dict[str, str]:
    trades = f"""SELECT {_DATE.format("ReportDate")} AS report_date, {_INSTRUMENT}, TradeID AS trade_id,
          {_doubles(quantity="Quantity", trade_price="TradePrice", ib_commission="IBCommission")},
          BuySell AS buy_sell
        {_HEADER_FREE} AND BuySell IN ('BUY', 'SELL')"""
    return {
        "clean_drop_headers": with_views(f"SELECT TradeID, ClientAccountID, Quantity {_HEADER_FREE}", "raw_trades"),
        "clean_rename": with_views(
            "SELECT TradeID AS trade_id, BuySell AS buy_sell, Quantity AS quantity FROM raw_trades", "raw_trades"
        ),
        "clean_parse_dates": with_views(
            f"SELECT TradeID AS trade_id, {_DATE.format('ReportDate')} AS report_date {_HEADER_FREE}", "raw_trades"
        ),
        "clean_empty_to_null": with_views(
            f"""SELECT ActionID AS action_id, {_DATE.format("nullif(ExDate, '')")} AS ex_date,
              {_DATE.format("nullif(PayDate, '')")} AS pay_date FROM raw_dividends""",
            "raw_dividends",
        ),
        "clean_positions": with_views(
            f"""SELECT {_DATE.format("ReportDate")} AS report_date, {_INSTRUMENT},
              {_doubles(mark_price="MarkPrice", quantity="Quantity", fx_rate_to_base="FXRateToBase")}
            FROM raw_positions WHERE ClientAccountID <> 'ClientAccountID'""",
            "raw_positions",
        ),
        "clean_trades": with_views(trades, "raw_trades"),
        "scan_csv_report": with_views(trades, "raw_trades"),
        "clean_dividends": with_views(
            f"""SELECT {_DATE.format("ReportDate")} AS report_date, {_INSTRUMENT}, ActionID AS action_id,
              {_DATE.format("nullif(ExDate, '')")} AS ex_date, {_DATE.format("nullif(PayDate, '')")} AS pay_date,
              {_doubles(quantity="Quantity", gross_rate="GrossRate", gross_amount="GrossAmount", tax="Tax",
                        fee="Fee", net_amount="NetAmount")}
            FROM raw_dividends WHERE ClientAccountID <> 'ClientAccountID' AND ExDate = ReportDate""",
            "raw_dividends",
        ),
        "clean_delta_nav": with_views(
            f"""SELECT {_DATE.format("ToDate")} AS date, ClientAccountID AS client_account_id,
              {_doubles(starting_value="StartingValue", ending_value="EndingValue",
                        deposits_withdrawals="DepositsWithdrawals", dividends="Dividends")}
            FROM raw_delta_nav WHERE ClientAccountID <> 'ClientAccountID' AND FromDate = ToDate""",
            "raw_delta_nav",
        ),
        "filter_asset_scope": with_views(
            """SELECT report_date, client_account_id, symbol, trade_id, sub_category FROM v_trades
            WHERE sub_category = 'ETF' OR sub_category = 'COMMON' OR sub_category = 'ADR'""",
            "v_trades",
        ),
        "filter_date_range": with_views(
            f"SELECT * FROM v_trades WHERE {_between('report_date', RANGE)}", "v_trades"
        ),
        "union_partials": with_views(
            """SELECT report_date, client_account_id, symbol, net AS quantity FROM v_traded_days
            UNION ALL SELECT report_date, client_account_id, symbol, quantity FROM v_positions""",
            "v_traded_days",
            "v_positions",
        ),
        "reload_union_distinct": with_views("SELECT * FROM v_trades", "v_trades"),
    }


# --- Accounts -----------------------------------------------------------------------------------------

# The session before is sought by joining, not by a lag.
_NAV = """SELECT a.date, a.client_account_id, a.ending_value, a.deposits_withdrawals, a.dividends,
      coalesce(b.ending_value, a.ending_value) AS starting_value
    FROM v_delta_nav a ASOF LEFT JOIN
      (SELECT date, client_account_id, ending_value FROM v_delta_nav WHERE date IN (SELECT date FROM v_calendar)) b
      ON a.client_account_id = b.client_account_id AND a.date > b.date
    WHERE a.date IN (SELECT date FROM v_calendar)"""
_RETURN = "round((ending_value - deposits_withdrawals) / nullif(starting_value, 0) - 1, 8)"


def _accounts() -> dict[str, str]:
    def per_account(where: str = "", view: str = "v_delta_nav") -> str:
        select = f"""SELECT date, client_account_id, ending_value - deposits_withdrawals AS value,
          {_RETURN} AS "return", dividends FROM nav {where}"""
        return with_views(select, view, "v_calendar", nav=_NAV.replace("v_delta_nav", view))

    def overall(where: str = "") -> str:
        sums = """SELECT date, sum(starting_value) AS starting_value, sum(ending_value) AS ending_value,
          sum(deposits_withdrawals) AS deposits_withdrawals, sum(dividends) AS dividends FROM nav GROUP BY date"""
        select = f"""SELECT date, ending_value - deposits_withdrawals AS value, {_RETURN} AS "return", dividends
          FROM per_day {where}"""
        return with_views(select, "v_delta_nav", "v_calendar", nav=_NAV, per_day=sums)

    late = f"WHERE {_between('date', LATE_RANGE)}"
    return {
        "nav_on_sessions": with_views(
            """SELECT date, client_account_id, ending_value, deposits_withdrawals, dividends
            FROM v_delta_nav WHERE date IN (SELECT date FROM v_calendar)""",
            "v_delta_nav",
            "v_calendar",
        ),
        "nav_lag": with_views("SELECT * FROM nav", "v_delta_nav", "v_calendar", nav=_NAV),
        "fund_returns": per_account(),
        "account_returns_repair": per_account(),
        "fund_returns_range": per_account(f"WHERE {_between('date', RANGE)}"),
        "fund_returns_incremental": per_account(late),
        "fund_returns_wide": per_account(view="w_delta_nav"),
        "fund_returns_wide_latest": per_account(late, "w_delta_nav"),
        "all_fund_returns": overall(),
        "all_fund_returns_incremental": overall(late),
    }


# --- Holdings -------------------------------------------------------------------------------------------


_NARROW = ("v_positions_held", "v_dividends", "v_trades")
_WIDE = ("w_positions", "w_dividends", "w_trades")


class _HoldingSql:
    """The steps of the holding returns as named queries, joins spelled out."""

    def __init__(self, trade_scope: str = "'ETF', 'COMMON', 'ATR'", within: str = "TRUE", wide: bool = False):
        positions, dividends, trades = _WIDE if wide else _NARROW
        self.views = (positions, dividends, trades)
        held_scope = f"sub_category IN ('ETF', 'COMMON', 'ADR') AND {within}"
        self.steps = {
            "held": f"""SELECT report_date, client_account_id, symbol, quantity, mark_price, fx_rate_to_base
                FROM {positions} WHERE {held_scope}""",
            "paid": f"""SELECT report_date, client_account_id, symbol, sum(net_amount) AS cash, sum(gross_rate) AS rate
                FROM {dividends} WHERE {held_scope} GROUP BY ALL""",
            "dealt": f"""SELECT report_date, client_account_id, symbol, net, notional / net AS vwap FROM (
                  SELECT report_date, client_account_id, symbol, sum(quantity) AS net,
                    sum(quantity * trade_price) AS notional
                  FROM {trades} WHERE sub_category IN ({trade_scope}) AND {within} GROUP BY ALL)
                WHERE net <> 0""",
            "joined": """SELECT report_date, client_account_id, symbol, fx_rate_to_base AS fx_rate_1,
                  quantity AS shares_1, mark_price AS price_1, coalesce(cash, 0) AS dividends,
                  coalesce(rate, 0) AS dividends_per_share, coalesce(net, 0) AS shares_traded,
                  coalesce(vwap, 0) AS average_trade_price
                FROM held FULL JOIN dealt USING (report_date, client_account_id, symbol)
                  LEFT JOIN paid USING (report_date, client_account_id, symbol)""",
            "earlier": """SELECT *, lag(fx_rate_1) OVER h AS fx_before, lag(shares_1) OVER h AS shares_before,
                  lag(price_1) OVER h AS price_before
                FROM joined WINDOW h AS (PARTITION BY client_account_id, symbol ORDER BY report_date)""",
            "lagged": """SELECT report_date, client_account_id, symbol, dividends, dividends_per_share,
                  shares_traded, average_trade_price,
                  coalesce(fx_before, fx_rate_1) AS fx_rate_0, coalesce(shares_before, shares_1) AS shares_0,
                  coalesce(price_before, price_1) AS price_0, coalesce(fx_rate_1, 0) AS fx_rate_1,
                  coalesce(shares_1, 0) AS shares_1, coalesce(price_1, average_trade_price) AS price_1
                FROM earlier""",
            # One kind per row, then one value per kind. A row without shares or trades is "idle".
            "classified": """SELECT *, fx_rate_0 * average_trade_price AS dealt_at, fx_rate_0 * price_0 AS worth_before,
                  fx_rate_1 * price_1 AS worth_now,
                  CASE WHEN shares_1 = 0 AND shares_traded = 0 THEN 'idle' WHEN shares_1 = shares_traded THEN 'entry'
                    WHEN shares_1 = 0 THEN 'exit' ELSE 'held' END AS kind
                FROM lagged""",
            "adjusted": """SELECT report_date, client_account_id, symbol, shares_0, shares_1, shares_traded,
                  average_trade_price, dividends, dividends_per_share,
                  CASE kind WHEN 'held' THEN shares_1 - shares_traded WHEN 'exit' THEN shares_0 ELSE shares_1 END
                    AS shares_1_adj,
                  CASE WHEN kind IN ('entry', 'idle') THEN dealt_at ELSE worth_before END AS price_0,
                  CASE WHEN kind IN ('exit', 'idle') THEN dealt_at ELSE worth_now END AS price_1
                FROM classified""",
            "weighed": """SELECT adjusted.*, round(shares_1 * price_1 / nullif(sum(shares_1 * price_1)
                  OVER (PARTITION BY client_account_id, report_date), 0), 8) AS weight
                FROM adjusted""",
            "rated": """SELECT report_date AS date, client_account_id, symbol AS ticker, weight,
                  if(shares_1 = 0, shares_0, shares_1) AS shares, price_1 AS price,
                  if(shares_1 = 0, shares_0, shares_1) * price_1 AS value, shares_traded, average_trade_price,
                  round((shares_1_adj * price_1 + dividends) / nullif(shares_0 * price_0, 0) - 1, 8) AS "return",
                  dividends, dividends_per_share
                FROM weighed WHERE report_date IN (SELECT date FROM v_calendar)""",
        }

    def sql(self, select: str, upto: str) -> str:
        names = list(self.steps)
        used = {name: self.steps[name] for name in names[: names.index(upto) + 1]}
        return with_views(select, *self.views, "v_calendar", **used)


def _holdings() -> dict[str, str]:
    full = _HoldingSql()
    confined = _HoldingSql(within=_between("report_date", RANGE))
    aligned = _HoldingSql(trade_scope="'ETF', 'COMMON', 'ADR'")
    wide = _HoldingSql(wide=True)
    late = f"SELECT * FROM rated WHERE {_between('date', LATE_RANGE)}"
    keys = "report_date, client_account_id, symbol"
    weights = full.sql(f"SELECT {keys}, weight FROM weighed", "weighed")
    return {
        "position_side": full.sql(
            f"""SELECT {keys}, fx_rate_to_base AS fx_rate_1, quantity AS shares_1, mark_price AS price_1,
              CAST(if(quantity > 0, 1, -1) AS INTEGER) AS side FROM held""",
            "held",
        ),
        "position_side_filled": full.sql(
            f"""SELECT {keys}, CAST(CASE WHEN shares_1 > 0 THEN 1 WHEN shares_1 <= 0 THEN -1
              ELSE -sign(shares_traded) END AS DOUBLE) AS side FROM joined""",
            "joined",
        ),
        "dividends_by_holding": full.sql(
            f"SELECT {keys}, cash AS dividends, rate AS dividends_per_share FROM paid", "paid"
        ),
        "trade_vwap": full.sql(
            f"SELECT {keys}, net AS shares_traded, vwap AS average_trade_price FROM dealt", "dealt"
        ),
        "holding_keys": full.sql(f"SELECT {keys} FROM held UNION SELECT {keys} FROM dealt", "dealt"),
        "holding_base_merge": full.sql("SELECT * FROM joined", "joined"),
        "holding_lag": full.sql("SELECT * FROM lagged", "lagged"),
        "holding_adjustments": full.sql("SELECT * FROM adjusted", "adjusted"),
        "holding_weights": weights,
        "holding_weights_joined": weights,
        "account_values": full.sql(
            """SELECT client_account_id, report_date, sum(quantity * (mark_price * fx_rate_to_base)) AS account_value
            FROM held GROUP BY ALL""",
            "held",
        ),
        "holding_returns": full.sql("SELECT * FROM rated", "rated"),
        "holding_returns_window_weights": full.sql("SELECT * FROM rated", "rated"),
        "holding_returns_range": full.sql(f"SELECT * FROM rated WHERE {_between('date', RANGE)}", "rated"),
        "holding_returns_literal_range": confined.sql("SELECT * FROM rated", "rated"),
        "holding_returns_incremental": full.sql(late, "rated"),
        "holding_returns_wide": wide.sql("SELECT * FROM rated", "rated"),
        "holding_returns_wide_latest": wide.sql(late, "rated"),
        "holding_returns_consistent_scope": aligned.sql("SELECT * FROM rated", "rated"),
        "returns_upsert": full.sql("SELECT * FROM rated", "rated"),
        "stream_holding_returns": full.sql("SELECT * FROM rated", "rated"),
        "returns_repair": full.sql("SELECT * FROM rated", "rated"),
    }


# --- Series and sessions ----------------------------------------------------------------------------------


_OWN_YIELDS = """SELECT date, series_id, y, 100.0 / (1 + y * 29 / 360) / (100.0 / (1 + before * 30 / 360)) - 1 AS r
    FROM (SELECT date, series_id, yield / 100 AS y,
        lag(yield / 100) OVER (PARTITION BY series_id ORDER BY date) AS before FROM v_yields)"""
_BENCHMARK = """SELECT date, ticker, adjusted_close, round(adjusted_close / before - 1, 8) AS "return",
      dividends_per_share
    FROM (SELECT *, lag(adjusted_close) OVER (PARTITION BY ticker ORDER BY date) AS before FROM v_prices)
    WHERE before IS NOT NULL"""


def _next_value(value: str, table: str, name: str) -> str:
    """The next value at or after a row, by joining instead of by a fill."""
    return f"""SELECT a.date, a.series_id, b.{value} AS {name} FROM {table} a
      ASOF LEFT JOIN (SELECT * FROM {table} WHERE {value} IS NOT NULL) b
      ON a.series_id = b.series_id AND a.date <= b.date"""


def _series() -> dict[str, str]:
    rates = f"SELECT date, series_id, round(r, 8) AS \"return\" FROM ({_next_value('r', 'own', 'r')})"
    return {
        "prices_wide_to_long": with_views(
            "SELECT date, ticker, adjusted_close, dividends_per_share FROM v_prices", "v_prices"
        ),
        "clean_prices": with_views(
            """SELECT CAST(Date AS DATE) AS date, Ticker AS ticker, nullif(Close, 'NaN'::DOUBLE) AS adjusted_close,
              Dividends AS dividends_per_share FROM raw_prices""",
            "raw_prices",
        ),
        "clean_yields": with_views("SELECT date, series_id, yield FROM v_yields", "v_yields"),
        "benchmark_return": with_views(_BENCHMARK, "v_prices"),
        "yield_lag": with_views(
            """SELECT date, series_id, yield, lag(yield) OVER (PARTITION BY series_id ORDER BY date) AS yield_lag
            FROM v_yields""",
            "v_yields",
        ),
        "daily_yield": with_views(
            f"""SELECT date, series_id, round(yield / 100 / 360, 8) AS daily_yield
            FROM ({_next_value("yield", "v_yields", "yield")})""",
            "v_yields",
        ),
        "backfill_nulls": with_views(_next_value("yield", "v_yields", "yield"), "v_yields"),
        "risk_free_return": with_views(rates, "v_yields", own=_OWN_YIELDS),
        "risk_free_return_range": with_views(f"{rates} WHERE {_between('date', RANGE)}", "v_yields", own=_OWN_YIELDS),
        "trading_days": with_views(
            """SELECT date FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE)
              AS date FROM v_order_days)
            WHERE isodow(date) < 6 AND date NOT IN (SELECT date FROM v_holidays)""",
            "v_order_days",
            "v_holidays",
        ),
        "last_market_date": with_views(
            f"SELECT max(date) AS date FROM v_calendar WHERE date <= DATE '{SUNDAY}'", "v_calendar"
        ),
        "prev_session": with_views(
            """SELECT a.date, max(b.date) AS previous_date FROM v_calendar a LEFT JOIN v_calendar b
            ON b.date < a.date AND b.date >= a.date - 30 GROUP BY a.date""",
            "v_calendar",
        ),
        "monthly_intervals": with_views(
            f"""SELECT CAST(date_trunc('month', date) AS DATE) AS month, min(date) AS from_date, max(date) AS to_date
            FROM v_calendar GROUP BY 1""",
            "v_calendar",
        ),
    }


# --- Merge, files, runs -------------------------------------------------------------------------------------


# Core tables: where their rows come from here, columns those have, columns that stay empty.
_STORED = {
    "positions": (
        "v_positions_held",
        "report_date date, client_account_id string, sub_category string, symbol string, mark_price double, "
        "quantity double, fx_rate_to_base double",
        "asset_class string, description string, cusip string, isin string",
    ),
    "trades": (
        "v_trades",
        "report_date date, client_account_id string, sub_category string, symbol string, trade_id string, "
        "quantity double, trade_price double, ib_commission double, buy_sell string",
        "asset_class string, description string, cusip string, isin string",
    ),
    "dividends": (
        "v_dividends",
        "report_date date, client_account_id string, sub_category string, symbol string, action_id string, "
        "quantity double, gross_rate double, gross_amount double, tax double, fee double, net_amount double",
        "asset_class string, description string, cusip string, isin string, ex_date date, pay_date date",
    ),
    "delta_nav": (
        "v_delta_nav",
        "date date, client_account_id string, ending_value double, deposits_withdrawals double, dividends double",
        "starting_value double",
    ),
    "calendar": ("v_calendar", "date date", ""),
    "benchmark": (
        "priced",
        "date date, ticker string, adjusted_close double, return double, dividends_per_share double",
        "",
    ),
    "risk_free_rate": ("rates", "date date, return double", ""),
    "holding_returns": (
        "rated",
        "date date, client_account_id string, ticker string, weight double, shares double, price double, value double, "
        "shares_traded double, average_trade_price double, return double, dividends double, dividends_per_share double",
        "",
    ),
    "fund_returns": (
        "accounts",
        "date date, client_account_id string, value double, return double, dividends double",
        "",
    ),
    "all_fund_returns": ("overall", "date date, value double, return double, dividends double", ""),
}


def _core_schemas() -> str:
    def line(table: str, column: str, n_values: str) -> str:
        name, kind = column.split()
        return f"""SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS column_type,
          {n_values.format(name)} AS n_values FROM {_STORED[table][0]}"""

    lines = [
        line(table, column, n_values)
        for table, (_, filled, empty) in _STORED.items()
        for columns, n_values in ((filled, 'count("{}")'), (empty, "count(NULL)"))
        for column in columns.split(", ")
        if column
    ]
    steps = {
        "nav": _NAV,
        **_HoldingSql().steps,
        "accounts": f"""SELECT date, client_account_id, ending_value - deposits_withdrawals AS value,
          {_RETURN} AS "return", dividends FROM nav""",
        "overall": """SELECT date, sum(value) AS value, sum("return") AS "return", sum(dividends) AS dividends
          FROM accounts GROUP BY date""",
        "priced": _BENCHMARK,
        "own": _OWN_YIELDS,
        "rates": f"""SELECT date, r AS "return" FROM ({_next_value('r', 'own', 'r')}) WHERE series_id = '{YIELD_SERIES}'""",
    }
    views = ["v_positions_held", "v_trades", "v_dividends", "v_delta_nav", "v_calendar", "v_prices", "v_yields"]
    return with_views("\nUNION ALL ".join(lines), *views, **steps)


def _merges() -> dict[str, str]:
    key = "report_date, client_account_id, symbol"
    core = f"SELECT {key}, mark_price, quantity FROM v_positions"
    stage = f"SELECT {key}, mark_price, net AS quantity FROM v_traded_days"

    def merged(core: str, stage: str, mark_price: str, quantity: str) -> str:
        """One full join; the expressions pick between core (c) and stage (s)."""
        return with_views(
            f"""SELECT {key}, {mark_price} AS mark_price, {quantity} AS quantity
            FROM core c FULL JOIN stage s USING ({key})""",
            "v_positions",
            "v_traded_days",
            "v_trades",
            core=core,
            stage=stage,
        )

    from_stage = ("coalesce(s.mark_price, c.mark_price)", "coalesce(s.quantity, c.quantity)")
    from_core = ("coalesce(c.mark_price, s.mark_price)", "coalesce(c.quantity, s.quantity)")
    last_trade = f"""SELECT {key}, arg_max(trade_price, trade_id) AS mark_price, arg_max(quantity, trade_id) AS quantity
        FROM v_trades GROUP BY {key}"""
    unpriced = f"SELECT {key}, CASE WHEN quantity > 0 THEN mark_price END AS mark_price, quantity FROM v_positions"
    trades = with_views(f"SELECT {_TRADE_COLUMNS} FROM v_trades", "v_trades")
    return {
        "upsert_update": merged(core, stage, *from_stage),
        "rerun_idempotent": merged(core, stage, *from_stage),
        "upsert_published": merged(core, stage, *from_stage),
        "upsert_update_latest": merged(core, last_trade, *from_stage),
        "upsert_ignore": merged(core, stage, *from_core),
        "upsert_fill": merged(unpriced, stage, *from_core),
        "upsert_trades": with_views(f"SELECT {key}, trade_id, quantity, trade_price FROM v_trades", "v_trades"),
        "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
            GROUP BY l_orderkey, l_linenumber
            HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
        "core_schemas": _core_schemas(),
        "upsert_wide": with_views(
            f"""SELECT {key}, coalesce(s.mark_price, c.mark_price) AS mark_price, coalesce(s.net, c.quantity) AS quantity
            FROM w_positions c FULL JOIN w_traded_days s USING ({key})""",
            "w_positions",
            "w_traded_days",
        ),
        "scan_daily": trades,
        "scan_all_zones": trades,
        "scan_mixed_layouts": trades,
        "reload_survivors": with_views(
            f"""SELECT {_TRADE_COLUMNS.replace("trade_price", "CASE WHEN third = 0 THEN 12.5 ELSE trade_price END AS trade_price")
              .replace("ib_commission", "CASE WHEN third < 2 THEN 0.75 ELSE ib_commission END AS ib_commission")}
            FROM (SELECT *, length(trade_id) % 3 AS third FROM v_trades)""",
            "v_trades",
        ),
        "exact_totals": """SELECT CAST(l_shipdate AS DATE) AS date, round(fsum(l_extendedprice * (1 - l_discount)), 4) AS paid
            FROM lineitem GROUP BY ALL""",
        "session_as_of": with_views(
            """SELECT event_id, c.date AS session
            FROM (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN TIMESTAMP '2024-01-06 12:00:00' ELSE ts END AS at FROM events) e
            ASOF LEFT JOIN v_event_sessions c ON e.at >= c.date""",
            "v_event_sessions",
        ),
        "warehouse_sql": with_views(
            f"""SELECT date, count(*) AS accounts, sum(ending_value) AS ending_value FROM v_delta_nav
            WHERE {_between("date", RANGE)} GROUP BY date""",
            "v_delta_nav",
        ),
        "land_partitioned": trades,
        "scan_backfill": with_views(
            """SELECT date, client_account_id, ending_value, deposits_withdrawals, dividends
            FROM v_delta_nav""",
            "v_delta_nav",
        ),
        "list_source_files": with_views(
            "SELECT DISTINCT client_account_id AS fund, TRUE AS has_bytes FROM v_delta_nav", "v_delta_nav"
        ),
    }


def _runs() -> dict[str, str]:
    # A loaded calendar follows the exchange rules: weekdays without holidays, order or no order.
    calendar = """SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT date FROM v_order_days UNION ALL SELECT report_date FROM v_trades)"""
    open_days = f"""SELECT date FROM ({calendar}) WHERE isodow(date) < 6 AND date NOT IN (SELECT date FROM v_holidays)"""
    nav = _NAV.replace("v_calendar", "open_days")
    rated = {name: text.replace("v_calendar", "open_days") for name, text in _HoldingSql().steps.items()}
    backfill = with_views(
        f"""SELECT date, client_account_id, ending_value - deposits_withdrawals AS value, {_RETURN} AS "return",
          dividends FROM nav""",
        "v_delta_nav",
        "v_trades",
        "v_holidays",
        open_days=open_days,
        nav=nav,
    )
    return {
        "run_backfill": backfill,
        "run_backfill_resumed": backfill,
        "run_reload": with_views(
            "SELECT * FROM rated",
            "v_positions_held",
            "v_dividends",
            "v_trades",
            "v_holidays",
            open_days=open_days,
            **rated,
        ),
        # The calendar holds the one session loaded; the lag reads every row landed.
        "run_daily": _HoldingSql().sql(
            "SELECT * FROM rated WHERE date = (SELECT max(date) FROM v_calendar)", "rated"
        ),
    }


def all_oracles() -> dict[str, str]:
    return {**_cleaning(), **_accounts(), **_holdings(), **_series(), **_merges(), **_runs()}

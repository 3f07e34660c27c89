"""The shared test tables seen as brokerage reports and market series.

One SQL text per view serves Spark and the checking engine; ``{name}`` stands for a table or
another view. Numbers are whole or dyadic, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

FUNDS = ("U0", "U1", "U2", "U3")
"""All accounts of the ``v_`` views, which take them modulo 4."""


def _compact(date: str) -> str:
    """A date as yyyyMMdd text, in terms both engines have."""
    parts = f"EXTRACT(YEAR FROM {date}) * 10000 + EXTRACT(MONTH FROM {date}) * 100 + EXTRACT(DAY FROM {date})"
    return f"CAST({parts} AS STRING)"


_SHIPPED = "CAST(l_shipdate AS DATE)"
_ORDERED = "CAST(o_orderdate AS DATE)"
_LINE_SCOPE = (
    "CASE l_partkey % 5 WHEN 0 THEN 'ETF' WHEN 1 THEN 'COMMON' WHEN 2 THEN 'ADR' WHEN 3 THEN 'ATR' ELSE 'BOND' END"
)
_ORDER_SCOPE = (
    "CASE o_orderkey % 5 WHEN 0 THEN 'ETF' WHEN 1 THEN 'COMMON' WHEN 2 THEN 'ADR' WHEN 3 THEN 'ATR' ELSE 'BOND' END"
)
_CUSTOMER = "CASE WHEN o_custkey % 3 = 0 THEN 'U0' ELSE concat('U', o_custkey) END"
_LINE_ID = "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"

VIEWS = {
    # key (report_date, client_account_id, symbol, trade_id)
    "v_trades": f"""
        SELECT {_SHIPPED} AS report_date, concat('U', l_suppkey % 4) AS client_account_id,
          {_LINE_SCOPE} AS sub_category, concat('S', l_partkey % 10) AS symbol, {_LINE_ID} AS trade_id,
          CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS quantity,
          CAST(FLOOR(l_extendedprice / 100) + 1 AS DOUBLE) AS trade_price, l_tax AS ib_commission,
          CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS buy_sell
        FROM {{lineitem}}""",
    # key (report_date, client_account_id, symbol)
    "v_positions": f"""
        SELECT {_ORDERED} AS report_date, concat('U', o_custkey % 4) AS client_account_id,
          {_ORDER_SCOPE} AS sub_category, concat('S', o_orderkey % 10) AS symbol,
          CAST(MAX(FLOOR(o_totalprice / 100) + 1) AS DOUBLE) AS mark_price,
          MAX(CAST(CASE WHEN o_custkey % 9 = 0 THEN -(o_orderkey % 50) - 1 ELSE o_orderkey % 50 + 1 END AS DOUBLE))
            AS quantity,
          MAX(CASE o_orderkey % 4 WHEN 0 THEN CAST(0.5 AS DOUBLE) WHEN 1 THEN CAST(1.25 AS DOUBLE)
            ELSE CAST(1 AS DOUBLE) END) AS fx_rate_to_base
        FROM {{orders}}
        GROUP BY {_ORDERED}, concat('U', o_custkey % 4), o_orderkey % 5, concat('S', o_orderkey % 10)""",
    # Running holdings of the traded symbols, with gaps so that exits occur; plus v_positions on
    # the days without trades. Key (report_date, client_account_id, symbol).
    "v_positions_held": """
        SELECT report_date, client_account_id, sub_category, symbol, mark_price, quantity,
          CAST(1 AS DOUBLE) AS fx_rate_to_base
        FROM (
          SELECT report_date, client_account_id, sub_category, symbol, mark_price,
            SUM(net) OVER (PARTITION BY client_account_id, symbol ORDER BY report_date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS quantity
          FROM {v_traded_days}) running
        WHERE quantity % 6 <> 0
        UNION ALL
        SELECT p.report_date, p.client_account_id, p.sub_category, p.symbol, p.mark_price, p.quantity,
          p.fx_rate_to_base
        FROM {v_positions} p LEFT JOIN {v_traded_days} n ON p.report_date = n.report_date
          AND p.client_account_id = n.client_account_id AND p.symbol = n.symbol
        WHERE n.symbol IS NULL""",
    # key (report_date, client_account_id, symbol)
    "v_traded_days": """
        SELECT report_date, client_account_id, sub_category, symbol, SUM(quantity) AS net,
          MAX(trade_price) AS mark_price
        FROM {v_trades} GROUP BY report_date, client_account_id, sub_category, symbol""",
    # key (report_date, client_account_id, symbol, action_id)
    "v_dividends": f"""
        SELECT {_SHIPPED} AS report_date, concat('U', l_suppkey % 4) AS client_account_id,
          {_LINE_SCOPE} AS sub_category, concat('S', l_partkey % 10) AS symbol, {_LINE_ID} AS action_id,
          l_quantity AS quantity, CAST(0.25 AS DOUBLE) AS gross_rate, l_quantity * 0.25 AS gross_amount,
          CAST(0 AS DOUBLE) AS tax, CAST(0 AS DOUBLE) AS fee, l_quantity * 0.25 AS net_amount
        FROM {{lineitem}} WHERE l_linenumber = 1""",
    # key (date, client_account_id)
    "v_delta_nav": f"""
        SELECT {_ORDERED} AS date, concat('U', o_custkey % 4) AS client_account_id,
          CAST(1000000 + SUM(FLOOR(o_totalprice)) AS DOUBLE) AS ending_value,
          CAST(SUM(CASE WHEN o_orderkey % 10 = 0 THEN FLOOR(o_totalprice / 10)
            WHEN o_orderkey % 10 = 1 THEN -FLOOR(o_totalprice / 10) ELSE 0 END) AS DOUBLE) AS deposits_withdrawals,
          CAST(SUM(FLOOR(o_totalprice / 1000)) AS DOUBLE) AS dividends
        FROM {{orders}} GROUP BY {_ORDERED}, concat('U', o_custkey % 4)""",
    # The same at the grain that grows: an account per customer, a symbol per part, and one account
    # with a third of all customers. Key (report_date, client_account_id, symbol, trade_id).
    "w_trades": f"""
        SELECT {_SHIPPED} AS report_date, {_CUSTOMER} AS client_account_id, {_LINE_SCOPE} AS sub_category,
          concat('S', l_partkey) AS symbol, {_LINE_ID} AS trade_id,
          CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS quantity,
          CAST(FLOOR(l_extendedprice / 100) + 1 AS DOUBLE) AS trade_price
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    # key (report_date, client_account_id, symbol)
    "w_traded_days": """
        SELECT report_date, client_account_id, sub_category, symbol, SUM(quantity) AS net,
          MAX(trade_price) AS mark_price
        FROM {w_trades} GROUP BY report_date, client_account_id, sub_category, symbol""",
    # key (report_date, client_account_id, symbol)
    "w_positions": """
        SELECT report_date, client_account_id, sub_category, symbol, mark_price, quantity,
          CAST(1 AS DOUBLE) AS fx_rate_to_base
        FROM (
          SELECT report_date, client_account_id, sub_category, symbol, mark_price,
            SUM(net) OVER (PARTITION BY client_account_id, symbol ORDER BY report_date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS quantity
          FROM {w_traded_days}) running
        WHERE quantity % 6 <> 0""",
    # key (report_date, client_account_id, symbol, action_id)
    "w_dividends": f"""
        SELECT {_SHIPPED} AS report_date, {_CUSTOMER} AS client_account_id, {_LINE_SCOPE} AS sub_category,
          concat('S', l_partkey) AS symbol, {_LINE_ID} AS action_id, CAST(0.25 AS DOUBLE) AS gross_rate,
          l_quantity * 0.25 AS net_amount
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey WHERE l_linenumber = 1""",
    # key (date, client_account_id)
    "w_delta_nav": f"""
        SELECT {_ORDERED} AS date, {_CUSTOMER} AS client_account_id,
          CAST(1000000 + SUM(FLOOR(o_totalprice)) AS DOUBLE) AS ending_value,
          CAST(SUM(CASE WHEN o_orderkey % 10 = 0 THEN FLOOR(o_totalprice / 10) ELSE 0 END) AS DOUBLE)
            AS deposits_withdrawals,
          CAST(SUM(FLOOR(o_totalprice / 1000)) AS DOUBLE) AS dividends
        FROM {{orders}} GROUP BY {_ORDERED}, {_CUSTOMER}""",
    # Yields and prices as a source delivers them: timestamps, NaN for gaps, other columns.
    "raw_yields": """
        SELECT CAST(date AS TIMESTAMP) AS date, series_id, coalesce(yield, CAST('NaN' AS DOUBLE)) AS yield,
          'percent' AS unit
        FROM {v_yields}""",
    "raw_prices": """
        SELECT CAST(date AS TIMESTAMP) AS Date, ticker AS Ticker,
          CASE WHEN dividends_per_share > 0 THEN CAST('NaN' AS DOUBLE) ELSE adjusted_close END AS Close,
          dividends_per_share AS Dividends, 0 AS Volume
        FROM {v_prices}""",
    # key (date, ticker)
    "v_prices": """
        SELECT CAST(ts AS DATE) AS date, event_type AS ticker,
          CAST(COUNT(*) * 100 + MAX(event_id) % 97 AS DOUBLE) AS adjusted_close,
          CASE WHEN MAX(event_id) % 5 = 0 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
            AS dividends_per_share
        FROM {events} GROUP BY CAST(ts AS DATE), event_type""",
    # key (date, series_id); percent, with gaps
    "v_yields": f"""
        SELECT {_ORDERED} AS date, o_orderpriority AS series_id,
          CASE WHEN EXTRACT(DAY FROM {_ORDERED}) % 7 = 0 THEN NULL
            ELSE CAST(1 AS DOUBLE) + CAST(SUM(o_orderkey) % 400 AS DOUBLE) / 100 END AS yield
        FROM {{orders}} GROUP BY {_ORDERED}, o_orderpriority""",
    "v_order_days": f"SELECT DISTINCT {_ORDERED} AS date FROM {{orders}}",
    # The exchange's days: order days that are no weekend. 1970-01-05 was a Monday.
    "v_calendar": """
        SELECT date FROM {v_order_days} WHERE datediff_days(date) % 7 < 5""",
    # Sessions among the days of events.
    "v_event_sessions": """
        SELECT date FROM (SELECT DISTINCT CAST(ts AS DATE) AS date FROM {events}) days
        WHERE datediff_days(date) % 7 < 5""",
    "v_holidays": """
        SELECT date FROM {v_order_days}
        WHERE EXTRACT(MONTH FROM date) * 100 + EXTRACT(DAY FROM date) IN (101, 704, 1225)""",
    # Raw report texts, with header lines inside the data.
    "raw_trades": f"""
        SELECT CASE WHEN is_header THEN 'ReportDate' ELSE {_compact(_SHIPPED)} END AS ReportDate,
          CASE WHEN is_header THEN 'ClientAccountID' ELSE concat('U', l_suppkey % 4) END AS ClientAccountID,
          'STK' AS AssetClass, {_LINE_SCOPE} AS SubCategory, concat('Part ', l_partkey) AS Description,
          lpad(CAST(l_partkey AS STRING), 9, '0') AS CUSIP, concat('XX', l_partkey) AS ISIN,
          concat('S', l_partkey % 10) AS Symbol, {_LINE_ID} AS TradeID,
          CASE WHEN is_header THEN 'Quantity' ELSE CAST(l_quantity AS STRING) END AS Quantity,
          CAST(l_extendedprice AS STRING) AS TradePrice, CAST(l_tax AS STRING) AS IBCommission,
          CASE l_returnflag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'BUY' ELSE 'BUY (Ca.)' END AS BuySell,
          l_linestatus AS Extra
        FROM (SELECT *, l_linenumber = 7 AND l_suppkey % 10 = 0 AS is_header FROM {{lineitem}}) marked""",
    "raw_positions": f"""
        SELECT CASE WHEN is_header THEN 'ReportDate' ELSE {_compact(_ORDERED)} END AS ReportDate,
          CASE WHEN is_header THEN 'ClientAccountID' ELSE concat('U', o_custkey % 4) END AS ClientAccountID,
          'STK' AS AssetClass, {_ORDER_SCOPE} AS SubCategory, concat('Order ', o_orderkey) AS Description,
          lpad(CAST(o_orderkey AS STRING), 9, '0') AS CUSIP, concat('XX', o_orderkey) AS ISIN,
          concat('S', o_orderkey) AS Symbol,
          CASE WHEN is_header THEN 'MarkPrice' ELSE CAST(o_totalprice AS STRING) END AS MarkPrice,
          CAST(o_custkey % 50 AS STRING) AS Quantity,
          CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '1.25' END AS FXRateToBase, o_orderstatus AS Extra
        FROM (SELECT *, o_custkey % 97 = 0 AS is_header FROM {{orders}}) marked""",
    "raw_dividends": f"""
        SELECT {_compact(_SHIPPED)} AS ReportDate,
          CASE WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN 'ClientAccountID'
            ELSE concat('U', l_suppkey % 4) END AS ClientAccountID,
          'STK' AS AssetClass, {_LINE_SCOPE} AS SubCategory, concat('Part ', l_partkey) AS Description,
          lpad(CAST(l_partkey AS STRING), 9, '0') AS CUSIP, concat('XX', l_partkey) AS ISIN,
          concat('S', l_partkey % 10) AS Symbol, {_LINE_ID} AS ActionID,
          CASE l_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN {_compact(_SHIPPED)}
            ELSE {_compact(f"({_SHIPPED} - 7)")} END AS ExDate,
          CASE WHEN l_partkey % 2 = 0 THEN '' ELSE {_compact(f"({_SHIPPED} + 14)")} END AS PayDate,
          CAST(l_quantity AS STRING) AS Quantity, '0.25' AS GrossRate,
          CAST(l_quantity * 0.25 AS STRING) AS GrossAmount, CAST(l_tax AS STRING) AS Tax, '0' AS Fee,
          CAST(l_quantity * 0.25 AS STRING) AS NetAmount
        FROM {{lineitem}}""",
    "raw_delta_nav": f"""
        SELECT CASE WHEN o_orderkey % 5 = 0 THEN {_compact(f"({_ORDERED} - 27)")} ELSE {_compact(_ORDERED)} END
            AS FromDate,
          {_compact(_ORDERED)} AS ToDate,
          CASE WHEN o_custkey % 97 = 0 THEN 'ClientAccountID' ELSE concat('U', o_custkey) END AS ClientAccountID,
          CAST(o_totalprice AS STRING) AS StartingValue, CAST(o_totalprice + 1 AS STRING) AS EndingValue,
          '0' AS DepositsWithdrawals, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '2.5' END AS Dividends
        FROM {{orders}}""",
}

_MONDAY = {"spark": "datediff(date, DATE '1970-01-05')", "check": "(date - DATE '1970-01-05')"}


def _text(view: str, dialect: str) -> str:
    return VIEWS[view].replace("datediff_days(date)", _MONDAY[dialect])


@cache
def _inputs(view: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(name for _, name, _, _ in Formatter().parse(VIEWS[view]) if name))


class Views:
    """The tables of one folder, and the views over them as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in VIEWS:
                frames = {dep: self[dep] for dep in _inputs(name)}
                self._built[name] = self.spark.sql(_text(name, "spark"), **frames)
            else:
                self._built[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._built[name]

    def raw_trades(self) -> DataFrame:
        return self["raw_trades"].withColumnRenamed("BuySell", "Buy/Sell")

    def tickers(self) -> list[str]:
        """The tickers of ``v_prices``, one per event type."""
        return sorted(row["ticker"] for row in self["v_prices"].select("ticker").distinct().collect())

    def wide_prices(self) -> DataFrame:
        """``v_prices`` as a price source delivers it: one column per field and ticker."""
        cells = {"Close": "adjusted_close", "Dividends": "dividends_per_share"}
        return self["v_prices"].groupBy("date").agg(
            *[
                F.max(F.when(F.col("ticker") == ticker, F.col(column))).alias(f"{field}|{ticker}")
                for field, column in cells.items()
                for ticker in self.tickers()
            ]
        )


def with_views(select: str, *names: str, **extra: str) -> str:
    """``select`` under a WITH clause of the named views and what they need."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name in VIEWS and name not in ordered:
            needed = _inputs(name)
            for other in needed:
                add(other)
            ordered[name] = _text(name, "check").format(**{n: n for n in needed})

    for name in names:
        add(name)
    ordered.update(extra)
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in ordered.items())
    return f"WITH {ctes}\n{select}" if ctes else select


def view_names() -> Iterable[str]:
    return VIEWS.keys()

"""Core table shapes, keys and the fixed value lists the returns rules depend on."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: they must equal the source system's for right results ---------------------

# Instrument sub-categories that count as holdings. The trade list really has ATR where the
# position list has ADR; ``plans.holdings.Scope`` lets a caller align them.
POSITION_SCOPE = ("ETF", "COMMON", "ADR")
TRADE_SCOPE = ("ETF", "COMMON", "ATR")

# Trade rows that are true executions; cancellations and corrections carry other texts.
EXECUTIONS = ("BUY", "SELL")

# Reports landed for every fund.
REPORTS = ("delta_nav", "dividends", "positions", "trades")

# First day of a full reload.
HISTORY_START = dt.date(2020, 1, 1)

# Raw report column -> core column. Raw files may hold more columns; these are the ones kept.
REPORT_COLUMNS = {
    "positions": {
        "ReportDate": "report_date",
        "ClientAccountID": "client_account_id",
        "AssetClass": "asset_class",
        "SubCategory": "sub_category",
        "Description": "description",
        "CUSIP": "cusip",
        "ISIN": "isin",
        "Symbol": "symbol",
        "MarkPrice": "mark_price",
        "Quantity": "quantity",
        "FXRateToBase": "fx_rate_to_base",
    },
    "trades": {
        "ReportDate": "report_date",
        "ClientAccountID": "client_account_id",
        "AssetClass": "asset_class",
        "SubCategory": "sub_category",
        "Description": "description",
        "CUSIP": "cusip",
        "ISIN": "isin",
        "Symbol": "symbol",
        "TradeID": "trade_id",
        "Quantity": "quantity",
        "TradePrice": "trade_price",
        "IBCommission": "ib_commission",
        "Buy/Sell": "buy_sell",
    },
    "dividends": {
        "ReportDate": "report_date",
        "ClientAccountID": "client_account_id",
        "AssetClass": "asset_class",
        "SubCategory": "sub_category",
        "Description": "description",
        "CUSIP": "cusip",
        "ISIN": "isin",
        "Symbol": "symbol",
        "ActionID": "action_id",
        "ExDate": "ex_date",
        "PayDate": "pay_date",
        "Quantity": "quantity",
        "GrossRate": "gross_rate",
        "GrossAmount": "gross_amount",
        "Tax": "tax",
        "Fee": "fee",
        "NetAmount": "net_amount",
    },
    "delta_nav": {
        "FromDate": "from_date",
        "ToDate": "to_date",
        "ClientAccountID": "client_account_id",
        "StartingValue": "starting_value",
        "EndingValue": "ending_value",
        "DepositsWithdrawals": "deposits_withdrawals",
        "Dividends": "dividends",
    },
}

# Columns of the core tables with their types.
CORE_COLUMNS = {
    "positions": [
        ("report_date", "date"),
        ("client_account_id", "string"),
        ("asset_class", "string"),
        ("sub_category", "string"),
        ("description", "string"),
        ("cusip", "string"),
        ("isin", "string"),
        ("symbol", "string"),
        ("mark_price", "double"),
        ("quantity", "double"),
        ("fx_rate_to_base", "double"),
    ],
    "trades": [
        ("report_date", "date"),
        ("client_account_id", "string"),
        ("asset_class", "string"),
        ("sub_category", "string"),
        ("description", "string"),
        ("cusip", "string"),
        ("isin", "string"),
        ("symbol", "string"),
        ("trade_id", "string"),
        ("quantity", "double"),
        ("trade_price", "double"),
        ("ib_commission", "double"),
        ("buy_sell", "string"),
    ],
    "dividends": [
        ("report_date", "date"),
        ("client_account_id", "string"),
        ("asset_class", "string"),
        ("sub_category", "string"),
        ("description", "string"),
        ("cusip", "string"),
        ("isin", "string"),
        ("symbol", "string"),
        ("action_id", "string"),
        ("ex_date", "date"),
        ("pay_date", "date"),
        ("quantity", "double"),
        ("gross_rate", "double"),
        ("gross_amount", "double"),
        ("tax", "double"),
        ("fee", "double"),
        ("net_amount", "double"),
    ],
    "delta_nav": [
        ("date", "date"),
        ("client_account_id", "string"),
        ("starting_value", "double"),
        ("ending_value", "double"),
        ("deposits_withdrawals", "double"),
        ("dividends", "double"),
    ],
    "calendar": [
        ("date", "date"),
    ],
    "benchmark": [
        ("date", "date"),
        ("ticker", "string"),
        ("adjusted_close", "double"),
        ("return", "double"),
        ("dividends_per_share", "double"),
    ],
    "risk_free_rate": [
        ("date", "date"),
        ("return", "double"),
    ],
    "holding_returns": [
        ("date", "date"),
        ("client_account_id", "string"),
        ("ticker", "string"),
        ("weight", "double"),
        ("shares", "double"),
        ("price", "double"),
        ("value", "double"),
        ("shares_traded", "double"),
        ("average_trade_price", "double"),
        ("return", "double"),
        ("dividends", "double"),
        ("dividends_per_share", "double"),
    ],
    "fund_returns": [
        ("date", "date"),
        ("client_account_id", "string"),
        ("value", "double"),
        ("return", "double"),
        ("dividends", "double"),
    ],
    "all_fund_returns": [
        ("date", "date"),
        ("value", "double"),
        ("return", "double"),
        ("dividends", "double"),
    ],
}

# --- End of fixed values ---------------------------------------------------------------------

ACCOUNT = "client_account_id"

# Share counts are compared for exact equality (entry and exit tests), so they are summed as
# decimals. NET leaves Spark enough integer digits to subtract without dropping scale.
SHARES = T.DecimalType(28, 8)
NET_SHARES = T.DecimalType(30, 8)


@dataclass(frozen=True)
class CoreTable:
    """A core table: primary key, the date column it is laid out by and how finely.

    ``grain`` is the partition width on disk: one partition per day for tables with rows per
    account, per year for the short series (a day each would be a file per row).
    """

    name: str
    key: tuple[str, ...]
    date: str
    grain: str = "day"

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in CORE_COLUMNS[self.name]))

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]


CORE_TABLES = {
    table.name: table
    for table in (
        CoreTable("positions", ("report_date", ACCOUNT, "symbol"), "report_date"),
        CoreTable("trades", ("report_date", ACCOUNT, "symbol", "trade_id"), "report_date"),
        CoreTable("dividends", ("report_date", ACCOUNT, "symbol", "action_id"), "report_date"),
        CoreTable("delta_nav", ("date", ACCOUNT), "date"),
        CoreTable("calendar", ("date",), "date", "year"),
        CoreTable("benchmark", ("date", "ticker"), "date", "year"),
        CoreTable("risk_free_rate", ("date",), "date", "year"),
        CoreTable("holding_returns", ("date", ACCOUNT, "ticker"), "date"),
        CoreTable("fund_returns", ("date", ACCOUNT), "date"),
        CoreTable("all_fund_returns", ("date",), "date", "year"),
    )
}

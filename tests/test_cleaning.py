from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException

from tallyfolio.operators import cleaning
from tallyfolio.sources import reports
from tallyfolio.sources.reports import Landing

JAN2 = dt.date(2024, 1, 2)

POSITIONS = """ClientAccountID,ReportDate,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,MarkPrice,Quantity,FXRateToBase,Extra
U0,20240102,STK,ETF,Fund A,037833100,US0378331005,S0,100,10,1,x
ClientAccountID,ReportDate,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,MarkPrice,Quantity,FXRateToBase,Extra
U1,20240102,STK,COMMON,Fund B,012345678,US0123456789,S1,50,4,0.5,x
"""

TRADES = """ClientAccountID,ReportDate,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,TradeID,Quantity,TradePrice,IBCommission,Buy/Sell
U0,20240102,STK,ETF,Fund A,1,1,S0,T1,10,98,-1,BUY
U0,20240102,STK,ETF,Fund A,1,1,S0,T2,-4,99,-1,SELL
U0,not a date,STK,ETF,Fund A,1,1,S0,T3,x,99,-1,BUY (Ca.)
U0,20240102,STK,ETF,Fund A,1,1,S0,T4,1,99,-1,
"""

DIVIDENDS = """ClientAccountID,ReportDate,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,ActionID,ExDate,PayDate,Quantity,GrossRate,GrossAmount,Tax,Fee,NetAmount
U0,20240102,STK,ETF,Fund A,1,1,S0,A1,20240102,20240110,10,0.5,5,-0.5,0,4.5
U0,20240102,STK,ETF,Fund A,1,1,S0,A2,20231229,20240110,10,0.5,5,-0.5,0,4.5
"U0","20240102","STK","ETF","Fund A","1","1","S0","A3","","","10","0.5","5","","0","4.5"
"U0","20240102","STK","ETF","Fund A","1","1","S0","A4","20240102","","10","0.5","5","","0","4.5"
"""

NAV = """ClientAccountID,FromDate,ToDate,StartingValue,EndingValue,DepositsWithdrawals,Dividends
U0,20240102,20240102,100,110,5,
U0,20231201,20240102,bad,110,5,1
"""


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_positions_keep_leading_zeros_and_drop_inner_headers(spark, tmp_path):
    path = _write(tmp_path / "positions.csv", POSITIONS)
    df = reports.read_report(spark, path, "positions")
    got = {r["symbol"]: r for r in df.collect()}
    assert set(got) == {"S0", "S1"}
    assert got["S0"]["cusip"] == "037833100"
    assert got["S1"]["report_date"] == JAN2 and got["S1"]["fx_rate_to_base"] == 0.5
    assert "Extra" not in df.columns


def test_trades_keep_executions_only(spark, tmp_path):
    df = reports.read_report(spark, _write(tmp_path / "trades.csv", TRADES), "trades")
    # T3 would not even parse.
    assert {r["trade_id"] for r in df.collect()} == {"T1", "T2"}


def test_dividends_on_ex_date(spark, tmp_path):
    df = reports.read_report(spark, _write(tmp_path / "dividends.csv", DIVIDENDS), "dividends")
    got = {r["action_id"]: r for r in df.collect()}
    assert set(got) == {"A1", "A4"}
    assert got["A4"]["pay_date"] is None and got["A4"]["tax"] is None


def test_delta_nav_single_days(spark, tmp_path):
    got = reports.read_report(spark, _write(tmp_path / "delta_nav.csv", NAV), "delta_nav").collect()
    assert [(r["date"], r["ending_value"], r["dividends"]) for r in got] == [(JAN2, 110, None)]


@pytest.mark.parametrize("bad", [("20240102", "2024-01-02"), (",100,10,", ",100,ten,"), ("20240102", "20240199")])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_values_fail_the_batch(spark, tmp_path, bad, ansi):
    path = _write(tmp_path / "positions.csv", POSITIONS.replace(*bad))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            reports.read_report(spark, path, "positions").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_missing_column_fails(spark):
    df = spark.createDataFrame([("U0", "20240102")], "ClientAccountID string, ReportDate string")
    with pytest.raises(PySparkException):
        cleaning.clean_positions(df)


def test_dates_given_as_integers(spark):
    df = spark.createDataFrame([(20240102,)], "d int")
    assert cleaning.parse_dates(df, "d").first()["d"] == JAN2


def _reordered(text):
    """The same report with its columns in reverse."""
    return "\n".join(",".join(reversed(line.split(","))) for line in text.splitlines()) + "\n"


def test_other_header_fails_unless_layouts_are_told_apart(spark, tmp_path):
    _write(tmp_path / "a" / "positions.csv", POSITIONS)
    _write(tmp_path / "b" / "positions.csv", _reordered(POSITIONS).replace("U0", "U2").replace("U1", "U3"))
    glob = f"{tmp_path}/*/positions.csv"
    with pytest.raises(Exception, match="header does not conform"):
        reports.read_report(spark, glob, "positions", mixed_layouts=False).collect()
    mixed = reports.read_report(spark, glob, "positions")
    got = {(r["client_account_id"], r["symbol"], r["cusip"], r["quantity"]) for r in mixed.collect()}
    assert got == {
        ("U0", "S0", "037833100", 10.0),
        ("U1", "S1", "012345678", 4.0),
        ("U2", "S0", "037833100", 10.0),
        ("U3", "S1", "012345678", 4.0),
    }


def test_zones(spark, tmp_path):
    landing = Landing(str(tmp_path))
    end = dt.date(2024, 1, 31)
    with pytest.raises(ValueError):
        reports.read_all_zones(spark, landing, "positions")
    _write(tmp_path / "history-files" / "x" / "old-positions-2023.csv", POSITIONS)
    assert reports.read_all_zones(spark, landing, "positions").count() == 2
    _write(tmp_path / landing.backfill(JAN2, end, "f", "positions").removeprefix(f"{tmp_path}/"), POSITIONS)
    _write(
        tmp_path / landing.daily(JAN2, "f", "positions").removeprefix(f"{tmp_path}/"),
        POSITIONS.replace("S1,50", "S1,51"),
    )
    os.utime(landing.daily(JAN2, "f", "positions"), (2_000_000_000, 2_000_000_000))
    assert reports.read_daily(spark, landing, JAN2, "positions").count() == 2
    assert reports.read_backfill(spark, landing, JAN2, end, "positions").count() == 2
    # Whole rows are compared: S1 is there at both prices.
    assert reports.read_all_zones(spark, landing, "positions").count() == 3
    newest = reports.read_all_zones(spark, landing, "positions", newest_only=True)
    assert {(r["symbol"], r["mark_price"]) for r in newest.collect()} == {("S0", 100.0), ("S1", 51.0)}
    assert "file_time" not in newest.columns
    listed = reports.list_source_files(spark, str(tmp_path)).collect()
    assert len(listed) == 3 and all(r["n_bytes"] > 0 for r in listed)


def test_land_and_read_back(spark, tmp_path):
    landing = Landing(str(tmp_path / "zone"))
    raw = reports.read_csv(spark, _write(tmp_path / "positions.csv", POSITIONS))
    path = landing.daily(JAN2, "f", "positions")
    reports.land_report(raw, path)
    reports.land_report(raw, path)  # replaces, does not add
    assert reports.read_daily(spark, landing, JAN2, "positions").count() == 2


def test_land_partitioned_replaces_only_its_folders(spark, tmp_path):
    root = str(tmp_path / "landed")
    df = spark.createDataFrame(
        [("2024-01-02", "f", "1"), ("2024-01-02", "g", "2"), ("2024-01-03", "f", "3")],
        "run_date string, fund string, v string",
    )
    reports.land_partitioned(df, root)
    reports.land_partitioned(df.filter("fund = 'g'").withColumn("v", df.v + 40), root)
    got = {(str(r["run_date"]), r["fund"], float(r["v"])) for r in reports.read_csv(spark, root).collect()}
    assert got == {("2024-01-02", "f", 1.0), ("2024-01-02", "g", 42.0), ("2024-01-03", "f", 3.0)}

"""Tables and run modes, on small landing zones."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tallyfolio import jobs
from tallyfolio.plans.holdings import Scope
from tallyfolio.sources import reports
from tallyfolio.sources.reports import Landing
from tallyfolio.sources.tables import Warehouse

# Tuesday to Friday, with New Year before them.
SESSIONS = [dt.date(2024, 1, n) for n in (2, 3, 4, 5)]

SHARED = "STK,{kind},Fund,037833100,US,{symbol}"
HEADERS = {
    "positions": "ReportDate,ClientAccountID,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,MarkPrice,Quantity,FXRateToBase",
    "trades": "ReportDate,ClientAccountID,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,TradeID,Quantity,TradePrice,IBCommission,Buy/Sell",
    "dividends": "ReportDate,ClientAccountID,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,ActionID,ExDate,PayDate,Quantity,GrossRate,GrossAmount,Tax,Fee,NetAmount",
    "delta_nav": "FromDate,ToDate,ClientAccountID,StartingValue,EndingValue,DepositsWithdrawals,Dividends",
}
INSTRUMENT = "STK,ETF,Fund,037833100,US,S0"
BODIES = {
    "positions": {
        2: f"20240102,U0,{INSTRUMENT},100,10,1",
        3: f"20240103,U0,{INSTRUMENT},110,10,1",
        4: f"20240104,U0,{INSTRUMENT},120,6,1",
    },
    "trades": {
        2: f"20240102,U0,{INSTRUMENT},T1,10,98,-1,BUY",
        4: f"20240104,U0,{INSTRUMENT},T2,-4,115,-1,SELL",
        5: f"20240105,U0,{INSTRUMENT},T3,-6,130,-1,SELL",
    },
    "dividends": {3: f"20240103,U0,{INSTRUMENT},A1,20240103,20240110,10,0.5,5,0,0,5"},
    "delta_nav": {
        2: "20240102,20240102,U0,0,1000,1000,0",
        3: "20240103,20240103,U0,1000,1105,0,5",
        4: "20240104,20240104,U0,1105,1200,0,0",
        5: "20240105,20240105,U0,1200,1260,0,0",
    },
}
RETURNS = {2: 1000 / 980 - 1, 3: 1105 / 1000 - 1, 4: 1200 / 1100 - 1, 5: 780 / 720 - 1}


def _put(path: str, report: str, days) -> None:
    from pathlib import Path

    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    body = [BODIES[report][d] for d in days if d in BODIES[report]]
    file.write_text("\n".join([HEADERS[report], *body]) + "\n")


@pytest.fixture
def setting(spark, tmp_path):
    landing = Landing(str(tmp_path / "landing"))
    prices = spark.createDataFrame(
        [(d, "IDX", 100.0 + 10 * i, 0.0) for i, d in enumerate(SESSIONS)],
        "date date, ticker string, adjusted_close double, dividends_per_share double",
    )
    yields = spark.createDataFrame(
        [(d, s, y) for d in SESSIONS for s, y in (("DGS10", 4.0), ("OTHER", 1.0))],
        "date date, series_id string, yield double",
    )
    holidays = spark.createDataFrame([(dt.date(2024, 1, 1),)], "date date")
    return Warehouse(spark, str(tmp_path / "core")), jobs.Inputs(landing, holidays, prices, yields)


def _land_day(landing: Landing, n: int) -> None:
    for report in reports.CLEANERS:
        _put(landing.daily(dt.date(2024, 1, n), "fund", report), report, [n])


def _returns(warehouse):
    return {r["date"].day: r["return"] for r in warehouse.read("holding_returns").collect()}


def test_daily_runs_add_up_to_a_reload(setting, spark, tmp_path):
    warehouse, inputs = setting
    for n in (2, 3, 4, 5):
        _land_day(inputs.landing, n)
        # The day after; for Friday the Monday after, which steps over the weekend.
        as_of = dt.date(2024, 1, n + 1 if n < 5 else 8)
        assert jobs.run_daily(warehouse, inputs, as_of) == dt.date(2024, 1, n)
    assert _returns(warehouse) == {n: pytest.approx(r) for n, r in RETURNS.items()}
    assert sorted(r["date"].day for r in warehouse.read("calendar").collect()) == [2, 3, 4, 5]
    bench = {r["date"].day: r["return"] for r in warehouse.read("benchmark").collect()}
    assert bench == {3: pytest.approx(0.1), 4: pytest.approx(120 / 110 - 1), 5: pytest.approx(130 / 120 - 1)}
    assert warehouse.read("risk_free_rate").count() == 4

    before = {t: sorted(map(tuple, warehouse.read(t).collect()), key=repr) for t in ("holding_returns", "fund_returns")}
    jobs.run_daily(warehouse, inputs, dt.date(2024, 1, 7))  # a Sunday repeats Friday
    after = {t: sorted(map(tuple, warehouse.read(t).collect()), key=repr) for t in before}
    assert before == after

    reloaded = Warehouse(spark, str(tmp_path / "again"))
    jobs.run_reload(reloaded, inputs, dt.date(2024, 1, 8))
    for table in ("positions", "trades", "dividends", "delta_nav", "holding_returns", "fund_returns", "all_fund_returns"):
        old, new = warehouse.read(table), reloaded.read(table)
        assert old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty(), table


def test_daily_runs_read_no_history(setting, spark, tmp_path):
    warehouse, inputs = setting
    scans, write = [], warehouse.merge
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # whole paths and filters in plans

    def merge(table, batch, **options):
        if table in ("holding_returns", "fund_returns"):
            scans.append((table, batch._jdf.queryExecution().executedPlan().toString()))
        write(table, batch, **options)

    warehouse.merge = merge
    for n in (2, 3, 4, 5):
        _land_day(inputs.landing, n)
        if n == 4:  # a holding that opens has no row to be found
            with open(inputs.landing.daily(dt.date(2024, 1, 4), "fund", "positions"), "a") as file:
                file.write("20240104,U0,STK,ETF,Fund,037833100,US,NEW,50,2,1\n")
        scans.clear()
        jobs.run_daily(warehouse, inputs, dt.date(2024, 1, n + 1))
        lower = f">= {dt.date(2024, 1, n)}"
        for table, plan in scans:
            tables = ("positions", "trades") if table == "holding_returns" else ("delta_nav",)
            found = [x for x in plan.splitlines() if "FileScan" in x and any(f"/core/{t}/" in x for t in tables)]
            assert found and all(lower in line for line in found), plan
    assert _returns_of(warehouse, "S0") == {n: pytest.approx(r) for n, r in RETURNS.items()}
    assert _returns_of(warehouse, "NEW") == {4: 0}


def _returns_of(warehouse, ticker):
    rows = warehouse.read("holding_returns").filter(f"ticker = '{ticker}'").collect()
    return {r["date"].day: r["return"] for r in rows}


def test_late_reports_make_latest_rows_stale(setting, spark, tmp_path):
    warehouse, inputs = setting
    for n in (2, 4, 5):
        _land_day(inputs.landing, n)
        jobs.run_daily(warehouse, inputs, dt.date(2024, 1, n + 1))
    assert warehouse._latest_days("accounts")[-1] == SESSIONS[3]
    # the third's reports come late: what is known of the fourth and the fifth no longer holds
    start, end = SESSIONS[1], SESSIONS[3]
    for report in reports.CLEANERS:
        _put(inputs.landing.backfill(start, end, "fund", report), report, [3])
    jobs.run_backfill(warehouse, inputs, start, end)
    assert _returns(warehouse) == {n: pytest.approx(r) for n, r in RETURNS.items()}
    plain = Warehouse(spark, str(tmp_path / "plain"))
    jobs.run_reload(plain, inputs, dt.date(2024, 1, 8), options=jobs.Options(keep_latest=False))
    for table in ("holding_returns", "fund_returns"):
        old, new = warehouse.read(table), plain.read(table)
        assert old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty(), table


def test_backfill(setting):
    warehouse, inputs = setting
    start, end = dt.date(2024, 1, 3), dt.date(2024, 1, 5)
    for report in reports.CLEANERS:
        _put(inputs.landing.backfill(start, end, "fund", report), report, [2, 3, 4, 5])
    jobs.run_backfill(warehouse, inputs, start, end)
    # The second's rows are loaded and looked back at, but are not in the range.
    assert _returns(warehouse) == {n: pytest.approx(RETURNS[n]) for n in (3, 4, 5)}
    # Prices end the day before the range does, and the first has nothing to compare with.
    assert [r["date"].day for r in warehouse.read("benchmark").collect()] == [4]


def test_confined_runs_lose_the_predecessor(setting):
    warehouse, inputs = setting
    for n in (2, 3):
        _land_day(inputs.landing, n)
        jobs.run_daily(warehouse, inputs, dt.date(2024, 1, n + 1), jobs.Options(look_back=False, scope=Scope()))
    assert _returns(warehouse)[3] == pytest.approx(1105 / 1100 - 1)


def test_merge_rewrites_only_touched_partitions(setting, spark, tmp_path):
    warehouse, _ = setting
    schema = "date date, client_account_id string, value double, return double, dividends double"
    first = [(SESSIONS[0], "U0", 1.0, 0.0, 0.0), (SESSIONS[1], "U0", 2.0, 0.0, 0.0), (SESSIONS[1], "U1", 3.0, 0.0, 0.0)]
    warehouse.merge("fund_returns", spark.createDataFrame(first, schema))
    untouched = sorted((tmp_path / "core" / "fund_returns").glob(f"date={SESSIONS[0]}/*.parquet"))
    warehouse.merge("fund_returns", spark.createDataFrame([(SESSIONS[1], "U0", 9.0, 0.0, 0.0)], schema))
    assert sorted((tmp_path / "core" / "fund_returns").glob(f"date={SESSIONS[0]}/*.parquet")) == untouched
    got = {(r["date"], r["client_account_id"]): r["value"] for r in warehouse.read("fund_returns").collect()}
    assert got == {(SESSIONS[0], "U0"): 1, (SESSIONS[1], "U0"): 9, (SESSIONS[1], "U1"): 3}
    over = "SELECT client_account_id, sum(value) AS v FROM {fund_returns} WHERE value < :top GROUP BY ALL"
    assert {tuple(r) for r in warehouse.sql(over, {"top": 5}).collect()} == {("U0", 1.0), ("U1", 3.0)}
    plan = warehouse.read("fund_returns", SESSIONS[1], SESSIONS[1])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_failed_merge_leaves_the_table(setting, spark):
    warehouse, _ = setting
    schema = "date date, value double, return double, dividends double"
    warehouse.merge("all_fund_returns", spark.createDataFrame([(SESSIONS[0], 1.0, 0.0, 0.0)], schema))
    twice = [(SESSIONS[0], 5.0, 0.0, 0.0), (SESSIONS[0], 6.0, 0.0, 0.0)]
    with pytest.raises(PySparkException, match="duplicate key"):
        warehouse.merge("all_fund_returns", spark.createDataFrame(twice, schema))
    with pytest.raises(ValueError):
        warehouse.merge("all_fund_returns", spark.createDataFrame([(None, 5.0, 0.0, 0.0)], schema))
    assert [r["value"] for r in warehouse.read("all_fund_returns").collect()] == [1.0]


def test_risk_free_modes(setting, spark):
    warehouse, _ = setting
    batch = lambda value: spark.createDataFrame([(SESSIONS[0], value)], "date date, return double")
    warehouse.merge("risk_free_rate", batch(None), mode="ignore")
    warehouse.merge("risk_free_rate", batch(0.5), mode="ignore")
    assert warehouse.read("risk_free_rate").first()["return"] is None
    warehouse.merge("risk_free_rate", batch(0.5), mode="fill")
    warehouse.merge("risk_free_rate", batch(0.7), mode="fill")
    assert warehouse.read("risk_free_rate").first()["return"] == 0.5


def test_backfill_window():
    today = dt.date(2026, 12, 1)
    assert jobs.earliest_backfill(today) == dt.date(2026, 1, 1)
    assert jobs.earliest_backfill(dt.date(2026, 5, 20)) == dt.date(2025, 6, 1)
    assert jobs.backfill_window(today) == (dt.date(2026, 1, 1), dt.date(2026, 11, 30))
    assert jobs.backfill_window(today, "2026-02-03", "2026-03-04") == (dt.date(2026, 2, 3), dt.date(2026, 3, 4))
    for bounds in (("2025-12-31", "2026-03-04"), ("2026-02-03", "2026-12-01"), ("2026-02-03", None)):
        with pytest.raises(ValueError):
            jobs.backfill_window(today, *bounds)


def test_pick_up_takes_new_files_once(setting, spark, tmp_path):
    from tallyfolio.streaming.pickup import pick_up

    warehouse, inputs = setting
    taken = []
    merge = warehouse.merge
    warehouse.merge = lambda table, batch, **options: (taken.append(batch.count()), merge(table, batch, **options))

    def run() -> None:
        pick_up(warehouse, inputs.landing, "positions", checkpoint=str(tmp_path / "ckpt")).awaitTermination()

    _land_day(inputs.landing, 2)
    run()
    _land_day(inputs.landing, 3)
    run()
    run()
    assert taken == [1, 1]
    assert sorted(r["report_date"].day for r in warehouse.read("positions").collect()) == [2, 3]


def test_backfill_by_month_resumes_where_it_ended(setting, spark, tmp_path, monkeypatch):
    inputs = setting[1]
    warehouse = Warehouse(spark, str(tmp_path / "months"), grain="month")
    start, end = dt.date(2023, 12, 28), dt.date(2024, 2, 2)
    days = [d for d in (start + dt.timedelta(days=n) for n in range(37)) if d.weekday() < 5]
    for report in reports.CLEANERS:
        lines = [HEADERS[report]]
        for i, d in enumerate(days):
            x = f"{d:%Y%m%d}"
            lines.append({
                "positions": f"{x},U0,{INSTRUMENT},{100 + i % 7},10,1", "trades": f"{x},U0,{INSTRUMENT},T{i},{i % 3 - 1},98,-1,BUY",
                "dividends": f"{x},U0,{INSTRUMENT},A{i},{x},,10,0.5,5,0,0,{i % 2}", "delta_nav": f"{x},{x},U0,0,{1000 + i},0,0",
            }[report])
        path = inputs.landing.backfill(start, end, "fund", report)
        _put(path, report, [])
        with open(path, "w") as file:
            file.write("\n".join(lines) + "\n")
    compute, runs = jobs.materialize_returns, []

    def third_fails(house, first, last, options):
        runs.append(first)
        if len(runs) == 3:
            raise RuntimeError("lost")
        compute(house, first, last, options)

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "materialize_returns", third_fails)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.run_backfill_by_month(warehouse, inputs, start, end)
    assert jobs.run_backfill_by_month(warehouse, inputs, start, end) == [dt.date(2024, 2, 1)]
    assert jobs.run_backfill_by_month(warehouse, inputs, start, end) == []
    whole = Warehouse(spark, str(tmp_path / "whole"), grain="month")
    jobs.run_backfill(whole, inputs, start, end)
    for table in ("positions", "trades", "delta_nav", "holding_returns", "fund_returns", "all_fund_returns", "calendar"):
        old, new = warehouse.read(table), whole.read(table)
        assert not old.isEmpty() and old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty(), table

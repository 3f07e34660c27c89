"""Plans keep the shape they were designed with: few shuffles, filters and columns at the scan."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from tallyfolio.operators import merge
from tallyfolio.plans import funds, holdings
from tallyfolio.schemas import CORE_TABLES

DAY = dt.date(2024, 1, 5)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")

    def table(name):
        spark.createDataFrame([], CORE_TABLES[name].schema).write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    return {name: table(name) for name in ("positions", "dividends", "trades", "calendar", "delta_nav")}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^0-9]*?), \d+\)", re.sub(r"#\d+L?", "", plan))


def test_merge_and_lag_share_one_shuffle_by_holding(stored):
    merged = holdings.holding_base_merge(stored["positions"], stored["dividends"], stored["trades"])
    plan = _plan(holdings.holding_lag(merged))
    by_key = "client_account_id, report_date, symbol"
    assert sorted(_shuffles(plan)) == sorted([by_key, by_key, "client_account_id, symbol"])
    assert "Join" not in plan


def test_holding_scan_reads_and_filters_little(stored):
    plan = _plan(holdings.trade_vwap(stored["trades"]))
    read = re.sub(r"#\d+L?", "", re.search(r"FileScan parquet \[(.*?)\]", plan).group(1))
    assert read == "report_date,client_account_id,sub_category,symbol,quantity,trade_price"
    assert "In(sub_category" in plan
    # A partial aggregation runs before the shuffle.
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_account_returns_shuffle_once(stored):
    plan = _plan(funds.fund_returns(stored["delta_nav"], stored["calendar"], end=DAY))
    assert [s for s in _shuffles(plan) if s != "date"] == ["client_account_id"]
    assert "BroadcastHashJoin" in plan
    assert f"LessThanOrEqual(date,{DAY})" in plan


def test_key_check_moves_keys_only(stored):
    rows = merge.require_keys(stored["trades"], CORE_TABLES["trades"].key)
    # The rows pass from scan to output; the shuffle is inside the subquery.
    main = _plan(rows).split("Subquery")[0]
    assert "Exchange" not in main


def test_fills_and_lags_share_one_sort(spark, stored):
    from tallyfolio.plans.series import risk_free_return

    yields = spark.createDataFrame([], "date date, series_id string, yield double")
    plan = _plan(risk_free_return(yields.repartition(4)))
    assert plan.count("Sort [") == 1

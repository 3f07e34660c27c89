"""Returns worked out by hand, and properties they must keep."""

from __future__ import annotations

import datetime as dt

import pytest

from tallyfolio.catalog.fixtures import Views
from tallyfolio.plans import funds, holdings
from tallyfolio.plans.series import benchmark_return, risk_free_return

SF = "/root/testdata/sf0.001"

POSITIONS = "report_date date, client_account_id string, sub_category string, symbol string, mark_price double, quantity double, fx_rate_to_base double"
TRADES = "report_date date, client_account_id string, sub_category string, symbol string, quantity double, trade_price double"
DIVIDENDS = "report_date date, client_account_id string, sub_category string, symbol string, net_amount double, gross_rate double"


def _calendar(spark, days):
    return spark.createDataFrame([(d,) for d in days], "date date")


@pytest.fixture
def lifecycle(spark, day):
    """A holding that is opened, held, trimmed and closed on four sessions."""
    positions = spark.createDataFrame(
        [
            (day(1), "U0", "ETF", "S0", 100.0, 10.0, 1.0),
            (day(2), "U0", "ETF", "S0", 110.0, 10.0, 1.0),
            (day(3), "U0", "ETF", "S0", 120.0, 6.0, 1.0),
        ],
        POSITIONS,
    )
    trades = spark.createDataFrame(
        [
            (day(1), "U0", "ETF", "S0", 10.0, 98.0),
            (day(3), "U0", "ETF", "S0", -4.0, 115.0),
            (day(4), "U0", "ETF", "S0", -6.0, 130.0),
        ],
        TRADES,
    )
    dividends = spark.createDataFrame([(day(2), "U0", "ETF", "S0", 5.0, 0.5)], DIVIDENDS)
    return positions, dividends, trades, _calendar(spark, [day(n) for n in range(1, 5)])


def _by_day(df, *columns):
    return {r["date"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("window_weights", [False, True])
def test_holding_lifecycle(lifecycle, day, window_weights):
    got = _by_day(
        holdings.holding_returns(*lifecycle, window_weights=window_weights), "shares", "price", "return", "weight"
    )
    assert got[day(1)] == (10, 100, pytest.approx(1000 / 980 - 1), 1)
    assert got[day(2)] == (10, 110, pytest.approx(1105 / 1000 - 1), 1)
    assert got[day(3)] == (6, 120, pytest.approx(1200 / 1100 - 1), 1)
    assert got[day(4)] == (6, 130, pytest.approx(780 / 720 - 1), None)


def test_range_sees_the_row_before_it_unless_told_not_to(lifecycle, day):
    look_back = holdings.holding_returns(*lifecycle, day(2), day(2)).collect()
    confined = holdings.holding_returns(*lifecycle, day(2), day(2), look_back=False).collect()
    bounded = holdings.holding_returns(*lifecycle, day(2), day(2), look_back_days=3).collect()
    assert [r["return"] for r in look_back] == [pytest.approx(0.105)]
    assert [r["return"] for r in confined] == [pytest.approx(1105 / 1100 - 1)]
    assert bounded == look_back


def test_fractional_shares_still_close_exactly(spark, day):
    # 0.1 + 0.2 - 0.3 is not 0 in binary.
    positions = spark.createDataFrame(
        [(day(1), "U0", "ETF", "S0", 10.0, 0.3, 1.0)], POSITIONS
    )
    trades = spark.createDataFrame(
        [(day(1), "U0", "ETF", "S0", 0.1, 9.0), (day(1), "U0", "ETF", "S0", 0.2, 9.0)], TRADES
    )
    dividends = spark.createDataFrame([], DIVIDENDS)
    merged = holdings.holding_base_merge(positions, dividends, trades).first()
    assert merged["shares_kept"] == 0
    round_trip = spark.createDataFrame(
        [(day(1), "U0", "ETF", "S1", q, 9.0) for q in (0.1, 0.2, -0.3)], TRADES
    )
    assert holdings.trade_vwap(round_trip).count() == 0


def test_base_merge_edges(spark, day):
    positions = spark.createDataFrame(
        [(day(1), "U0", "ETF", "HELD", 10.0, 4.0, 1.0), (day(1), "U0", "BOND", "OUT", 10.0, 4.0, 1.0)], POSITIONS
    )
    trades = spark.createDataFrame(
        [
            (day(1), "U0", "ETF", "HELD", 1.0, 9.0),
            (day(1), "U0", "ETF", "HELD", -1.0, 9.5),
            (day(1), "U0", "ATR", "SOLD", -2.0, 7.0),
            (day(1), "U0", "ADR", "SKIPPED", -2.0, 7.0),
        ],
        TRADES,
    )
    dividends = spark.createDataFrame(
        [(day(1), "U0", "ETF", "HELD", 2.0, 0.5), (day(1), "U0", "ETF", "GONE", 3.0, 0.5)], DIVIDENDS
    )
    got = {r["symbol"]: r for r in holdings.holding_base_merge(positions, dividends, trades).collect()}
    assert set(got) == {"HELD", "SOLD"}
    held, sold = got["HELD"], got["SOLD"]
    assert (held["shares_traded"], held["average_trade_price"], held["dividends"]) == (0, 0, 2)
    assert held["shares_kept"] == 4
    assert (sold["shares_1"], sold["price_1"], sold["shares_traded"], sold["shares_kept"]) == (None, None, -2, 2)
    aligned = holdings.holding_base_merge(positions, dividends, trades, holdings.Scope.consistent())
    assert {r["symbol"] for r in aligned.collect()} == {"HELD", "SKIPPED"}


def test_unmarked_position_counts_at_its_trade_price(spark, day):
    positions = spark.createDataFrame(
        [
            (day(1), "U0", "ETF", "A", None, 4.0, 0.5),
            (day(1), "U0", "ETF", "B", 10.0, 1.0, 1.0),
            (day(1), "U0", "ETF", "C", None, 9.0, 1.0),
        ],
        POSITIONS,
    )
    trades = spark.createDataFrame([(day(1), "U0", "ETF", "A", 1.0, 20.0)], TRADES)
    dividends = spark.createDataFrame([], DIVIDENDS)
    calendar = _calendar(spark, [day(1)])
    for window_weights in (False, True):
        df = holdings.holding_returns(positions, dividends, trades, calendar, window_weights=window_weights)
        weights = {r["ticker"]: r["weight"] for r in df.collect()}
        assert weights == {"A": pytest.approx(0.8), "B": pytest.approx(0.2), "C": 0}


def test_lag_reads_non_sessions_but_they_are_not_reported(spark, day):
    positions = spark.createDataFrame(
        [(day(n), "U0", "ETF", "S0", p, 1.0, 1.0) for n, p in ((1, 100.0), (2, 110.0), (3, 121.0))], POSITIONS
    )
    none = spark.createDataFrame([], DIVIDENDS), spark.createDataFrame([], TRADES)
    df = holdings.holding_returns(positions, *none, _calendar(spark, [day(1), day(3)]))
    assert _by_day(df, "return") == {day(1): (0,), day(3): (pytest.approx(0.1),)}


def test_fund_returns(spark, day):
    nav = spark.createDataFrame(
        [
            (day(1), "U0", 100.0, 0.0, 1.0),
            (day(2), "U0", 110.0, 5.0, 2.0),
            (day(2), "U1", 50.0, 50.0, 0.0),
            (day(6), "U0", 500.0, 0.0, 0.0),  # no session
        ],
        "date date, client_account_id string, ending_value double, deposits_withdrawals double, dividends double",
    )
    calendar = _calendar(spark, [day(1), day(2)])
    got = {(r["date"], r["client_account_id"]): (r["value"], r["return"]) for r in funds.fund_returns(nav, calendar).collect()}
    assert got == {
        (day(1), "U0"): (100, 0),
        (day(2), "U0"): (105, pytest.approx(0.05)),
        (day(2), "U1"): (0, -1),
    }
    total = _by_day(funds.all_fund_returns(nav, calendar), "value", "return", "dividends")
    assert total == {day(1): (100, 0, 1), day(2): (105, pytest.approx(-0.3), 2)}


def test_zero_start_gives_no_return(spark, day):
    nav = spark.createDataFrame(
        [(day(1), "U0", 0.0, 0.0, 0.0), (day(2), "U0", 10.0, 10.0, 0.0)],
        "date date, client_account_id string, ending_value double, deposits_withdrawals double, dividends double",
    )
    assert _by_day(funds.fund_returns(nav, _calendar(spark, [day(1), day(2)])), "return") == {
        day(1): (None,),
        day(2): (None,),
    }


def test_look_back_falls_back_to_all_history(spark, day):
    nav = spark.createDataFrame(
        [
            (day(1), "OLD", 100.0, 0.0, 0.0),
            (day(30), "OLD", 150.0, 0.0, 0.0),
            (day(29), "NEAR", 10.0, 0.0, 0.0),
            (day(30), "NEAR", 20.0, 0.0, 0.0),
            (day(30), "NEW", 5.0, 0.0, 0.0),
        ],
        "date date, client_account_id string, ending_value double, deposits_withdrawals double, dividends double",
    )
    calendar = _calendar(spark, [day(n) for n in (1, 29, 30)])
    full = funds.fund_returns(nav, calendar, day(30), day(30))
    near = funds.fund_returns(nav, calendar, day(30), day(30), look_back_days=5)
    assert {r["client_account_id"]: r["return"] for r in near.collect()} == {"OLD": 0.5, "NEAR": 1, "NEW": 0}
    assert sorted(full.collect()) == sorted(near.collect())


def test_risk_free(spark, day):
    yields = spark.createDataFrame(
        [(day(1), "S", 4.0), (day(2), "S", None), (day(3), "S", 4.2), (day(4), "S", 4.1), (day(5), "S", None)],
        "date date, series_id string, yield double",
    )
    expected = (1 + 0.042 * 30 / 360) / (1 + 0.041 * 29 / 360) - 1
    got = _by_day(risk_free_return(yields), "return")
    assert got == {**{day(n): (pytest.approx(expected),) for n in range(1, 5)}, day(5): (None,)}
    assert set(_by_day(risk_free_return(yields, day(2), day(3)), "return")) == {day(2), day(3)}


def test_benchmark(spark, day):
    prices = spark.createDataFrame(
        [(day(n), t, c, 0.0) for n, t, c in
         [(1, "A", 100.0), (2, "A", 102.0), (3, "A", 51.0), (1, "B", 1.0), (2, "B", None), (3, "B", 2.0)]],
        "date date, ticker string, adjusted_close double, dividends_per_share double",
    )
    got = {(r["ticker"], r["date"]): r["return"] for r in benchmark_return(prices).collect()}
    assert got == {
        ("A", day(2)): pytest.approx(0.02),
        ("A", day(3)): -0.5,
        ("B", day(2)): 0,  # a gap counts as unchanged
        ("B", day(3)): 1,
    }


def test_weights_sum_to_one_and_totals_agree(spark):
    from pyspark.sql import functions as F

    v = Views(spark, SF)
    sources = v["v_positions_held"], v["v_dividends"], v["v_trades"], v["v_calendar"]
    sums = (
        holdings.holding_returns(*sources)
        .groupBy("date", "client_account_id")
        .agg(F.sum("weight").alias("w"), F.count("weight").alias("n"))
        .filter("n > 0")
    )
    assert sums.filter("abs(w - 1) > 1e-9").count() == 0
    assert sums.count() > 100
    per_day = funds.fund_returns(v["v_delta_nav"], v["v_calendar"]).groupBy("date").agg(F.sum("value").alias("s"))
    overall = funds.all_fund_returns(v["v_delta_nav"], v["v_calendar"])
    assert per_day.join(overall, "date").filter("s <> value").count() == 0
    assert per_day.count() == overall.count()


@pytest.mark.parametrize("days", [1, 15, 10_000])
def test_incremental_equals_full(spark, days):
    v = Views(spark, SF)
    sources = v["v_positions_held"], v["v_dividends"], v["v_trades"], v["v_calendar"]
    bounds = dt.date(2000, 6, 5), dt.date(2000, 9, 1)
    full = holdings.holding_returns(*sources, *bounds)
    bounded = holdings.holding_returns(*sources, *bounds, look_back_days=days)
    assert full.count() > 0
    assert full.exceptAll(bounded).isEmpty() and bounded.exceptAll(full).isEmpty()

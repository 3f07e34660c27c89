"""Returns after late corrections: the repaired rows against a full computation."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tallyfolio import jobs
from tallyfolio.operators.merge import upsert_or_drop, upsert_update
from tallyfolio.plans import funds, holdings, repair
from tallyfolio.schemas import CORE_TABLES
from tallyfolio.session import kept
from tallyfolio.sources.tables import Warehouse, conform

FIRST = dt.date(2024, 1, 1)
DAYS = [FIRST + dt.timedelta(days=n) for n in range(0, 60)]
SOURCES = ("positions", "dividends", "trades")


def random_sources(rng, n_accounts=2, n_symbols=3):
    positions, trades, dividends = {}, {}, {}
    for a in range(n_accounts):
        for s in range(n_symbols):
            for d in DAYS:
                key = (d, f"U{a}", f"S{s}")
                if rng.random() < 0.35:
                    positions[key] = (rng.choice(["ETF", "COMMON", "ADR", "BOND"]), rng.choice([None, 8.0, 16.0, 32.0]), float(rng.randint(-3, 9)), 1.0)
                for t in range(rng.choice([0, 0, 0, 1, 2])):
                    trades[(*key, f"T{t}")] = (rng.choice(["ETF", "ATR", "BOND"]), float(rng.randint(-4, 6)), float(rng.choice([4, 8, 16])))
                if rng.random() < 0.1:
                    dividends[(*key, "A")] = ("ETF", 0.5, 2.0)
    return positions, dividends, trades


SHAPES = (
    "report_date date, client_account_id string, symbol string, sub_category string, mark_price double, quantity double, fx_rate_to_base double",
    "report_date date, client_account_id string, symbol string, action_id string, sub_category string, gross_rate double, net_amount double",
    "report_date date, client_account_id string, symbol string, trade_id string, sub_category string, quantity double, trade_price double",
)


def frames(spark, sources):
    made = [spark.createDataFrame([(*k, *v) for k, v in rows.items()], shape) for rows, shape in zip(sources, SHAPES, strict=True)]
    return [kept(df.coalesce(1), "test") for df in made]


def corrections(rng, sources, share):
    """Some rows with other values, and some new ones."""
    changed = []
    for rows, other in zip(sources, random_sources(rng), strict=True):
        some = {k: v for k, v in other.items() if rng.random() < share}
        changed.append(some)
    return changed


def same(left, right):
    def plain(df):
        return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)

    assert left.columns == right.columns
    assert plain(left) == plain(right)


@pytest.mark.parametrize("seed, share, near", [(2, 0.02, 4), (3, 0.3, 10)])
def test_repaired_holdings_equal_a_full_computation(spark, seed, share, near):
    rng = random.Random(seed)
    old = random_sources(rng)
    new = corrections(rng, old, share)
    calendar = kept(spark.createDataFrame([(d,) for d in DAYS if d.weekday() < 5], "date date"), "test")
    before = frames(spark, old)
    stage = frames(spark, new)
    keys = [CORE_TABLES[t].key for t in SOURCES]
    after = [kept(upsert_update(b, s, k), "test") for b, s, k in zip(before, stage, keys, strict=True)]
    changed = [repair.changed_keys(b, s, k).select(*holdings.KEY) for b, s, k in zip(before, stage, keys, strict=True)]
    stored = kept(holdings.holding_returns(*before, calendar), "test")
    rows = repair.repair_holdings(stored, changed[0].union(changed[1]).union(changed[2]), *after, calendar, near_days=near)
    rows = kept(rows, "test")
    key = CORE_TABLES["holding_returns"].key
    full = holdings.holding_returns(*after, calendar)
    same(upsert_or_drop(stored, rows, key), full)
    if share == 0.02:
        assert rows.count() < full.count() / 2
    assert not rows.filter("gone").isEmpty() or share < 0.3


def test_nothing_changed_gives_nothing(spark):
    sources = frames(spark, random_sources(random.Random(4), 1, 1))
    calendar = spark.createDataFrame([(d,) for d in DAYS], "date date")
    stored = holdings.holding_returns(*sources, calendar)
    changed = repair.changed_keys(sources[0], sources[0], CORE_TABLES["positions"].key)
    assert changed.isEmpty() and repair.repair_holdings(stored, changed, *sources, calendar).isEmpty()


def test_repaired_accounts_and_totals_equal_a_full_computation(spark):
    rng = random.Random(5)
    shape = "date date, client_account_id string, ending_value double, deposits_withdrawals double, dividends double"

    def row(d, a):
        return (d, f"U{a}", float(rng.randint(100, 900)), float(rng.choice([0, 0, 50])), 1.0)

    old = {(d, a): row(d, a) for d in DAYS for a in range(4) if rng.random() < 0.6}
    new = old | {(d, a): row(d, a) for d in DAYS for a in range(4) if rng.random() < 0.03}
    calendar = spark.createDataFrame([(d,) for d in DAYS if d.weekday() < 5], "date date")
    before, after = (kept(spark.createDataFrame(list(rows.values()), shape), "test") for rows in (old, new))
    changed = repair.changed_keys(before, after, ["date", "client_account_id"])
    stored, totals = funds.fund_returns(before, calendar), funds.all_fund_returns(before, calendar)
    rows = kept(repair.repair_accounts(stored, changed, after, calendar, near_days=4), "test")
    same(upsert_or_drop(stored, rows, ["date", "client_account_id"]), funds.fund_returns(after, calendar))
    fixed = repair.repair_totals(totals, rows, after, calendar, near_days=4)
    same(upsert_or_drop(totals, fixed, ["date"]), funds.all_fund_returns(after, calendar))


def test_corrections_of_stored_tables_read_the_days_around_them(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    # every holding has a row on every day, so that neighbours lie near
    positions = {(d, f"U{a}", f"S{s}"): ("ETF", 8.0, float(rng.randint(1, 9)), 1.0) for d in DAYS for a in range(2) for s in range(3)}
    late = DAYS[30]
    sources = frames(spark, (positions, {(late, "U0", "S0", "A"): ("ETF", 0.5, 2.0)}, {(late, "U0", "S0", "T"): ("ETF", 1.0, 4.0)}))
    house = Warehouse(spark, str(tmp_path / "core"))
    with house.transaction() as loads:
        for table, df in zip(SOURCES, sources, strict=True):
            house.merge(table, df, transaction=loads)
        house.merge("calendar", spark.createDataFrame([(d,) for d in DAYS], "date date"), transaction=loads)
        house.merge("delta_nav", spark.createDataFrame([(d, "U0", 100.0 + n, 0.0, 0.0) for n, d in enumerate(DAYS)],
                    "date date, client_account_id string, ending_value double, deposits_withdrawals double, dividends double"), transaction=loads)
    jobs.materialize_returns(house, DAYS[0], DAYS[-1])
    plans, merge = [], house.merge

    def watched(table, batch, **options):
        if options.get("mode") == "repair":
            plans.append(batch._jdf.queryExecution().executedPlan().toString())
        merge(table, batch, **options)

    monkeypatch.setattr(house, "merge", watched)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    fixes = frames(spark, ({(late, "U1", "S2"): ("ETF", 8.0, 77.0, 1.0)}, {}, {(late, "U0", "S1", "T"): ("ETF", 2.0, 4.0)}))
    nav = spark.createDataFrame([(late, "U0", 500.0, 0.0, 0.0)], "date date, client_account_id string, ending_value double, deposits_withdrawals double, dividends double")
    jobs.run_corrections(house, {"positions": fixes[0], "trades": fixes[2], "delta_nav": nav}, near_days=5)
    scans = [line for p in plans for line in p.splitlines() if "FileScan" in line and any(f"/core/{t}/" in line for t in ("positions", "trades"))]
    assert scans
    for line in scans:  # days are tested on the folders, and none is far from the correction
        filters = line[line.index("PartitionFilters") : line.index("PushedFilters")]
        assert "report_date" in filters and str(late) in filters and str(DAYS[10]) not in filters and str(DAYS[50]) not in filters
    now = {t: house.read(t) for t in (*SOURCES, "calendar", "delta_nav")}
    same(house.read("holding_returns"), conform(holdings.holding_returns(*[now[t] for t in SOURCES], now["calendar"]), "holding_returns"))
    same(house.read("fund_returns"), conform(funds.fund_returns(now["delta_nav"], now["calendar"]), "fund_returns"))
    same(house.read("all_fund_returns"), conform(funds.all_fund_returns(now["delta_nav"], now["calendar"]), "all_fund_returns"))


def test_a_day_without_rows_after_a_repair(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "core"))
    rows = spark.createDataFrame([(d, "U0", 1.0) for d in DAYS[:3]], "date date, client_account_id string, value double")
    house.merge("fund_returns", rows)
    gone = rows.filter(rows["date"] == DAYS[1]).selectExpr("*", "true AS gone")
    house.merge("fund_returns", gone, mode="repair")
    assert sorted(r["date"] for r in house.read("fund_returns").collect()) == [DAYS[0], DAYS[2]]
    house.merge("fund_returns", gone.drop("gone"))
    assert house.read("fund_returns").count() == 3

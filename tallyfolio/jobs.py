"""The three run modes: one day, a date range, everything.

Each loads reports and series into the core tables, then materialises the returns of its range. All loads
become visible in one step, and so do all returns.
Dates are arguments; nothing here asks the clock.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfolio.operators.filters import between_dates, union_all
from tallyfolio.operators.sessions import last_market_date, trading_days
from tallyfolio.plans.funds import all_fund_returns, fund_returns, latest_accounts
from tallyfolio.plans.holdings import KEY, Scope, holding_returns, latest_holdings
from tallyfolio.plans.repair import NEAR_DAYS, changed_keys, repair_accounts, repair_holdings, repair_totals
from tallyfolio.plans.series import benchmark_return, risk_free_return
from tallyfolio.schemas import CORE_TABLES, HISTORY_START, REPORTS
from tallyfolio.sources.reports import Landing, list_files, read_all_zones, read_backfill, read_daily
from tallyfolio.sources.series import PRICE_COLUMNS, clean_prices, clean_yields
from tallyfolio.sources.tables import Transaction, Warehouse, conform

_ONE_DAY = dt.timedelta(days=1)
# Where the search for a session may begin: a few thousand rows, and before any report.
EARLIEST = dt.date(1900, 1, 1)


@dataclass(frozen=True)
class Inputs:
    """What a run reads besides the core tables.

    ``prices`` and ``yields`` are in the shape of ``sources.series``, ``holidays`` has a ``date``
    column. ``series`` names the yield series to use.
    """

    landing: Landing
    holidays: DataFrame | None
    prices: DataFrame
    yields: DataFrame
    series: str = "DGS10"


@dataclass(frozen=True)
class Options:
    scope: Scope = field(default_factory=Scope)
    # Keep the last row per holding and account as tables, so that a run reads the days since the
    # last one. The first run reads all history for them.
    keep_latest: bool = True
    # Without them: how far before the range the last row of a key is searched first; None reads all.
    look_back_days: int | None = 30
    # False confines holding returns to the range, without predecessors before it.
    look_back: bool = True
    # "ignore" keeps the first risk-free value stored for a day, also an empty one.
    risk_free_mode: str = "ignore"
    mixed_layouts: bool = True
    # Reloads only: let the newest file decide where files disagree on a key, instead of failing.
    newest_only: bool = False


def earliest_backfill(today: dt.date) -> dt.date:
    """First day of the month after the one a year ago: as far back as reports can be asked for."""
    month = today.year * 12 + today.month - 12  # the month after, counted from 0
    return dt.date(month // 12, month % 12 + 1, 1)


def backfill_window(
    today: dt.date, from_date: dt.date | str | None = None, to_date: dt.date | str | None = None
) -> tuple[dt.date, dt.date]:
    """The range of a backfill: both bounds given, or neither for the widest one allowed."""
    if from_date is None and to_date is None:
        return earliest_backfill(today), today - _ONE_DAY
    if from_date is None or to_date is None:
        raise ValueError("give both bounds of a backfill or neither")
    start, end = (dt.date.fromisoformat(d) if isinstance(d, str) else d for d in (from_date, to_date))
    check_window(today, start, end)
    return start, end


def check_window(today: dt.date, start: dt.date, end: dt.date) -> None:
    if start < earliest_backfill(today):
        raise ValueError(f"start {start} is before {earliest_backfill(today)}")
    if end > today - _ONE_DAY:
        raise ValueError(f"end {end} is after {today - _ONE_DAY}")


def last_session_before(spark: SparkSession, inputs: Inputs, day: dt.date) -> dt.date:
    """Latest session before ``day``, from the exchange rules and not from what has been loaded."""
    yesterday = day - _ONE_DAY
    return last_market_date(trading_days(spark, EARLIEST, yesterday, inputs.holidays), yesterday)


def _together(*tasks: Callable[[], None]) -> None:
    """Run tasks that touch different tables side by side, so that the end of one job and the
    start of another share the cluster. The first failure is raised once all have ended."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = [pool.submit(task) for task in tasks]
    for task in running:
        task.result()


def _report_loads(
    warehouse: Warehouse, read: Callable[[str], DataFrame], transaction: Transaction
) -> list[Callable[[], None]]:
    return [lambda report=report: warehouse.merge(report, read(report), transaction=transaction) for report in REPORTS]


def _series_loads(
    warehouse: Warehouse,
    inputs: Inputs,
    options: Options,
    start: dt.date,
    end: dt.date,
    prices: DataFrame,
    transaction: Transaction,
) -> list[Callable[[], None]]:
    sessions = trading_days(warehouse.spark, start, end, inputs.holidays)
    one_series = clean_yields(inputs.yields).filter(F.col("series_id") == inputs.series)
    rates = risk_free_return(one_series, start, end)
    merge = partial(warehouse.merge, transaction=transaction)
    return [
        lambda: merge("calendar", sessions, mode="ignore"),
        lambda: merge("benchmark", benchmark_return(clean_prices(prices, PRICE_COLUMNS))),
        lambda: merge("risk_free_rate", rates, mode=options.risk_free_mode),
    ]


Step = Callable[[dt.date, DataFrame | None, dt.date | None], DataFrame]


def _latest_before(warehouse: Warehouse, name: str, start: dt.date, step: Step) -> DataFrame:
    """The latest rows of the day before ``start``: from the newest stored ones, or else from all
    history, which are then stored."""
    day = start - _ONE_DAY
    known = warehouse.latest(name, start)
    if known is None:
        warehouse.keep_latest(name, day, step(day, None, None))
        known = warehouse.latest(name, start)
    return step(day, known[1], known[0])


def _store_latest(warehouse: Warehouse, name: str, end: dt.date, step: Step) -> None:
    known = warehouse.latest(name, end)
    known_day, rows = known or (None, None)
    warehouse.keep_latest(name, end, step(end, rows, known_day))


def materialize_returns(warehouse: Warehouse, start: dt.date, end: dt.date, options: Options = Options()) -> None:
    """Compute the returns of a range at all three levels and merge them into their tables, in one step.

    With ``keep_latest`` the rows before the range come from the stored latest rows, and those of
    its end are stored for the next run."""
    calendar = warehouse.read("calendar")
    nav, positions, trades = (warehouse.read(table) for table in ("delta_nav", "positions", "trades"))
    days = options.look_back_days

    def holding_step(day: dt.date, known: DataFrame | None, known_day: dt.date | None) -> DataFrame:
        return latest_holdings(positions, trades, day, options.scope, known, known_day)

    def account_step(day: dt.date, known: DataFrame | None, known_day: dt.date | None) -> DataFrame:
        return latest_accounts(nav, calendar, day, known, known_day)

    def holdings(results: Transaction) -> None:
        kept = options.keep_latest and options.look_back
        name = f"holdings-{hashlib.md5(repr((*options.scope.positions, '/', *options.scope.trades)).encode()).hexdigest()}"
        latest = _latest_before(warehouse, name, start, holding_step) if kept else None
        rows = holding_returns(
            positions,
            warehouse.read("dividends"),
            trades,
            calendar,
            start,
            end,
            scope=options.scope,
            look_back=options.look_back,
            look_back_days=days,
            latest=latest,
        )
        warehouse.merge("holding_returns", rows, transaction=results)
        if kept:
            _store_latest(warehouse, name, end, holding_step)

    def accounts(results: Transaction) -> None:
        latest = _latest_before(warehouse, "accounts", start, account_step) if options.keep_latest else None
        merge = partial(warehouse.merge, transaction=results)
        _together(
            lambda: merge("fund_returns", fund_returns(nav, calendar, start, end, days, latest)),
            lambda: merge("all_fund_returns", all_fund_returns(nav, calendar, start, end, days, latest)),
        )
        if options.keep_latest:
            _store_latest(warehouse, "accounts", end, account_step)

    with warehouse.transaction() as results:
        _together(lambda: holdings(results), lambda: accounts(results))


def run_daily(warehouse: Warehouse, inputs: Inputs, as_of: dt.date, options: Options = Options()) -> dt.date:
    """Load and compute the last session before ``as_of``; returns that session."""
    spark = warehouse.spark
    day = last_session_before(spark, inputs, as_of)
    day_before = last_session_before(spark, inputs, day)
    mixed = options.mixed_layouts
    prices = between_dates(inputs.prices, "date", day_before, day)
    with warehouse.transaction() as loads:
        _together(
            *_report_loads(warehouse, lambda r: read_daily(spark, inputs.landing, day, r, mixed_layouts=mixed), loads),
            *_series_loads(warehouse, inputs, options, day, day, prices, loads),
        )
    materialize_returns(warehouse, day, day, options)
    return day


def run_backfill(
    warehouse: Warehouse, inputs: Inputs, start: dt.date, end: dt.date, options: Options = Options()
) -> None:
    """Load and compute a range from the backfill zone. Prices end the day before ``end``."""
    spark = warehouse.spark
    mixed = options.mixed_layouts
    prices = between_dates(inputs.prices, "date", start, end - _ONE_DAY)
    with warehouse.transaction() as loads:
        _together(
            *_report_loads(warehouse, lambda r: read_backfill(spark, inputs.landing, start, end, r, mixed_layouts=mixed), loads),
            *_series_loads(warehouse, inputs, options, start, end, prices, loads),
        )
    materialize_returns(warehouse, start, end, options)


def _chunks(start: dt.date, end: dt.date, months: int) -> list[tuple[dt.date, dt.date]]:
    """The range cut into so many calendar months each."""
    cuts, first = [], start
    while first <= end:
        month = first.year * 12 + first.month - 1 + months
        following = dt.date(month // 12, month % 12 + 1, 1)
        cuts.append((first, min(end, following - _ONE_DAY)))
        first = following
    return cuts


def run_backfill_by_month(
    warehouse: Warehouse,
    inputs: Inputs,
    start: dt.date,
    end: dt.date,
    options: Options = Options(),
    months: int = 1,
    most: int | None = None,
) -> list[dt.date]:
    """``run_backfill`` in chunks of ``months`` that a repeated run takes up where the last one ended; returns the first
    days of the chunks done now, of which there are ``most`` if that is given.

    A ledger beside the tables has an entry per chunk, written when its returns are there, with the input files and
    their times. Chunks whose entry names the same files are skipped; a new or corrected file opens all of them.
    The reports are parsed once: cleaned rows are staged by month, which the ledger notes as well."""
    spark, folder = warehouse.spark, warehouse.published.folder
    globs = [inputs.landing.backfill_glob(start, end, report) for report in REPORTS]
    files = [[path, size, folder.modified(path)] for path, size in list_files(spark, globs)]
    ledger = f"_ledger/backfill-{start}_{end}"
    kept = json.loads(folder.read(f"{ledger}/stage.json")) if "stage.json" in folder.names(ledger) else {}
    if kept.get("files") != files:
        root = f"{ledger}/stage-{uuid.uuid4().hex}"
        month = F.col("__date").cast("date")

        def stage(report: str) -> None:
            spec = CORE_TABLES[report]
            rows = read_backfill(spark, inputs.landing, start, end, report, mixed_layouts=options.mixed_layouts)
            rows = conform(rows, report).withColumn("__date", F.trunc(spec.date, "month"))
            rows.withColumn("__date", month).hint("rebalance", F.col("__date")).write.partitionBy("__date").parquet(f"{warehouse.root}/{root}/{report}")

        _together(*[lambda r=r: stage(r) for r in REPORTS])
        folder.write(f"{ledger}/stage.json", json.dumps({"files": files, "root": root}))
        kept = {"root": root}
    done = []
    for first, last in _chunks(start, end, months):
        if most is not None and len(done) >= most:
            break
        name = f"{first}_{last}.json"
        entry = f"{ledger}/{name}"
        if name in folder.names(ledger) and json.loads(folder.read(entry)) == files:
            continue

        def read(report: str, first: dt.date = first, last: dt.date = last) -> DataFrame:
            rows = spark.read.schema(CORE_TABLES[report].schema.add("__date", "date")).parquet(f"{warehouse.root}/{kept['root']}/{report}")
            return rows.filter(F.col("__date").between(F.lit(first.replace(day=1)), F.lit(last))).drop("__date")

        # the price before the month is what its first change compares with
        before = last_session_before(spark, inputs, first) if first > start else start
        prices = between_dates(inputs.prices, "date", before, min(last, end - _ONE_DAY))
        with warehouse.transaction() as loads:
            _together(
                *_report_loads(warehouse, read, loads),
                *_series_loads(warehouse, inputs, options, first, last, prices, loads),
            )
        materialize_returns(warehouse, first, last, options)
        folder.write(entry, json.dumps(files))
        done.append(first)
    return done


def run_reload(
    warehouse: Warehouse,
    inputs: Inputs,
    as_of: dt.date,
    start: dt.date = HISTORY_START,
    options: Options = Options(),
) -> None:
    """Load every file of every zone and compute all returns from ``start`` on."""
    spark = warehouse.spark
    mixed = options.mixed_layouts
    prices = between_dates(inputs.prices, "date", start, as_of - _ONE_DAY)
    with warehouse.transaction() as loads:
        _together(
            *_report_loads(warehouse, lambda r: read_all_zones(spark, inputs.landing, r, options.newest_only, mixed), loads),
            *_series_loads(warehouse, inputs, options, start, as_of, prices, loads),
        )
    # All history is read anyway; searching the days before the start first would gain nothing.
    materialize_returns(warehouse, start, as_of, replace(options, look_back_days=None))


def run_corrections(
    warehouse: Warehouse, corrections: Mapping[str, DataFrame], options: Options = Options(), near_days: int = NEAR_DAYS
) -> None:
    """Merge corrected report rows (report -> cleaned rows) of any days, and compute again the returns they change.

    The corrections become visible in one step, and the returns in another; a run that dies between the two is
    to be repeated with ``materialize_returns`` over the days, as a second look finds nothing changed."""
    state = warehouse.published.state()
    changed, staged = {}, {}
    for report, rows in corrections.items():
        spec = CORE_TABLES[report]
        rows = conform(rows, report)
        days = [r[0] for r in rows.select(spec.date).distinct().collect()]
        core = warehouse.read(report, min(days), max(days), state) if days else warehouse.read(report, state=state).limit(0)
        keys = changed_keys(core.filter(F.col(spec.date).isin(days)), rows, spec.key)
        # written before the merge, which changes what they are compared with
        changed[report], staged[report] = warehouse.keep(keys)
        corrections = corrections | {report: rows}
    with warehouse.transaction() as loads:
        _together(*[lambda r=r: warehouse.merge(r, corrections[r], transaction=loads) for r in corrections])
    read = partial(warehouse.read, state=warehouse.published.state())
    calendar = read("calendar")
    with warehouse.transaction() as results:
        held = [changed[r].select(*KEY) for r in ("positions", "trades", "dividends") if r in changed]
        if held:
            sources = (read("positions"), read("dividends"), read("trades"), calendar)
            rows = repair_holdings(read("holding_returns"), union_all(held), *sources, options.scope, near_days)
            warehouse.merge("holding_returns", rows, mode="repair", transaction=results)
        if "delta_nav" in changed:
            nav = read("delta_nav")
            rows = repair_accounts(read("fund_returns"), changed["delta_nav"], nav, calendar, near_days)
            warehouse.merge("fund_returns", rows, mode="repair", transaction=results)
            totals = repair_totals(read("all_fund_returns"), rows, nav, calendar, near_days)
            warehouse.merge("all_fund_returns", totals, mode="repair", transaction=results)
    for path in staged.values():
        warehouse.drop_stage(path)

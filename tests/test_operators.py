from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from tallyfolio.operators import merge, sessions, windows
from tallyfolio.sources import series as series_sources

KV = "k int, v string"


def _map(df):
    got = [tuple(r) for r in df.collect()]
    assert len({k for k, _ in got}) == len(got)
    return dict(got)


# --- Merge ---


def test_upserts(spark):
    core = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    stage = spark.createDataFrame([(2, "c"), (3, "d")], KV)
    updated = merge.upsert_update(core, stage, ["k"])
    assert _map(updated) == {1: "a", 2: "c", 3: "d"}
    assert _map(merge.upsert_update(updated, stage, ["k"])) == {1: "a", 2: "c", 3: "d"}
    ignored = merge.upsert_ignore(core, stage, ["k"])
    assert _map(ignored) == {1: "a", 2: "b", 3: "d"}
    assert _map(merge.upsert_ignore(ignored, stage, ["k"])) == {1: "a", 2: "b", 3: "d"}


def test_duplicates_in_a_batch(spark):
    core = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    twice = spark.createDataFrame([(2, "c"), (2, "e")], KV)
    with pytest.raises(PySparkException, match="duplicate key: 2"):
        merge.upsert_update(core, twice, ["k"]).collect()
    assert _map(merge.upsert_ignore(core, twice, ["k"])) == {1: "a", 2: "b"}
    assert _map(merge.upsert_ignore(core.limit(0), twice, ["k"])) == {2: "c"}
    ordered = spark.createDataFrame([(2, "new", 9), (2, "old", 1)], "k int, v string, file int")
    latest = merge.upsert_update(core, ordered, ["k"], on_duplicate="latest", order=["file"])
    assert _map(latest) == {1: "a", 2: "new"} and latest.columns == ["k", "v"]
    with pytest.raises(ValueError):
        merge.upsert_update(core, twice, ["k"], on_duplicate="maybe")


def test_duplicates_and_nulls_raise_on_count_too(spark):
    core = spark.createDataFrame([(1, "a")], KV)
    for stage in ([(2, "c"), (2, "c")], [(None, "c")]):
        with pytest.raises(PySparkException, match="duplicate key|null in key"):
            merge.upsert_update(core, spark.createDataFrame(stage, KV), ["k"]).write.format("noop").mode(
                "overwrite"
            ).save()


def test_many_copies_of_one_key(spark):
    stage = spark.range(200_000).selectExpr("CAST(7 AS INT) AS k", "CAST(id AS STRING) AS v")
    core = spark.createDataFrame([(1, "a")], KV)
    with pytest.raises(PySparkException, match="duplicate key: 7"):
        merge.upsert_update(core, stage, ["k"]).collect()
    assert _map(merge.upsert_update(core, stage, ["k"], "latest", ["v"])) == {1: "a", 7: "99999"}
    assert [tuple(r) for r in merge.key_violations(stage, ["k"]).collect()] == [(7, 200_000)]


def test_merges_can_follow_each_other(spark):
    rows = spark.range(5000).selectExpr("CAST(id AS INT) AS k", "CAST(id AS STRING) AS v")
    stage = spark.range(2500, 7500).selectExpr("CAST(id AS INT) AS k", "'x' AS v")
    df = rows
    for _ in range(2):
        df = merge.upsert_update(df, stage.union(stage), ["k"], "latest", ["v"])
        df = merge.upsert_ignore(df, stage.union(stage), ["k"])
        df = merge.upsert_fill(df, stage, ["k"])
        df = merge.upsert_update(df, stage, ["k"])
    got = _map(df)
    assert len(got) == 7500 and all(v == (str(k) if k < 2500 else "x") for k, v in got.items())


def test_fill(spark):
    core = spark.createDataFrame([(1, None), (2, "b"), (4, None)], KV)
    stage = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], KV)
    assert _map(merge.upsert_fill(core, stage, ["k"])) == {1: "x", 2: "b", 3: "z", 4: None}
    assert _map(merge.upsert_ignore(core, stage, ["k"])) == {1: None, 2: "b", 3: "z", 4: None}


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], KV)
    got = {(r["k"], r["n_rows"]) for r in merge.key_violations(df, ["k"]).collect()}
    assert got == {(1, 2), (None, 1)}


# --- Windows against plain Python ---

_values = st.lists(st.one_of(st.none(), st.integers(1, 50).map(float)), min_size=1, max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups=st.lists(_values, min_size=1, max_size=3))
def test_windows_match_plain_loops(spark, groups):
    start = dt.date(2024, 1, 1)
    data = [(f"g{g}", start + dt.timedelta(days=2 * i), v) for g, vs in enumerate(groups) for i, v in enumerate(vs)]
    random.Random(0).shuffle(data)
    df = spark.createDataFrame(data, "g string, d date, v double")
    df = windows.pct_change(df, ["g"], "d", "v", "change")
    df = windows.with_previous(df, ["g"], "d", {"v": "before"})
    df = windows.backfill_nulls(df.selectExpr("*", "v AS filled"), ["g"], "d", "filled")
    got = {(r["g"], r["d"]): (r["before"], r["filled"], r["change"]) for r in df.collect()}
    for g, vs in enumerate(groups):
        seen = None
        for i, v in enumerate(vs):
            before = vs[i - 1] if i and vs[i - 1] is not None else v
            filled = next((x for x in vs[i:] if x is not None), None)
            now = v if v is not None else seen
            change = None if seen is None else now / seen - 1
            row = got[(f"g{g}", start + dt.timedelta(days=2 * i))]
            assert row[:2] == (before, filled)
            assert row[2] is None if change is None else row[2] == pytest.approx(change)
            seen = now


def test_last_per_key(spark, day):
    df = spark.createDataFrame(
        [("a", day(1), 1.0), ("a", day(3), None), ("b", day(2), 2.0)], "g string, d date, v double"
    )
    got = {tuple(r) for r in windows.last_per_key(df, ["g"], "d", ["d", "v"]).collect()}
    assert got == {("a", day(3), None), ("b", day(2), 2.0)}


@pytest.mark.parametrize("broadcast_keys", [1, 500_000])
def test_last_before_reads_far_history_only_when_it_must(spark, day, monkeypatch, broadcast_keys):
    monkeypatch.setattr(windows, "BROADCAST_KEYS", broadcast_keys)
    df = spark.createDataFrame([("a", day(1), 1.0), ("b", day(9), 2.0)], "g string, d date, v double")
    read = []

    def rows(first, last):
        read.append(first)
        return df.filter(df.d <= last) if first is None else df.filter(df.d.between(first, last))

    def search(keys, days):
        read.clear()
        wanted = spark.createDataFrame([(k,) for k in keys], "g string")
        found = windows.last_before(rows, ["g"], "d", ["d", "v"], day(10), wanted, days)
        return {tuple(r) for r in found.collect() if r["g"] in keys}, len(read)

    assert search("b", 3) == ({("b", day(9), 2.0)}, 1)
    assert search("abc", 3) == ({("a", day(1), 1.0), ("b", day(9), 2.0)}, 2)
    assert search("ab", None) == ({("a", day(1), 1.0), ("b", day(9), 2.0)}, 1)


# --- Sessions ---


def _dates(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "date date")


def test_trading_days(spark):
    new_year = _dates(spark, dt.date(2024, 1, 1))
    got = [r["date"] for r in sessions.trading_days(spark, dt.date(2023, 12, 29), dt.date(2024, 1, 3), new_year).collect()]
    assert sorted(got) == [dt.date(2023, 12, 29), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]


def test_last_market_date(spark):
    calendar = _dates(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 5))
    assert sessions.last_market_date(calendar, dt.date(2024, 1, 7)) == dt.date(2024, 1, 5)
    assert sessions.last_market_date(calendar, dt.date(2024, 1, 4)) == dt.date(2024, 1, 2)
    assert sessions.last_market_date(calendar, dt.date(2024, 3, 1)) == dt.date(2024, 1, 5)
    with pytest.raises(ValueError):
        sessions.last_market_date(calendar, dt.date(2024, 1, 1))


def test_monthly_intervals(spark):
    d = dt.date
    calendar = _dates(spark, d(2024, 1, 30), d(2024, 1, 31), d(2024, 2, 1), d(2024, 2, 29), d(2024, 3, 4))
    got = sorted((r["from_date"], r["to_date"]) for r in sessions.monthly_intervals(calendar).collect())
    assert got == [
        (d(2024, 1, 30), d(2024, 1, 31)),
        (d(2024, 2, 1), d(2024, 2, 29)),
        (d(2024, 3, 4), d(2024, 3, 4)),
    ]
    clipped = sessions.monthly_intervals(calendar, d(2024, 1, 31), d(2024, 2, 15)).collect()
    assert sorted((r["from_date"], r["to_date"]) for r in clipped) == [
        (d(2024, 1, 31), d(2024, 1, 31)),
        (d(2024, 2, 1), d(2024, 2, 1)),
    ]


# --- Series ---


def test_wide_prices_and_gaps(spark, day):
    wide = spark.createDataFrame(
        [(day(1), 1.0, 2.0, 0.0, None), (day(2), None, 3.0, 0.5, 0.0)],
        "Date date, `Close|A` double, `Close|B.C` double, `Dividends|A` double, `Dividends|B.C` double",
    )
    long = series_sources.prices_wide_to_long(wide, "Date", {"Close": "Close", "Dividends": "Dividends"}, ["A", "B.C"])
    got = {tuple(r) for r in long.collect()}
    assert got == {(day(1), "A", 1.0, 0.0), (day(1), "B.C", 2.0, None), (day(2), "A", None, 0.5), (day(2), "B.C", 3.0, 0.0)}
    clean = series_sources.clean_prices(long.withColumnRenamed("ticker", "Ticker"))
    assert clean.columns == ["date", "ticker", "adjusted_close", "dividends_per_share"]


def test_nan_is_a_gap(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2), float("nan"))], "date timestamp_ntz, yield double")
    got = series_sources.clean_yields(df, "S").first()
    assert tuple(got) == (dt.date(2024, 1, 2), "S", None)

"""Holding returns from a stream in several runs, against the batch computation."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tallyfolio.plans import holdings
from tallyfolio.session import kept
from tallyfolio.streaming.holdings import LOG, VALUES, Days, follow_holdings, followed_returns

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in range(40)]


def test_a_day_says_what_compares_otherwise():
    days = Days()
    row = tuple(float(i) for i in range(len(VALUES)))
    assert days.put(DAYS[5], row) == [DAYS[5]]
    assert days.put(DAYS[2], (None, *row[1:])) == [DAYS[2], DAYS[5]]
    assert days.with_previous(DAYS[5])[-3:] == (0.0, 1.0, 2.0)  # an empty value before: its own
    assert days.put(DAYS[2], None) == [DAYS[2], DAYS[5]] and days.put(DAYS[3], None) == [DAYS[3], DAYS[5]]


def test_stream_in_runs_equals_batch(spark, tmp_path):
    rng = random.Random(1)
    names = [f.name for f in LOG.fields]

    def row(d, a, s, gone=False, version=0):
        values = [rng.choice([None, 1.0, 2.0]), rng.choice([None, 0.0, 4.0, 8.0]), rng.choice([None, 16.0, 32.0]), 1.0, 0.5, float(rng.randint(-4, 4)), 8.0]
        kept_shares = (values[1] or 0.0) - values[5]
        return dict(zip(names, (d, f"U{a}", f"S{s}", *values, kept_shares, gone, version), strict=True))

    final, log = {}, str(tmp_path / "log")
    calendar = kept(spark.createDataFrame([(d,) for d in DAYS if d.weekday() < 5], "date date"), "test")
    for run in range(3):
        # later runs bring new, older and corrected days, days that go, and a key twice
        news = [row(d, a, s, run > 0 and rng.random() < 0.2) for d in DAYS for a in range(2) for s in range(2) if rng.random() < 0.4]
        news += [row(r["report_date"], r["client_account_id"][1:], r["symbol"][1:], version=1) for r in news[:5]]
        for r in sorted(news, key=lambda r: r["version"]):
            final[(r["report_date"], r["client_account_id"], r["symbol"])] = r
        spark.createDataFrame(news, LOG).repartition(3).write.mode("append").parquet(log)
        follow_holdings(spark, log, str(tmp_path / "sink"), calendar, str(tmp_path / "checkpoint")).awaitTermination()
        merged = kept(spark.createDataFrame([r for r in final.values() if not r["gone"]], LOG).drop("gone", "version"), "test")
        lagged = holdings.holding_lag(merged).join(calendar.withColumnRenamed("date", "report_date"), "report_date", "left_semi")
        want = holdings._output(holdings.holding_weights(holdings.holding_adjustments(lagged)))
        got = followed_returns(spark, str(tmp_path / "sink"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_a_batch_that_failed_is_taken_again(spark, tmp_path, monkeypatch):
    calendar = spark.createDataFrame([(d,) for d in DAYS], "date date")
    places = [str(tmp_path / n) for n in ("log", "sink")]
    rows = [(d, "U0", "S0", 1.0, 4.0, 8.0 + i, 0.0, 0.0, 0.0, 0.0, 4.0, False, 0) for i, d in enumerate(DAYS[:4])]
    spark.createDataFrame(rows[:2], LOG).coalesce(1).write.parquet(places[0])

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(holdings, "holding_adjustments", fail)
        with pytest.raises(Exception, match="lost"):
            follow_holdings(spark, *places, calendar, str(tmp_path / "checkpoint")).awaitTermination()
    spark.createDataFrame(rows[2:], LOG).coalesce(1).write.mode("append").parquet(places[0])
    follow_holdings(spark, *places, calendar, str(tmp_path / "checkpoint")).awaitTermination()
    got = {r["date"]: r["return"] for r in followed_returns(spark, places[1]).collect()}
    assert got == {DAYS[0]: 0.0, **{DAYS[i]: (8.0 + i) / (7.0 + i) - 1 for i in (1, 2, 3)}}

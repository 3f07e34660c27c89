"""Merges that are seen whole or not at all."""

from __future__ import annotations

import datetime as dt
import threading

import pytest

from tallyfolio.sources.published import Conflict, Published
from tallyfolio.sources.tables import Transaction, Warehouse

DAYS = [dt.date(2024, 1, n) for n in range(2, 7)]
NAV = "date date, client_account_id string, ending_value double"


def nav(spark, value, days=DAYS, account="U0"):
    return spark.createDataFrame([(d, account, float(value)) for d in days], NAV)


def values(warehouse, table="delta_nav", **bounds):
    return {r["date"]: r["ending_value"] for r in warehouse.read(table, **bounds).collect()}


def folders(warehouse, table="delta_nav"):
    listed = warehouse.published.folder
    return sum("=" in part for gen in listed.names(table) for part in listed.names(f"{table}/{gen}"))


class Killed(BaseException):
    """Stands for the end of the driver: nothing is tidied up after it."""


@pytest.fixture
def warehouse(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "core"))
    house.merge("delta_nav", nav(spark, 1))
    return house


def test_a_merge_killed_before_its_step_leaves_the_old_rows(warehouse, spark, monkeypatch):
    def die(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(Published, "publish", die)
        with pytest.raises(Killed):
            warehouse.merge("delta_nav", nav(spark, 2))
    assert folders(warehouse) == 2 * len(DAYS)  # all of it had been written
    assert set(values(warehouse).values()) == {1.0}
    warehouse.merge("delta_nav", nav(spark, 3))
    assert set(values(warehouse).values()) == {3.0}


def test_a_merge_killed_after_its_step_leaves_the_new_rows(warehouse, spark, monkeypatch):
    publish = Published.publish

    def die(self, *arguments):
        publish(self, *arguments)
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(Published, "publish", die)
        with pytest.raises(Killed):
            warehouse.merge("delta_nav", nav(spark, 2))
    assert values(warehouse) == dict.fromkeys(DAYS, 2.0)
    warehouse.merge("delta_nav", nav(spark, 2))  # the repeated run
    assert values(warehouse) == dict.fromkeys(DAYS, 2.0)


def test_a_failed_merge_drops_what_it_wrote(warehouse, spark, monkeypatch):
    def fail(*_):
        raise Conflict("always")

    monkeypatch.setattr(Published, "publish", fail)
    with pytest.raises(Conflict):
        warehouse.merge("delta_nav", nav(spark, 2))
    assert folders(warehouse) == len(DAYS) and set(values(warehouse).values()) == {1.0}


def test_of_two_merges_of_one_partition_one_wins_and_one_computes_anew(warehouse, spark, monkeypatch):
    runs, write = [], Transaction._write

    def counted(self, merge, base):
        runs.append(base.number)
        write(self, merge, base)

    monkeypatch.setattr(Transaction, "_write", counted)
    with warehouse.transaction() as late:
        warehouse.merge("delta_nav", nav(spark, 5, DAYS[:2], "U0"), transaction=late)
        warehouse.merge("delta_nav", nav(spark, 7, DAYS[1:3], "U1"))  # in between
    assert runs == [1, 1, 2]
    found = {(r["date"], r["client_account_id"]): r["ending_value"] for r in warehouse.read("delta_nav").collect()}
    assert found == {
        **{(d, "U0"): 1.0 for d in DAYS[2:]}, **{(d, "U0"): 5.0 for d in DAYS[:2]}, **{(d, "U1"): 7.0 for d in DAYS[1:3]},
    }


def test_merges_of_different_partitions_do_not_repeat(warehouse, spark, monkeypatch):
    runs, write = [], Transaction._write
    monkeypatch.setattr(Transaction, "_write", lambda self, *a: (runs.append(1), write(self, *a)))
    with warehouse.transaction() as late:
        warehouse.merge("delta_nav", nav(spark, 5, DAYS[:2]), transaction=late)
        warehouse.merge("delta_nav", nav(spark, 7, DAYS[3:]))
    assert len(runs) == 2 and values(warehouse) == dict(zip(DAYS, (5.0, 5.0, 1.0, 7.0, 7.0), strict=True))


def test_many_writers_lose_nothing(warehouse, spark):
    def write(n):
        warehouse.merge("delta_nav", nav(spark, n, DAYS[:1], f"W{n}"))

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = {r["client_account_id"] for r in warehouse.read("delta_nav", end=DAYS[0]).collect()}
    assert found == {"U0", "W0", "W1", "W2", "W3"}
    assert warehouse.published.state().number == 5


def test_tables_of_a_transaction_change_together(warehouse, spark):
    before = warehouse.published.state()
    with pytest.raises(ValueError, match="null date"):
        with warehouse.transaction() as both:
            warehouse.merge("calendar", spark.createDataFrame([(d,) for d in DAYS], "date date"), transaction=both)
            warehouse.merge("delta_nav", nav(spark, 9, [None]), transaction=both)
    assert warehouse.read("calendar").isEmpty() and warehouse.published.state() == before
    with warehouse.transaction() as both:
        warehouse.merge("calendar", spark.createDataFrame([(d,) for d in DAYS], "date date"), transaction=both)
        warehouse.merge("delta_nav", nav(spark, 9), transaction=both)
        assert warehouse.read("calendar").isEmpty()
    assert warehouse.read("calendar").count() == len(DAYS) and set(values(warehouse).values()) == {9.0}
    assert warehouse.published.state().number == before.number + 1
    # a reader that holds on to the step before still sees its rows
    assert {r["ending_value"] for r in warehouse.read("delta_nav", state=before).collect()} == {1.0}


def test_put_if_absent_keeps_what_is_there(warehouse):
    folder = warehouse.published.folder
    assert folder.put_if_absent("some/name.json", "one") and not folder.put_if_absent("some/name.json", "two")
    assert folder.read("some/name.json") == "one" and folder.names("some") == ["name.json"]


def test_vacuum_keeps_live_and_recent_folders(warehouse, spark):
    for n in range(2, 5):
        warehouse.merge("delta_nav", nav(spark, n))
    assert warehouse.vacuum() == [] and warehouse.vacuum(keep_steps=1) == []  # too young
    gone = warehouse.vacuum(keep_steps=1, older_than=0)
    assert len([g for g in gone if g.startswith("delta_nav/")]) == 3 and folders(warehouse) == len(DAYS)
    assert values(warehouse) == dict.fromkeys(DAYS, 4.0)
    warehouse.merge("delta_nav", nav(spark, 5))
    assert values(warehouse) == dict.fromkeys(DAYS, 5.0)


def test_stored_keys_can_be_checked(warehouse):
    assert warehouse.key_violations("delta_nav").isEmpty()
    live = warehouse.published.live(warehouse.published.state(), "delta_nav")
    folder = f"{warehouse.path('delta_nav')}/gen={live[str(DAYS[0])]}/date={DAYS[0]}"
    one = warehouse.read("delta_nav", DAYS[0], DAYS[0]).drop("date")
    one.write.mode("append").parquet(folder)  # by hand
    assert [r["n_rows"] for r in warehouse.key_violations("delta_nav").collect()] == [2]

"""A reload by field: what it moves and keeps on disk, and its values."""

from __future__ import annotations

import datetime as dt
import gzip
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyfolio.catalog.queries import all_queries
from tallyfolio.functions.columns import compact_date, number
from tallyfolio.operators.merge import survivors
from tallyfolio.session import kept_in_shares, kept_while, shared_dir
from tallyfolio.sources import reports

HEADER = "ReportDate,ClientAccountID,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,MarkPrice,Quantity,FXRateToBase"


def _land(path: Path, *rows: tuple[str, str, str], at: int = 1_700_000_000, packed: bool = False) -> None:
    """Positions (symbol, price, quantity) of one day and account, in a file of that age."""
    lines = [HEADER, *[f"20240102,U0,STK,ETF,,,,{symbol},{price},{quantity},1" for symbol, price, quantity in rows]]
    path.parent.mkdir(parents=True, exist_ok=True)
    text = ("\n".join(lines) + "\n").encode()
    path.write_bytes(gzip.compress(text) if packed else text)
    os.utime(path, (at, at))


def _zones(root: Path) -> reports.Landing:
    _land(root / "history-files/x/positions.csv", ("S0", "1", "1"), ("S1", "1", "1"), ("", "3", ""), at=1_700_000_500)
    _land(root / "backfill-files/a/f/b-positions.csv", ("S0", "2", ""), ("S1", "", "7"), ("S1", "", "9"), ("S1", "", "8"))
    # as old as the other, behind it by path
    _land(root / "backfill-files/a/f/c-positions.csv", ("S1", "5", "4"), ("", "", "6"))
    _land(root / "daily-files/d/f/z-positions.csv", ("S0", "", "3"), ("S2", "", ""), at=1_700_000_900)
    return reports.Landing(str(root))


def test_fields_survive_by_time_then_path(spark, tmp_path):
    found = reports.read_all_zones(spark, _zones(tmp_path), "positions", by_field=True)
    got = {r["symbol"]: (r["mark_price"], r["quantity"], r["sub_category"]) for r in found.collect()}
    assert got == {"S0": (1.0, 3.0, "ETF"), "S1": (1.0, 1.0, "ETF"), "S2": (None, None, "ETF"), None: (3.0, 6.0, "ETF")}
    os.utime(tmp_path / "history-files/x/positions.csv", (1, 1))
    found = reports.read_all_zones(spark, reports.Landing(str(tmp_path)), "positions", by_field=True)
    got = {r["symbol"]: (r["mark_price"], r["quantity"]) for r in found.collect()}
    assert got == {"S0": (2.0, 3.0), "S1": (5.0, 4.0), "S2": (None, None), None: (3.0, 6.0)}


def test_rows_move_without_their_paths(spark, tmp_path):
    found = reports.read_all_zones(spark, _zones(tmp_path), "positions", by_field=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    moved, read = plan.split("Exchange hashpartitioning", 1)
    partial = read.split("BroadcastHashJoin", 1)[0]
    assert "file_place" in partial and partial.count("partial_max(") == 8
    # one partial value a column, and neither path nor time beside it
    for text in (moved, partial.split("Project", 1)[0]):
        assert "file_path" not in text and "file_time" not in text and "max_by" not in text


def test_places_of_repeated_and_spaced_names(spark, tmp_path):
    for name, at in (("b c%25.csv", 50), ("a.csv", 50), ("z.csv", 10)):
        _land(tmp_path / name, ("S0", "1", "1"), at=at)
    globs = [f"{tmp_path}/*.csv", f"{tmp_path}/a.csv"]
    rows = reports.read_csv(spark, globs[0], with_origin=True).select("file_path").distinct()
    got = rows.join(reports.file_places(spark, globs), "file_path").orderBy("file_place").collect()
    assert [r["file_path"].rsplit("/", 1)[1][0] for r in got] == ["z", "a", "b"]
    assert [r["file_place"] for r in got] == [0, 1, 2]


def test_ties_and_origins(spark):
    rows = [("k", 1, "f1", 1.0), ("k", 1, "f2", 3.0), ("k", 1, "f0", 2.0), ("k", 0, "f9", 9.0), ("n", None, "f1", 4.0), ("n", None, "f2", None)]
    df = spark.createDataFrame(rows, "id string, place int, file string, a double")
    assert sorted(map(tuple, survivors(df, ["id"], ["place"], "file").collect())) == [("k", 3.0, "f2"), ("n", 4.0, "f1")]


def test_compressed_reports_are_read_by_their_layout(spark, tmp_path):
    raw = spark.createDataFrame([("20240102", f"U{i}", "STK", "ETF", 'a "x", y', None, None, f"S{i}", "1.5", "", "1") for i in range(50)], ", ".join(f"{c} string" for c in HEADER.split(",")))
    landing = reports.Landing(str(tmp_path))
    path = landing.daily(dt.date(2024, 1, 2), "f", "positions")
    reports.land_report(raw.repartition(1), path, compressed=True)
    parts = [p for p in Path(path).iterdir() if p.name.startswith("part-")]
    assert [p.suffixes for p in parts] == [[".csv", ".gz"]]
    other = landing.daily(dt.date(2024, 1, 3), "f", "positions")
    reports.land_report(raw.select(*reversed(raw.columns)), other)
    got = reports.read_all_zones(spark, landing, "positions")
    assert got.count() == 50 and {tuple(r) for r in got.select("description", "mark_price", "quantity").collect()} == {('a "x", y', 1.5, None)}
    listed = {r["path"] for r in reports.list_source_files(spark, landing.root).collect()}
    assert any(p.endswith(".csv.gz") for p in listed) and any(p.endswith(".csv") for p in listed)
    _land(tmp_path / "daily-files/d/f/lacks-positions.csv/part-0.csv.gz", packed=True)
    Path(tmp_path / "daily-files/d/f/lacks-positions.csv/part-0.csv.gz").write_bytes(gzip.compress(HEADER.removeprefix("ReportDate,").encode() + b"\n"))
    with pytest.raises(ValueError, match="no column ReportDate"):
        reports.read_all_zones(spark, landing, "positions")


def _shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_shares_are_the_whole_and_leave_no_shuffle(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 7 > 0 THEN concat('k', id % 501) END k", "id % 3 g", "id").groupBy("k", "g").agg(F.sum("id").alias("n"))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, there = spark.conf.get(setting, None), _shuffle_files(spark)
    got = kept_in_shares(df, "shares", ["k"], 4)
    for _ in range(40):
        if not (left := _shuffle_files(spark) - there):
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(setting, None) == was
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert kept_in_shares(df.limit(0), "shares", ["k"], 2).isEmpty()
    with pytest.raises(ValueError, match="floating-point x"):
        kept_in_shares(spark.range(1).selectExpr("cast(id AS double) x"), "shares", ["x"], 2)


def test_rows_kept_for_a_block_are_removed(spark):
    with kept_while(spark.range(5).toDF("id"), "block") as rows:
        assert rows.count() == 5
        place = Path(rows.inputFiles()[0].removeprefix("file://")).parent
        assert place.exists()
    assert not place.exists()
    with pytest.raises(ZeroDivisionError), kept_while(spark.range(5).toDF("id"), "block") as rows:
        place = Path(rows.inputFiles()[0].removeprefix("file://")).parent
        raise ZeroDivisionError
    assert not place.exists()


def test_reload_query_keeps_little(spark, tmp_path):
    lines = [(i, i % 7, i % 3, i % 4, float(i % 50 + 1), 100.0 * (i % 9 + 1), 0.5, 0.25, "R" if i % 5 == 0 else "N", "O", dt.datetime(2024, 1, 2 + i % 5)) for i in range(1, 400)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    there = set(Path(shared_dir(spark).removeprefix("file://"), "tallyfolio").glob("*"))
    got = {r["trade_id"]: (r["trade_price"], r["quantity"], r["ib_commission"]) for r in all_queries()["reload_survivors"](spark, str(tmp_path)).collect()}
    want = {}
    for key, part, supplier, line, quantity, price, _, tax, flag, *_ in lines:
        third = len(name := f"{key}-{line}-{part}-{supplier}") % 3
        want[name] = (12.5 if third == 0 else price // 100 + 1, -quantity if flag == "R" else quantity, 0.75 if third < 2 else tax)
    assert got == want
    made = set(Path(shared_dir(spark).removeprefix("file://"), "tallyfolio").glob("*")) - there
    assert not [p for p in made if p.name.startswith("raw-")]
    landed = [p for folder in made for p in folder.rglob("part-*") if "-files" in str(p)]
    assert landed and all(p.suffix == ".gz" for p in landed)


def test_texts_are_parsed_once_and_strictly(spark):
    df = spark.createDataFrame([("20240102", "1.5"), (None, " "), (None, None), ("20240229", "-0")], "d string, n string")
    got = [tuple(r) for r in df.select(compact_date(F.col("d")), number(F.col("n"))).collect()]
    assert got == [(dt.date(2024, 1, 2), 1.5), (None, None), (None, None), (dt.date(2024, 2, 29), 0.0)]
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for on in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", on)
            for column, parsed in (("20240230", compact_date), ("1.5x", number)):
                with pytest.raises(Exception, match="cannot read|CAST_INVALID_INPUT|CANNOT_PARSE"):
                    spark.createDataFrame([(column,)], "c string").select(parsed(F.col("c"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    plan = df.select(number(F.col("n")).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" as double)") - plan.count("NullType) as double)") == 1

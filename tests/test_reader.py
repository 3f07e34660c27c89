"""Files that differ in layout or quoting; batches side by side; folders pruned by period."""

from __future__ import annotations

import datetime as dt

import pytest

from tallyfolio.sources import reports
from tallyfolio.sources.reports import Landing
from tallyfolio.sources.tables import Warehouse
from tallyfolio.streaming.pickup import pick_up

HEADER = "FromDate,ToDate,ClientAccountID,StartingValue,EndingValue,DepositsWithdrawals,Dividends"


def _file(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def _values(df):
    return sorted((r["client_account_id"], r["ending_value"], r["deposits_withdrawals"]) for r in df.collect())


def test_inner_header_in_another_spelling(spark, tmp_path):
    quoted = ",".join(f'"{c}"' for c in HEADER.split(","))
    _file(tmp_path / "a.csv", HEADER, "20240102,20240102,U0,1,2,3,4", quoted, "20240102,20240102,U1,1,5,6,4")
    got = reports.read_report(spark, str(tmp_path / "*.csv"), "delta_nav")
    assert _values(got) == [("U0", 2.0, 3.0), ("U1", 5.0, 6.0)]


def test_layouts_side_by_side(spark, tmp_path):
    _file(tmp_path / "a.csv", HEADER, "20240102,20240102,U0,1,2,3,4")
    _file(tmp_path / "b.csv", "ClientAccountID,Extra," + HEADER.replace("ClientAccountID,", ""), 'U1,"x, ""y""",20240102,20240102,1,5,6,4')
    got = reports.read_report(spark, str(tmp_path / "*.csv"), "delta_nav", with_origin=True)
    assert _values(got) == [("U0", 2.0, 3.0), ("U1", 5.0, 6.0)]
    assert {r["file_path"].rpartition("/")[2] for r in got.collect()} == {"a.csv", "b.csv"}


def test_three_layouts_are_one_scan(spark, tmp_path):
    names = HEADER.split(",")
    row = dict(zip(names, ["20240102", "20240102", "U0", "1", "2", "3", "4"], strict=True))
    for i, order in enumerate((names, names[::-1], ["Note", *names[3:], *names[:3]])):
        own = row | {"ClientAccountID": f"U{i}", "Note": f'"line {i}, ""x"""'}
        lines = [",".join(own[c] for c in order)] * 2
        _file(tmp_path / "in" / f"{i} %25.csv", ",".join(order), lines[0], "", ",".join(order) + "  ", lines[1])
    (tmp_path / "in" / "empty.csv").write_text("")
    got = reports.read_report(spark, str(tmp_path / "in" / "*.csv"), "delta_nav")
    assert _values(got) == [("U0", 2.0, 3.0)] * 2 + [("U1", 2.0, 3.0)] * 2 + [("U2", 2.0, 3.0)] * 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") + plan.count("Scan text") == 1 and "FileScan csv" not in plan


def test_line_of_another_width_fails(spark, tmp_path):
    _file(tmp_path / "a.csv", HEADER, "20240102,20240102,U0,1,2,3,4")
    _file(tmp_path / "b.csv", "Extra," + HEADER, "x,20240102,20240102,U1,1,5,6,4", "20240102,20240102,U1,1,5,6,4")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        reports.read_report(spark, str(tmp_path / "*.csv"), "delta_nav").collect()


def test_headers_are_read_by_their_first_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reports, "HEADER_BYTES", 7)
    _file(tmp_path / "a" / "part-0.csv", HEADER, "20240102,20240102,U0,1,2,3,4")
    _file(tmp_path / "a" / "_SUCCESS")
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbfx,y\r\n1,2\r\n")
    found = reports.file_headers(spark, [str(tmp_path / "a"), str(tmp_path / "*.csv")])
    assert {k.rpartition("/")[2]: v for k, v in found.items()} == {"part-0.csv": HEADER, "b.csv": "x,y"}


@pytest.mark.parametrize("missing", ["ClientAccountID", "DepositsWithdrawals"])
def test_missing_column_names_the_file(spark, tmp_path, missing):
    _file(tmp_path / "a.csv", HEADER, "20240102,20240102,U0,1,2,3,4")
    _file(tmp_path / "broken.csv", HEADER.replace(missing, "Other"), "20240102,20240102,U1,1,5,6,4")
    with pytest.raises(ValueError, match=f"broken.csv has no column {missing}"):
        reports.read_report(spark, str(tmp_path / "*.csv"), "delta_nav")


def test_doubled_quotes_and_commas(spark, tmp_path):
    header = "ReportDate,ClientAccountID,AssetClass,SubCategory,Description,CUSIP,ISIN,Symbol,MarkPrice,Quantity,FXRateToBase"
    texts = ['Plain ""C"" Inc', 'Fund ""A, B"" Inc', "Ends in a backslash\\"]
    rows = [f'20240102,U0,STK,ETF,"{t}",1,US,S{i},100,10,1' for i, t in enumerate(texts)]
    _file(tmp_path / "in" / "positions.csv", header, *rows)
    raw = reports.read_csv(spark, str(tmp_path / "in" / "positions.csv"))
    want = ['Plain "C" Inc', 'Fund "A, B" Inc', "Ends in a backslash\\"]
    assert [r["Description"] for r in raw.orderBy("Symbol").collect()] == want
    reports.land_report(raw, str(tmp_path / "out"))
    again = reports.read_csv(spark, str(tmp_path / "out"))
    assert [r["Description"] for r in again.orderBy("Symbol").collect()] == want


def _nav(spark, day, value):
    return spark.createDataFrame([(day, "U0", value)], "date date, client_account_id string, ending_value double")


def test_two_stages_of_one_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    day = dt.date(2024, 1, 2)
    first, path = warehouse.stage("delta_nav", _nav(spark, day, 1.0))
    second, other = warehouse.stage("delta_nav", _nav(spark, day, 2.0))
    assert path != other
    assert [r["ending_value"] for r in first.collect()] == [1.0]
    warehouse.drop_stage(path)
    assert [r["ending_value"] for r in second.collect()] == [2.0]


def test_period_prunes_folders(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), grain="month")
    for month in (1, 2, 3):
        warehouse.merge("delta_nav", _nav(spark, dt.date(2024, month, 5), float(month)))
    bounded = warehouse.read("delta_nav", dt.date(2024, 2, 1), dt.date(2024, 2, 28))
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "period" in filters and "2024-02-01" in filters
    assert [r["ending_value"] for r in bounded.collect()] == [2.0]


@pytest.mark.parametrize("grain", ["month", "year", None])
def test_sql_reads_the_periods_of_its_dates_only(spark, tmp_path, grain):
    warehouse = Warehouse(spark, str(tmp_path), grain=grain)
    days = [dt.date(y, m, 5) for y in (2022, 2023, 2024) for m in (2, 11)]
    for day in days:
        warehouse.merge("delta_nav", _nav(spark, day, float(day.month)))
    query = "SELECT date, ending_value FROM {delta_nav} WHERE date >= :d"
    whole = warehouse.sql("SELECT date FROM {delta_nav}")
    assert sorted(r["date"] for r in whole.collect()) == days
    # what the condition excludes can't be read any more
    for path in tmp_path.glob("delta_nav/*/*/*.parquet"):
        if "=2024" not in str(path):
            path.write_bytes(b"gone")
    found = warehouse.sql(query, {"d": dt.date(2024, 2, 1)})
    assert sorted(map(tuple, found.collect())) == [(dt.date(2024, 2, 5), 2.0), (dt.date(2024, 11, 5), 11.0)]
    joined = warehouse.sql("SELECT a.date FROM {delta_nav} a JOIN {delta_nav} b USING (date) WHERE a.date BETWEEN :a AND :b AND b.date BETWEEN :a AND :b",
                           {"a": dt.date(2024, 2, 1), "b": dt.date(2024, 3, 1)})
    assert [tuple(r) for r in joined.collect()] == [(dt.date(2024, 2, 5),)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert ("dynamicpruning" in filters) if grain else ("date" in filters)


def test_backlog_with_a_correction(spark, tmp_path):
    import os

    landing, warehouse = Landing(str(tmp_path / "landing")), Warehouse(spark, str(tmp_path / "core"))
    for n, value in ((2, 10), (3, 20)):
        day = dt.date(2024, 1, n)
        path = tmp_path / "landing" / "daily-files" / str(day) / "f" / f"{day}-f-delta_nav.csv"
        _file(path, HEADER, f"20240102,20240102,U0,1,{value},3,4")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    columns = HEADER.split(",")
    pick_up(warehouse, landing, "delta_nav", columns, checkpoint=str(tmp_path / "check")).awaitTermination()
    assert [r["ending_value"] for r in warehouse.read("delta_nav").collect()] == [20.0]

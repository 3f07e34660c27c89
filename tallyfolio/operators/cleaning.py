"""Raw report rows to typed core rows. Narrow transformations only: no shuffle, one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfolio.functions.columns import compact_date, number
from tallyfolio.schemas import CORE_TABLES, EXECUTIONS, REPORT_COLUMNS


def drop_header_rows(df: DataFrame, column: str = "ClientAccountID") -> DataFrame:
    """Drop header lines repeated inside a file; rows without an account id go too."""
    return df.filter(F.col(column) != F.lit(column))


def pick_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep and rename the mapped columns. A missing one is an error, extra ones drop."""
    return df.select([F.col(f"`{raw}`").alias(core) for raw, core in mapping.items()])


def parse_dates(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: compact_date(F.col(c), c) for c in columns})


def empty_to_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns})


def parse_numbers(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema`` in its order, doubles parsed strictly, and those to ``keep``."""
    return df.select(
        *[
            number(F.col(f.name), f.name).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *keep,
    )


# The cleaners take raw report rows; columns named in ``keep`` pass through untouched.


def _report_rows(df: DataFrame, report: str, keep: Sequence[str]) -> DataFrame:
    return pick_columns(drop_header_rows(df), {**REPORT_COLUMNS[report], **{c: c for c in keep}})


def clean_positions(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    rows = parse_dates(_report_rows(df, "positions", keep), "report_date")
    return parse_numbers(rows, CORE_TABLES["positions"].schema, keep)


def clean_trades(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Executions only: rows that are no plain buy or sell are not even parsed."""
    rows = _report_rows(df, "trades", keep).filter(F.col("buy_sell").isin(*EXECUTIONS))
    return parse_numbers(parse_dates(rows, "report_date"), CORE_TABLES["trades"].schema, keep)


def clean_dividends(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Dividends on their ex-date; accrual rows on other days drop."""
    rows = empty_to_null(_report_rows(df, "dividends", keep), "ex_date", "pay_date")
    rows = parse_dates(rows, "report_date", "ex_date", "pay_date")
    on_ex_date = rows.filter(F.col("ex_date") == F.col("report_date"))
    return parse_numbers(on_ex_date, CORE_TABLES["dividends"].schema, keep)


def clean_delta_nav(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Single-day rows only; a report over several days is a summary of them."""
    rows = parse_dates(_report_rows(df, "delta_nav", keep), "from_date", "to_date")
    single_day = rows.filter(F.col("from_date") == F.col("to_date"))
    return parse_numbers(single_day.withColumnRenamed("to_date", "date"), CORE_TABLES["delta_nav"].schema, keep)


CLEANERS = {
    "positions": clean_positions,
    "trades": clean_trades,
    "dividends": clean_dividends,
    "delta_nav": clean_delta_nav,
}

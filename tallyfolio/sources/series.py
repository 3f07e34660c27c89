"""Market series: prices and yields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfolio.functions.columns import nan_to_null


def prices_wide_to_long(
    df: DataFrame,
    date: str,
    fields: Mapping[str, str],
    tickers: Sequence[str],
    separator: str = "|",
) -> DataFrame:
    """Columns ``{field}{separator}{ticker}`` to rows ``(date, ticker, *fields)``.

    Each row unfolds in place, so nothing is shuffled. ``fields`` maps source field to name.
    """
    rows = [
        F.struct(
            F.lit(ticker).alias("ticker"),
            *[F.col(f"`{field}{separator}{ticker}`").alias(name) for field, name in fields.items()],
        )
        for ticker in tickers
    ]
    return df.select(date, F.inline(F.array(*rows)))


PRICE_COLUMNS = {c: c for c in ("date", "ticker", "adjusted_close", "dividends_per_share")}
"""For prices that have their core names already."""


def clean_prices(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Price history as ``(date, ticker, adjusted_close, dividends_per_share)``."""
    # Column names of the price source.
    mapping = mapping or {
        "Date": "date",
        "Ticker": "ticker",
        "Close": "adjusted_close",
        "Dividends": "dividends_per_share",
    }
    picked = df.select([F.col(f"`{source}`").alias(name) for source, name in mapping.items()])
    return picked.withColumns(
        {
            "date": F.col("date").cast("date"),
            "adjusted_close": nan_to_null(F.col("adjusted_close")),
            "dividends_per_share": nan_to_null(F.col("dividends_per_share")),
        }
    )


def clean_yields(df: DataFrame, series: str | None = None) -> DataFrame:
    """Yield history as ``(date, series_id, yield)`` in percent, gaps as NULL."""
    named = df if series is None else df.withColumn("series_id", F.lit(series))
    return named.select(
        F.col("date").cast("date").alias("date"),
        "series_id",
        nan_to_null(F.col("yield").cast("double")).alias("yield"),
    )

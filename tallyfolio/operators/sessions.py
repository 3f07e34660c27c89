"""Trading sessions.

A calendar has one row per session, some 250 a year, so it is bounded by the years covered and
not by the data. That bound is what makes its broadcast and its ordered windows safe.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def trading_days(
    spark: SparkSession, start: dt.date, end: dt.date, holidays: DataFrame | None = None
) -> DataFrame:
    """Weekdays in the closed range that are no holiday; ``holidays`` has a ``date`` column."""
    span = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return drop_closed_days(spark.range(1).select(F.explode(span).alias("date")), holidays)


def drop_closed_days(dates: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Keep the days of ``date`` an exchange opens on."""
    weekdays = dates.filter(F.weekday("date") < 5)
    if holidays is None:
        return weekdays
    return weekdays.join(holidays.select("date"), "date", "left_anti")


def on_sessions(df: DataFrame, calendar: DataFrame, column: str = "date") -> DataFrame:
    """Rows dated on a session. A semi join: the calendar adds no column and repeats no row.

    The broadcast is of distinct dates, so it is small whatever the calendar was made from.
    """
    sessions = calendar.select(F.col("date").alias(column)).distinct()
    return df.join(F.broadcast(sessions), column, "left_semi")


def last_session(calendar: DataFrame, reference: dt.date) -> DataFrame:
    """One row: the latest session on or before ``reference``, NULL if there is none."""
    return calendar.filter(F.col("date") <= F.lit(reference)).agg(F.max("date").alias("date"))


def last_market_date(calendar: DataFrame, reference: dt.date) -> dt.date:
    found = last_session(calendar, reference).first()["date"]
    if found is None:
        raise ValueError(f"no session up to {reference}")
    return found


def with_previous_session(calendar: DataFrame, exchange: str = "exchange") -> DataFrame:
    """Each session with the one before it on the same exchange."""
    by_date = Window.partitionBy(exchange).orderBy("date")
    return calendar.withColumn("previous_date", F.lag("date").over(by_date))


def monthly_intervals(
    calendar: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """First and last session of every calendar month, clipped to the range."""
    sessions = calendar
    if start is not None:
        sessions = sessions.filter(F.col("date") >= F.lit(start))
    if end is not None:
        sessions = sessions.filter(F.col("date") <= F.lit(end))
    month = F.trunc("date", "month").alias("month")
    return sessions.groupBy(month).agg(F.min("date").alias("from_date"), F.max("date").alias("to_date"))

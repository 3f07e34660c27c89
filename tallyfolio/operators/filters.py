"""Row filters and distinct unions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_scope(df: DataFrame, scope: Sequence[str], column: str = "sub_category") -> DataFrame:
    return df.filter(F.col(column).isin(*scope))


def date_range(column: Column, start: dt.date | None, end: dt.date | None) -> Column:
    """Closed range test; an absent bound is open."""
    test = F.lit(True)
    if start is not None:
        test = test & (column >= F.lit(start))
    if end is not None:
        test = test & (column <= F.lit(end))
    return test


def between_dates(df: DataFrame, column: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    return df if start is None and end is None else df.filter(date_range(F.col(column), start, end))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    """Whole-row distinct union. Copies collapse on the map side first, so however often a row is
    repeated a task ships it once."""
    return union_all(frames).distinct()

"""Row-to-row operators over ordered keys.

Every window here is partitioned by a key and ordered by a date, on inputs whose primary key is
(date, key...). A group therefore has one row per day at most (some 10,000 rows in 40 years),
however the rows are spread over keys: no group can grow with the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous(column: str, keys: Sequence[str], order: str) -> Column:
    """Value of the row before, by row and not by date: a gap is bridged."""
    return F.lag(column).over(Window.partitionBy(*keys).orderBy(order))


def with_previous(
    df: DataFrame, keys: Sequence[str], order: str, columns: Mapping[str, str], own_if_none: bool = True
) -> DataFrame:
    """Add the previous row's value for each ``source -> name`` in ``columns``.

    Where there is no previous row, or it held NULL, the row's own value stands in. All columns
    share one window, hence one shuffle and one sort.
    """
    added = {}
    for source, name in columns.items():
        value = previous(source, keys, order)
        added[name] = F.coalesce(value, F.col(source)) if own_if_none else value
    return df.withColumns(added)


# Keys up to this many are broadcast to the scan of history, after counting them.
BROADCAST_KEYS = 500_000


def last_per_key(
    df: DataFrame, keys: Sequence[str], order: Column | str, columns: Sequence[str]
) -> DataFrame:
    """``columns`` of the latest row per key, as an aggregate.

    One ``max_by`` a column and not one over a struct: fixed-width buffers are hashed, a struct
    would have to be sorted by key first.
    """
    return df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in columns])


def last_before(
    rows: Callable[[dt.date | None, dt.date], DataFrame],
    keys: Sequence[str],
    order: Column | str,
    columns: Sequence[str],
    start: dt.date,
    wanted: DataFrame,
    look_back_days: int | None = None,
) -> DataFrame:
    """``columns`` of the latest row before ``start``, of the keys in ``wanted`` and maybe others.

    ``rows(first, last)`` gives the rows of a closed range. With ``look_back_days`` the days just
    before ``start`` are searched first. The keys not found there are counted: if
    there are none the rest of history is not read, if they are few they are broadcast and cut it
    down where it is read, and if they are many it is joined with them by shuffle.
    """
    day_before = start - dt.timedelta(days=1)
    if look_back_days is None:
        return last_per_key(rows(None, day_before), keys, order, columns)
    horizon = start - dt.timedelta(days=look_back_days)
    kept = rows(horizon, day_before)
    missing = wanted.join(kept.select(*keys).distinct(), list(keys), "left_anti")
    n_missing = missing.count()
    if n_missing > 0:
        among = F.broadcast(missing) if n_missing <= BROADCAST_KEYS else missing
        far = rows(None, horizon - dt.timedelta(days=1)).join(among, list(keys), "left_semi")
        kept = kept.unionByName(far)
    return last_per_key(kept, keys, order, columns)


def pct_change(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Change against the latest earlier non-null value; NULL where there is none.

    A NULL value is taken as unchanged, so the change on its own row is 0 once a value was seen.
    """
    by_date = Window.partitionBy(*keys).orderBy(order)
    filled = F.last(value, ignorenulls=True).over(by_date.rowsBetween(Window.unboundedPreceding, 0))
    earlier = F.last(value, ignorenulls=True).over(by_date.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(name, filled / F.nullif(earlier, F.lit(0.0)) - 1)


def backfill_nulls(df: DataFrame, keys: Sequence[str], order: str, *columns: str) -> DataFrame:
    """Replace NULL by the next non-null value; trailing NULLs stay.

    The descending order lets the frame grow row by row. The ascending frame from the current
    row to the end says the same but rescans the rest of the group for every row.
    """
    newest_first = (
        Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    )
    return df.withColumns({c: F.last(c, ignorenulls=True).over(newest_first) for c in columns})

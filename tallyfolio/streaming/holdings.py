"""Holding returns from a stream of day rows, with corrections of older days.

The stream is a log of merged day rows (``plans.holdings.holding_base_merge``), each new, corrected or ``gone``, in any order of
days. State is kept by holding: its rows so far, one a day, so it is bounded by the days of history; rows of many
trades are sums before they get here. A row that comes says again what its own day compares with, and what the holding's
*next* day does. Both are put out with the values of the row before, and the sink takes the last word on each key.

A run takes what is new and stops. The checkpoint holds the state and the files taken, so the next run, or
one after a crash, goes on from there; a batch that is repeated writes the same folder again.
"""

from __future__ import annotations

import datetime as dt
import pickle
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyfolio.operators.sessions import on_sessions
from tallyfolio.plans import holdings
from tallyfolio.plans.holdings import HOLDING, KEY

VALUES = [
    "fx_rate_1", "shares_1", "price_1", "dividends", "dividends_per_share", "shares_traded", "average_trade_price", "shares_kept",
]
LAGGED = {"fx_rate_1": "fx_rate_0", "shares_1": "shares_0", "price_1": "price_0"}
LOG = T.StructType(
    [
        T.StructField("report_date", T.DateType()),
        *(T.StructField(n, T.StringType()) for n in HOLDING),
        *(T.StructField(n, T.DoubleType()) for n in VALUES),
        T.StructField("gone", T.BooleanType()),
        T.StructField("version", T.LongType()),
    ]
)
"""Of several rows of a key in one batch the one of the highest version counts."""
_OUT = T.StructType(
    [*LOG.fields[:-2], *(T.StructField(n, T.DoubleType()) for n in LAGGED.values()), T.StructField("gone", T.BooleanType())]
)
_STATE = T.StructType([T.StructField("rows", T.BinaryType())])


class Days:
    """One holding's rows by day."""

    def __init__(self, rows: dict[dt.date, tuple] | None = None):
        self.rows = rows or {}
        self.order = sorted(self.rows)

    def put(self, day: dt.date, values: tuple | None) -> list[dt.date]:
        """Set a day's row, or take it away. Returns the days that compare otherwise now: its own and the next."""
        at = bisect_left(self.order, day)
        known = at < len(self.order) and self.order[at] == day
        following = self.order[at + known : at + known + 1]
        if values is None:
            if known:
                del self.rows[day], self.order[at]
        else:
            if not known:
                insort(self.order, day)
            self.rows[day] = values
        return [day, *following]

    def with_previous(self, day: dt.date) -> tuple:
        """The day's row and what it compares with: the row before, its own values where that is absent or empty."""
        own = self.rows[day]
        at = bisect_left(self.order, day)
        before = self.rows[self.order[at - 1]] if at else own
        places = [VALUES.index(name) for name in LAGGED]
        return (*own, *(own[p] if before[p] is None else before[p] for p in places))


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    days = Days(pickle.loads(state.get[0]) if state.exists else None)
    news = pd.concat(list(frames)).sort_values("version", kind="stable")
    touched: set[dt.date] = set()
    for row in news.itertuples(index=False):
        values = tuple(None if pd.isna(x) else float(x) for x in (getattr(row, v) for v in VALUES))
        touched.update(days.put(row.report_date, None if row.gone else values))
    state.update((pickle.dumps(days.rows),))
    account, symbol = key
    out = []
    for day in sorted(touched):
        here = day in days.rows
        out.append((day, account, symbol, *(days.with_previous(day) if here else (None,) * (len(VALUES) + len(LAGGED))), not here))
    made = pd.DataFrame(out, columns=_OUT.fieldNames())
    yield made.astype({c: "float64" for c in (*VALUES, *LAGGED.values())})


def lagged_stream(log: DataFrame) -> DataFrame:
    """Of a stream of day rows: each row whose comparison is new, with the values of the row before."""
    return log.groupBy(*HOLDING).applyInPandasWithState(_update, _OUT, _STATE, "update", GroupStateTimeout.NoTimeout)


def follow_holdings(spark: SparkSession, log_root: str, sink_root: str, calendar: DataFrame, checkpoint: str) -> StreamingQuery:
    """Take the new files of the log, put adjusted rows into ``sink_root``, a folder per batch, and stop."""
    log = spark.readStream.schema(LOG).parquet(log_root)

    def write(batch: DataFrame, number: int) -> None:
        lagged = holdings._current_values(batch.filter(~F.col("gone")))
        adjusted = holdings.holding_adjustments(on_sessions(lagged, calendar, "report_date")).withColumn("gone", F.lit(False))
        rows = adjusted.unionByName(batch.filter("gone").select(*KEY, "gone"), allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{sink_root}/batch={number}")

    writer = lagged_stream(log).writeStream.foreachBatch(write).outputMode("update")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def followed_returns(spark: SparkSession, sink_root: str) -> DataFrame:
    """The holding returns as the batches so far leave them: the last word on each key, weights over all of them."""
    rows = spark.read.option("basePath", sink_root).parquet(f"{sink_root}/batch=*")
    newest = Window.partitionBy(*KEY).orderBy(F.col("batch").desc())
    last = rows.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1 AND NOT gone")
    return holdings._output(holdings.holding_weights(last))

"""As-of joins by bins of time.

The right side's rows are gathered by bin of time, whose width bounds how many those are. A bin also carries the last
right row before it, so an empty bin knows as much as a full one. A left row meets the one row of its bin: an
equi-join whose left side adaptive execution can split, however many rows a day has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    seconds: int = 86_400,
) -> DataFrame:
    """``left`` with ``values`` of the latest ``right`` row at or before its time, of the same ``by`` keys. NULL
    where there is none, or the time is NULL. Bins are ``seconds`` wide. Of right rows of one time the largest by ``values`` counts."""

    def bin_of(time: str) -> Column:
        micros = F.unix_micros(F.col(time).cast("timestamp"))
        return (micros - F.pmod(micros, F.lit(seconds * 1_000_000))).alias("__bin")

    row = F.struct(F.col(right_time).cast("timestamp").alias("time"), *[F.col(v).alias(v) for v in values])
    dated = right.filter(F.col(right_time).isNotNull()).select(*by, bin_of(right_time), row.alias("__row"))
    filled = dated.groupBy(*by, "__bin").agg(F.array_sort(F.collect_list("__row")).alias("__rows"))
    keyed = left.withColumn("__bin", bin_of(left_time))
    empty = keyed.select(*by, "__bin").distinct().join(filled.select(*by, "__bin"), [*by, "__bin"], "left_anti")
    bins = filled.unionByName(empty, allowMissingColumns=True)
    # a row per bin of time and key
    before = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.element_at("__rows", -1), ignorenulls=True).over(before)
    bins = bins.withColumn("__carry", carried).withColumn("__key", F.struct(*by, "__bin")).drop(*by, "__bin")
    met = keyed.withColumn("__key", F.struct(*by, "__bin")).join(bins, "__key", "left")
    inside = F.filter("__rows", lambda r: r["time"] <= F.col(left_time).cast("timestamp"))
    found = F.coalesce(F.try_element_at(inside, F.lit(-1)), F.when(F.col(left_time).isNotNull(), F.col("__carry")))
    return met.select(*left.columns, *[found[v].alias(v) for v in values])


def session_as_of(rows: DataFrame, calendar: DataFrame, time: str, name: str = "session") -> DataFrame:
    """Rows with the latest session on or before their time."""
    sessions = calendar.select(F.col("date").alias(name)).distinct()
    return as_of(rows, sessions, time, name, [name])

"""What the operators share: tables in the shared folder, bounded filters, joins that can be split."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfolio.session import shared_dir

FILTER_BITS = 1 << 23
"""Bits of a bounded filter: at most 131,072 rows of 64 bits, about 2 MB, whatever it is built from."""

ARROW_BYTES = 3 << 20
"""Bytes of an Arrow batch of whole texts: an executor holds a few of them per task, whatever the texts' lengths."""

SMALL_ARROW_BYTES = 1 << 20
"""The same where operators follow one another in an application: Python workers outlive them and keep what they once took."""


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder. What is written there goes when the application ends;
    until then results that are read later may depend on it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder. It cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def bounded_filter(keys: DataFrame, key: Column, bits: int = FILTER_BITS) -> DataFrame:
    """A bit per hashed key, as rows (__word, __mask). No key is missed; others may pass by chance, so
    an exact step has to follow. Its size is bounded by ``bits``, not by the number of keys."""
    slot = F.xxhash64(key).bitwiseAND(bits - 1)
    return keys.select(
        F.shiftright(slot, 6).alias("__word"), _bit(slot).alias("__mask")
    ).groupBy("__word").agg(F.bit_or("__mask").alias("__mask"))


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))


def passing(rows: DataFrame, key: Column, bits: DataFrame, size: int = FILTER_BITS, hit: bool = True) -> DataFrame:
    """The rows whose key the filter holds (``hit``), or those whose key it surely lacks. Rows stay
    where they are: the filter is broadcast, which its size bound allows."""
    slot = F.xxhash64(key).bitwiseAND(size - 1)
    match = (F.shiftright(slot, 6) == F.col("__word")) & (F.col("__mask").bitwiseAND(_bit(slot)) != 0)
    return rows.join(F.broadcast(bits), match, "left_semi" if hit else "left_anti")


def only(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key is in ``ids`` (one column of the same name). A bounded filter first, so that
    few other rows are shuffled."""
    bits = bounded_filter(ids, F.col(key))
    return passing(rows, F.col(key), bits).join(ids, key, "left_semi")


def without(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key is not in ``ids``. Those the bounded filter clears are not shuffled."""
    bits = bounded_filter(ids, F.col(key))
    doubtful = passing(rows, F.col(key), bits).join(ids, key, "left_anti")
    return passing(rows, F.col(key), bits, hit=False).unionByName(doubtful)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join rows with one row per group. Both sides are exchanged on a key of their own, so adaptive
    execution can split a hot group, which it can't where an aggregate's layout is reused."""
    left = rows.withColumn("__key", F.struct(*keys))
    right = groups.withColumn("__key", F.struct(*keys)).drop(*keys)
    return left.join(right, "__key", how).drop("__key")


def map_texts(
    rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, most_bytes: int = ARROW_BYTES
) -> DataFrame:
    """``mapInArrow`` whose batches end at ``most_bytes`` (a longer row is one by itself). Spark takes this
    bound from the session when the frame runs, so it stays set there; no result depends on it."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))
    return rows.mapInArrow(function, schema)


def batches(frames: Iterator[pa.RecordBatch], text: str, most_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of about ``most_bytes`` of text each, at least one row."""
    for frame in frames:
        sizes = pa.compute.binary_length(frame.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most_bytes:
                yield frame.slice(begin, i - begin)
                begin, total = i, 0
            total += int(n)
        if begin < frame.num_rows:
            yield frame.slice(begin)

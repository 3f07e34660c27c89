"""Token ids in ORC files: documents in ascending id order, integers run-length encoded by ORC, with row
indexes and a Bloom filter on the document id in every stripe.

Documents are dealt by ranges of their id and sorted within a range; each range is encoded in its order
and written as one file, whose rows tell their place within it. Tokens per file, a table of one row per
file, turn that into a place in the whole corpus. Reading is by stripe, in parallel; a filter on ids
prunes files and stripes by their statistics, and groups of rows by index and Bloom filter.

Null text is empty: its only id is the end id. Null ids come first. Rows that repeat an id are adjacent,
in the order of their texts. A text of any length is one row. An empty table gives empty files. Extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfolio.llm.common import batches, map_texts, text_of
from tallyfolio.llm.tokens import BATCH_BYTES, encoder

SCHEMA = "doc_id long, shard int, place long, n_tokens long, ids array<int>"
_FIELDS = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id: str = "doc_id", text: str = "text"
) -> None:
    """Writes the token files under ``path``."""

    def encode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, place = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for frame in batches(frames, "text", BATCH_BYTES):
            ids, offsets = coder.encode_ended(frame.column("text"), end_id)
            n = np.diff(offsets).astype(np.int64)
            starts = place + offsets[:-1].astype(np.int64)
            place += int(offsets[-1])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [frame.column("doc_id"), pa.array(np.full(len(n), shard, np.int32)), pa.array(starts), pa.array(n), lists], schema=_FIELDS
            )

    narrow = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_texts(ordered, encode, SCHEMA).write.option("orc.bloom.filter.columns", "doc_id").option(
        "orc.create.index", "true"
    ).option("orc.compress", "ZSTD").orc(path)


def read_tokens(spark: SparkSession, path: str, wanted: Column | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; ``wanted``, a condition on doc_id, prunes them. What
    is broadcast has a row of two numbers per file."""
    files = spark.read.schema(SCHEMA).orc(path)
    sums = files.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    bases = sums.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")).alias("base"))
    rows = files if wanted is None else files.filter(wanted)
    return rows.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids")


def ids_crc32(ids: Column) -> Column:
    """crc32 of ids as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("long")
    def crc(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: zlib.crc32(np.asarray(x, "<u4").tobytes()))

    return crc(ids)

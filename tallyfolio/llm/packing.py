"""Packing token pieces into fixed-length sequences, shortest pack first over the length histogram.

Documents are cut into pieces of the sequence length and a rest; a full piece is a sequence. The counts
of rests by length, at most one per possible length, go to the driver. There lengths are placed longest
first: all pieces of a length go into the packs that are shortest so far, as long as they fit, else into
new packs. Packs are never listed: the state is how many packs have each pattern of lengths, so the work
depends on the number of lengths and not of documents.

Each pattern then owns a range of sequence ids, and each length a list of segments: ranks a to b of this
length go, one each, to sequences from s on at offset o. A piece's rank among those of its length is its
place in its salt plus the sizes of the salts before; no length is gathered in one task. Joining rank
and segment gives every piece its sequence and offset.

Null text is empty: a document of the end id alone. Rows that repeat an id are packed once each. An empty
table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.llm.common import SMALL_ARROW_BYTES, batches, join_groups, map_texts, text_of, written
from tallyfolio.llm.tokens import encoder

LENGTH = 2048
SALTS = 256
CACHE_PIECES = 100_000


def histogram_packs(counts: dict[int, int], room: int = LENGTH) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Segments (length, first rank, end rank, first sequence, offset) and the number of sequences.

    A state entry is a run of packs with the same pattern: (first pack, number of packs). Runs are held
    by the space left in them."""
    runs: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []  # ascending
    segments, packs = [], 0

    def put(space: int, run: tuple[int, int]) -> None:
        if space not in runs:
            bisect.insort(spaces, space)
            runs[space] = []
        runs[space].append(run)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if spaces and spaces[-1] >= length:
                space = spaces[-1]
                first, n = runs[space].pop()
                if not runs[space]:
                    del runs[spaces.pop()]
                used = min(n, left)
                if used < n:
                    put(space, (first + used, n - used))
            else:
                space, first, used = room, packs, left
                packs += used
            segments.append((length, rank, rank + used, first, room - space))
            put(space - length, (first, used))
            rank, left = rank + used, left - used
    return segments, packs


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, id: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) and ``ids``: every document's tokens, cut at multiples
    of ``length``."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, CACHE_PIECES)
        for frame in batches(frames, "text", SMALL_ARROW_BYTES):
            ids, offsets = coder.encode_ended(frame.column("text"), end_id)
            n = np.diff(offsets).astype(np.int64)
            parts = -(-n // length)
            row = np.repeat(np.arange(len(n)), parts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            size = np.minimum(length, n[row] - start)
            bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            raw = memoryview(ids.astype("<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(bounds, bounds[1:], strict=False)]
            columns = [frame.column("doc_id").take(pa.array(row)), *map(pa.array, (start, size)), pa.array(crc, pa.int64()), pa.array(n[row])]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [*names, "ids"][: len(columns)])
        pa.default_memory_pool().release_unused()  # the worker stays for what follows

    narrow = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return map_texts(narrow, cut, ", ".join(f"{c} long" for c in names) + ", ids array<int>" * with_ids, SMALL_ARROW_BYTES)


def pack(cuts: DataFrame, room: int = LENGTH) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces; ``cuts`` has doc_id, start and length, at most
    ``room`` each, and should be a table, as it is read several times. Full pieces come first."""
    spark = cuts.sparkSession
    salted = cuts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS)).cast("int"))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))  # at most room * SALTS rows
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written(sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))), "pack-sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = counts.pop(room, 0)
    segments, _ = histogram_packs(counts, room)
    if full:
        segments.append((room, 0, full, -full, 0))
    rows = [(a, b, c, d + full, e) for a, b, c, d, e in segments]
    plan = spark.createDataFrame(rows, "length long, low long, high long, first long, offset long")
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "start")
    placed = salted.withColumn("nth", F.row_number().over(inside) - 1)
    ranked = join_groups(placed, sizes.drop("n"), ["length", "salt"]).withColumn("rank", F.col("base") + F.col("nth"))
    where = F.broadcast(plan.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("low", "high", "first", "offset"))).alias("parts")))
    # a length has few segments; the one with the rank is picked from its list
    found = F.filter("parts", lambda p: (p["low"] <= F.col("rank")) & (F.col("rank") < p["high"]))[0]
    return ranked.join(where, "length").withColumn("p", found).select(
        *cuts.columns, (F.col("p.first") + F.col("rank") - F.col("p.low")).alias("sequence_id"), F.col("p.offset").alias("offset")
    )


def sequences(placed: DataFrame, tokens: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences; ``tokens`` has doc_id, start and ids of the pieces."""
    joined = placed.select("doc_id", "start", "sequence_id", "offset").join(tokens.select("doc_id", "start", "ids"), ["doc_id", "start"])
    parts = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))

"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

A narrow table (id, length in bytes, hash of the first characters) is written once. Lengths that occur
once are settled; of the rest, so are prefixes that occur once within their length. The full content is
hashed for surviving groups only. Both cuts are handed to the scans as bounded filters, so no text is
shuffled to find the copies.

Null text counts as empty; empty texts are copies of one another. Rows that repeat both id and text
count as one document. Ids that repeat with different texts are different documents. A null id is
smaller than any other. An empty table gives no rows. Other columns don't matter and are kept by
``exact_dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfolio.llm.common import bounded_filter, join_groups, passing, text_of, written

PREFIX_CHARS = 256


def _length(text: str) -> Column:
    return F.octet_length(text_of(text)).cast("long")


def _prefix(text: str) -> Column:
    return F.xxhash64(F.substring(text_of(text), 1, PREFIX_CHARS))


def _full(text: str) -> Column:
    return F.sha2(text_of(text), 256)


def _survivors(docs: DataFrame, text: str) -> DataFrame:
    """A bounded filter of the (length, prefix) that more than one row has."""
    keys = written(docs.select(_length(text).alias("length"), _prefix(text).alias("prefix")), "dedup-keys")
    repeated = F.col("n") > 1
    lengths = keys.groupBy("length").agg(F.count("*").alias("n")).filter(repeated)
    left = passing(keys, F.col("length"), bounded_filter(lengths, F.col("length")))
    prefixes = left.groupBy("length", "prefix").agg(F.count("*").alias("n")).filter(repeated)
    return written(bounded_filter(prefixes, F.struct("length", "prefix")), "dedup-filter")


def _candidates(docs: DataFrame, text: str, bits: DataFrame, hit: bool) -> DataFrame:
    return passing(docs, F.struct(_length(text).alias("length"), _prefix(text).alias("prefix")), bits, hit=hit)


def _hashed(docs: DataFrame, id: str, text: str, bits: DataFrame) -> DataFrame:
    rows = _candidates(docs.select(id, text), text, bits, True).select(
        F.col(id).alias("id"), _length(text).alias("length"), _full(text).alias("digest")
    )
    return written(rows.distinct(), "dedup-hashes")


def _groups(hashed: DataFrame) -> DataFrame:
    """Groups of two or more, from sums per task: a group of any size is one row per task."""
    groups = hashed.groupBy("length", "digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    return groups.filter(F.col("group_size") > 1)


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``. Only rows of
    surviving groups are shuffled, as ids and hashes."""
    bits = _survivors(docs, text)
    hashed = _hashed(docs, id, text, bits)
    marked = join_groups(hashed, _groups(hashed), ["length", "digest"])
    copies = marked.select(
        F.col("id").alias(id),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("group_size").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    single = _candidates(docs.select(id, text), text, bits, False).select(
        F.col(id), F.col(id).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        _full(text).alias("text_sha256"),
    )
    return single.unionByName(copies)


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all columns: of equal texts the one with the largest id."""
    bits = _survivors(docs, text)
    groups = _groups(_hashed(docs, id, text, bits))
    rows = _candidates(docs, text, bits, True).select(
        F.struct(*docs.columns).alias("row"), F.col(id).alias("id"), _length(text).alias("length"), _full(text).alias("digest")
    )
    joined = join_groups(rows, groups, ["length", "digest"])
    stay = joined.filter(F.col("group_size").isNull() | F.col("id").eqNullSafe(F.col("keep_id")))
    # repeated rows fall together here; anything else is unique by now
    stay = stay.dropDuplicates(["id", "length", "digest"]).select("row.*")
    return _candidates(docs, text, bits, False).unionByName(stay)

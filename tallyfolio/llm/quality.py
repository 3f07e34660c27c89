"""Quality rules: what a document repeats within itself, and lines its host repeats across documents.

Lines are normalised (lower case, digits as 0, runs of white space as one space), hashed, and counted
per host by the number of distinct documents they are in. A line is boilerplate where that number is at
least ``MIN_DOCUMENTS``, whatever the size of the host. Boilerplate lines are removed; a
document is depleted, and rejected, if less than ``LEFT_PERCENT`` of its words are left.

A document's own pass yields each distinct line once with its words. Rows are counted first, as sums per
host and line with partial sums in each task; a bounded filter of the lines in enough rows then picks those
whose distinct documents are counted, by host, line and document, however common the line. Hosts with a
third of all documents need nothing else, as no host is gathered anywhere.

Null text has no words (and so fails the base rules); a null host is the host ``-``. A null id is a
document like any other. Rows that repeat an id are one document to the counts of lines; their removed words
are summed per row. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfolio.llm.common import batches, bounded_filter, join_groups, map_texts, passing, written
from tallyfolio.llm.textscan import counted, windows, words

MIN_DOCUMENTS = 20
LEFT_PERCENT = 50
LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8

_SPACES = " \t\n\v\f\r"
_BLANK = re.compile(r"[ \t-\r]+")
_DIGIT = re.compile(r"[0-9]")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_LINE = "lines array<struct<line: long, words: int>>"


def line_hash(line: str) -> int:
    """Signed 64-bit hash of a normalised line."""
    plain = _DIGIT.sub("0", _BLANK.sub(" ", line).strip(" ").lower())
    h = xxhash.xxh3_64_intdigest(plain)
    return h - (1 << 64) if h >> 63 else h


def _repeats(hashes: np.ndarray) -> int:
    """Words in windows that occur twice or more."""
    if len(hashes) < WINDOW + 1:
        return 0
    runs = windows(hashes, WINDOW)
    order = np.argsort(runs, kind="stable")
    same = runs[order[1:]] == runs[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _lines(text: str) -> tuple[int, dict[int, int]]:
    """Lines equal to an earlier one; words per distinct normalised line."""
    seen: set[str] = set()
    repeated, found = 0, {}
    for line in text.split("\n"):
        if not line.strip(_SPACES):
            continue
        if line in seen:
            repeated += 1
        seen.add(line)
        h = line_hash(line)
        found[h] = found.get(h, 0) + len(_BLANK.sub(" ", line).strip(" ").split(" "))
    return repeated, found


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: id, host, the base counts, and its distinct lines with their words."""

    def measure(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, "text"):
            w = words(frame.column("text"))
            lead = counted((w.data & 0xC0) != 0x80)
            chars = np.concatenate([[0], np.cumsum(lead[w.end] - lead[w.begin])])
            symbols = counted(_SYMBOL[w.data])
            texts = frame.column("text").to_pylist()
            rows = {k: [] for k in _BASE}
            lines = []
            for i, text in enumerate(texts):
                a, b = w.first[i], w.first[i + 1]
                repeated, found = _lines(text or "")
                values = (b - a, chars[b] - chars[a], symbols[w.offsets[i + 1]] - symbols[w.offsets[i]], repeated, _repeats(w.hash[a:b]))
                for k, v in zip(_BASE, values, strict=True):
                    rows[k].append(int(v))
                lines.append([{"line": k, "words": n} for k, n in found.items()])
            kind = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [frame.column("id"), frame.column("host"), *(pa.array(rows[k], pa.int64()) for k in _BASE), pa.array(lines, kind)],
                ["id", "host", *_BASE, "lines"],
            )

    narrow = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(host), F.lit("-")).alias("host"), F.col(text).alias("text"))
    return map_texts(narrow, measure, f"id long, host string, {', '.join(f'{k} long' for k in _BASE)}, {_LINE}")


def boilerplate(rows: DataFrame) -> DataFrame:
    """(host, line) in enough documents."""
    lines = rows.select("id", "host", F.explode("lines").alias("l")).select("id", "host", "l.line")
    key = F.struct("host", "line")
    often = lines.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_DOCUMENTS)
    some = passing(lines, key, bounded_filter(often, key)).dropDuplicates(["host", "line", "id"])
    counts = some.groupBy("host", "line").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= MIN_DOCUMENTS).select("host", "line")


def quality(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per document: id, the base counts, ``base_failed``, ``kept`` and ``removed_words``."""
    rows = written(measured(docs, id, text, host).withColumn("row", F.monotonically_increasing_id()), "quality-rows")
    bad = written(boilerplate(rows).withColumn("bad", F.lit(True)), "quality-lines")
    used = rows.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    hit = join_groups(used, bad, ["host", "line"], "inner")
    removed = hit.groupBy("row").agg(F.sum("words").alias("removed_words"))
    judged = rows.drop("lines", "host").join(removed, "row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - F.col("removed_words")) < LEFT_PERCENT * F.col("n_words")
    return judged.select(
        F.col("id").alias(id), *_BASE, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "removed_words"
    )


def without_boilerplate(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The documents with boilerplate lines taken out of their text; other columns as they were."""
    rows = written(measured(docs, id, text, host), "quality-rows")
    bad = boilerplate(rows)
    used = rows.select("id", "host", F.explode("lines").alias("l")).select("id", "host", "l.line")
    hit = join_groups(used, bad.withColumn("bad", F.lit(True)), ["host", "line"], "inner")
    drop = hit.groupBy(F.col("id").alias(id)).agg(F.collect_set("line").alias("__drop"))  # a document's own lines

    def strip(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = [
                t if t is None or not d else "\n".join(x for x in t.split("\n") if not x.strip(_SPACES) or line_hash(x) not in d)
                for t, d in zip(frame.column(text).to_pylist(), map(lambda d: set(d or ()), frame.column("__drop").to_pylist()), strict=True)
            ]
            at = frame.schema.get_field_index(text)
            yield frame.set_column(at, frame.schema.field(at), pa.array(texts, frame.schema.field(at).type)).drop_columns(["__drop"])

    return map_texts(docs.join(drop, id, "left"), strip, docs.schema)

"""Ranked lexical search by range-maximum tables over posting lists.

A term is a run of ASCII letters and digits and of other characters above ASCII, A-Z lower-cased. Terms are
compared by 64-bit hashes. Documents are ranked by sums of integer impacts (``impact``).

*Gathering.* The terms of a block of queries, a bounded number, go to all tasks; one scan over the documents keeps of
each its length and its counts of those terms. Lengths and document frequencies are sums by Spark over all documents.
Queries beyond a block are searched in further blocks, each a scan of its own.

*Searching.* Kept documents are dealt to shards of about ``SHARD_POSTINGS`` postings. In a shard they are put in order
of their lengths, so that neighbours have like impacts. Each term has a posting list with a sparse table of maxima
over spans of powers of two: the maximum over any run of documents is the larger of two entries. For a query, the sum
of its terms' maxima bounds the score of every document of an interval. Intervals are taken best bound first,
``TOGETHER`` at a time and for many queries side by side. The document where the largest of the maxima lies is scored in
full, and the interval is split there in two. Intervals of up to ``LEAF`` documents are scored from their postings.
A query ends when no bound reaches the score of its k-th document found; an equal bound is still followed, as ties
go to the smaller id. Each shard's best k meet in a ranking by query, cut to k before they are shuffled.

Null texts and texts without a term hold no terms and are no documents for N. Documents of null id count in the
statistics and are not ranked. Repeated rows are documents of their own. Queries of null id or text return nothing; of
several texts of one query id the largest counts. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.llm.common import batches, map_texts, text_of, written
from tallyfolio.llm.textscan import Words, bytes_of, words

BLOCK_TERMS = 1 << 16
"""Distinct terms, summed over queries, of a block of queries."""
SHARD_POSTINGS = 1 << 19
LEAF = 16
TOGETHER = 32
STEP_CELLS = 1 << 18
"""Intervals times terms that are bounded at once."""

_TERM = np.full(256, 32, np.uint8)
for _first, _last in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _TERM[_first : _last + 1] = np.arange(_first, _last + 1)


def terms(column: pa.Array) -> Words:
    """The terms of texts, by their hashes."""
    data, offsets = bytes_of(column)
    mapped = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(_TERM[data].tobytes())])
    return words(mapped.view(pa.large_string()), lower=True)


def impact(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """A term's part of a document's score, in integers."""
    m = 100 - 90 + (90 * n * documents) // tokens
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def term_weight(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def _query_terms(queries: DataFrame) -> DataFrame:
    """(query, terms): distinct hashes."""

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, "text"):
            w = terms(frame.column("text"))
            lists = [np.unique(w.hash[a:b].view(np.int64)).tolist() for a, b in zip(w.first, w.first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([frame.column("query"), pa.array(lists, pa.list_(pa.int64()))], ["query", "terms"])

    return map_texts(queries, find, "query long, terms array<long>").filter(F.size("terms") > 0)


def _gather(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts) of documents with a term: all their terms, and which of ``wanted`` (its places)
    they hold how often, as arrays of integers in binary."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = shared.value
        low = np.zeros(1 << 16, bool)
        low[(sought.view(np.uint64) & np.uint64(0xFFFF)).astype(np.int64)] = True
        for frame in batches(frames, "text"):
            w = terms(frame.column("text"))
            n = np.diff(w.first)
            maybe = np.flatnonzero(low[(w.hash & np.uint64(0xFFFF)).astype(np.int64)])
            value = w.hash[maybe].view(np.int64)
            at = np.minimum(np.searchsorted(sought, value), len(sought) - 1)
            hit = sought[at] == value
            owner = np.searchsorted(w.first, maybe[hit], "right") - 1
            key, counts = np.unique(owner * len(sought) + at[hit], return_counts=True)
            cut = np.searchsorted(key, np.arange(len(n) + 1) * len(sought))
            place, counts = (key % len(sought)).astype("<i4"), counts.astype("<i4")
            blobs = [pa.array([x[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()) for x in (place, counts)]
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(n), *blobs], ["doc_id", "n", "terms", "counts"]).filter(pa.array(n > 0))

    return map_texts(docs, find, "doc_id long, n long, terms binary, counts binary")


def _frequencies(found: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each wanted term: a row per term and task is shuffled, one per term is collected."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for frame in frames:
            held = np.frombuffer(b"".join(frame.column("terms").to_pylist()), "<i4")
            sums += np.bincount(held, minlength=size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["term", "df"])

    df = np.zeros(size, np.int64)
    for row in map_texts(found.select("terms"), count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    return df


class Shard:
    """Posting lists of some documents, in an order of its own, with a sparse table of maxima for each list."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, term: np.ndarray, doc: np.ndarray, score: np.ndarray, size: int):
        """``doc`` are places in ``ids``; ``size`` is the number of terms."""
        order = np.lexsort((ids, n))
        self.ids = ids[order]
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.span = len(ids) + 1
        key = term * self.span + place[doc]
        by = np.argsort(key)
        self.key, self.score = key[by], score[by]
        self.first = np.searchsorted(self.key, np.arange(size + 1) * self.span)
        lengths = np.diff(self.first)
        # levels of spans 2, 4, ...; an entry that would leave its list is never asked for
        self.levels = [self.score]
        width = 1
        while 2 * width <= lengths.max(initial=0):
            below = self.levels[-1]
            level = below.copy()
            level[:-width] = np.maximum(below[:-width], below[width:])
            self.levels.append(level)
            width *= 2
        self.table = np.stack(self.levels)

    def range_max(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest score among postings a to b - 1; 0 where there are none."""
        n = b - a
        level = np.frexp(np.maximum(n, 1).astype(np.float64))[1] - 1
        a, last = np.minimum(a, len(self.score) - 1), np.maximum(b - (1 << level), 0)
        return np.where(n > 0, np.maximum(self.table[level, a], self.table[level, last]), 0)

    def places(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Where each term's postings of documents from ``docs`` on begin."""
        return np.searchsorted(self.key, terms * self.span + docs)

    def scores(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of documents (rows) for the terms of their rows; terms of -1 are none."""
        key = np.where(terms < 0, -1, terms * self.span + docs[:, None])
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.score[at], 0).sum(axis=1)

    def search(self, queries: list[np.ndarray], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place of the query, ids, scores) of each query's best k documents with a score above 0."""
        queries = [q[self.first[q + 1] > self.first[q]] for q in queries]  # terms without postings here add nothing
        at, left = 0, [i for i in np.argsort([len(q) for q in queries]) if len(queries[i])]
        while at < len(left):
            # queries of like length side by side, as many as STEP_CELLS allows
            width, group = 0, []
            while at < len(left):
                longer = max(width, len(queries[left[at]]))
                if group and longer * (len(group) + 1) * TOGETHER * 2 > STEP_CELLS:
                    break
                width, group, at = longer, [*group, left[at]], at + 1
            terms = np.full((len(group), width), -1, np.int64)
            for row, q in enumerate(group):
                terms[row, : len(queries[q])] = queries[q]
            ids, scores = self._group(terms, k)
            for row, q in enumerate(group):
                good = scores[row] > 0
                yield q, ids[row][good], scores[row][good]

    def _group(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        many = len(terms)
        best = np.zeros((many, k), np.int64)
        best_id = np.full((many, k), np.iinfo(np.int64).max)
        row = np.arange(many)
        low, high = np.zeros(many, np.int64), np.full(many, self.span - 1)
        bound, peak = self._bounds(terms[row], low, high)
        while len(row):
            live = (bound > 0) & (bound >= best[row, k - 1])
            row, low, high, bound, peak = (x[live] for x in (row, low, high, bound, peak))
            # of each query the TOGETHER intervals of the best bounds
            order = np.lexsort((-bound, row))
            row, low, high, bound, peak = (x[order] for x in (row, low, high, bound, peak))
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            now = rank < TOGETHER
            leaf = now & (high - low <= LEAF)
            split = now & ~leaf
            docs = [peak[split]] + [self._leaf(low[leaf], high[leaf])[1]]
            rows = [row[split], row[leaf][self._leaf(low[leaf], high[leaf])[0]]]
            self._offer(best, best_id, np.concatenate(rows), np.concatenate(docs), terms, k)
            r, a, b, p = row[split], low[split], high[split], peak[split]
            new_row, new_low, new_high = np.concatenate([r, r]), np.concatenate([a, p + 1]), np.concatenate([p, b])
            some = new_low < new_high
            new_row, new_low, new_high = new_row[some], new_low[some], new_high[some]
            new_bound, new_peak = self._bounds(terms[new_row], new_low, new_high)
            row, low, high, bound, peak = (
                np.concatenate([x[~now], y]) for x, y in ((row, new_row), (low, new_low), (high, new_high), (bound, new_bound), (peak, new_peak))
            )
        return best_id, best

    @staticmethod
    def _leaf(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = high - low
        which = np.repeat(np.arange(len(low)), n)
        return which, low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)

    def _bounds(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the terms' maxima over each interval, and the document of the largest of them."""
        known = np.maximum(terms, 0)
        a, b = self.places(known, low[:, None]), self.places(known, high[:, None])
        b = np.where(terms < 0, a, b)
        most = self.range_max(a, b)
        top = most.argmax(axis=1)
        pick = np.arange(len(terms))
        return most.sum(axis=1), self._peak(a[pick, top], b[pick, top])

    def _peak(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The document of the largest score among postings a to b - 1, by halving over the tables."""
        a, b = a.copy(), b.copy()
        while (wide := b - a > 1).any():
            middle = (a + b) // 2
            left = self.range_max(a, middle) >= self.range_max(middle, b)
            a, b = np.where(wide & ~left, middle, a), np.where(wide & left, middle, b)
        return self.key[np.minimum(a, len(self.key) - 1)] % self.span

    def _offer(self, best: np.ndarray, best_id: np.ndarray, row: np.ndarray, doc: np.ndarray, terms: np.ndarray, k: int) -> None:
        """Documents join their queries' best k: larger scores first, then smaller ids."""
        score = self.scores(terms[row], doc)
        good = (score > 0) & (score >= best[row, k - 1])
        rows, scores, ids = row[good], score[good], self.ids[doc[good]]
        touched = np.unique(rows)
        rows = np.concatenate([rows, np.repeat(touched, k)])
        scores, ids = np.concatenate([scores, best[touched].ravel()]), np.concatenate([ids, best_id[touched].ravel()])
        order = np.lexsort((ids, -scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < k
        best[rows[kept], rank[kept]], best_id[rows[kept], rank[kept]] = scores[kept], ids[kept]


def _search_block(docs: DataFrame, block: list[tuple[int, np.ndarray]], k: int, shard_postings: int) -> DataFrame:
    """(query, doc_id, score): each shard's best k of every query of the block."""
    spark = docs.sparkSession
    wanted = np.unique(np.concatenate([t for _, t in block]))
    found = written(_gather(docs, wanted), "lexical-postings")
    held = F.octet_length("terms") / F.lit(4)
    sums = found.agg(F.count("*").alias("documents"), F.sum("n").alias("tokens"), F.sum(held).cast("long").alias("postings")).first()
    documents, tokens = sums["documents"], sums["tokens"] or 0
    weight = term_weight(_frequencies(found, len(wanted)), documents)
    shared = spark.sparkContext.broadcast((weight, [(q, np.searchsorted(wanted, t)) for q, t in block]))

    def search(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, queries = shared.value
        ids, n, place, count, held = [], [], [], [], []
        for frame in frames:
            ids.append(frame.column("doc_id").to_numpy())
            n.append(frame.column("n").to_numpy())
            for blobs, into in (("terms", place), ("counts", count)):
                into.append(np.frombuffer(b"".join(frame.column(blobs).to_pylist()), "<i4"))
            held += [len(x) // 4 for x in frame.column("terms").to_pylist()]
        if not held:
            return
        ids, n, place, count = (np.concatenate(x).astype(np.int64) for x in (ids, n, place, count))
        doc = np.repeat(np.arange(len(ids)), held)
        shard = Shard(ids, n, place, doc, impact(weight[place], count, n[doc], documents, tokens), len(weight))
        for q, best, scores in shard.search([t for _, t in queries], k):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(best), queries[q][0])), pa.array(best), pa.array(scores)], ["query", "doc_id", "score"]
            )

    shards = max(1, -(-(sums["postings"] or 0) // shard_postings))
    dealt = found.filter(F.col("doc_id").isNotNull() & (F.octet_length("terms") > 0)).repartitionById(shards, F.pmod(F.xxhash64("doc_id", "n"), F.lit(shards)).cast("int"))
    return map_texts(dealt, search, "query long, doc_id long, score long")


def ranked_search(
    docs: DataFrame, queries: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", query: str = "item_id",
    query_text: str = "text", block_terms: int = BLOCK_TERMS, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """(query id, rank, doc_id, score): each query's k best documents."""
    narrow = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    asked = queries.filter(F.col(query).isNotNull()).groupBy(F.col(query).cast("long").alias("query")).agg(F.max(query_text).alias("text"))
    asked = written(_query_terms(asked), "lexical-queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // block_terms)
    parts = []
    for k_block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == k_block).toArrow()
        block = [(r["query"], np.array(r["terms"], np.int64)) for r in mine.to_pylist()]
        if block:
            parts.append(written(_search_block(narrow, block, k, shard_postings), "lexical-best"))
    if not parts:
        found = docs.sparkSession.createDataFrame([], "query long, doc_id long, score long")
    else:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query), "rank", F.col("doc_id").alias(id), "score")

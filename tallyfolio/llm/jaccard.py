"""Exact Jaccard join of word shingles that skips by relations between sets.

A document's set is its distinct five-word shingles as 64-bit hashes. Equal sets are one set, named by
the smallest id that has it. Sets are ordered by how frequent a shingle is in the whole corpus, rare
first, by a counting sketch of fixed size over all documents; any order gives right results, this one
keeps shared passages out of the index. Two sets that overlap enough share a shingle in a short prefix.

*Index.* Each prefix shingle has a list of (set, size, position). Lists with one entry are dropped: entries meet once by
shingle, where a shingle that a task has seen twice has one entry of that task. Of lists of
the same sets, told by their number and two 64-bit hashes, all but that of the first shingle are dropped too. The
rest is cut into blocks by size class: sets more than one class apart can't be similar, and blocks that
can't match are never joined. Within matching blocks the positions bound the overlap that is left.

*Answers.* The set of a list whose prefix is the most frequent in the corpus is the list's hub: of near copies the one with
the fewest words of its own, to which most of the others are similar, and the same one in most of their lists. It is
compared with the list's sets. Sets found similar share a component with the hub, and need no comparison with each other. The other sets of the list, outsiders,
are still to be compared with all sets of other components. In each of ``ROUNDS`` rounds one of them is the list's next
hub; what it is similar to joins its component, and lists without outsiders are done. The overlap of an outsider o
with any set x follows from each hub's answers within bounds: |o & x| <= |o & h| + |x - h|, and the same with o and
x swapped. Most pairs end there. What is left after the rounds is compared in full.

Before sets are fetched, a parity bitmap per set bounds a pair's overlap: bits that differ are shingles
that differ. Only sets that a surviving pair needs are fetched. No list is expanded into all its pairs
where the sets are similar, and lists, hubs and components are joins that can be split.

Null or blank text has the empty set and no links. Texts with fewer than five words have one shingle, the
whole sequence. Rows that repeat an id with equal sets are one document. An id with different sets is
ambiguous: its rows get no links. Null ids get no links and a null component. Ties don't exist: ids order
sets. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.llm.common import SMALL_ARROW_BYTES, batches, bounded_filter, join_groups, map_texts, only, passing, without, written
from tallyfolio.llm.components import components
from tallyfolio.llm.textscan import _STEPS, mix, windows, words

WORDS = 5
PERCENT = 80
SKETCH_BITS = 21
BLOCK_BITS = 15
PARITY_BITS = 1024
SEEN_TWICE = 1 << 16
"""Shingles a task remembers to have seen twice; of others it sends an entry for every half megabyte of text."""
ROUNDS = 2
"""Hubs of a list after its first one. Their answers join components, so that fewer pairs are left for the last step."""


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    w = words(column, lower=True)
    runs = windows(w.hash, WORDS)
    found = []
    for a, b in zip(w.first, w.first[1:], strict=False):
        if b - a >= WORDS:
            x = np.sort(runs[a : b - WORDS + 1])
            x = x[np.concatenate([[True], x[1:] != x[:-1]])]
        elif b > a:
            x = mix(np.array([(w.hash[a:b] * _STEPS[32 : 32 + b - a]).sum() + np.uint64(b - a)], np.uint64))
        else:
            x = np.zeros(0, np.uint64)
        found.append(x)
    return found


def _profiles(docs: DataFrame) -> DataFrame:
    """Rows of documents (id, n, sig, parity) and, per task, blocks of the sketch (block, counts)."""
    fields = pa.schema([
        ("id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("parity", pa.list_(pa.int64())),
        ("block", pa.int32()), ("counts", pa.binary()),
    ])

    def profile(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for frame in batches(frames, "text"):
            sets = shingle_sets(frame.column("text"))
            sigs = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
            parity = [
                np.packbits(np.bincount((x >> np.uint64(40)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS).astype(np.uint8) & 1).view("<i8")
                for x in sets
            ]
            if sets:
                np.add.at(sketch, (np.concatenate(sets) & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), 1)
            none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (PARITY_BITS // 64)), pa.array(np.concatenate([*parity, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays(
                [frame.column("id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(sigs, pa.binary()), flat, *none], schema=fields
            )
        pack = pa.Codec("zstd", 1)
        for block, part in enumerate(np.split(sketch, 1 << (SKETCH_BITS - BLOCK_BITS))):
            if part.any():
                row = {"block": block, "counts": pack.compress(part.tobytes(), asbytes=True)}
                yield pa.RecordBatch.from_pylist([row], fields)

    return map_texts(docs, profile, "id long, n long, sig binary, parity array<long>, block int, counts binary", SMALL_ARROW_BYTES)


def _sketch(profiles: DataFrame) -> np.ndarray:
    """The sketch of the whole corpus; blocks are summed as they stream by. Its size is fixed."""

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        pack = pa.Codec("zstd", 1)
        for frame in frames:
            for block, counts in zip(frame.column("block").to_pylist(), frame.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(pack.decompress(counts, decompressed_size=4 << BLOCK_BITS, asbytes=True), np.uint32)
                sums[block] = sums[block] + part if block in sums else part.astype(np.uint64)
        small = {k: pack.compress(np.minimum(v, 0xFFFFFFFF).astype(np.uint32).tobytes(), asbytes=True) for k, v in sums.items()}
        rows = [{"block": k, "counts": v} for k, v in small.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("block", pa.int32()), ("counts", pa.binary())]))

    blocks = profiles.filter(F.col("block").isNotNull()).select("block", "counts")
    # twice: first by block and sender, then by block, so that many tasks' blocks don't meet in one
    spread = blocks.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(16)))
    partial = spread.repartition("block", "part").select("block", "counts").mapInArrow(add, "block int, counts binary")
    found, pack = np.zeros(1 << SKETCH_BITS, np.uint32), pa.Codec("zstd")
    for row in partial.repartition("block").mapInArrow(add, "block int, counts binary").collect():
        part = pack.decompress(bytes(row["counts"]), decompressed_size=4 << BLOCK_BITS, asbytes=True)
        found[row["block"] << BLOCK_BITS : (row["block"] + 1) << BLOCK_BITS] = np.frombuffer(part, np.uint32)
    return found


def prefix_length(n: int) -> int:
    """Shingles among which two sets of enough overlap must meet, for a set of n."""
    return n - -(-PERCENT * n // 100) + 1


def _postings(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(token, id, n, pos, weight, known) for the prefix of each set; ``weight`` sums the sketch over it; ``known`` is 0 where the task has no other set with the
    shingle so far, 1 for an entry that speaks for others of the task, 2 for those others."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def post(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, mask = shared.value, np.uint64((1 << SKETCH_BITS) - 1)
        twice = np.zeros(0, np.uint64)
        for frame in batches(frames, "text"):
            ids = frame.column("id").to_numpy(zero_copy_only=False)
            tokens, sizes, taken, weights = [], [], [], []
            for x in shingle_sets(frame.column("text")):
                p, weight = prefix_length(len(x)) if len(x) else 0, 0
                if p:
                    df = rank[(x & mask).astype(np.int64)].astype(np.int64)
                    rare = np.argsort(df, kind="stable")[:p]
                    tokens.append(x[rare])
                    weight = df[rare].sum()
                weights.append(weight)
                sizes.append(len(x))
                taken.append(p)
            taken = np.array(taken, np.int64)
            pos = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
            flat = np.concatenate([*tokens, np.zeros(0, np.uint64)])
            distinct, first, count = np.unique(flat, return_index=True, return_counts=True)
            told, many = np.isin(distinct, twice), count > 1
            known = np.full(len(flat), 2, np.int8)
            known[first] = np.where(told, 2, many)
            twice = np.concatenate([twice, distinct[many & ~told]])[:SEEN_TWICE]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(flat.view(np.int64)), pa.array(np.repeat(ids, taken).astype(np.int64)),
                    pa.array(np.repeat(np.array(sizes, np.int32), taken)), pa.array(pos.astype(np.int32)),
                    pa.array(np.repeat(np.array(weights, np.int64), taken)), pa.array(known),
                ],
                ["token", "id", "n", "pos", "weight", "known"],
            )

    return map_texts(docs, post, "token long, id long, n int, pos int, weight long, known byte", SMALL_ARROW_BYTES)


def _need(n: Column, m: Column) -> Column:
    """The smallest overlap for which 100 * overlap >= PERCENT * union."""
    return F.ceil(PERCENT * (n + m) / F.lit(100.0 + PERCENT) - 1e-9)


def _possible(n: Column, i: Column, m: Column, j: Column) -> Column:
    """Sizes and the positions of a shared shingle leave room for the overlap needed."""
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (F.least(n - i, m - j) >= _need(n, m))


def _of(rows: DataFrame, pairs: DataFrame, side: str, *columns: Column) -> DataFrame:
    """Columns of the rows that one side of the pairs names; other rows are not moved."""
    bits = bounded_filter(pairs, F.col(side))
    return passing(rows, F.col("id"), bits).select(F.col("id").alias(side), *columns)


def _compare(pairs: DataFrame, docs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b, lo, hi, link): bounds of the overlap, exact where the bitmaps leave the pair open."""
    pairs = written(pairs, "jaccard-candidates")
    for side in ("a", "b"):
        known = _of(sizes, pairs, side, F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"p_{side}"))
        pairs = join_groups(pairs, known, [side], "inner")
    differ = F.aggregate(F.zip_with("p_a", "p_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    pairs = pairs.withColumn("hi", F.floor((F.col("n_a") + F.col("n_b") - differ) / 2)).drop("p_a", "p_b")
    pairs = written(pairs.withColumn("need", _need(F.col("n_a"), F.col("n_b"))), "jaccard-pairs")
    opened = pairs.filter("hi >= need").select("a", "b", "need")

    def overlap(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, "t_b"):
            # a hub's rows are neighbours: its set is made once for all of them
            _, own, which = np.unique(frame.column("a").to_numpy(), return_index=True, return_inverse=True)
            hubs = shingle_sets(frame.column("t_a").take(pa.array(own)))
            both = zip(which, shingle_sets(frame.column("t_b")), strict=True)
            n = [len(np.intersect1d(hubs[x], y, assume_unique=True)) for x, y in both]
            yield pa.RecordBatch.from_arrays([frame.column("a"), frame.column("b"), frame.column("need"), pa.array(n, pa.int64())], ["a", "b", "need", "overlap"])

    # texts take less room than sets of hashes
    both = opened
    for side in ("b", "a"):
        both = join_groups(both, _of(docs, opened, side, F.col("text").alias(f"t_{side}")), [side], "inner")
    exact = map_texts(both.select("a", "b", "need", "t_a", "t_b"), overlap, "a long, b long, need long, overlap long")
    exact = exact.select("a", "b", F.col("overlap").alias("lo"), F.col("overlap").alias("hi"), (F.col("overlap") >= F.col("need")).alias("link"))
    shut = pairs.filter("hi < need").select("a", "b", F.lit(0).cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"), F.lit(False).alias("link"))
    return written(shut.unionByName(exact.dropDuplicates(["a", "b"])), "jaccard-answers")


def _central() -> list[Column]:
    """The order in which sets of a list become its hubs."""
    return [(-F.col("weight")).alias("rank"), F.col("id")]


def _index(postings: DataFrame) -> DataFrame:
    """The lists with two entries or more: each entry with its list's hub and length ``k``."""
    # nearly all entries are alone: they are moved once, and no filter of fixed size, which fills up, stands for them
    token = Window.partitionBy("token")
    met = postings.filter("known < 2").withColumns({"k": F.count("*").over(token), "many": F.max("known").over(token)})
    fields = ["token", "id", "n", "pos"]
    shared = met.filter("k > 1 or many = 1").select(fields).unionByName(postings.filter("known = 2").select(fields))
    shared = written(shared, "jaccard-shared")
    # weights follow the entries that are left: most entries move without them
    weights = postings.filter("pos = 0").groupBy("id").agg(F.max("weight").alias("weight"))
    shared = written(join_groups(shared, weights, ["id"], "inner"), "jaccard-weighed")
    marks = [F.bit_xor(F.xxhash64("id", F.lit(seed))).alias(f"mark_{seed}") for seed in (1, 2)]
    hubs = shared.groupBy("token").agg(F.count("*").alias("k"), F.min(F.struct(*_central(), "n", "pos")).alias("hub"), *marks).filter("k > 1")
    # Like sets share most of their shingles, so many lists hold the same sets. Of those the one of the first shingle
    # stays: a pair's first shared shingle is the first of all lists with its sets, and is where the positions bound it.
    same = hubs.groupBy("k", F.col("hub.id").alias("h"), "mark_1", "mark_2")
    hubs = same.agg(F.min(F.struct(F.col("hub.pos").alias("h_pos"), "token", F.col("hub.n").alias("h_n"))).alias("first"))
    hubs = hubs.select("first.token", "k", "h", "first.h_n", "first.h_pos")
    return written(join_groups(shared, hubs, ["token"], "inner"), "jaccard-index")


def _links(docs: DataFrame, sets: DataFrame, postings: DataFrame) -> DataFrame:
    """(id, label) of sets that have links."""
    at = _index(postings)
    first = at.filter((F.col("id") != F.col("h")) & _possible(F.col("n"), F.col("pos"), F.col("h_n"), F.col("h_pos")))
    answers = _compare(first.select(F.col("h").alias("a"), F.col("id").alias("b")).distinct(), docs, sets)
    labels = written(components(answers.filter("link")), "jaccard-labels")
    # what the hub knows of each set in its list; a list of two is settled
    at = _told(at.filter("k > 2").withColumnRenamed("h_n", "hub_n"), answers, "h", 0)
    at = at.withColumn("size_class", F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / PERCENT))).cast("int"))
    lists = _opened(at.select("token", "id", "n", "pos", "weight", "h", "size_class", "lo_0", "hi_0"), labels)
    bounds = [("lo_0", "hi_0")]
    for k in range(1, ROUNDS + 1):
        # the next hub of each list is the first of its outsiders; all sets of other components are compared with it
        fields = ["id", "n", "pos", "label", *[c for pair in bounds for c in pair]]
        hubs = lists.filter("out").groupBy("token").agg(F.min(F.struct(*_central(), *fields[1:])).alias("o"))
        if hubs.isEmpty():
            return labels
        met = join_groups(lists, hubs, ["token"], "inner").select("*", *[F.col(f"o.{c}").alias(f"o_{c}") for c in fields]).drop("o")
        pairs = met.filter((F.col("id") != F.col("o_id")) & _unsettled(bounds)).select(F.col("o_id").alias("a"), F.col("id").alias("b")).distinct()
        more = _compare(pairs, docs, sets)
        labels = _relabelled(labels, more.filter("link"))
        told = met.select("token", "id", "n", "pos", "weight", "h", "size_class", *[c for pair in bounds for c in pair], F.col("o_id").alias("o"), F.col("o_n").alias("hub_n"))
        lists = _opened(_told(told, more, "o", k).drop("o", "hub_n"), labels)
        bounds.append((f"lo_{k}", f"hi_{k}"))
    fields = ["token", "id", "n", "pos", "label", *[c for pair in bounds for c in pair]]
    probes = lists.filter("out").select(*[F.col(c).alias(f"o_{c}") for c in fields],
                                        F.explode(F.array(*[F.col("size_class") + k for k in (-1, 0, 1)])).alias("o_class"))
    met = probes.join(
        lists,
        (F.col("token") == F.col("o_token"))
        & (F.col("size_class") == F.col("o_class"))
        & (~F.col("out") | (F.col("o_id") < F.col("id")))
        & _unsettled(bounds),
    )
    second = met.select(F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b")).distinct()
    more = _compare(second, docs, sets)
    return _relabelled(labels, more.filter("link"))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after further links: those join components, of which a few edges are left to follow."""
    edges = links.select("a", "b")
    for side in ("a", "b"):
        edges = join_groups(edges, labels.select(F.col("id").alias(side), F.col("label").alias(f"l_{side}")), [side])
        edges = edges.withColumn(f"l_{side}", F.coalesce(f"l_{side}", side))
    edges = written(edges.filter("l_a <> l_b").select("l_a", "l_b").distinct(), "jaccard-joined")
    if edges.isEmpty():
        return labels
    tops = written(components(edges, "l_a", "l_b"), "jaccard-tops")
    moved = join_groups(labels, tops.select(F.col("id").alias("label"), F.col("label").alias("top")), ["label"])
    found = tops.join(labels.select("id"), "id", "left_anti")
    return written(moved.select("id", F.coalesce("top", "label").alias("label")).unionByName(found), "jaccard-labels")


def _told(rows: DataFrame, answers: DataFrame, hub: str, k: int) -> DataFrame:
    """List entries with the bounds of their overlap with the list's hub: all of it for the hub itself, none for
    a set that was not compared with it."""
    known = answers.select(F.col("a").alias(hub), F.col("b").alias("id"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"))
    self = F.col("id") == F.col(hub)
    lo = F.when(self, F.col("n")).otherwise(F.coalesce("__lo", F.lit(0)))
    hi = F.when(self, F.col("n")).otherwise(F.coalesce("__hi", F.least("n", "hub_n")))
    return join_groups(rows, known, [hub, "id"]).withColumns({f"lo_{k}": lo, f"hi_{k}": hi}).drop("__lo", "__hi")


def _opened(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries with the label of their component, and whether they are outsiders: not of the component of the
    list's first hub. Lists without outsiders are done."""
    for side, label in (("id", "label"), ("h", "main")):
        lists = join_groups(lists, labels.select(F.col("id").alias(side), F.col("label").alias(label)), [side])
        lists = lists.withColumn(label, F.coalesce(label, side))
    lists = written(lists.withColumn("out", F.col("label") != F.col("main")).drop("main"), "jaccard-lists")
    outside = written(bounded_filter(lists.filter("out"), F.col("token")), "jaccard-open")
    return passing(lists, F.col("token"), outside)


def _unsettled(bounds: list[tuple[str, str]]) -> Column:
    """Sets of two components whose overlap may be enough by sizes, positions and every hub's answers."""
    need = _need(F.col("n"), F.col("o_n"))
    test = (F.col("label") != F.col("o_label")) & _possible(F.col("n"), F.col("pos"), F.col("o_n"), F.col("o_pos"))
    for lo, hi in bounds:
        test &= (F.col(f"o_{hi}") + F.col("n") - F.col(lo) >= need) & (F.col(hi) + F.col("o_n") - F.col(f"o_{lo}") >= need)
    return test


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``n_shingles`` and ``component_id``, the smallest id it reaches by links."""
    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    profiles = written(_profiles(narrow), "jaccard-profiles")
    rows = profiles.filter(F.col("block").isNull())
    named = rows.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    twofold = named.groupBy("id").agg(F.min("sig").alias("first"), F.max("sig").alias("last")).filter("first <> last").select("id")
    twofold = written(twofold, "jaccard-ambiguous")
    unlinked = F.col("id").isNull() | (F.col("n") == 0)
    rest = rows.filter(unlinked).unionByName(only(named, "id", twofold))
    named = without(named, "id", twofold)
    same = written(named.groupBy("sig").agg(F.min("id").alias("set")), "jaccard-same")
    copies = join_groups(named.select("sig", "id"), same, ["sig"], "inner").filter(F.col("id") != F.col("set")).select("id").distinct()
    left_out = written(copies.unionByName(twofold), "jaccard-left-out")
    sets = named.select("id", F.col("n").cast("int").alias("n"), "parity").dropDuplicates(["id"])
    sets = written(without(sets, "id", left_out), "jaccard-reps")
    texts = narrow.filter(F.col("id").isNotNull())
    alone = without(texts, "id", left_out)
    postings = written(_postings(alone, _sketch(profiles)), "jaccard-postings")
    labels = _links(texts, sets, postings)
    by_set = join_groups(same, labels.select(F.col("id").alias("set"), "label"), ["set"])
    by_set = by_set.select("sig", F.coalesce("label", "set").alias("component_id"))
    found = join_groups(named.select("sig", "id", "n"), by_set, ["sig"], "inner")
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id").unionByName(
        rest.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    )

"""Tokens of two tokenizers over the same bytes, aligned by an associative monoid of fragments.

A byte-level BPE (A) encodes a space and the text; a sentencepiece model (B) encodes the text and puts that
space there itself. Byte places where a token of A and a token of B both end cut the text into groups.

A *fragment* is what a range of bytes tells by itself: an open head (tokens up to the first common end), the
closed groups after it, and an open tail (tokens after the last common end). Joining two neighbours closes
the left one's tail with the right one's head, as one group; ranges without a common end are all head. That
is associative, so a tree of joins may be cut anywhere. Texts of up to ``CHUNK_BYTES`` are one range. Longer
ones are cut into ranges at any byte, also inside tokens and groups: a token belongs to the range in which it
ends. Ranges are dealt over tasks, read with the words that their edges cut, and joined ``FAN`` at a time.

Both tokenizers end a token before a single space or line break between two characters that aren't white
space, so ids of whole texts can be taken word by word, from the caches of ``tokens``; ranges are encoded
from such a space to such a space. A text without one is a single range.

*Links* are all pairs of an A and a B token that overlap. Between two neighbouring ends of either kind lies
exactly one link. Their counts by pair of ids are a table of at most (ids of A) * (ids of B) rows, whatever
the corpus; it is broadcast ``ROUND_PAIRS`` rows at a time, a pass over the documents' links for each round.

Null or empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens: zeros and
an empty string. Repeated rows and null ids are rows like others. An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import os
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.llm.common import batches, map_texts, text_of, written
from tallyfolio.llm.textscan import bytes_of
from tallyfolio.llm.tokens import _ODD, PieceEncoder, _byte_letters

CHUNK_BYTES = 1 << 16
FAN = 8
ROUND_PAIRS = 1 << 22
BATCH_BYTES = 1 << 19
KEPT_PIECES = 60_000
"""Words of each tokenizer that a worker's younger cache keeps."""
FLUSH_PAIRS = 1 << 20
NONE = np.zeros(0, np.int64)


class _AfterSpace:
    """Encodes texts as they stand after a space."""

    def encode_spaced(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (neither null nor empty), and how many each has."""
        odd = pc.match_substring_regex(column, self.odd).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(odd)
        special = self.whole_spaced(column.take(pa.array(at)).to_pylist()) if len(at) else []
        if len(at):
            column = pc.if_else(pa.array(odd), "x", column)
        split = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        lists = self._ids(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(lists), "<u4")
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        starts = np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy()
        n = sizes[index]
        place = np.cumsum(n) - n
        ids = flat[np.repeat(starts[index] - place, n) + np.arange(n.sum())].astype(np.int64)
        offsets = split.offsets.to_numpy()
        counts = np.add.reduceat(n, offsets[:-1] - offsets[0])
        if len(at):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, x in zip(at, special, strict=True):
                parts[i] = np.frombuffer(x, "<u4").astype(np.int64)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, counts


class SpacedBpe(_AfterSpace, PieceEncoder):
    """Byte-level BPE. Special tokens' strings are plain text."""

    def __init__(self, path: str):
        super().__init__(path, KEPT_PIECES)
        self.tokenizer.encode_special_tokens = True
        self.odd = _ODD
        byte = {ord(letter): chr(b) for b, letter in _byte_letters().items()}
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.entries = [name.translate(byte).encode("latin-1") for name in names]

    def whole_spaced(self, texts: list[str]) -> list[bytes]:
        return self._whole([" " + t for t in texts])


class SpacedPieces(_AfterSpace, PieceEncoder):
    """A sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        self.kept = KEPT_PIECES
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.odd = _ODD
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.entries = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.entries.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def whole_spaced(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in self.model.encode(texts, num_threads=1)]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        # before a line break the model's own space is a token by itself
        return {p: ids[4:] if p[:1] == "\n" else ids for p, ids in zip(pieces, self.whole_spaced(pieces), strict=True)}


@dataclass
class Coder:
    """Both tokenizers of a worker, with the bytes of their entries as flat tables."""

    a: SpacedBpe
    b: SpacedPieces

    def __post_init__(self):
        self.tables = []
        for side in (self.a, self.b):
            sizes = np.array([len(e) for e in side.entries], np.int64)
            self.tables.append((np.frombuffer(b"".join(side.entries), np.uint8), np.cumsum(sizes) - sizes, sizes))
        self.ids = max(len(self.a.entries), len(self.b.entries))
        number = np.arange(self.ids).astype("U")
        self.names = pa.array(np.concatenate([np.char.add(number, mark) for mark in (",", "|", ";", "")]), pa.large_string())

    def bytes_of_ids(self, side: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined bytes of the ids, and the end of each in them."""
        flat, starts, sizes = self.tables[side]
        n = sizes[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return flat[np.repeat(starts[ids] - (ends - n), n) + np.arange(total)], ends

    def encode(self, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Which texts both tokenizers give back; of those the ids and byte ends of A and of B, and the texts'
        own byte ends. Bytes count over a space and the text, one text after the other."""
        data, offsets = bytes_of(column)
        length = np.diff(offsets) + 1
        coded = [self.a.encode_spaced(column), self.b.encode_spaced(column)]
        good = np.ones(len(column), bool)
        for side, (ids, counts) in enumerate(coded):
            total = np.concatenate([[0], np.cumsum(self.tables[side][2][ids])])
            at = np.concatenate([[0], np.cumsum(counts)])
            good &= total[at[1:]] - total[at[:-1]] == length
        data = np.insert(data, offsets[:-1], 32)
        while True:
            keep = np.repeat(good, length)
            wanted = data if good.all() else data[keep]
            bounds = np.cumsum(length[good])
            bad = np.zeros(len(wanted), bool)
            out = []
            for side, (ids, counts) in enumerate(coded):
                ids = ids if good.all() else ids[np.repeat(good, counts)]
                joined, ends = self.bytes_of_ids(side, ids)
                bad |= joined != wanted
                out += [ids, ends]
            if not bad.any():
                return good, out, bounds
            good[np.flatnonzero(good)[np.unique(np.searchsorted(bounds, np.flatnonzero(bad), "right"))]] = False


@lru_cache(maxsize=1)
def coder(tokenizer: str, model: str) -> Coder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Coder(SpacedBpe(tokenizer), SpacedPieces(model))


@dataclass
class Groups:
    """Closed groups of one text or range: their wording, the numbers, and pairs of ids with their links."""

    text: bytes = b""
    numbers: np.ndarray = field(default_factory=lambda: np.zeros(4, np.int64))
    pairs: np.ndarray = field(default_factory=lambda: NONE)
    weights: np.ndarray = field(default_factory=lambda: NONE)


def grouped(code: Coder, tokens: list[np.ndarray], bounds: np.ndarray):
    """Groups of texts that end at the bytes ``bounds``: wordings, numbers (n_a, n_b, n_groups, n_links a row),
    and for all texts together the text, pair and weight of each distinct pair."""
    a, a_end, b, b_end = tokens
    ends_a, ends_b = np.zeros(int(bounds[-1]) + 1, bool), np.zeros(int(bounds[-1]) + 1, bool)
    ends_a[a_end] = True
    ends_b[b_end] = True
    cuts, steps = np.flatnonzero(ends_a & ends_b), np.flatnonzero(ends_a | ends_b)
    group_a, group_b = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
    order = np.arange(len(cuts))
    at_a = np.arange(len(a)) + np.searchsorted(group_b, order)[group_a]
    at_b = np.arange(len(b)) + np.searchsorted(group_a, order, "right")[group_b]
    named = np.empty(len(a) + len(b), np.int64)
    named[at_a] = a + code.ids * ends_b[a_end]  # "," within A, "|" after its last token
    last = ends_a[b_end]
    mark = np.where(last, 2, 0)
    mark[np.searchsorted(b_end, bounds)] = 3
    named[at_b] = b + code.ids * mark
    wording = code.names.take(pa.array(named))
    n_a, n_b, n_groups, n_links = (np.diff(np.searchsorted(x, bounds, "right"), prepend=0) for x in (a_end, b_end, cuts, steps))
    offsets = np.frombuffer(wording.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(n_a + n_b)])]
    texts = pa.Array.from_buffers(pa.large_string(), len(bounds), [None, pa.py_buffer(offsets.tobytes()), wording.buffers()[2]])
    pairs = a[np.searchsorted(a_end, steps)] * len(code.b.entries) + b[np.searchsorted(b_end, steps)]
    bits = np.int64(len(code.a.entries) * len(code.b.entries))
    both, weights = np.unique(np.repeat(np.arange(len(bounds)), n_links) * bits + pairs, return_counts=True)
    return texts, np.stack([n_a, n_b, n_groups, n_links], axis=1), both // bits, both % bits, weights


@dataclass
class Fragment:
    """``head`` and ``tail`` are [ids of A, their ends, ids of B, their ends]; ``closed`` is None where the
    range has no common end, and then all is head. ``good`` is false where bytes differ."""

    head: list[np.ndarray]
    closed: Groups | None
    tail: list[np.ndarray]
    good: bool = True


def _closed(code: Coder, tokens: list[np.ndarray], begin: int) -> Groups:
    a, a_end, b, b_end = tokens
    if not len(a):
        return Groups()
    texts, numbers, _, pairs, weights = grouped(code, [a, a_end - begin, b, b_end - begin], np.array([a_end[-1] - begin]))
    return Groups(texts[0].as_py().encode(), numbers[0], pairs, weights)


def fragment(code: Coder, tokens: list[np.ndarray], low: int, high: int) -> Fragment:
    """Of tokens with their byte ends, those that end in the range (low, high]."""
    a, a_end, b, b_end = tokens
    mine = [(x > low) & (x <= high) for x in (a_end, b_end)]
    a, a_end, b, b_end = a[mine[0]], a_end[mine[0]], b[mine[1]], b_end[mine[1]]
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    if not len(common):
        return Fragment([a, a_end, b, b_end], None, [NONE] * 4)
    part = []
    for f, t in ((-1, common[0]), (common[0], common[-1]), (common[-1], high)):
        p, q = (a_end > f) & (a_end <= t), (b_end > f) & (b_end <= t)
        part.append([a[p], a_end[p], b[q], b_end[q]])
    return Fragment(part[0], _closed(code, part[1], int(common[0])), part[2])


def _plus(x: list[np.ndarray], y: list[np.ndarray]) -> list[np.ndarray]:
    return [np.concatenate([p, q]) for p, q in zip(x, y, strict=True)]


def _sum(parts: list[Groups]) -> Groups:
    parts = [p for p in parts if p.numbers[2]]
    if len(parts) < 2:
        return parts[0] if parts else Groups()
    pairs, where = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
    weights = np.bincount(where, np.concatenate([p.weights for p in parts])).astype(np.int64)
    return Groups(b";".join(p.text for p in parts), sum(p.numbers for p in parts), pairs, weights)


def joined(code: Coder, left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges. Associative."""
    good = left.good and right.good
    if not good:
        return Fragment([NONE] * 4, None, [NONE] * 4, False)
    if left.closed is None:
        return Fragment(_plus(left.head, right.head), right.closed, right.tail)
    if right.closed is None:
        return Fragment(left.head, left.closed, _plus(left.tail, right.head))
    middle = _plus(left.tail, right.head)
    begin = int(min(middle[1][0] - len(code.a.entries[middle[0][0]]), middle[3][0] - len(code.b.entries[middle[2][0]])))
    return Fragment(left.head, _sum([left.closed, _closed(code, middle, begin), right.closed]), right.tail)


def whole(code: Coder, found: Fragment) -> Groups:
    """The groups of a text from its only fragment: its first byte begins a group, its last one ends one."""
    if not found.good:
        return Groups()
    first = [NONE] * 4, Groups(), [NONE] * 4
    return joined(code, Fragment(*first), found).closed or Groups()


ALIGNED = pa.schema([("doc_id", pa.int64()), ("groups", pa.string()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("pairs", pa.binary()), ("weights", pa.binary())])
_ALIGNED = "doc_id long, groups string, n_a long, n_b long, n_groups long, n_links long, pairs binary, weights binary"
_CHUNK = pa.schema([*((n, pa.int64()) for n in ("key", "doc_id", "chunk", "base", "low", "high")), ("text", pa.string())])
_CHUNKS = "key long, doc_id long, chunk long, base long, low long, high long, text string"
_FRAGMENTS = "key long, doc_id long, chunk long, body binary"
_WIDE = [rb"[\t-\r\x1c-\x20]", rb"\xc2[\x85\xa0]", rb"\xe1\x9a\x80", rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]", rb"\xe2\x81\x9f", rb"\xe3\x80\x80"]
_SAFE = re.compile(rb"(?s)(?<=.)" + b"".join(b"(?<!%s)" % w for w in _WIDE) + rb"\x20(?=.)" + b"".join(b"(?!%s)" % w for w in _WIDE))
"""A single space between two characters that aren't white space, in UTF-8."""


def _blob(x: np.ndarray) -> bytes:
    """Integers as compressed differences of neighbours, their size in front."""
    body = np.diff(x, prepend=0).astype("<i8").tobytes()
    return len(body).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(body, asbytes=True) if body else b""


def numbers_of(blob: bytes | None) -> np.ndarray:
    """The integers of a column ``pairs`` or ``weights``."""
    if not blob:
        return NONE
    blob = bytes(blob)
    size = int.from_bytes(blob[:8], "little")
    return np.cumsum(np.frombuffer(pa.Codec("zstd", 1).decompress(blob[8:], decompressed_size=size, asbytes=True), "<i8"))


def _aligned_rows(code: Coder, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, "text", BATCH_BYTES):
        n, column = frame.num_rows, frame.column("text").cast(pa.string())
        full = np.flatnonzero(pc.binary_length(column).to_numpy(zero_copy_only=False) > 0)
        numbers, pairs, weights = np.zeros((n, 4), np.int64), [b""] * n, [b""] * n
        texts, which = pa.array([""], pa.large_string()), np.zeros(n, np.int64)
        good, tokens, bounds = code.encode(column.take(pa.array(full))) if len(full) else (np.zeros(0, bool), [], NONE)
        rows = full[good]
        if len(rows):
            found, numbers[rows], owner, keys, times = grouped(code, tokens, bounds)
            at = np.searchsorted(owner, np.arange(len(rows) + 1))
            for i, row in enumerate(rows):
                pairs[row], weights[row] = _blob(keys[at[i] : at[i + 1]]), _blob(times[at[i] : at[i + 1]])
            texts, which[rows] = pa.concat_arrays([texts, found]), np.arange(1, len(rows) + 1)
        yield pa.RecordBatch.from_arrays(
            [
                frame.column("doc_id"), texts.take(pa.array(which)).cast(pa.string()), *(pa.array(c) for c in numbers.T),
                pa.array(pairs, pa.binary()), pa.array(weights, pa.binary()),
            ],
            schema=ALIGNED,
        )


def cut_ranges(text: bytes, size: int) -> list[tuple[int, int, int, bytes]]:
    """(base, low, high, bytes): ranges (low, high] of a space and the text, and the bytes to encode for each, after
    a space at place ``base``. A range ends at any byte, after a place at which both tokenizers cut: so a word at
    an edge is read for the two ranges beside it at most, and a text without such a place is one range."""
    safe = np.array([m.start() + 1 for m in _SAFE.finditer(text)], np.int64)
    total, low, out = len(text) + 1, 0, []
    while low < total:
        before, after = np.searchsorted(safe, low, "right"), None
        high = max(low + size, int(safe[before]) + 1) if before < len(safe) else total
        high = min(high, total)
        after = np.searchsorted(safe, high, "left")
        base = int(safe[before - 1]) if before else 0
        stop = int(safe[after]) if after < len(safe) else total
        out.append((base, low, high, text[base : stop - 1]))
        low = high
    return out


def _chunks(long: DataFrame, size: int) -> DataFrame:
    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, "text", 1):
            for key, doc, text in zip(*(frame.column(c).to_pylist() for c in ("key", "doc_id", "text")), strict=True):
                for k, (base, low, high, part) in enumerate(cut_ranges(text.encode(), size)):
                    yield pa.RecordBatch.from_pylist([{"key": key, "doc_id": doc, "chunk": k, "base": base, "low": low, "high": high, "text": part.decode()}], _CHUNK)

    return map_texts(long, cut, _CHUNKS)


def _long_rows(long: DataFrame, tokenizer: str, model: str, size: int) -> DataFrame:
    """Alignment of long texts: ranges over all tasks, fragments joined in a tree."""
    chunks = written(_chunks(long.withColumn("key", F.monotonically_increasing_id()), size), "align-ranges")
    most = chunks.agg(F.max("chunk")).first()[0]
    if most is None:
        return chunks.sparkSession.createDataFrame([], _ALIGNED)

    def encode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer, model)
        for frame in frames:
            for r in frame.to_pylist():
                good, tokens, _ = code.encode(pa.array([r["text"]]))
                if good[0]:
                    a, a_end, b, b_end = tokens
                    found = fragment(code, [a, a_end + r["base"], b, b_end + r["base"]], r["low"], r["high"])
                else:
                    found = Fragment([NONE] * 4, None, [NONE] * 4, False)
                yield pa.RecordBatch.from_pylist(
                    [{"key": r["key"], "doc_id": r["doc_id"], "chunk": r["chunk"], "body": pickle.dumps(found)}],
                    pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("body", pa.binary())]),
                )

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        found = reduce(partial(joined, coder(tokenizer, model)), map(pickle.loads, rows["body"]))
        first = rows.iloc[0]
        doc = None if pd.isna(first["doc_id"]) else first["doc_id"]
        return pd.DataFrame({"key": [first["key"]], "doc_id": pd.array([doc], "Int64"), "chunk": [first["chunk"] // FAN], "body": [pickle.dumps(found)]})

    def close(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for doc, body in zip(frame.column("doc_id").to_pylist(), frame.column("body").to_pylist(), strict=True):
                g = whole(coder(tokenizer, model), pickle.loads(body))
                row = [doc, g.text.decode(), *map(int, g.numbers), _blob(g.pairs), _blob(g.weights)]
                yield pa.RecordBatch.from_pylist([dict(zip(ALIGNED.names, row, strict=True))], ALIGNED)

    # about 64 ranges a task; an explicit number, so that they are not merged into few tasks by their bytes
    tasks = max(chunks.sparkSession.sparkContext.defaultParallelism, -(-chunks.count() // 64))
    found = map_texts(chunks.repartition(tasks, "key", "chunk"), encode, _FRAGMENTS)
    while most:
        found = found.groupBy("key", F.floor(F.col("chunk") / FAN).alias("part")).applyInPandas(join, _FRAGMENTS)
        most //= FAN
    return map_texts(found, close, _ALIGNED)


def align(docs: DataFrame, tokenizer: str, model: str, id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row per document: doc_id, ``groups`` (``a1,a2|b1;a3|b2,b3``), n_a, n_b, n_groups, n_links, and its
    distinct ``pairs`` (A id * size of B + B id) with the links of each as ``weights``, for ``numbers_of``."""
    narrow = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    size = F.octet_length("text")

    def rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _aligned_rows(coder(tokenizer, model), frames)

    short = map_texts(narrow.filter(size <= chunk_bytes), rows, _ALIGNED)
    return short.unionByName(_long_rows(narrow.filter(size > chunk_bytes), tokenizer, model, chunk_bytes))


def link_counts(aligned: DataFrame, model: str) -> DataFrame:
    """(pair, links, best) of the whole corpus: ``best`` where no pair of the same B id has more links. A task
    sums its documents' pairs before they are shuffled."""
    b_ids = sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size()

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            pairs, where = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pairs, np.bincount(where, np.concatenate([w for _, w in held])).astype(np.int64)

        def row(pairs: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(links)], ["pair", "links"])

        for frame in frames:
            for pairs, weights in zip(frame.column("pairs").to_pylist(), frame.column("weights").to_pylist(), strict=True):
                held.append((numbers_of(pairs), numbers_of(weights)))
                size += len(held[-1][0])
                if size >= 2 * FLUSH_PAIRS:
                    held = [summed()]
                    size = len(held[0][0])
                    if size >= FLUSH_PAIRS:
                        yield row(*held[0])
                        held, size = [], 0
        if size:
            yield row(*summed())

    counts = map_texts(aligned.select("pairs", "weights"), count, "pair long, links long").groupBy("pair").agg(F.sum("links").alias("links"))
    same = Window.partitionBy(F.pmod("pair", F.lit(b_ids)))  # at most a row per id of A
    return counts.withColumn("best", F.col("links") == F.max("links").over(same))


def with_scores(aligned: DataFrame, counts: DataFrame, round_pairs: int = ROUND_PAIRS) -> DataFrame:
    """The aligned rows with n_best, their links that are a best pair, and count_sum, the counts of all their
    links. The counts are broadcast in rounds of ``round_pairs`` rows, each a pass over the rows."""
    spark = aligned.sparkSession
    rounds = -(-counts.count() // round_pairs)
    kept = [f.name for f in aligned.schema.fields]
    frame = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    schema = frame.schema
    for k in range(rounds):
        part = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(rounds)) == k).toPandas().sort_values("pair")
        table = spark.sparkContext.broadcast((part["pair"].to_numpy(), part["links"].to_numpy(), part["best"].to_numpy()))

        def score(frames: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            keys, links, best = table.value
            for frame in frames:
                n_best, sums = frame.column("n_best").to_numpy().copy(), frame.column("count_sum").to_numpy().copy()
                for i, (p, w) in enumerate(zip(frame.column("pairs").to_pylist(), frame.column("weights").to_pylist(), strict=True)):
                    pairs, weights = numbers_of(p), numbers_of(w)
                    at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                    weights = weights * (keys[at] == pairs)
                    n_best[i] += (weights * best[at]).sum()
                    sums[i] += (weights * links[at]).sum()
                yield pa.RecordBatch.from_arrays([*(frame.column(c) for c in kept), pa.array(n_best), pa.array(sums)], [*kept, "n_best", "count_sum"])

        frame = map_texts(frame, score, schema)
        if k + 1 < rounds:
            frame = written(frame, "align-round")
            table.unpersist()
    return frame

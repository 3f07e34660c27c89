"""Graph search, ranked search and token alignment: against brute force, and odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyfolio.llm import alignment, queries
from tallyfolio.llm.alignment import Fragment, align, coder, cut_ranges, fragment, joined, link_counts, numbers_of, whole, with_scores
from tallyfolio.llm.graph_index import Graph, build, search
from tallyfolio.llm.lexical import ranked_search
from tallyfolio.llm.tokens import _byte_letters

SF = "/root/testdata/sf0.001"
BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'")


# ---- 11 ----


def nearest(rows, asked, k=10):
    """By the contract's words: (id, vector) pairs, brute force."""
    out = {}
    for q, x in asked:
        best = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))), i) for i, y in rows if i != q and len(y) == len(x))
        out[q] = best[:k]
    return out


def found_by(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_graph_query_recall_and_scores(spark):
    got = found_by(queries.op11_graph_search(spark, SF))
    rows = [(i, np.array(x, np.float64)) for i, x, _ in table("embeddings").fetchall()]
    want = nearest(rows, [r for r in rows if r[0] % 100 == 0])
    vectors = dict(rows)
    hits = 0
    for q, best in want.items():
        assert len(got[q]) == len(best) and got[q] == sorted(got[q])
        assert all(math.isclose(s, np.sqrt(((vectors[q] - vectors[i]) ** 2).sum()), rel_tol=1e-12) for s, i in got[q])
        hits += len({i for _, i in got[q]} & {i for _, i in best})
    assert set(got) == set(want) and hits >= 0.95 * sum(map(len, want.values()))


def test_graph_recall_over_several_shards_and_dense_groups(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 16))
    x[:1500] = x[0] + 0.01 * rng.normal(size=(1500, 16))  # a group of near copies
    x[1500:2500] = x[1500]  # a thousand equal vectors
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    index = build(frame, shard_rows=1500)
    assert index.count() == 4
    got = found_by(search(index, frame.filter("vec_id % 100 = 0"), block_queries=20))
    want = nearest(list(enumerate(x)), [(i, x[i]) for i in range(0, 6000, 100)])
    assert sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) >= 0.95 * 600
    copies = [q for q in want if 1500 <= q < 2500]
    assert all([i for _, i in got[q]] == [i for i in range(1500, 1512) if i != q][:10] for q in copies)


def test_graph_edges_are_pruned_and_bounded():
    points = np.random.default_rng(5).normal(size=(800, 8))
    graph = Graph(points, degree=12)
    degree = (graph.edges >= 0).sum(axis=1)
    assert degree.max() <= 12 and degree.min() >= 1
    for i, own in enumerate(graph.edges[:50]):
        own = own[own >= 0]
        assert i not in own and len(set(own)) == len(own)


def test_graph_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [5.0, 5.0]), (3, [0.0, 3.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (11, [0.0, 1.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("own") for c in ("id", "vector", "score", "length", "rank")})
    got = found_by(search(build(frame), frame))
    assert {q: [i for _, i in best] for q, best in got.items()} == {1: [2, 11, 3], 2: [11, 1, 3], 11: [2, 1, 3], 3: [2, 11, 1]}
    assert got[2][0] == (0.0, 11) and got[3][0][0] == 2.0  # of the two rows of 3 the smaller vector counts
    none = frame.limit(0)
    assert search(build(none), none).collect() == [] and search(build(frame), none).collect() == []


# ---- 12 ----

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ranked(docs, items, k=10):
    tf = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    tf = [(d, c) for d, c in tf if c]
    count, total = len(tf), sum(sum(c.values()) for _, c in tf)
    df = collections.Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        weights = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) for t in set(TERM.findall(text.translate(LOWER)))}
        scores = []
        for d, c in tf:
            m = 100 - 90 + (90 * sum(c.values()) * count) // total
            s = sum(w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if s > 0 and d is not None:
                scores.append((-s, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_ranked_query_equals_brute_force(spark):
    docs = table("documents").project("doc_id, text").fetchall()
    got = queries.op12_ranked_search(spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect())) == ranked(docs, table("benchmark").fetchall())


def test_ranked_search_in_blocks_and_many_shards(spark):
    docs = table("documents").project("doc_id, text").fetchall()
    got = ranked_search(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"), k=3, block_terms=300, shard_postings=500)
    assert sorted(map(tuple, got.collect())) == ranked(docs, table("benchmark").fetchall(), 3)


def test_ranked_search_of_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,-"), (4, "Red fish"), (5, "red fish"), (5, "red fish"), (6, "blue " * 4000 + "fish"), (None, "red"), (7, "Ünique ünique red"), (8, "gr\x00een")]
    items = [(1, "RED fish!"), (2, None), (3, "--"), (4, "ünique"), (None, "red"), (5, "absent"), (6, "blue"), (6, "a"), (7, "gr een")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("n", "terms", "query", "score", "rank")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("own") for c in ("doc_id", "query", "terms")})
    got = sorted(map(tuple, ranked_search(frame, asked, k=3).collect()))
    assert got == ranked(docs, [(1, "RED fish!"), (4, "ünique"), (5, "absent"), (6, "blue"), (7, "gr een")], 3)
    assert ranked_search(frame.limit(0), asked).collect() == [] and ranked_search(frame, asked.limit(0)).collect() == []


# ---- 13 ----

ODD_TEXTS = [
    None, "", "a", " x", "a  b", "a\nb c", "\nlead", "tail ", "héllo wörld", "x▁y", "<|endoftext|> hi </s>", "日本語 テスト。", "\x00",
    "it's o.k. 12345", "a　b c", "½ Ⅷ 👩‍👩‍👧 z", "same words", "same words",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES), {v: k for k, v in _byte_letters().items()}


def aligned_by_hand(tokenizers, text):
    a, b, byte = tokenizers
    if not text:
        return "", 0, 0, 0, 0, collections.Counter()
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    parts = [
        [bytes(byte[c] for c in a.id_to_token(i)) for i in ids[0]],
        [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]],
    ]
    if any(b"".join(p) != (" " + text).encode() for p in parts):
        return "", 0, 0, 0, 0, collections.Counter()
    ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
    groups, last = [], 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        groups.append("|".join(",".join(str(i) for i, e in zip(ids[s], ends[s], strict=True) if last < e <= end) for s in (0, 1)))
        last = end
    links = collections.Counter()
    for x, e, p in zip(ids[0], ends[0], parts[0], strict=True):
        for y, f, q in zip(ids[1], ends[1], parts[1], strict=True):
            if max(e - len(p), f - len(q)) < min(e, f):
                links[x, y] += 1
    return ";".join(groups), len(ids[0]), len(ids[1]), len(groups), sum(links.values()), links


def scores_by_hand(found):
    counts = sum((f[5] for f in found), collections.Counter())
    best = collections.Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(sum(w for p, w in f[5].items() if counts[p] == best[p[1]]), sum(w * counts[p] for p, w in f[5].items())) for f in found]


def test_alignment_of_odd_texts_equals_brute_force(spark, tokenizers):
    texts = [*ODD_TEXTS, "one two  three héllo. " * 40, "nospaces" * 200]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("own") for c in ("key", "chunk", "groups", "n_a", "pairs")})
    found = [aligned_by_hand(tokenizers, t) for t in texts]
    for size in (1 << 16, 40):  # whole texts, and ranges of 40 bytes joined over tasks
        rows = align(frame, BYTE_BPE, PIECES, chunk_bytes=size)
        got = {r["doc_id"]: r for r in with_scores(rows, link_counts(rows, PIECES), round_pairs=50).collect()}
        assert len(got) == len(texts)
        for i, (want, (n_best, count_sum)) in enumerate(zip(found, scores_by_hand(found), strict=True)):
            r = got[i]
            assert (r["groups"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == want[:5], (size, texts[i])
            assert (r["n_best"], r["count_sum"]) == (n_best, count_sum), (size, texts[i])
            links = dict(zip(numbers_of(r["pairs"]).tolist(), numbers_of(r["weights"]).tolist(), strict=True))
            assert links == {x * 32000 + y: n for (x, y), n in want[5].items()}
    assert align(frame.limit(0), BYTE_BPE, PIECES).collect() == []


def test_word_caches_of_both_tokenizers_are_bounded(tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_PIECES", 20)
    texts = ["one two one", *(" ".join(f"word{k}x{j}, two" for j in range(9)) for k in range(12)), "one two one"]
    for coder, library in ((alignment.SpacedBpe(BYTE_BPE), tokenizers[0]), (alignment.SpacedPieces(PIECES), tokenizers[1])):
        for t in texts:
            want = library.encode(" " + t, add_special_tokens=False).ids if library is tokenizers[0] else library.encode(t)
            assert coder.encode_spaced(pa.array([t]))[0].tolist() == want
            assert len(coder.young) <= 20


def test_joining_fragments_is_associative(tokenizers):
    code, rng = coder(BYTE_BPE, PIECES), np.random.default_rng(7)
    texts = [t[:600] for (t,) in table("documents").project("text").limit(25).fetchall() if t] + [t for t in ODD_TEXTS if t]
    for text in texts:
        want = aligned_by_hand(tokenizers, text)
        for size in (1, 9, 120):
            parts = []
            for base, low, high, part in cut_ranges(text.encode(), size):
                good, tokens, _ = code.encode(pa.array([part.decode()]))
                none = [alignment.NONE] * 4
                shifted = [tokens[0], tokens[1] + base, tokens[2], tokens[3] + base] if good[0] else none
                parts.append(fragment(code, shifted, low, high) if good[0] else Fragment(none, None, none, False))
            while len(parts) > 1:  # in any order
                i = int(rng.integers(len(parts) - 1))
                parts[i : i + 2] = [joined(code, parts[i], parts[i + 1])]
            found = whole(code, parts[0])
            assert (found.text.decode(), *found.numbers) == want[:5]


def test_ranges_cover_the_text_and_read_little_twice():
    text = ("word and 日本 more  text\nline " * 200).encode()
    ranges = cut_ranges(text, 64)
    assert ranges[0][1] == 0 and ranges[-1][2] == len(text) + 1
    assert all(x[2] == y[1] for x, y in zip(ranges, ranges[1:], strict=False))
    assert sum(len(r[3]) for r in ranges) < 2 * len(text)
    assert len(cut_ranges(b"x" * 1000, 10)) == 1


def test_alignment_query_equals_brute_force(spark, tokenizers):
    docs = table("documents").project("doc_id, text").fetchall()
    got = {r["doc_id"]: r for r in queries.op13_token_alignment(spark, SF).collect()}
    short = [(d, t) for d, t in docs if len(t or "") < 3000]
    for d, t in short:
        want = aligned_by_hand(tokenizers, t)
        digest = hashlib.sha256(want[0].encode()).hexdigest() if want[0] else ""
        r = got[d]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) == (*want[1:5], digest)
    assert len(got) == len(docs)

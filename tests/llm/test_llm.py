"""The operators for training data: against SQL, brute force, round trips and odd rows."""

from __future__ import annotations

import collections
import hashlib
import io
import re
import struct
import zipfile
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfolio.catalog.fixtures import TABLES
from tallyfolio.llm import jaccard, queries
from tallyfolio.llm.common import bounded_filter, passing
from tallyfolio.llm.components import components
from tallyfolio.llm.exact_dedup import exact_dedup, exact_groups
from tallyfolio.llm.jaccard import jaccard_components
from tallyfolio.llm.language import fit, with_language
from tallyfolio.llm.licenses import scan_licenses, size_range
from tallyfolio.llm.mixing import Mix, mix_documents, mixed
from tallyfolio.llm.oracles import all_oracles
from tallyfolio.llm.packing import histogram_packs, pack, pieces, sequences
from tallyfolio.llm.quality import quality, without_boilerplate
from tallyfolio.llm.token_files import read_tokens, write_tokens
from tallyfolio.llm.tokens import PieceEncoder
from tallyfolio.llm.warc import list_records, members, read_records, write_packages
from tallyfolio.llm.markup import fold, parse, shape
from tallyfolio.llm.wrappers import _slot, extract, main_text, marks_of, merged, weighed
from tools.check_queries import compare

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_BPE, WORD_BPE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, and columns whose names the operators use inside."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "src1", 0), (3, " \n\t", "en", "src1", 3),
        (4, "same words here", "en", "src1", 15), (5, "same words here", "de", None, 15), (5, "same words here", "de", None, 15),
        (6, "x " * 3000, None, "src2", 6000), (7, "12 34", "fr", "", 5),
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("id", "kept", "n", "digest", "label", "row", "place", "h")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.all_queries()[name](spark, SF)
    result = db.execute(all_oracles()[name])
    columns = [d[0] for d in result.description]
    assert compare([tuple(r) for r in df.collect()], df.columns, result.fetchall(), columns) is None


# ---- 1 ----


def test_exact_groups_of_odd_rows(odd):
    got = {r["doc_id"]: r for r in exact_groups(odd).collect()}
    assert {k: (r["keep_id"], r["group_size"], r["kept"]) for k, r in got.items()} == {
        1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (5, 2, False), 5: (5, 2, True), 6: (6, 1, True), 7: (7, 1, True),
    }
    assert got[1]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    kept = exact_dedup(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 6, 7]


# ---- 2 ----

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><header><h2>Site</h2></header>"
    "<nav><ul><li><a href='/'>Home</a></li><li><a>News</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
    "<article><h1>Title {n}</h1><p>One &amp; <b>bo</b>ld {n}</p><p>Two\n  &lt;{n}&gt;</p>{more}<form>Name <input></form></article>"
    "<aside>Ads</aside><section id='comments'><p>Nice {n}</p></section><footer>&copy; x</footer></body></html>"
)


def test_main_text_by_wrapper(spark):
    rows = [(n, "https://a.example.com/x", PAGE.format(n=n, more="<ul><li>item</li></ul>" if n % 2 else "")) for n in range(30)]
    rows += [(100, None, None), (101, "odd", "plain <i>te</i>xt"), (102, "https://b.example.com", "<body><p>Cut o&amp;f<p>here <b")]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == 33
    for n in range(30):
        assert got[n] == f"Title {n} One & bold {n} Two <{n}>" + (" item" if n % 2 else "")
    assert (got[100], got[101], got[102]) == ("", "plain text", "Cut o&f here")


def test_pages_against_their_article(spark):
    import html as H

    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall())
    for r in queries.op2_html_wrappers(spark, SF).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)[1]
        plain = re.sub(r"<[^>]*(>|\Z)", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inner))
        assert r["text"] == " ".join(H.unescape(plain).split()) and r["n_chars"] == len(r["text"])


def texts_of(spark, pages, host="https://a.example.com/x"):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("url", F.lit(host))
    return [r["text"] for r in main_text(df).orderBy("page_id").collect()]


def test_class_words_do_not_bar_an_article(spark):
    pages = {
        "<body class='has-sidebar comments-open'><article><p>a 1</p></article></body>": "a 1",
        "<body><article class='post format-aside category-social'><p>b 1</p></article></body>": "b 1",
        "<body><div id='content' class='with-sidebar'><p>c 1</p></div><div class='left-sidebar'>no</div><div class='ad-slot-3'>no</div></body>": "c 1",
        "<body><div data-role='menu' data-id='ad' title='a hidden one'><p>d 1</p></div><div hidden>no</div></body>": "d 1",
        "<body><div style='x: hidden; y'><p>e 1</p></div><p class='hidden'>no</p><div aria-hidden=true>no</div></body>": "e 1",
    }
    for page, want in pages.items():
        assert texts_of(spark, [page]) == [want]


def test_constants_are_texts_of_many_pages_outside_articles(spark):
    inside = [f"<body><article><h2>Summary</h2><p>own {n}</p></article></body>" for n in range(25)]
    assert texts_of(spark, inside) == [f"Summary own {n}" for n in range(25)]
    loose = [f"<body><div><p>own {n}</p></div></body>" for n in range(24)] + ["<body><div>All loose<p>own x</p></div></body>"]
    assert texts_of(spark, loose) == [f"own {n}" for n in range(24)] + ["All loose own x"]
    template = [f"<body><div><h2>Our shop</h2><p>own {n}</p></div></body>" for n in range(25)]
    assert texts_of(spark, template) == [f"own {n}" for n in range(25)]


def test_elements_without_a_partner_keep_their_text(spark):
    more = "<code>c</code><a>link</a><table><tr><td>t</td></tr></table>"
    shapes = ["<p>P {n}</p><h2>H</h2>", "<h2>H</h2><p>Q {n} " + more + "</p>", "<p>R {n} " + more + "</p>"]
    pages = [f"<body><article>{shapes[n % 3].format(n=n)}</article></body>" for n in range(30)]
    want = ["P {n} H", "H Q {n} clink t", "R {n} clink t"]
    assert texts_of(spark, pages) == [want[n % 3].format(n=n) for n in range(30)]
    assert texts_of(spark, pages, None) == [want[n % 3].format(n=n) for n in range(30)]


def test_extract_by_a_merged_wrapper():
    inner = ["<p>x</p><h2>y</h2>", "<h2>y</h2><p>z<code>k</code><nav>no</nav></p>", "<p>lone<code>k</code><nav>no</nav></p>"]
    pages = [f"<article>{x}</article>" for x in inner]
    trees = []
    for page in pages[:2]:
        root, texts = parse(page)
        trees.append(weighed(shape(fold(root), lambda node, texts=texts: _slot(texts, node)), 1))
    for a, b in (trees, trees[::-1]):
        marks = marks_of(merged(a, b))
        assert [extract(page, marks) for page in pages] == ["x y", "y zk", "lonek"]


def test_pages_of_any_depth(spark):
    deep = lambda n, x: "<div>" * n + x + "</div>" * n
    page = "<body><div><article><p>A {n}</p>" + deep(80, "in<nav>menu</nav><form>f</form>") + "<p>after</p></article></div><footer>f</footer></body>"
    assert texts_of(spark, [page.format(n=n) for n in range(3)]) == [f"A {n} in after" for n in range(3)]
    assert texts_of(spark, [f"<article>{n}" + deep(20_000, "x") + "end</article>no" for n in range(2)]) == [f"{n} x end" for n in range(2)]
    assert texts_of(spark, ["<article>" + "<div>" * 30_000 + "cut"]) == ["cut"]


# ---- 3 and 5 ----

STRINGS = [
    "", " ", "a  b", " lead", "trail ", "x\n\ny", "don't Stop 'Tis", "a\tb", "Über ÀÉ ß, naïve.\nZwei", "é café", "日本語 テスト",
    "<|endoftext|> x", "ﬁ ΑΣ Σ.", "a b c", "hi\r\nyou", "a. b, C.D e,f", "\n", "x\n", "😀 🙂x", "a\x00b", "it's we'll I'M", "ªº µm", "x.\ny,\nZ",
]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_pieces_give_the_ids_of_whole_texts(path):
    coder, texts = PieceEncoder(path), STRINGS + [t for _, t in documents()]
    for _ in range(2):  # the second time from the cache
        ids, counts = coder.encode(pa.array(texts))
        whole = [x.ids for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, whole)) and ids.tolist() == [i for w in whole for i in w]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_added_tokens_are_those_of_a_fresh_tokenizer(path):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(path)
    texts = [*STRINGS, "a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|>", "x <|ENDOFTEXT|> y", "plain text", "two\n<|startoftext|>lines<|endoftext|>"]
    ids, counts = PieceEncoder(path).encode(pa.array(texts))
    whole = [x.ids for x in fresh.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, whole)) and ids.tolist() == [i for w in whole for i in w]


MARKED = [
    "end$$$ end&&& End!! END.%%% end,*** a(b) c[d] e- f_ g' h.' i'. don't. it's! x<y", "Ünder$$ ünder?\nÜnder; naïve:", "a.b, 9. 9! |a |",
    "J\u030cx j\u030cx", "H\u0331 T\u0308 h\u0331", "I\u0307 E\u0301!", "end" + "!" * 200,
]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_marks_after_words_and_capitals_need_no_full_pass(path, monkeypatch):
    coder = PieceEncoder(path)
    ids, counts = coder.encode(pa.array(MARKED))
    whole = [x.ids for x in coder.tokenizer.encode_batch(MARKED, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, whole)) and ids.tolist() == [i for w in whole for i in w]
    taken, full = [], coder._whole
    monkeypatch.setattr(coder, "_whole", lambda texts: taken.extend(texts) or full(texts))
    words = ["".join(chr(97 + int(d)) for d in str(k)) + "xyz" for k in range(500)]
    text = " ".join(w + mark for w in words for mark in ("$$$", "!!", ".", "%%%;"))
    ids, _ = coder.encode(pa.array([text]))
    assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(taken) < 10
    if coder.folds:
        before = len(coder.young)
        coder.encode(pa.array([" ".join(words).title(), "\n".join(words)]))
        assert len(coder.young) == before


def test_packing_takes_little_memory_of_workers_that_stay(spark):
    coder = PieceEncoder(BYTE_BPE, 50)
    for k in range(20):
        coder.encode(pa.array([" ".join(f"w{k}x{j}" for j in range(40))]))
    assert len(coder.young) <= 90 and len(coder.old) <= 90
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(3 << 20))
    queries.packed(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(1 << 20)


def _whole(path, text):
    coder = PieceEncoder(path)
    return np.array([*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_token_files_round_trip(spark, odd, empty, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(odd, path, WORD_BPE)
    place = 0
    rows = read_tokens(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [1, 2, 3, 4, 5, 5, 6, 7]
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in rows:
        ids = _whole(WORD_BPE, texts[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids"]) == (place, len(ids), ids.tolist())
        place += len(ids)
    assert [r["doc_id"] for r in read_tokens(spark, path, F.col("doc_id") == 4).collect()] == [4]
    write_tokens(empty, str(tmp_path / "none"), WORD_BPE)
    assert read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_token_query(spark):
    got, place = {r["doc_id"]: r for r in queries.op3_token_files(spark, SF).collect()}, 0
    coder = PieceEncoder(WORD_BPE)
    for doc, text in sorted(documents()):
        ids = np.array([*coder.tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(got[doc])[1:] == (place, len(ids), zlib.crc32(ids.tobytes()))
        place += len(ids)


def test_histogram_packs():
    segments, packs = histogram_packs({1500: 3, 600: 2, 500: 4, 48: 3}, 2048)
    filled, ranks = collections.Counter(), collections.defaultdict(list)
    for length, low, high, first, offset in segments:
        ranks[length] += range(low, high)
        for k in range(high - low):
            assert filled[first + k] == offset
            filled[first + k] += length
    assert {k: sorted(v) for k, v in ranks.items()} == {1500: [0, 1, 2], 600: [0, 1], 500: [0, 1, 2, 3], 48: [0, 1, 2]}
    assert max(filled.values()) <= 2048 and sorted(filled) == list(range(packs))


def test_packing(spark, odd, empty):
    got = queries.op5_packing(spark, SF).toPandas()
    coder, texts = PieceEncoder(BYTE_BPE), dict(documents())
    for doc, rows in got.sort_values("start").groupby("doc_id"):
        ids = np.array([*coder.tokenizer.encode(texts[doc], add_special_tokens=False).ids, 1], "<u4")
        assert (rows.doc_tokens == len(ids)).all() and rows.length.sum() == len(ids)
        assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(rows.start, rows.length, strict=True)] == rows.ids_crc32.tolist()
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == (rows.length.cumsum() - rows.length).tolist() and rows.length.sum() <= 2048
    assert len(got.groupby("doc_id")) == len(texts)
    assert got.length.sum() / 2048 / got.sequence_id.nunique() > 0.9
    cuts = pieces(odd, BYTE_BPE, length=64)
    placed = pack(cuts.drop("ids"), 64)
    assert sum(r["length"] for r in placed.collect()) == sum(len(_whole(BYTE_BPE, r["text"])) for r in odd.collect())
    assert all(len(r["ids"]) <= 64 for r in sequences(placed.dropDuplicates(["doc_id", "start"]), cuts.dropDuplicates(["doc_id", "start"])).collect())
    assert pack(pieces(empty, BYTE_BPE).drop("ids")).count() == 0


# ---- 4 ----


def brute_components(rows):
    sets, parent = {}, {}
    for i, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = documents()
    for base in range(6):  # chains of copies, each further from the first
        words = [f"w{x}" for x in rng.integers(0, 5000, 60 + 40 * base)]
        for k in range(25):
            words = list(words)
            words[int(rng.integers(len(words)))] = f"new{base}-{k}"
            rows.append((10_000 + 100 * base + k, " ".join(words)))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(20_000 + k, " ".join(f"q{k}-{j}" for j in range(30)) + " " + passage) for k in range(40)]
    rows += [(30_000, "a b"), (30_001, "A  b\n"), (30_002, "a b c"), (30_003, ""), (30_004, None), (30_005, " \t")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect()}
    assert got == brute_components(rows)


def test_jaccard_of_odd_rows(spark, odd, empty):
    got = sorted(tuple(r) for r in jaccard_components(odd).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7)]
    assert jaccard_components(empty).count() == 0
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, "one text"), (2, "another text"), (3, "one text")]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=repr) == [(1, 1), (2, 2), (2, 2), (3, 3), (None, None)]


def test_only_shared_shingles_are_indexed_whatever_the_filter_holds(spark, monkeypatch):
    rows = [(k, " ".join(f"own{k}-{j}" for j in range(50))) for k in range(60)]
    rows += [(100 + k, " ".join([*(f"t{j}" for j in range(50)), f"end{k}"])) for k in range(30)]
    moved, write = [], jaccard.written

    def written(df, name):
        moved.append((df.columns, write(df, name)))
        return moved[-1][1]

    # a filter of 64 bits, as full as the usual one is with many shingles
    monkeypatch.setattr(jaccard, "bounded_filter", lambda keys, key: bounded_filter(keys, key, 64))
    monkeypatch.setattr(jaccard, "passing", lambda rows, key, bits: passing(rows, key, bits, 64))
    monkeypatch.setattr(jaccard, "written", written)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
    assert got == brute_components(rows)
    entries = [table for columns, table in moved if columns == ["token", "id", "n", "pos"]]
    sizes = [r["count"] for r in entries[-1].groupBy("token").count().collect()]
    assert sizes and min(sizes) > 1


def test_near_copies_are_compared_with_the_set_between_them(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(1000, " ".join(base := [f"w{j}" for j in range(150)]))]
    for k in range(300):  # three words in the middle differ at most; most of these texts are not similar to each other
        words = list(base)
        for at in rng.choice(np.arange(5, 145), int(rng.integers(1, 4)), replace=False):
            words[at] = f"own{k}-{at}"
        rows.append((k, " ".join(words)))
    answers, write = [], jaccard.written

    def written(df, name):
        found = write(df, name)
        if name == "jaccard-answers":
            answers.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "written", written)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
    assert got == brute_components(rows)
    assert len({c for _, c in got.values()}) == 1 and sum(answers) < 3 * len(rows)


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


# ---- 6 ----


def test_language_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op6_language(spark, folder).toPandas()
    truth = duckdb.sql(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").df()
    both = got.merge(truth, on="doc_id")
    assert len(both) == len(truth)
    assert (both.held_out == both.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and both.score.between(0, 1).all()


def test_language_of_odd_rows(odd, empty):
    net = fit(odd)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in with_language(odd, net).collect()]
    assert {i for i, lang, s in got if lang == "und" and s == 1.0} == {1, 2, 3, 7} and len(got) == 8
    assert fit(empty) is None and with_language(empty, None).count() == 0


# ---- 7 ----


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times, covered = collections.Counter(runs), set()
    for k, run in enumerate(runs):
        if times[run] > 1:
            covered |= set(range(k, k + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts(spark, odd, empty):
    texts = dict(documents())
    for r in queries.op7_quality_rules(spark, SF).collect():
        want = brute_base(texts[r["doc_id"]])
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["kept"] and r["base_failed"])
    got = {(r["doc_id"], *tuple(r)[1:6]) for r in quality(odd).collect()}
    assert got == {(r["doc_id"], *brute_base(r["text"])) for r in odd.collect()}
    assert quality(empty).count() == 0


def test_boilerplate_lines(spark):
    letters = str.maketrans("0123456789", "abcdefghij")  # digits are alike to a normalised line
    own = lambda i, n: " ".join(f"{i}x{k}".translate(letters) for k in range(n))
    rows = [(i, f"{own(i, 30)}\nShared  Line {i % 10} here", "a") for i in range(40)]
    rows += [(100 + i, f"{own(100 + i, 5)}\n" + "\n".join(f"Notice number {j} of this site that all pages have" for j in range(5)), "a") for i in range(40)]
    rows += [(200, own(200, 30) + "\nShared Line 1 here", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["kept"], r["removed_words"]) for r in quality(df).collect()}
    assert all(got[i] == (True, 4) for i in range(40))
    assert all(got[100 + i][0] is False and got[100 + i][1] == 50 for i in range(40))
    assert got[200] == (True, 0)
    cleaned = {r["doc_id"]: r["text"] for r in without_boilerplate(df).collect()}
    assert cleaned[3] == own(3, 30) and cleaned[200].endswith("here") and len(cleaned) == len(rows)


def test_boilerplate_counts_distinct_documents_on_hosts_of_any_size(spark):
    letters = str.maketrans("0123456789", "abcdefghij")
    own = lambda i, n: " ".join(f"{i}x{k}".translate(letters) for k in range(n))
    rows = [(i, own(i, 20) + "\nread more on this site" * (i < 20), "big") for i in range(3000)]
    rows += [(9000, own(9000, 20) + "\n" + own(9001, 20), "small")] * 25
    rows += [(9100 + i, own(9100 + i, 20) + "\nnineteen share this line", "small") for i in range(19)]
    got = {r["doc_id"]: (r["kept"], r["removed_words"]) for r in quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] == (True, 5 if i < 20 else 0) for i in range(3000))
    assert got[9000] == (True, 0) and all(got[9100 + i] == (True, 0) for i in range(19))


# ---- 8 ----


def test_license_scan_of_odd_rows(spark, odd, empty):
    rows = [(1, "An introduction first.\nReleased under the MIT License.\nMore"), (2, "released UNDER the -- mit license"), (3, "Released under a licence of sorts"), (4, None)]
    got = {r["doc_id"]: (r["license"], r["line_no"], r["n_notices"]) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("MIT", 2, 1), 2: ("MIT", 1, 1), 3: (None, None, 0), 4: (None, None, 0)}
    assert {(r["doc_id"], r["license"]) for r in scan_licenses(odd).collect()} == {(k, None) for k in range(1, 8)}
    assert scan_licenses(empty).count() == 0


def test_license_full_texts_and_headers(spark):
    from pathlib import Path

    import tallyfolio.llm.licenses as licenses

    texts = {p.stem: p.read_text() for p in (Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0"} <= set(texts)
    header = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    rows = [*texts.items(), ("GPL-3.0", header), ("MIT", "Copyright (c) 2020 Jane Doe\n\n" + texts["MIT"])]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["line_no"] if i else 0) for i, r in enumerate(scan_licenses(df).orderBy("doc_id").collect())}
    assert [got[i][0] for i in range(len(rows))] == [name for name, _ in rows]


def test_wrapped_and_embedded_licenses(spark):
    import textwrap
    from pathlib import Path

    import tallyfolio.llm.licenses as licenses

    prose = "\n".join(" ".join(f"w{k}x{j}" for j in range(12)) for k in range(40))
    longest = {name: max((w for n, w in licenses.TEMPLATES if n == name), key=len) for name in ("MIT", "GPL-3.0")}
    wrap = lambda t: "\n".join("# " + x for x in textwrap.wrap(t, 60))
    bsd = (Path(licenses.__file__).parent / "license_texts/BSD-3-Clause.txt").read_text()
    texts = [
        (f"{prose}\n{wrap(longest['MIT'])}\n{prose}", "MIT", 41, 1),
        (f"{wrap(longest['GPL-3.0'])}\n{prose}", "GPL-3.0", 1, 1),
        (f"{prose} and so on. Released under the MIT License. More\nof it. {prose}", "MIT", 40, 1),
        (f"{prose}\n{bsd}\n{prose}", "BSD-3-Clause", 41, 1),
        (f"{prose}\nReleased under\nthe MIT License.\n{prose}\nReleased\nunder the ISC License.\n{prose}", "ISC", 83, 2),
        (f"{prose}\nReleased under the MIT License.\n{prose}", "MIT", 41, 1),
    ]
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [(r["license"], r["line_no"], r["n_notices"]) for r in scan_licenses(df).orderBy("doc_id").collect()]
    assert got == [t[1:] for t in texts]


@pytest.mark.parametrize("n", range(1, 40))
def test_license_size_bounds(n):
    low, high = size_range(n, 0.8)
    fits = [m for m in range(1, 200) if 2 * min(m, n) / (m + n) >= 0.8 - 1e-12]
    assert (low, high) == (fits[0], fits[-1])


# ---- 9 ----


def test_mixing_fills_short_leaves_and_passes_the_rest_on(spark, odd, empty):
    rows = [(i, "w " * 10, "en", f"src{i % 2 * 4}", 0) for i in range(200)] + [(1000 + i, "w " * 10, "de", "src0", 0) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mix_documents(df, Mix(budget=1000)).collect()
    taken = collections.Counter((r["lang"], r["source"]) for r in got for _ in range(r["copies"]))
    assert taken == {("de", "src0"): 5, ("en", "src0"): 47, ("en", "src4"): 47}  # the short one whole, its rest to the others
    assert len(got) == 205
    again = {r["doc_id"] for r in mix_documents(df, Mix(budget=1000, seed=8)).collect() if r["copies"]}
    assert again != {r["doc_id"] for r in got if r["copies"]}
    assert mixed(df, Mix(budget=1000)).columns == df.columns and mixed(df, Mix(budget=1000)).count() == 99
    assert {r["doc_id"]: r["copies"] for r in mix_documents(odd, Mix(budget_percent=100)).collect()}.keys() == set(range(1, 8))
    assert mix_documents(empty).count() == 0


# ---- 10 ----


def test_warc_round_trip(spark):
    long = "<p>" + "é" * 600
    rows = [(1, "http://a/1", long), (2, None, long), (3, "http://a/3", "small"), (4, "http://a/4", "small"), (5, "u\r\nX: y", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("own"))
    index = list_records(write_packages(pages))
    got = {r["id"]: r for r in read_records(index).collect()}
    assert {k: (r["record_type"], r["refers_to"], r["html"]) for k, r in got.items()} == {
        1: ("revisit", 2, None), 2: ("response", None, long), 3: ("response", None, "small"), 4: ("response", None, "small"), 5: ("response", None, ""),
    }
    assert all(r["payload_bytes"] == len((dict((a, c) for a, _, c in rows)[k] or "").encode()) for k, r in got.items())
    assert got[2]["digest"] == hashlib.sha1(long.encode()).hexdigest() == got[1]["digest"]
    assert got[2]["url"] is None and got[5]["url"] == "u X: y"
    assert [r["id"] for r in read_records(index.filter("id = 3")).collect()] == [3]
    assert read_records(list_records(write_packages(pages.limit(0)))).count() == 0


def test_zip64_directory():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("indexes/index.cdxj", "x")
        with z.open("archive/data.warc.gz", "w", force_zip64=True) as f:
            f.write(b"hello")
        z.writestr(zipfile.ZipInfo("packed"), "y" * 99, compress_type=zipfile.ZIP_DEFLATED)
    raw = out.getvalue()
    end = raw.rindex(b"PK\5\6")
    count, length, start = struct.unpack_from("<HII", raw, end + 10)
    directory = bytearray(raw[start : start + length])
    at = directory.index(b"archive/data.warc.gz") - 46  # sizes and place of this member only in its ZIP64 field
    packed, plain = struct.unpack_from("<II", directory, at + 20)
    n_name, n_extra = struct.unpack_from("<HH", directory, at + 28)
    local = struct.unpack_from("<I", directory, at + 42)[0]
    wide = struct.pack("<HHQQQ", 1, 24, plain, packed, local)
    struct.pack_into("<II", directory, at + 20, 0xFFFFFFFF, 0xFFFFFFFF)
    struct.pack_into("<I", directory, at + 42, 0xFFFFFFFF)
    struct.pack_into("<H", directory, at + 30, n_extra + len(wide))
    directory[at + 46 + n_name : at + 46 + n_name] = wide
    record = struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, count, count, len(directory), start)
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, start + len(directory), 1)
    tail = struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    file = io.BytesIO(raw[:start] + bytes(directory) + record + locator + tail)
    found = members(file)
    assert set(found) == {"indexes/index.cdxj", "archive/data.warc.gz"}
    begin, size = found["archive/data.warc.gz"]
    assert file.getvalue()[begin : begin + size] == b"hello"


# ---- pipeline ----


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.collect()}
        kept = stage(spark, docs, SF)
        assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        ids = [r["doc_id"] for r in kept.collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before
        texts = {i: first[i] for i in before}
        if name == "language":
            assert set(ids) == before  # all are clean
        elif name == "exact_copies":
            assert set(ids) == set({t: i for i, t in sorted(texts.items())}.values())
        elif name == "near_copies":
            assert set(ids) == {c for _, c in brute_components(texts.items()).values()}
        else:
            n = {i: len(WORD.findall(t)) for i, t in texts.items()}
            assert 0.6 < sum(n[i] for i in ids) / sum(n.values()) <= 0.9
        docs = spark.createDataFrame(kept.collect(), SCHEMA)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_pipeline_of_an_empty_table(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


# ---- pages judged one by one, odd ids, letters ----


def _texts(spark, bodies, url="http://h.example/{}"):
    rows = [(i, url.format(i), f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    return [r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_pages_without_an_article_beside_some_with_one(spark):
    plain = "<div id='content'><h1>About</h1><p>long about text</p></div>"
    article = "<nav>Menu</nav><article><p>story {}</p></article><div><p>beside</p></div>"
    for url in ("http://h.example/{}", "odd"):
        got = _texts(spark, [plain, *[article.format(i) for i in range(5)]], url)
        assert got == ["About long about text", *[f"story {i}" for i in range(5)]]


def test_names_that_only_begin_like_an_aside(spark):
    kept = ["share-price-report", "side-effects", "login-methods", "has-sidebar", "category-social"]
    gone = ["ad-slot-2", "sidebar-left", "cookie-notice", "post-comments", "comment-17", "nav-menu"]
    got = _texts(spark, [f"<div><p>one {n}</p></div><div class='{n}'><p>two</p></div>" for n in (*kept, *gone)])
    assert got == [*[f"one {n} two" for n in kept], *[f"one {n}" for n in gone]]


def test_comments_and_related_articles_go(spark):
    nested = "<article><p>story</p><section><article class='comment'><p>nice</p></article></section><article class='related'>more</article></article>"
    after = "<article class='post format-aside'><p>story</p></article><article class='comment'><p>nice</p></article>"
    assert _texts(spark, [nested, after]) == ["story", "story"]


def test_pages_of_odd_rows(spark):
    rows = [(None, "http://h/1", "<p>a</p>"), (1, None, None), (1, None, None), (2, "http://h/2", "<p>b</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("own") for c in ("host", "text", "id", "wrapper")})
    got = sorted((tuple(r)[::2] for r in main_text(frame).select("page_id", "url", "text").collect()), key=repr)
    assert got == [(1, ""), (1, ""), (2, "b"), (None, "a")]
    assert main_text(frame.limit(0)).collect() == []


def test_archives_of_null_ids_are_read_by_many_tasks(spark, monkeypatch):
    body = "<p>" + "x" * 1200
    rows = [(None, "http://h/n", body), (7, "http://h/7", body), (3, None, body), (None, None, None), (5, "u", "y" * 1500), (5, "u", "y" * 1500)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    monkeypatch.setattr("tallyfolio.llm.warc.PACKAGE_BYTES", 1000)
    packages = write_packages(frame)
    index = list_records(packages)
    assert index.rdd.getNumPartitions() == packages.count() > 1
    got = sorted(((r["id"], r["record_type"], r["refers_to"]) for r in read_records(index).collect()), key=repr)
    assert got == [(3, "revisit", 7), (5, "response", None), (5, "response", None), (7, "response", None), (None, "response", None), (None, "revisit", 7)]


def test_half_is_no_letter(spark):
    docs = [(i, ("the cat sat on the mat " if i % 2 else "der hund lief in den wald ") * 5, "en" if i % 2 else "de") for i in range(60)]
    rows = [*docs, (100, "½ ² Ⅷ 12", "en"), (101, "ß", "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in with_language(frame, fit(frame)).collect()}
    assert got[100] == "und" and got[101] != "und"

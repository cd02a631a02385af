"""HTML extraction, cross-tokenizer alignment and centroid clustering against brute force and worked examples."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import DATA
from corpusloom.llm.centroid_clustering import Block, cluster_vectors, scan
from corpusloom.llm.html_text import extract_text, main_text, regions
from corpusloom.llm.token_alignment import Aligner, align_documents, counted, planes_of, read_bitmaps, runs, stored_bitmaps
from llm_tables import no_docs, odd, odd_docs  # noqa: F401

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# HTML extraction.

LONG = "a sentence with some words in it and a stop. " * 6
PAGES = {
    "": "",
    "<nav><a href='/'>Home</a></nav>": "",
    "plain text &eacute; only": "plain text é only",
    "<article><h1>T</h1><p>One\n two&nbsp;&amp;<br>three<p>x</article>": "T\nOne two & three\nx",
    "<article><p>a<!-- > <p>no</p> -->b</p><script>if(a<b){'</p>'}</script><style>p{}</style><p title='x>y'>c <b>d</b>e</article>": "ab\nc de",
    "<header>Site</header><main><article><p>A.</p><aside><p>no</p></aside><form><p>no</p></form><p>B.</p></article></main><footer>no</footer>": "A.\nB.",
    "<article><p>one</p><section id='comments'><article><p>no</p></article></section></article><div class='cookie-notice'>no</div>": "one",
    "<div class='page has-sidebar'><article class='post'><p>keep</p><div class='ad-slot'>no</div></article></div>": "keep",
    "<article><p>left open <ul><li>one<li>two</ul></article>after": "left open\none\ntwo",
    f"<div id=menu><a href=1>Home</a></div><div><h2>Title</h2><p>{LONG}<p>x.</div><div class=sidebar><p>{LONG}</p></div><div>Copyright</div>": f"Title\n{LONG.strip()}\nx.",
    "<article><p>cut off &am</p><p>in the mid": "cut off &am\nin the mid",
    "<p hidden>no</p><p style='display: none'>no</p><p>yes</p>": "yes",
    "<article><p>a < b and 1<2</p></article>": "a < b and 1<2",
    "<article><p>q</p></article>" + "<div>" * 3_000: "q",
}


@pytest.mark.parametrize("html", PAGES)
def test_main_text(html):
    assert main_text(html) == PAGES[html]


def test_regions_are_parted_by_empty_windows():
    weights = np.array([0, 0, 0, 5, 0, 0, 7, 0, 0, 0, 2, 0])
    assert regions(weights, 3) == [(3, 7, 7), (10, 11, 2)]
    assert regions(np.zeros(4, np.int64), 3) == []


def test_pages_of_the_table_give_their_articles(spark):
    got = {r.page_id: r for r in extract_text(spark.read.parquet(f"{DATA}/pages.parquet")).collect()}
    for row in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"<br>|</?p>|</?h1>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (got[row.page_id].text, got[row.page_id].n_chars, got[row.page_id].url) == (want, len(want), row.url)


def test_odd_pages(spark):
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    rows = [(1, None, None, 1), (1, "u", "", 2), (None, "u", "<p>x", 3), (2, "u", "<p>x", 4), (2, "u", "<p>x", 4), (3, "u", long, 5), (4, "u", "\0<article>a\0b", 6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long").withColumnRenamed("text", "n_chars")
    got = sorted((r.page_id or 0, r.n_chars, r.text[:3]) for r in extract_text(pages).collect())
    assert got == [(0, 1, "x"), (1, 0, ""), (1, 0, ""), (2, 1, "x"), (2, 1, "x"), (3, 249_999, "wor"), (4, 3, "a\0b")]
    assert extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<", "<a ", "<p>", "<b><p>", "<!--", "<a b='", "&amp;", "</i>", "<script>", "<div><span>"])
def test_odd_markup_takes_linear_time(piece):
    main_text(piece * 50_000)


# Cross-tokenizer alignment.


@pytest.fixture(scope="module")
def units():
    return Aligner(BYTES, PIECES)


@pytest.fixture(scope="module")
def library(units):
    tokenizer, pieces = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tokenizer.encode_special_tokens = True

    def tokens(text):
        if not text:
            return [], []
        a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        if not b"".join(units.a_bytes[i] for i in a) == (" " + text).encode() == b"".join(units.b_bytes[i] for i in b):
            return [], []
        return a, b

    return tokens


def brute_alignment(rows, tokens, units):
    docs, held = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(text)
        ends = [{0}, {0}]
        places = [[], []]
        for side, ids, table in ((0, a, units.a_bytes), (1, b, units.b_bytes)):
            at = 0
            for token in ids:
                at += len(table[token])
                ends[side].add(at)
                places[side].append((at, token))
        cuts = sorted((ends[0] & ends[1]) - {0})
        groups = [([], []) for _ in cuts]
        for side in (0, 1):
            for at, token in places[side]:
                groups[next(i for i, cut in enumerate(cuts) if cut >= at)][side].append(token)
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        held.update(links.keys())
        docs.append((doc_id, a, b, groups, links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    for doc_id, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in links.items() if held[p] == top[p[0]])
        yield doc_id, len(a), len(b), len(groups), sum(links.values()), best, sum(n * held[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if a else ""


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_units_equal_the_library(units, library):
    rng = random.Random(5)
    parts = ["a", "the", "é", " ", "  ", "\n", "\r\n", "\t", ".", ",", "'s", "日本", "▁", "<s>", "<|endoftext|>", "<0x0A>", " ", "　", "1", "🎉", "_", "A", "-", "\0", "x" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3_000)]
    number, counts = units.numbers(texts)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        own = number[at : at + n]
        at += n
        a, b = library(text)
        assert bool(n and units.facts[own, 4].all()) == bool(a)
        if a:
            groups = [g.split("|") for g in "".join(units.strings[i] for i in own)[:-1].split(";")]
            assert [int(i) for g in groups for i in g[0].split(",")] == a
            assert [int(i) for g in groups for i in g[1].split(",")] == b


@pytest.mark.parametrize("docs", [1, 9, 700, 65_536])
def test_bitmaps_read_back(docs):
    rng = np.random.default_rng(docs)
    sets = [np.sort(rng.choice(docs, size=rng.integers(1, docs + 1) if i % 2 else 1, replace=False)) for i in range(12)]
    members, cuts = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    assert (read_bitmaps(docs, *stored_bitmaps(members, cuts, docs)) == members).all()


def test_planes_add_up():
    times = np.array([1, 2, 3, 4, 9, 1_000])
    keys, docs = planes_of(np.arange(6), np.arange(6) + 10, times)
    back = Counter()
    for key, doc in zip(keys.tolist(), docs.tolist(), strict=True):
        back[doc] += 1 if key % 32 == 0 else 1 << key % 32 - 1
    assert back == {i + 10: t for i, t in enumerate(times.tolist())}
    values, n = counted(np.array([3, 1, 3]))
    assert values.tolist() == [1, 3] and n.tolist() == [1, 2] and runs(np.array([1, 1, 2])).tolist() == [0, 2, 3]


def test_alignment_of_odd_documents(spark, odd_docs, odd, units, library):  # noqa: F811
    want = sorted(brute_alignment([(r[0], r[1]) for r in odd], library, units), key=str)
    assert rows_of(align_documents(odd_docs, BYTES, PIECES)) == want
    # Many blocks and slices, as in a large corpus.
    assert rows_of(align_documents(odd_docs, BYTES, PIECES, block_bytes=40)) == want


def test_alignment_of_the_table(spark, units, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = sorted(brute_alignment([(r.doc_id, r.text) for r in docs.collect()], library, units), key=str)
    assert rows_of(align_documents(docs.repartition(5), BYTES, PIECES, block_bytes=20_000)) == want


def test_alignment_of_no_documents(no_docs):  # noqa: F811
    assert align_documents(no_docs, BYTES, PIECES).count() == 0


def test_repeated_links_beyond_sixteen_bits(spark, units, library):
    text = "ab " * 70_000
    docs = spark.createDataFrame([(1, text), (2, "ab"), (3, "")], "doc_id long, text string")
    short = "ab " * 3
    (row,) = align_documents(docs, BYTES, PIECES).filter("doc_id = 1").collect()
    a, b = library(text)
    assert (row.n_a, row.n_b) == (len(a), len(b)) and library(short)[0][0] in a


# Centroid clustering.


def brute_clusters(rows, clusters=40, rounds=5):
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    centroids = [v for _, _, v in sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v, v) for i, v in kept)][:clusters]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, k), (_, v) in zip(assign(), kept):
            groups[k].append(v)
        for k, vectors in groups.items():
            centroids[k] = [sum(column) // len(vectors) for column in zip(*vectors)]
    last = assign()
    inertia = Counter()
    for d, k in last:
        inertia[k] += d
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), prints[k]) for (d, k), (i, _) in zip(last, kept)), key=str)


def vectors_table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, cluster int, v int")


def test_clusters_of_odd_vectors(spark):
    rng = random.Random(2)

    def vector(spread=1.0):
        return [float(np.float32(rng.gauss(0, spread))) for _ in range(64)]

    rows = [(i, vector()) for i in range(150)]
    rows += [(500, vector(300.0)), (501, [0.0] * 64), (502, [0.0] * 64), (None, vector()), (None, vector()), (7, vector()), rows[3], rows[3]]
    rows += [(600, None), (601, []), (602, [1.0] * 63), (603, [None] + [1.0] * 63), (604, [float("nan")] * 64), (605, [float("inf")] * 64)]
    table = vectors_table(spark, rows).repartition(3)
    assert rows_of(cluster_vectors(table)) == brute_clusters(rows)
    assert rows_of(cluster_vectors(table, clusters=5, block_vectors=7)) == brute_clusters(rows, clusters=5)
    few = rows[:3] + [rows[0]]
    assert rows_of(cluster_vectors(vectors_table(spark, few))) == brute_clusters(few)
    alone = rows[:1] * 4
    assert rows_of(cluster_vectors(vectors_table(spark, alone), clusters=1)) == brute_clusters(alone, clusters=1)
    assert cluster_vectors(table.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [float(i * 997 % 4_096) * 100 + j for j in range(64)]) for i in range(60)]
    assert rows_of(cluster_vectors(vectors_table(spark, rows), clusters=6)) == brute_clusters(rows, clusters=6)
    with pytest.raises(Exception, match="beyond 64 bits"):
        cluster_vectors(vectors_table(spark, [(1, [1e9] * 64), (2, [1.0] * 64)])).collect()


def test_only_expired_vectors_are_scanned():
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.integers(-9, 9, (50, 64)), rng.integers(900, 918, (50, 64))]).astype(np.int64)
    row = {"ids": b"", "wide": True, "vectors": vectors.astype("<i4").tobytes(), "clusters": np.full(100, -1, "<i4").tobytes(), "keys": b"", "heaps": b"", "sizes": b""}
    block = Block(row, 64, 2)
    gained = block.round(vectors[[0, 99]], np.zeros(2))
    assert gained[:, 0].tolist() == [50, 50] and (gained[0, 1:] == vectors[:50].sum(0)).all()
    assert len(block.expired(np.full(2, 30.0))) == 0
    assert len(block.expired(np.full(2, 1e9))) == 100
    assert scan(vectors[:1], vectors[[3, 3]])[0].tolist() == [0]

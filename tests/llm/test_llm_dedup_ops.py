from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.common import row_texts
from corpusloom.llm.components import components
from corpusloom.llm.exact_dedup import drop_copies, find_copies, merge_runs
from corpusloom.llm.grams import Texts
from corpusloom.llm import jaccard_join
from corpusloom.llm.jaccard_join import group_members, group_pairs, keep_one_of_each, link_documents, matrix, shared_tokens
from corpusloom.llm.queries import ORACLES, QUERIES
from corpusloom.llm.substring_dedup import anchors, hits, remove_repeats
from corpusloom.llm.suffix_dedup import minimizers, remove_repeated_bytes
from llm_tables import no_docs, odd, odd_docs, passage  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 63
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def key(doc_id):
    return LAST if doc_id is None else doc_id


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_exact_copies(odd_docs, odd):
    got = find_copies(odd_docs).collect()
    groups = defaultdict(list)
    for r in odd:
        groups[sha(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""))].append(key(r[0]))
    want = sorted((key(r[0]), min(g := groups[s]), len(g), s) for r in odd for s in [sha(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""))])
    assert sorted((key(r.doc_id), key(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert kept == Counter(dict.fromkeys(groups, 1))
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_copies_stay_or_go_as_rows(odd_docs, odd, no_docs):
    left = drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in odd})
    assert find_copies(no_docs).count() == drop_copies(no_docs).count() == 0


def test_runs_merge_in_rounds(spark):
    rows = [(run, bytes([run % 5]), 1, 1, (run * 7 % 300, run), 1) for run in range(300)]
    runs = spark.createDataFrame(rows, "run int, digest binary, n_bytes int, check long, first struct<key: long, row: long>, size long")
    got = {r.digest[0]: (r.first.key, r["size"]) for r in merge_runs(runs, 299).collect()}
    assert got == {d: (min(run * 7 % 300 for run in range(d, 300, 5)), 60) for d in range(5)}


def brute_words(rows, window):
    first = {}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, LAST), key(doc_id))
    out = []
    for doc_id, text in rows:
        words, gone = WORD.findall(text or ""), set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < key(doc_id):
                gone.update(range(i, i + window))
        out.append((key(doc_id), len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out)


@pytest.mark.parametrize("window", [13, 4, 1])
def test_repeated_words_of_earlier_documents_go(odd_docs, odd, window):
    got = remove_repeats(odd_docs, window=window).collect()
    assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words([(r[0], r[1]) for r in odd], window)


def test_what_is_left_is_returned_on_request(odd_docs, no_docs):
    got = remove_repeats(odd_docs, with_text=True).collect()
    assert all(sha(r.kept) == r.kept_sha256 for r in got)
    assert remove_repeats(no_docs).count() == remove_repeated_bytes(no_docs).count() == 0


def brute_bytes(rows, length):
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    count = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    want = []
    for doc_id, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want.append((key(doc_id), len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(want)


@pytest.mark.parametrize("length,gram,neighbours", [(200, 64, 32), (40, 16, 8)])
def test_repeated_bytes_go(odd_docs, odd, length, gram, neighbours):
    got = remove_repeated_bytes(odd_docs, length, gram, neighbours).collect()
    assert sorted((key(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes([(r[0], r[1]) for r in odd], length)


def hot_rows():
    """A third of the rows without an id, a third equal in everything, passages that begin and end many texts."""
    rows = [(None, passage(40, 50 + i % 20) + " " + passage(30, 900 + i)) for i in range(60)]
    rows += [(3, passage(50, 70))] * 40 + [(None, passage(50, 71))] * 20
    rows += [(100 + i, passage(30, 2000 + i) + " " + passage(45, 60 + i % 7)) for i in range(60)]
    return rows


def test_hot_ids_and_equal_rows(spark):
    rows = hot_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = remove_repeats(docs).collect()
    assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(rows, 13)
    assert sorted((key(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeated_bytes(docs).collect()) == brute_bytes(rows, 200)


def test_no_row_gets_more_prints_than_its_own(spark):
    rows = hot_rows()
    texts = row_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    found = hits(anchors(texts, 16, 13), 16)
    words = {r.row: len(r.text.split()) for r in texts.collect()}
    got = texts.select("row").join(found, "row").select("row", F.size("prints").alias("n")).collect()
    assert len(got) > 100 and all(r.n <= words[r.row] for r in got)


def test_minimizers_do_not_depend_on_the_neighbours():
    data = [passage(60, i).encode() for i in range(5)]
    alone = [minimizers(packed_texts([b]), 16, 8) for b in data]
    prints, at = minimizers(packed_texts(data), 16, 8)
    begin = np.concatenate([[0], np.cumsum([len(b) for b in data])])
    assert at.tolist() == [int(x + begin[i]) for i, (_, a) in enumerate(alone) for x in a]
    assert prints.tolist() == [int(x) for p, _ in alone for x in p]


def packed_texts(data):
    return Texts(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in data])]))


def test_windows_too_short_for_the_sampling_are_refused(odd_docs):
    with pytest.raises(ValueError):
        remove_repeated_bytes(odd_docs, 100, 64, 32)


def brute_components(rows, n=5, percent=75):
    """Per row its set size and the number of its component; every row is a node of its own."""
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append(frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else []))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, t in enumerate(sets[:i]):
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                parent[find(i)] = find(j)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def brute_links(rows, n=5, percent=75):
    found, least = brute_components(rows, n, percent), {}
    for (doc_id, _), (_, component) in zip(rows, found):
        least[component] = min(least.get(component, key(None)), key(doc_id))
    return sorted((key(doc_id), size, least[component]) for (doc_id, _), (size, component) in zip(rows, found))


@pytest.mark.parametrize("slice_members", [512, 2])
def test_links_and_components(odd_docs, odd, slice_members):
    got = link_documents(odd_docs, slice_members=slice_members).collect()
    want = brute_links([(r[0], r[1]) for r in odd])
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == want


@pytest.mark.parametrize("slice_members", [512, 3])
def test_links_in_a_large_group_of_near_copies(spark, slice_members):
    import random

    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(80)] = f"n{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in link_documents(docs, slice_members=slice_members).collect())
    assert got == brute_links(rows)


def test_one_document_of_each_group_stays(odd_docs, no_docs, odd):
    left = keep_one_of_each(odd_docs)
    assert left.columns == odd_docs.columns
    rows = [(r[0], r[1]) for r in odd]
    found = brute_components(rows)
    groups = {}
    for row, (size, component) in zip(rows, found):
        if size:
            groups.setdefault(component, []).append(row)
    want = [min(g, key=lambda r: key(r[0]))[0] for g in groups.values()] + [r[0] for r, (size, _) in zip(rows, found) if not size]
    assert sorted(key(r.doc_id) for r in left.collect()) == sorted(map(key, want))
    assert link_documents(no_docs).count() == keep_one_of_each(no_docs).count() == 0


def test_rows_without_an_id_lose_nothing(spark):
    a, b, c = (passage(60, seed) for seed in (21, 22, 23))
    near = lambda t: t + " tail"
    rows = [(5, a, "x"), (None, near(a), "x"), (None, b, "x"), (7, c, "x"), (None, near(c), "x"), (None, b, "y"), (None, b, "y"), (None, " ", "z"), (None, " ", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_row string")
    got = sorted((key(r.doc_id), r.text) for r in keep_one_of_each(docs).collect())
    assert got == sorted([(5, a), (7, c), (key(None), b), (key(None), " "), (key(None), " ")])
    found = sorted((key(r.doc_id), key(r.component_id)) for r in link_documents(docs).collect())
    assert found == sorted([(5, 5), (7, 7), (key(None), 5), (key(None), 7)] + [(key(None), key(None))] * 5)


def test_near_copies_make_few_groups_and_work_is_linear_without_ids(spark):
    import random

    rng = random.Random(9)
    base = passage(300, 30).split()
    rows = []
    for _ in range(300):
        words = list(base)
        words[rng.randrange(300)] = f"n{rng.randrange(10**9)}"
        rows.append((None, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = docs.select(F.xxhash64("text").alias("key"), "text")
    tokens = shared_tokens(texts, 16, 5)
    assert tokens.count() == 300 and tokens.agg(F.max(F.size("prints"))).first()[0] <= 296
    packed = matrix(texts.join(tokens, "key"), 16, 5, 75)
    assert group_members(packed).count() == 300
    pairs = group_pairs(packed.filter("bucket >= 0"), 16).count()
    assert group_members(packed).select("group").distinct().count() <= 60 and pairs <= 1_800
    assert {r.component_id for r in link_documents(docs).collect()} == {None}
    assert keep_one_of_each(docs).count() == 1


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(7, 60), 7)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_dedup_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    cursor = con.execute(ORACLES["op3_exact_dedup"])
    names = [d[0] for d in cursor.description]
    got = QUERIES["op3_exact_dedup"](spark, folder).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(cursor.fetchall())


def test_pairs_within_both_limits_are_those_of_brute_force(monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS_HELD", 7)
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = int(rng.integers(0, 40))
        token, least = np.sort(rng.integers(0, 4, n)), rng.integers(1, 30, n)
        most = (least * rng.uniform(0.75, 1.34, n)).astype(np.int64)
        got = [tuple(sorted(p)) for i, j in jaccard_join.near_enough(token, least, most) for p in zip(i.tolist(), j.tolist())]
        want = {(a, b) for a in range(n) for b in range(a + 1, n) if token[a] == token[b] and least[a] <= most[b] and least[b] <= most[a]}
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("percent", [40, 75, 100])
def test_limits_admit_every_linked_pair_at_its_first_common_token(percent):
    """Random sets in one global order; the limit of each at the first common token, and its step, must reach the other's size."""
    rng = np.random.default_rng(percent)
    ends = jaccard_join.limit_steps(percent)
    linked = 0
    for _ in range(10_000):
        base = rng.permutation(60)[: int(rng.integers(1, 40))]
        x, y = (np.unique(np.concatenate([base[rng.random(len(base)) < 0.93], rng.integers(60, 90, int(rng.integers(0, 3)))])) for _ in "xy")
        both = np.intersect1d(x, y)
        if not len(both) or 100 * len(both) < percent * len(np.union1d(x, y)):
            continue
        linked += 1
        for one, other in ((x, y), (y, x)):
            n = np.array([len(one)])
            limit = jaccard_join.partner_limits(n, np.searchsorted(one, both[:1]), percent)
            step = np.searchsorted(ends[:-1], limit / n)
            assert limit[0] >= len(other) and n[0] * ends[step][0] + 1e-6 >= limit[0]
            assert jaccard_join._STEPS_OF[jaccard_join._STEP_MARKS[step] | 2][0] == step[0]
    assert linked > 100


def test_near_copies_in_many_groups_are_opened_by_slices(spark):
    import random

    rng = random.Random(31)
    base = passage(150, 44).split()
    rows = []
    for i in range(240):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 9])):  # the last are no longer linked with most of the others
            at = rng.randrange(150)
            words[at] = f"n{at}-{rng.randrange(2)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = docs.select(F.col("doc_id").alias("key"), "text")
    packed = jaccard_join.written(matrix(texts.join(shared_tokens(texts, 16, 5), "key"), 16, 5, 75), "packed")
    entries, members = packed.filter("bucket >= 0"), group_members(packed)
    around = jaccard_join.written(jaccard_join.centres(entries, 16), "around")
    placed = jaccard_join.families(around, members, 60)
    tiles = group_pairs(entries, 16, places=around.join(placed, "group").select("bucket", "group", "tile"))
    assert placed.count() == placed.select("group").distinct().count() == members.select("group").distinct().count()
    assert group_pairs(entries, 16).count() > 1_000 and tiles.count() <= 100
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in link_documents(docs, slice_members=16).collect())
    assert got == brute_links(rows)


def test_open_sets_come_from_the_matrix_and_hold_shared_tokens(spark):
    rows = [(i, passage(60, 50 + i // 2) + f" tail{i}") for i in range(8)] + [(8, passage(60, 99))]
    texts = spark.createDataFrame(rows, "key long, text string").repartition(3)
    packed = jaccard_join.written(matrix(texts.join(shared_tokens(texts, 16, 5), "key"), 16, 5, 75), "packed")
    got = {r.key: (r.n, len(set(r.tokens))) for r in jaccard_join.token_sets(packed).collect()}
    sets = {k: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for k, t in rows for w in [t.split()]}
    assert got == {k: (len(s), sum(any(t in sets[o] for o in sets if o != k) for t in s)) for k, s in sets.items() if k < 8}


def test_a_token_costs_the_same_in_however_many_buckets():
    rng = np.random.default_rng(3)
    keys, of = np.arange(400), np.repeat(np.arange(400), 200)
    prints = rng.integers(0, 1 << 63, len(of), dtype=np.uint64) * np.uint64(2)
    few, many = (jaccard_join._asked(0, [(keys, of, prints)], bits) for bits in (4, 12))
    assert many.num_rows > 200 * few.num_rows and many.nbytes < 1.5 * few.nbytes
    for batch in (few, many):
        got = [p for s, n in zip(batch.column("steps").to_pylist(), np.diff(batch.column("prints").offsets.to_numpy())) for p in jaccard_join._places(s, n).tolist()]
        assert np.bincount(got).tolist() == [200] * 400


def test_stars_need_no_round(spark, monkeypatch):
    import importlib

    module, labels = importlib.import_module("corpusloom.llm.components"), []
    monkeypatch.setattr(module, "written", lambda df, label: labels.append(label) or jaccard_join.written(df, label))
    got = {r.node: r.component for r in components(spark.createDataFrame([(1, 5), (9, 1), (1, 7), (2, 3)], "a long, b long")).collect()}
    assert got == {1: 1, 5: 1, 7: 1, 9: 1, 2: 2, 3: 2} and len(labels) == 1

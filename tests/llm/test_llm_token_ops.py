from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpusloom.llm.packing import assign, pack
from corpusloom.llm.sentencepiece_lattice import Vocabulary, decode_documents, encode_documents, lattice, segmented
from corpusloom.llm.token_files import read_token_files, token_digests, write_token_files
from llm_tables import no_docs, odd, odd_docs  # noqa: F401

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def ids_of(path: str, text: str | None) -> list[int]:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_every_document_in_order(spark, odd_docs, odd):
    folder, manifest = write_token_files(odd_docs, BYTES, keeps_space=True, shard_text_bytes=4_000)
    got = read_token_files(spark, folder, manifest).collect()
    assert len(got) == len(odd)
    in_order = sorted(got, key=lambda r: r.start)
    keys = [r.doc_id if r.doc_id is not None else 1 << 62 for r in in_order]
    assert keys == sorted(keys)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(in_order, in_order[1:]))
    want = sorted((str(r[0]), ids_of(BYTES, r[1])) for r in odd)
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == want
    digests = {(str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in token_digests(spark, folder, manifest).collect()}
    assert digests == {(str(r.doc_id), r.start, r.n_tokens, crc(r.ids)) for r in got}


def test_files_of_an_empty_table(spark, no_docs):
    folder, manifest = write_token_files(no_docs, BYTES, keeps_space=True)
    assert read_token_files(spark, folder, manifest).count() == 0


@pytest.mark.parametrize("capacity", [16, 256, 4096])
def test_pieces_cover_every_token_once(odd_docs, odd, capacity):
    got = pack(odd_docs, WORDS, keeps_space=False, capacity=capacity, block_tokens=3_000).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[(r.doc_id, r.doc_tokens)].append(r)
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    want = defaultdict(list)
    for r in odd:
        ids = ids_of(WORDS, r[1])
        want[(r[0], len(ids))].append(ids)
    assert set(documents) == set(want)
    for key, parts in documents.items():
        whole = [ids for ids in want[key]]
        assert sum(p.length for p in parts) == sum(map(len, whole))
        assert all(any(crc(ids[p.start : p.start + p.length]) == p.ids_crc32 for ids in whole) for p in parts)


def test_queries_read_special_tokens_as_the_library_does(spark, tmp_path):
    import corpus_pipeline
    from corpusloom.llm.queries import QUERIES

    texts = ["foo <|endoftext|> bar", "<|startoftext|>a b<|endoftext|>", "x, y.<|endoftext|>\n z  <|endoftext|>  <|endoftext|>", "word\n<|EndOfText|>", "<|endoftext|>word tail"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    byte, word = (Tokenizer.from_file(p) for p in (BYTES, WORDS))
    want = lambda t: {(i, crc([*t.encode(x, add_special_tokens=False).ids, 2])) for i, x in enumerate(texts)}
    rows = QUERIES["op1_token_files"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.ids_crc32) for r in rows} == want(byte)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for packed in (QUERIES["op9_cost_balanced_packing"](spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        pieces = packed.collect()
        assert {(r.doc_id, r.ids_crc32) for r in pieces if r.length == r.doc_tokens} == want(word)


def test_packing_balances_cost_and_leaves_little_room():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 3_000, 4_000)
    pieces = assign(lengths, 4096)
    many = max(p.sequence for p in pieces) + 1
    assert many == -(-int(lengths.sum()) // 4096)
    cost = np.zeros(many)
    for p in pieces:
        cost[p.sequence] += p.length + p.length**2 / 4096
    assert cost.std() / cost.mean() < 0.25
    assert assign(np.zeros(0, int), 4096) == []


def test_packing_an_empty_table(no_docs):
    assert pack(no_docs, WORDS, keeps_space=False).count() == 0


def test_sentencepiece_ids_are_the_librarys(spark, odd_docs, odd):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    more = ["a  b", "  a", "a ", "a\tb\nc", " ", "a\x00b", " " * 40 + "z", "\n\n \n", "thethethe" * 20]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    got = decode_documents(encode_documents(docs, PIECES, block_bytes=5_000), PIECES).collect()
    want = sorted((str(d), model.encode(t or ""), t or "") for d, t in [*((r[0], r[1]) for r in odd), *((100 + i, t) for i, t in enumerate(more))])
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_sentencepiece_of_an_empty_table(no_docs):
    assert encode_documents(no_docs, PIECES).count() == 0


def test_viterbi_finds_the_largest_sum(spark):
    table = [("a", 1, -3.0), ("b", 2, -3.1), ("ab", 3, -4.0), ("ba", 4, -2.5), ("aba", 5, -6.7), ("bab", 6, -9.0)]
    pieces = spark.createDataFrame(table, "piece string, id int, score double")
    words = ["a", "ab", "aba", "abab", "bababab", "aabb", "c", "acb"]
    grid = lattice(spark.createDataFrame([(w,) for w in words], "word string"), pieces, 3)
    score = {p: s for p, _, s in table} | {"c": -1e6}

    def best(word):
        found = {0: (0.0, [])}
        for stop in range(1, len(word) + 1):
            found[stop] = max((found[i][0] + score[word[i:stop]], [*found[i][1], word[i:stop]]) for i in range(max(0, stop - 3), stop) if word[i:stop] in score)
        return found[len(word)][0]

    names = {i: p for p, i, _ in table} | {50 + ord("c"): "c"}
    for r in segmented(grid, "unigram", 50).collect():
        parts = [names[i] for i in r.ids]
        assert "".join(parts) == r.word
        assert sum(score[p] for p in parts) == pytest.approx(best(r.word))


def test_vocabulary_reads_the_model():
    v = Vocabulary(PIECES)
    assert v.first_byte == 3 and v.longest == 16 and len(v.pieces) == 31_741


def test_ids_go_to_their_shards_without_a_table_between(spark, odd_docs, monkeypatch):
    from corpusloom.llm import token_files
    from corpusloom.llm.common import written

    tables = []
    monkeypatch.setattr(token_files, "written", lambda df, label: tables.append((label, df.columns)) or written(df, label))
    _, manifest = write_token_files(odd_docs, BYTES, keeps_space=True, shard_text_bytes=4_000)
    assert manifest.count() > 1 and tables and all("ids" not in columns for _, columns in tables)
    rng = np.random.default_rng(8)
    rows = sorted((int(k), int(h)) for k, h in zip(rng.integers(0, 6, 300), rng.integers(-9, 9, 300)))
    firsts = rows[::25]
    bounds = tuple(np.array(b, np.int64) for b in zip(*firsts))
    got = token_files.shard_of(*(np.array(c, np.int64) for c in zip(*rows)), bounds)
    assert got.tolist() == [sum(f <= r for f in firsts[1:]) for r in rows]

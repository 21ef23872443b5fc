"""Token output (2) and packing (5) against the tokenizers library and round trips."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lapmart.llm import packing, simple8b
from lapmart.llm.bpe import PieceEncoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {p: PieceEncoder(p) for p in (WORD, BYTE)}


def whole(path, text):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return np.array(tok.encode(text or "", add_special_tokens=False).ids, "<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "word", "Word", "don't", "'s", ",", ".", "12", "é", "É", "ß", "Σ",
                                 "ΣΑΣ", "İ", " ", "　", "\x01", "\x00", "á", "́", "<|endoftext|>",
                                 "!!", "%%%", "😀", "ǅ", ";", ":", "?", ".)", "a,b", "...", ",\n"]), max_size=12).map("".join))
def test_pieces_give_the_ids_of_the_whole_text(path, text):
    tok = ENCODERS[path].tok
    want = np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert ENCODERS[path].encode([text]) == [want]


def test_cache_generations_change_nothing(monkeypatch):
    monkeypatch.setattr("lapmart.llm.bpe.CACHE_PIECES", 3)
    enc = PieceEncoder(BYTE)
    texts = [f"some words, {i} and {i % 3} more\n\nwords" for i in range(30)]
    assert enc.encode(texts[:10]) + enc.encode(texts[10:]) == [whole(BYTE, t).tobytes() for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300))
def test_simple8b_round_trip(ids):
    ids = np.array(ids, np.uint64)
    words, escapes = simple8b.encode_block(ids)
    assert (simple8b.decode_block(words, escapes, len(ids)) == ids).all()
    assert len(escapes) == (ids >= 2**60).sum()


def key(row):
    return (row is not None, row or 0)


def test_token_files(docs, documents):
    got = sorted(simple8b.token_output(docs, WORD, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in documents), key=key)
    want = {}
    for d, t in documents:
        ids = np.append(whole(WORD, t), 2).astype("<u4")
        want.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for r in got:
        assert r.start == at
        assert (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        at += r.n_tokens
    assert at == sum(n for rows in want.values() for n, _ in rows)


def test_token_files_of_nothing(no_docs):
    assert simple8b.token_output(no_docs, WORD, 2).count() == 0


def check_packing(pieces, documents, window=2048):
    by_sequence, by_doc = {}, {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or at & (at - 1) == 0
    want = {}
    for d, t in documents:
        ids = np.append(whole(BYTE, t), 1).astype("<u4")
        want.setdefault((d, len(ids)), []).append(ids)
    assert want.keys() == by_doc.keys()
    for k, texts in want.items():
        got = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[k])
        assert sum(n for _, n, _ in got) == sum(map(len, texts))
        for start, n, crc in got:
            assert crc in {zlib.crc32(ids[start:start + n].tobytes()) for ids in texts}


def test_packing(docs, documents, monkeypatch):
    check_packing(packing.pack(docs, BYTE, 1).collect(), documents)


def test_packing_many_shards(docs, documents, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 5_000)
    check_packing(packing.pack(docs, BYTE, 1).collect(), documents)


def test_related_tails_meet_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 1_000)
    rng = np.random.default_rng(11)
    rows = []
    for pair in range(150):
        words = [f"{w:04x}" for w in rng.integers(0, 1 << 16, 12)]
        rows += [(2 * pair + i, " ".join(rng.permutation(words))) for i in range(2)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "doc_id long, text string").repartition(3)
    sequences = {}
    for r in packing.pack(df, BYTE, 1, window=128).collect():
        sequences.setdefault(r.doc_id, set()).add(r.sequence_id)
    together = sum(bool(sequences[2 * i] & sequences[2 * i + 1]) for i in range(150))
    # dealt by number, about one pair in ten shares a shard
    assert together >= 105


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, BYTE, 1).count() == 0


def test_a_seed_takes_its_nearest_neighbours():
    # tails 0 and 2 share their ids, 1 and 3 share others; a window holds two tails
    ids = np.concatenate([np.arange(10, 20), np.arange(50, 60), np.arange(10, 20), np.arange(50, 60)]).astype("<u4")
    idf = np.where(np.arange(100) > 0, 1.0, 0.0)
    got = packing.pack_shard(ids, np.full(4, 10), idf, 10.0, window=20)
    assert [[u for u, _, _ in s] for s in got] == [[0, 2], [1, 3]]


def test_scores_are_bm25():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 30, 40)
    ids = rng.integers(1, 25, lengths.sum()).astype("<u4")
    idf = rng.random(26)
    index = packing.ShardIndex(ids, lengths, idf, 12.0)
    tails = np.split(ids, np.cumsum(lengths)[:-1])
    for seed in range(40):
        want = []
        for t in tails:
            norm = packing.K1 * (1 - packing.B + packing.B * len(t) / 12.0)
            terms = sorted(set(tails[seed].tolist()), key=lambda x: -idf[x])[:packing.QUERY_TERMS]
            tf = {x: int((t == x).sum()) for x in terms}
            want.append(sum(idf[x] * n * (packing.K1 + 1) / (n + norm) for x, n in tf.items() if n))
        assert np.allclose(index.scores(seed), want)


def test_scores_are_bm25_of_all_ids():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 400, 40)
    ids = rng.integers(1, 500, lengths.sum()).astype("<u4")
    idf = rng.random(501)
    tails = np.split(ids, np.cumsum(lengths)[:-1])
    index = packing.ShardIndex(ids, lengths, idf, 200.0)
    free = np.ones(40, bool)
    for round_ in range(2):
        for seed in range(40):
            want = []
            for t in tails:
                norm = packing.K1 * (1 - packing.B + packing.B * len(t) / 200.0)
                tf = {x: int((t == x).sum()) for x in set(tails[seed].tolist())}
                want.append(sum(idf[x] * n * (packing.K1 + 1) / (n + norm) for x, n in tf.items() if n))
            assert np.allclose(index.scores(seed), np.where(free, want, 0))
        free = rng.random(40) < 0.5
        index.keep(free)


def test_windows_are_filled_with_neighbours_by_frequent_ids():
    # the seed shares only its most frequent id with tail 2, and none with tail 1
    seed = np.arange(10, 50)
    ids = np.concatenate([seed, np.arange(60, 100), np.r_[10, np.arange(110, 149)]]).astype("<u4")
    idf = np.ones(200)
    idf[10] = 0.1
    got = packing.pack_shard(ids, np.full(3, 40), idf, 40.0, window=80)
    assert [u for u, _, _ in got[0]] == [0, 2]


def test_ids_beyond_the_span_are_refused():
    assert len(packing._pairs(np.array([packing.SPAN - 1], np.uint32), np.array([1]))) == 1
    with pytest.raises(ValueError):
        packing._pairs(np.array([3, packing.SPAN], np.uint32), np.array([1, 1]))


def test_encoders_are_let_go():
    from lapmart.llm import bpe

    bpe._ENCODERS["x"] = object()
    bpe.forget()
    assert not bpe._ENCODERS

import base64
import hashlib
import random
import sys
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketlake.llm import byte_bpe, common, token_counts, token_files
from marketlake.llm.queries import op1_token_files, op9_token_counts, op10_byte_bpe
from marketlake.session import scratch_path

from .conftest import ODD

WORDS, RANKS, PIECES = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken"), P.path("piece_bpe_32k.model")
VOCABULARY = byte_bpe.Vocabulary(RANKS, P.PATTERN)
with open(RANKS, "rb") as lines:
    TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, special_tokens={})
PARTS = st.sampled_from([" ", "  ", "\n", "a", "the", "ing", "'s", "'", "12", "é", "ß", "日本", "😀", "́", "====", "\t", "\xa0", "THE", "th", "r", ",", ".", "İ", "J̌", "<|", "<|endoftext|>", "Σ", "²"])


def brute_ids(text):
    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids + [1]


def expected_files(pairs):
    out, start = [], 0
    for doc_id, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or "")):
        ids = brute_ids(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def key(row):
    return str(row)


def test_token_files_match_the_library(spark, make_docs):
    path = scratch_path(spark, "t")
    token_files.write_token_files(make_docs(ODD), path, WORDS, block_ids=64)
    got = token_files.read_token_files(spark, path, token_files.crc_row, token_files.CRC_SCHEMA).collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected_files(ODD), key=key)
    some = token_files.read_token_files(spark, path, doc_ids=[13, 9]).collect()
    assert {r.doc_id: r.ids for r in some} == {d: brute_ids(t) for d, t in ODD if d in (13, 9)}
    assert token_files.read_token_files(spark, path, doc_ids=[]).count() == 0


def test_token_files_of_an_empty_table(spark, make_docs):
    path = scratch_path(spark, "t")
    token_files.write_token_files(make_docs([]), path, WORDS)
    assert token_files.read_token_files(spark, path).count() == 0


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=60), st.data())
def test_packing_round_trip(bits, ids, data):
    ids = np.array(ids, np.uint64).astype(np.uint32) & np.uint32(2**bits - 1)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    a = data.draw(st.integers(0, len(ids)))
    assert token_files.unpack(packed, bits, a, len(ids) - a).tolist() == ids[a:].tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=14))
def test_encoders_match_the_libraries(parts):
    text = "".join(parts)
    encoder = token_files.encoder_of(WORDS)
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == brute_ids(text)[:-1]
    ids = VOCABULARY.encode(text)
    assert ids == TIKTOKEN.encode_ordinary(text) and VOCABULARY.decode(ids) == text.encode()


def test_bpe_of_long_pieces_and_every_token():
    rng = random.Random(1)
    for text in ["a" * 5000, "=" * 3000, " " * 3000, "日" * 2000, "".join(rng.choice("etaoinshr") for _ in range(4000))]:
        assert VOCABULARY.encode(text) == TIKTOKEN.encode_ordinary(text)
    for rank in range(0, len(VOCABULARY.tokens), 97):
        assert VOCABULARY.encode_piece(VOCABULARY.tokens[rank] * 3) == TIKTOKEN._core_bpe.encode_single_piece(VOCABULARY.tokens[rank] * 3)


def test_bpe_rows(spark, make_docs):
    got = byte_bpe.encode_documents(make_docs(ODD), RANKS, P.PATTERN).collect()
    want = [(d, TIKTOKEN.encode_ordinary(t or ""), (t or "").encode()) for d, t in ODD]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=key) == sorted(want, key=key)
    assert byte_bpe.encode_documents(make_docs([]), RANKS, P.PATTERN).count() == 0


def documents(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_op1_against_brute_force(spark, sf_small):
    assert sorted(map(tuple, op1_token_files(spark, sf_small).collect())) == expected_files(documents(spark, sf_small))


def test_op10_against_tiktoken(spark, sf_small):
    want = []
    for d, t in documents(spark, sf_small):
        ids = TIKTOKEN.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, op10_byte_bpe(spark, sf_small).collect())) == sorted(want)


def brute_count(model, word):
    path = token_counts.MARK + word
    best = [(0.0, 0)]
    for end in range(1, len(path) + 1):
        size = len(path[end - 1].encode())
        found = [(best[end - 1][0] + token_counts.FALLBACK * size, best[end - 1][1] - size)]
        found += [(best[a][0] + model.scores[path[a:end]], best[a][1] - 1) for a in range(end) if path[a:end] in model.scores]
        best.append(max(found))
    return -best[-1][1]


def test_token_counts(spark, make_docs, sf_small):
    model = token_counts.Unigram.from_sentencepiece(PIECES)
    words = sorted({w for _, t in documents(spark, sf_small)[:20] for w in t.split()})[:400]
    assert model.counts(words) == {w: brute_count(model, w) for w in words}
    got = token_counts.token_counts(make_docs(ODD), PIECES).collect()
    want = [(d, len((t or "").split()), sum(brute_count(model, w) for w in (t or "").split())) for d, t in ODD if d != 9]
    assert sorted((tuple(r) for r in got if r.doc_id != 9), key=key) == sorted(want, key=key) and len(got) == len(ODD)
    assert token_counts.token_counts(make_docs([]), PIECES).count() == 0
    assert op9_token_counts(spark, sf_small).count() == len(documents(spark, sf_small))


def test_trie_of_all_words(spark, sf_small):
    """Whole table: each prefix is scored once, and the counts at the ends are the brute-force ones."""
    model = token_counts.Unigram.from_sentencepiece(PIECES)
    words = sorted({w for _, t in documents(spark, sf_small) for w in (t or "").split()} | {"é", "é😀x", "日本" * 40})
    trie, scored = token_counts.Trie(model), []
    real = trie._forward
    trie._forward = lambda path, end: scored.append(path[:end]) or real(path, end)
    for w in words:
        trie.insert(w)
    assert len(scored) == len(set(scored)) == len(trie) - 1
    assert set(scored) == {(token_counts.MARK + w)[:n] for w in words for n in range(1, len(w) + 2)}
    want = {w: brute_count(model, w) for w in words}
    assert dict(trie.terminals()) == want == model.counts(words) == model.counts(words, nodes=50)
    with pytest.raises(ValueError):
        trie.insert("")
    assert model.counts([]) == {}


def test_memos_stay_under_their_bound(spark, make_docs, monkeypatch):
    """Many distinct words: what a task remembers stays under the bound and one chunk's words, and nothing stays behind."""
    limit = 200_000
    monkeypatch.setattr(common, "MEMO_BYTES", limit)
    monkeypatch.setattr(byte_bpe, "PAIR_BYTES", limit)
    rng = random.Random(3)
    chunks = [["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(400)] for _ in range(20)]
    encoder, vocabulary, terms = token_files.WordEncoder(WORDS, limit), byte_bpe.Vocabulary(RANKS, P.PATTERN), common.Memo(len)
    for words in chunks:
        text = " ".join(words)
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == brute_ids(text)[:-1]
        vocabulary.trim()
        assert vocabulary.encode(text) == TIKTOKEN.encode_ordinary(text)
        terms.trim()
        assert sum(map(terms.__getitem__, words)) == 3600
        for memo in (encoder.memo, vocabulary.chunks, vocabulary.pairs, terms):
            held = sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in memo.items()) + sys.getsizeof(memo)
            assert memo.size() <= limit + 2000 * 250 and held < 2 * (limit + 2000 * 250)
    assert len(terms) < 8000
    vocabulary.forget()
    assert not vocabulary.chunks and not vocabulary.pairs

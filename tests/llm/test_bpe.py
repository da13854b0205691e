"""Encoding against tiktoken, the splitter against the pattern itself."""

import hashlib
import pickle
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from tidemark.llm import bpe, token_counts
from tidemark.llm import words as W

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.read_ranks(spark, PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})


def random_texts(n, size):
    rnd = random.Random(5)
    parts = [*"abst'dmrelv  \n\t.,!0123é漢字 ́😀' ", "'s", "'re", " '", "n't", "'ll", "the ", "ation", "  \n "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, size))) for _ in range(n)]


def test_the_splitter_is_the_pattern():
    texts = random_texts(5000, 40)
    data, offsets = W.text_buffer(pa.array(texts))
    start, end, first = bpe.split_texts(data, offsets)
    raw = data.tobytes()
    pattern = regex.compile(public_tokenizers.PATTERN)
    for i, text in enumerate(texts):
        assert [raw[start[k]:end[k]].decode() for k in range(first[i], first[i + 1])] == pattern.findall(text)


def test_ids_and_round_trip_match_the_library(frame, ranks, library, words):
    rows = words + [(1000 + i, t) for i, t in enumerate(random_texts(200, 60))]
    rows += [(5000, "<|endoftext|> it's"), (5001, "x" * 3000), (5002, "".join(random.Random(1).choice("abcdefg") for _ in range(700)))]
    encoded = bpe.encode(frame(rows), ranks, chunk_bytes=5000)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"]))
                 for r in bpe.decode(encoded, ranks).collect())
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i is None, i or 0, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert got == sorted(want)
    fused = bpe.encode(frame(rows), ranks, with_decoded=True).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in fused) == sorted(want)


def test_long_words_take_the_same_merges(ranks, library):
    rnd = random.Random(3)
    for word in (b"a" * 2000, bytes(rnd.choice(b"thean") for _ in range(900))):
        assert ranks.merge_long(word) == library._core_bpe.encode_single_piece(word)


def test_empty_table_and_other_vocabulary(frame, ranks, spark):
    assert bpe.encode(frame([(1, "a")]).limit(0), ranks).collect() == []
    multi = bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    row = bpe.decode(bpe.encode(frame([(1, "Ünïcode is the thing")]), multi), multi).first()
    assert bytes(row["decoded"]).decode() == "Ünïcode is the thing"
    with pytest.raises(ValueError):
        bpe.Ranks([b"YQ== 0"])


def greedy(word, vocabulary):
    n = i = 0
    while i < len(word):
        i = next(j for j in range(len(word), i, -1) if word[i:j] in vocabulary)
        n += 1
    return n


@pytest.mark.parametrize("vocabulary", [{b"ab", b"abcx", b"bcd", b"abcdz", b"cd"}, {b"aaaa", b"aab"}, set()])
def test_automaton_counts_greedy_pieces(vocabulary):
    rnd = random.Random(1)
    every = {*vocabulary, *(bytes([b]) for b in range(256))}
    texts = [bytes(rnd.choice(b"abcdxz") for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    cuts = np.append(0, np.cumsum([len(t) for t in texts]))
    got = token_counts.Automaton(vocabulary).counts(data, cuts[:-1], cuts[1:])
    assert got.tolist() == [greedy(t, every) for t in texts]


def test_token_counts_of_texts(frame, ranks, words):
    pattern = regex.compile(public_tokenizers.PATTERN)
    got = sorted((tuple(r) for r in token_counts.count_tokens(frame(words), ranks.rank).collect()), key=str)
    want = []
    for i, t in words:
        pieces = [p.encode() for p in pattern.findall(t or "")]
        want.append((i, len(pieces), sum(greedy(p, ranks.rank) for p in pieces)))
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(frame([(1, "a")]).limit(0), ranks.rank).collect() == []


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_a_task_of_many_words_takes_little_memory(ranks):
    """Chunk rows and remembered pre-tokens have a bound; decoding needs no ranks."""
    rnd = np.random.default_rng(5)
    batch = pa.record_batch([pa.array(range(900)), pa.array([" ".join(f"{x:x}" for x in rnd.integers(0, 1 << 40, 1000)) for _ in range(900)])], names=["_id", "_text"])
    rows, known, held = 0, 0, []
    for row in bpe._chunks(iter([batch]), ranks, bpe.CHUNK_BYTES):
        rows += len(row.column("ids")[0])
        known = 0 if row.column("restart")[0].as_py() else known
        known += len(row.column("pieces")[0]) + len(row.column("ready")[0])
        held.append(known)
        assert row.column("pieces").nbytes < 64 << 20
    assert rows == 900 and max(held) < 1 << 19 and len(held) > 3
    assert len(pickle.dumps(ranks.pieces)) < len(pickle.dumps(ranks)) / 4

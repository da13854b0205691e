"""The pipeline against plain Python, and operators on texts of megabytes."""

import hashlib
import re
import struct
from collections import Counter
from itertools import combinations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, decontaminate, quality_classifier, quality_rules, substring_dedup, token_counts
from tidemark.llm.common import crc_mod

from .conftest import LOW

SF = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def without_near_copies(texts):
    sets = {}
    for i, t in texts.items():
        w = SPACED.findall(t.translate(LOW))
        sets[i] = {tuple(w[s:s + 5]) for s in range(max(1, len(w) - 4))} if w else set()
    lead = {i: i for i in texts}

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((top(a), top(b)))
            lead[high] = low
    return {i: t for i, t in texts.items() if top(i) == i}


def without_repeats(texts, window=35):
    words = {i: SPACED.findall(t) for i, t in texts.items()}
    count = Counter(tuple(w[s:s + window]) for w in words.values() for s in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = {s + k for s in range(len(w) - window + 1) if count[tuple(w[s:s + window])] > 1 for k in range(window)}
        out[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else texts[i]
    return out


def without_benchmark(texts, items, window=13):
    wanted = set()
    for t in items:
        w = PLAIN.findall((t or "").translate(LOW))
        size = min(window, len(w))
        wanted |= {tuple(w[s:s + size]) for s in range(len(w) - size + 1)} if size else set()
    out = {}
    for i, t in texts.items():
        w = PLAIN.findall(t.translate(LOW))
        hit = {s + k for n in {len(x) for x in wanted} for s in range(len(w) - n + 1) if tuple(w[s:s + n]) in wanted for k in range(n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out[i] = t
    return out


@pytest.fixture(scope="module")
def tokenizer():
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pipeline_matches_plain_python(spark, tokenizer):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    # the classifier is learnt; what it keeps is taken as given
    kept = {r["doc_id"] for r in quality_classifier.score_quality(docs, labels, crc_mod(F.col("doc_id"), 5) != 0).collect() if r["predicted"]}
    texts = without_repeats(without_near_copies({i: t for i, t in texts.items() if i in kept}))
    texts = without_benchmark(texts, [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    want = {}
    for i, t in texts.items():
        ids = tokenizer.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


@pytest.fixture(scope="module")
def long_rows():
    varied = " ".join(f"w{k * 7919 % 100_003}" for k in range(300_000))  # 2 MB, some words twice
    return [(1, varied), (2, "z " * 400_000), (3, "y" * 1_500_000), (4, "short text"), (None, "w0 w7919 w15838")]


def test_long_texts_are_whole_in_the_counting_operators(spark, frame, long_rows, tokenizer):
    df = frame(long_rows)
    bench = spark.createDataFrame([("a", " ".join(f"w{k * 7919 % 100_003}" for k in range(250_000, 250_020))), ("b", "z " * 30)], "item_id string, text string")
    found = {r["doc_id"]: r for r in decontaminate.find_contamination(df, bench).collect()}
    assert (found[1]["n_words"], found[1]["items"]) == (300_000, ["a"]) and found[1]["n_hit"] in (20, 40, 60)
    assert found[2]["n_hit"] == found[2]["n_words"] == 400_000 and found[3]["n_words"] == 1
    removed = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(df).collect()}
    # the words' order comes again after 100,003 of them
    assert removed[1] == (300_000, 300_000) and removed[2] == (400_000, 400_000) and removed[3] == (1, 0)
    judged = {r["doc_id"]: r for r in quality_rules.judge_documents(df).collect()}
    assert judged[2]["n_repeat_words"] == 400_000 and judged[3]["word_chars"] == 1_500_000 and judged[1]["n_words"] == 300_000
    ranks = bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, ranks.rank).collect()}
    assert all(counts[i] > 0 for i, _ in long_rows) and counts[4] == len(tokenizer.encode_ordinary("short text"))
    encoded = {r["doc_id"]: r["n_tokens"] for r in bpe.encode(df.where("doc_id <> 3"), ranks).collect()}
    assert encoded[1] == len(tokenizer.encode_ordinary(long_rows[0][1])) and encoded[2] == len(tokenizer.encode_ordinary(long_rows[1][1]))

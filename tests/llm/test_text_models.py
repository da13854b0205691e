"""Language model, toxicity, quality classifier and quality rules on small texts."""

import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm_score, quality_classifier, quality_rules, toxicity
from tidemark.llm import words as W
from tidemark.llm.common import crc_mod

from .conftest import LOW


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), None]


# ---------------------------------------------------------------- language model


def learns(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 != 1


def test_counts_and_base_scores_match_brute_force(frame, words):
    got = lm_score.score_texts(frame(words), crc_mod(F.col("doc_id"), 5) != 1).collect()
    count = Counter(x for i, t in words if learns(i) for x in tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(tokens(t)), sum(count[x] > 0 for x in tokens(t)),
                   round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens(t)), 6)) for i, t in words)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and r["score"] <= 1e-9 for r in got)


def test_each_state_is_a_distribution():
    """Known words and the unknown one sum to one after any history."""
    texts = pa.array(["a b a b a b a c", "a b c a b a b", "c c a b"])
    block = W.find_words(W.fold_ascii(W.text_buffer(texts)[0]), W.text_buffer(texts)[1], W.SPACES)
    seen = lm_score.Tokens(block)
    grams = []
    for m in range(lm_score.ORDER):
        keys, at, count = np.unique(seen.key[m], return_index=True, return_counts=True)
        keep = count >= (2 if m else 1)
        grams.append([keys[keep], count[keep], seen.state[m][at][keep]])
    n, v = len(seen.owner), len(grams[0][0])
    model = lm_score.Model(n, v, int((grams[0][1] == 1).sum()), [grams[0][:2], *grams[1:]])
    names = ["a", "b", "c"]
    for history in ([], ["a"], ["b"], ["a", "b"], ["b", "a"], ["c", "c"]):
        total = 0.0
        for word in [*names, None, "unknown"]:
            text = " ".join([*history, *([word] if word else [])])
            data, offsets = W.text_buffer(pa.array([text]))
            one = lm_score.Tokens(W.find_words(data, offsets, W.SPACES))
            log, count = model.traverse(one)
            p = 10 ** log[len(history)]
            total += p if count[len(history)] else p * model.unknown
        assert total == pytest.approx(1, abs=1e-6)


def test_the_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lm_score.score_texts(docs, crc_mod(F.col("doc_id"), 5) != 1).where(crc_mod(F.col("doc_id"), 5) == 1)
    base, score = got.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_model_edges(frame, words):
    assert lm_score.score_texts(frame(words).limit(0), F.lit(True)).collect() == []
    nothing = lm_score.score_texts(frame(words[:5]), F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == 0 for r in nothing)


def backoff_score(texts, learnt):
    """Scores by the definition, with all n-grams of at least two occurrences."""
    pad = [[None, None, *tokens(t)] for t in texts]
    seen = [Counter(tuple(w[k - m:k + 1]) for w, ok in zip(pad, learnt, strict=True) if ok for k in range(2, len(w))) for m in range(3)]
    starts = sum(learnt)
    n, v, ones = sum(seen[0].values()), len(seen[0]), sum(c == 1 for c in seen[0].values())
    d = min(0.95, max(0.05, ones / v))

    def total(h):
        return starts if h in ((None,), (None, None)) else seen[len(h) - 1][h]

    arcs = [{}, Counter(), Counter()]
    for m in (1, 2):
        for g, c in seen[m].items():
            if c >= 2:
                arcs[m][g[:-1]] += (c - 0.75) / total(g[:-1])

    def p(w, k):
        c = seen[0][(w[k],)]
        out = max(c - d, 0.05) / n if c else d * v / n
        for m in (1, 2):
            g = tuple(w[k - m:k + 1])
            out *= max(1 - arcs[m][g[:-1]], 1e-9)
            out += (seen[m][g] - 0.75) / total(g[:-1]) if seen[m][g] >= 2 else 0
        return out

    return [sum(math.log10(p(w, k)) for k in range(2, len(w))) for w in pad]


@pytest.mark.parametrize("chunk", [1 << 23, 3000])
def test_scores_match_the_definition(frame, words, chunk):
    got = lm_score.score_texts(frame(words), crc_mod(F.col("doc_id"), 5) != 1, chunk_bytes=chunk).collect()
    want = backoff_score([t for _, t in words], [learns(i) for i, _ in words])
    assert sorted((str(r["doc_id"]), round(r["score"], 6)) for r in got) == sorted((str(i), round(x, 6)) for (i, _), x in zip(words, want, strict=True))


def test_rare_ngrams_have_arcs_in_large_corpora(frame):
    """An n-gram seen twice counts, however many tokens there are."""
    rows = [(k, f"u{k}a u{k}b u{k}c " * 300) for k in range(80)] + [(100, "red fox runs"), (101, "red fox runs"), (102, "runs red fox")]
    got = {r["doc_id"]: r["score"] for r in lm_score.score_texts(frame(rows), F.lit(True)).collect()}
    want = backoff_score([t for _, t in rows], [True] * len(rows))
    assert sum(len(tokens(t)) for _, t in rows) > 4 * 16384
    assert [got[i] for i, _ in rows] == pytest.approx(want, abs=1e-6)


def test_scoring_writes_little_beside_the_texts(spark, frame):
    """Texts are not shuffled, and the files of earlier rounds go."""
    rnd = np.random.default_rng(3)
    names = np.array(["".join(x) for x in rnd.choice(list("abcdefghijklmnopqrstuvwxyz"), (30_000, 6))])
    rows = [(k, " ".join(names[np.minimum(rnd.zipf(1.3, 400) - 1, len(names) - 1)])) for k in range(1000)]
    size = sum(len(t) for _, t in rows)
    docs = frame(rows).select("doc_id", "text")
    local = [str(x) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    kept = spark.sparkContext.getCheckpointDir().removeprefix("file:")

    def used():
        time.sleep(2)  # files go in the background
        return {f: f.stat().st_size for top in [*local, kept] for f in Path(top).rglob("*") if f.is_file()}

    before = used()
    got = lm_score.score_texts(docs, F.lit(True), chunk_bytes=size // 4)
    assert len(got.collect()) == len(rows)
    written = sum(n for f, n in used().items() if f not in before)
    assert written < 1.2 * size


# ---------------------------------------------------------------- toxicity


@pytest.fixture(scope="module")
def spoken(spark):
    rnd = random.Random(9)
    clean = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnr"]
    rows, labels = [], []
    for i in range(400):
        w = [rnd.choice(clean) for _ in range(rnd.randint(8, 60))]
        toxic = i % 4 == 0
        for _ in range(max(2, len(w) // 10) if toxic else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["zorkel", "grumpft", "snarkex", "snarkid", "snarkum"]))
        if not toxic and i % 5 == 0:
            w += ["friendly", "grumpft"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_texts_are_found(frame, spoken):
    rows, labels = spoken
    extra = [(9001, "bal Z0RKEL dem, zorke1 fin gr\u0443mpft"), (9002, "snarkolo " * 3), (9003, None), (9004, ""), (None, "zorkel zorkel"),
             (9005, "bal dem friendly grumpft fin gor"), (9006, "bal " * 30000)]
    found = toxicity.score_toxicity(frame(rows + extra), labels, F.col("doc_id") % 3 != 1).collect()
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in found}
    held = [i for i, _ in rows if i % 3 == 1]
    wrong = [i for i in held if got[i][1] != (i % 4 == 0)]
    assert len(wrong) <= 0.03 * len(held), [(i, got[i], dict(rows)[i]) for i in wrong[:4]]
    assert [got[i][1] for i in (9001, 9002, 9003, 9004, 9005, 9006)] == [1, 1, 0, 0, 0, 0] and got[None][1] == 1
    assert got[9003][0] == got[9004][0] == min(s for s, _ in got.values())
    assert all(0 <= s <= 1 for s, _ in got.values())


def test_toxicity_edges(frame, spoken):
    rows, labels = spoken
    assert toxicity.score_toxicity(frame(rows).limit(0), labels, F.lit(True)).collect() == []
    blind = toxicity.score_toxicity(frame(rows[:9]), labels.limit(0), F.lit(True)).collect()
    assert len(blind) == 9 and not any(r["predicted"] for r in blind)


@pytest.mark.parametrize("support", [1 << 18, 0])
def test_rare_toxic_words_are_learnt_from_many_labels(spark, monkeypatch, support):
    """Four toxic texts are enough, be there 5000 others of them."""
    monkeypatch.setattr(toxicity, "SUPPORT", support)
    rows = [("bal zorkel dem", 1)] * 5000 + [("bal quibbex dem", 1)] * 4 + [("bal grumpft dem", 1)] * 2 + [("bal dem fin", 0)] * 60000 + [("bal friendly fin", 0)] * 9
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "_text string, y int"))
    assert {"=zorkel", "=quibbex"} <= set(lexicon.weights) and not {"=grumpft", "=bal", "=friendly"} & set(lexicon.weights)
    assert lexicon.weights["=quibbex"] == pytest.approx((math.log(4.5 / 5007) - math.log(0.5 / 60010)) * 4 / 7)


def test_folding():
    assert toxicity.fold("\u0406DI0T m0r\u043en tr4$h a@b $5") == "idiot moron trash aab $s"
    assert toxicity.fold(None) == ""


# ---------------------------------------------------------------- quality classifier


@pytest.fixture(scope="module")
def judged(spark):
    rnd = random.Random(3)
    vocabulary = [f"{a}{b}{c}{d}" for a in "bdfg" for b in "aeiou" for c in "lmnr" for d in ("", "es", "ing")]
    rows, labels = [], []
    for i in range(600):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 120))]
        bad = i % 6 == 0
        if bad:
            w = [x.upper() + "!!" for x in w] if i % 12 else [w[k // 9] for k in range(len(w))]
        rows.append((i, (" ".join(w) + ".").capitalize() if not bad else " ".join(w)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(not bad)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int")


def test_low_quality_is_told_from_positives_and_unlabelled_text_alone(frame, judged):
    rows, labels = judged
    positives = labels.where("quality = 1")  # no negative is ever seen
    found = quality_classifier.score_quality(frame([*rows, (7001, None), (7002, ""), (None, "x")]), positives, F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in found.collect()}
    right = [got[i][1] == (i % 6 != 0) for i, _ in rows]
    assert sum(right) / len(right) > 0.97
    assert got[7001] == got[7002] and all(0 <= s <= 1 for s, _ in got.values())


def test_classifier_edges(frame, judged):
    rows, labels = judged
    assert quality_classifier.score_quality(frame(rows).limit(0), labels, F.lit(True)).collect() == []
    blind = quality_classifier.score_quality(frame(rows[:7]), labels.limit(0), F.lit(True)).collect()
    assert {r["score"] for r in blind} == {0.5}
    df = frame([*rows, (None, "X!! " * 50)])
    left = quality_classifier.drop_low_quality(df, labels, F.lit(True))
    assert left.columns == df.columns and left.where("doc_id is null").count() == 1 and 480 <= left.count() <= 520


def test_good_texts_of_a_clashing_id_stay(frame, judged):
    rows, labels = judged
    left = quality_classifier.drop_low_quality(frame([*rows, (0, rows[1][1])]), labels, F.lit(True)).where("doc_id = 0").collect()
    assert [r["text"] for r in left] == [rows[1][1]]


# ---------------------------------------------------------------- quality rules


def counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(w[s:s + 5]) for s in range(len(w) - 4))
    repeat = {s + k for s in range(len(w) - 4) if windows[tuple(w[s:s + 5])] > 1 for k in range(5)}
    lines = Counter(x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), sum(c - 1 for c in lines.values()), len(repeat))


def test_counts_match_brute_force(frame, words):
    rows = [*words, (500, "a\nb\na\n a\n\n\n"), (501, "#x %% |é| <>\n#x %% |é| <>"), (502, "a b c d e f a b c d e g")]
    got = quality_rules.judge_documents(frame(rows)).collect()
    have = sorted(str((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])) for r in got)
    want = [(i, *counts(t)) for i, t in rows]
    assert have == sorted(str((*r, r[1] < 10 or 100 * r[5] > 20 * r[1])) for r in want)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_a_bad_host_is_rejected_and_a_small_one_gets_the_benefit(spark):
    good, bad = " ".join(f"w{k}" for k in range(30)), "x"
    rows = [(i, good, "fine") for i in range(200)] + [(300 + i, bad if i % 10 else good, "junk") for i in range(200)]
    rows += [(600 + i, good, f"h{i % 20}") for i in range(400)] + [(1100, bad, "tiny"), (1101, good, "tiny"), (1102, good, None), (1103, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge_documents(docs).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[300 + i] for i in range(200))
    assert kept[1101] and kept[1102] and not kept[1100] and not kept[1103]
    assert quality_rules.judge_documents(docs.limit(0)).collect() == []


def test_long_words_are_counted_in_linear_time():
    """Spans on both sides of LONG_BYTES count alike, and 5 MB take seconds."""
    import time

    from tidemark.llm.token_counts import LONG_BYTES, Automaton

    automaton = Automaton([b"ab", b"abc", b"bca", b"ca", b"aaaa", b"abcab"])
    rnd = np.random.default_rng(3)
    for size in (1, 7, LONG_BYTES, LONG_BYTES + 1):
        span = bytes(rnd.choice(list(b"abc"), size).tolist())
        data = np.frombuffer(span, np.uint8)
        assert automaton.count_long(span) == _greedy(span, [b"ab", b"abc", b"bca", b"ca", b"aaaa", b"abcab"]) == automaton.counts(data, np.array([0]), np.array([size]))[0]
    begin = time.process_time()
    data = np.frombuffer(b"abca" * (5 << 18), np.uint8)
    assert automaton.counts(data, np.array([0]), np.array([len(data)]))[0] > 0 and time.process_time() - begin < 10


def _greedy(span, vocabulary):
    n, at = 0, 0
    while at < len(span):
        at += max([1, *(len(v) for v in vocabulary if span.startswith(v, at))])
        n += 1
    return n

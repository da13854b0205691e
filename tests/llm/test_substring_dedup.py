"""Removal of repeated windows against a brute-force count of all windows."""

import re
from collections import Counter

import pytest

from tidemark.llm import substring_dedup


def brute(rows, window):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    count = Counter(tuple(w[s:s + window]) for _, w in texts for s in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = {s + k for s in range(len(w) - window + 1) if count[tuple(w[s:s + window])] > 1 for k in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,anchor", [(35, 8), (12, 4), (9, 9)])
def test_removal_matches_brute_force(frame, words, window, anchor):
    got = substring_dedup.remove_repeats(frame(words), window=window, anchor=anchor)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(words, window)


def test_passages_cut_short_and_spliced(frame):
    """Repeats that begin and end inside other repeats."""
    import random

    rnd = random.Random(8)
    pool = [f"p{k}" for k in range(200)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            a = rnd.randrange(150)
            parts += pool[a:a + rnd.randint(5, 50)] + [f"u{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(0, 6))]
        rows.append((i, " ".join(parts)))
    got = substring_dedup.remove_repeats(frame(rows), window=14, anchor=4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 14)


def test_spans_cover_what_is_removed_and_paths_agree(frame):
    passage = " ".join(f"q{k}" for k in range(60))
    rows = [(1, "a b c " + passage), (2, passage + " d e"), (3, "f " + passage + " g"), (4, "nothing here")]
    spans = substring_dedup.repeated_spans(frame(rows)).collect()
    assert {r["doc_id"] for r in spans} == {1, 2, 3}
    for doc, first in ((1, 3), (2, 0), (3, 1)):
        mine = [r for r in spans if r["doc_id"] == doc]
        assert min(r["start"] for r in mine) == first and max(r["end"] for r in mine) == first + 60
    inner = [{r["path"] for r in spans if r["doc_id"] == d} for d in (1, 2, 3)]
    assert inner[0] & inner[1] & inner[2]


def test_applied_to_documents(frame):
    passage = " ".join(f"q{k}" for k in range(40))
    df = frame([(1, "a  b " + passage), (2, passage), (3, "kept  as it\nis"), (None, None)])
    out = substring_dedup.apply_removal(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a b", 2: "", 3: "kept  as it\nis", None: None}


def test_empty_table(frame):
    assert substring_dedup.remove_repeats(frame([(1, "a")]).limit(0)).collect() == []


def brute_paths(rows, window):
    """Maximal runs of repeated windows of which each has one next and one last
    window wherever it occurs: (document, first word, end) and the windows."""
    docs = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    wins = {i: [tuple(w[s:s + window]) for s in range(len(w) - window + 1)] for i, w in docs.items()}
    count = Counter(x for w in wins.values() for x in w)
    after, before = {}, {}
    for w in wins.values():
        for s, x in enumerate(w):
            after.setdefault(x, set()).add(w[s + 1] if s + 1 < len(w) else None)
            before.setdefault(x, set()).add(w[s - 1] if s else None)
    out = set()
    for i, w in wins.items():
        begin = None
        for s in range(len(w) + 1):
            held = s < len(w) and count[w[s]] > 1
            joins = held and s and count[w[s - 1]] > 1 and after[w[s - 1]] == {w[s]} and before[w[s]] == {w[s - 1]}
            if begin is not None and not joins:
                out.add((i, begin, s - 1 + window, w[begin]))
                begin = None
            if held and begin is None:
                begin = s
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_paths_are_the_graphs_nonbranching_ones(frame, seed):
    """Spans and names against the graph of all windows, on spliced passages."""
    import random

    rnd = random.Random(seed)
    pool = [f"p{k}" for k in range(120)]
    rows = []
    for i in range(25):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            a = rnd.randrange(90)
            parts += pool[a:a + rnd.randint(14, 60)] + [f"u{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(0, 4))]
        rows.append((i, " ".join(parts)))
    want = brute_paths(rows, 12)
    got = substring_dedup.repeated_spans(frame(rows), window=12, anchor=4).collect()
    assert {(r["doc_id"], r["start"], r["end"]) for r in got} == {x[:3] for x in want}
    names = {(r["doc_id"], r["start"]): r["path"] for r in got}
    by_path = {}
    for i, start, _, first in want:
        by_path.setdefault(first, set()).add(names[i, start])
    assert all(len(x) == 1 for x in by_path.values()) and len({x for v in by_path.values() for x in v}) == len(by_path)


def test_rows_whose_short_text_hashes_clash_keep_their_words(spark, frame):
    """Two texts with one 32-bit hash, without an id; one of them also under an id."""
    from pyspark.sql import functions as F

    texts = spark.range(400_000).select(F.concat_ws(" ", *[F.concat(F.lit(c), F.col("id") * 7 + k) for k, c in enumerate("abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrs")]).alias("t"))
    clash = texts.withColumn("h", F.hash("t")).groupBy("h").agg(F.collect_list("t").alias("ts")).where("size(ts) > 1").first()
    one, two = clash["ts"][:2]
    got = substring_dedup.remove_repeats(frame([(None, one), (None, two), (7, one)])).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("7", 45), ("None", 0), ("None", 45)]


def test_many_rows_without_an_id_or_of_one_id(frame):
    passage = " ".join(f"q{k}" for k in range(40))
    rows = [(None, f"n{k} {passage}") for k in range(30)] + [(5, f"m{k} " + " ".join(f"v{k}x{j}" for j in range(50))) for k in range(30)] + [(5, "m3 " + " ".join(f"v3x{j}" for j in range(50)))]
    got = substring_dedup.remove_repeats(frame(rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 35)


def test_runs_of_one_word_are_one_row(frame):
    """Exact as the brute force, while a run of any length is one k-mer's row."""
    import pyarrow as pa

    rows = [(k, f"a{k} b{k} " + "osa " * (30 + 9 * k) + f"c{k} " + "x y " * (5 * k) + "z") for k in range(12)] + [(99, "lone " * 90), (100, "q " * 35)]
    got = substring_dedup.remove_repeats(frame(rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 35)
    names = {(r["doc_id"], r["start"], r["end"]) for r in substring_dedup.repeated_spans(frame(rows), window=12, anchor=4).collect()}
    assert names == {x[:3] for x in brute_paths(rows, 12)}
    batch = pa.RecordBatch.from_pydict({"k": [1], "h": [2], "_text": ["run " * 5000]})
    assert sum(b.num_rows for b in substring_dedup._occurrences(iter([batch]), 35, 8)) <= 2

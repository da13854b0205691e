"""Near-duplicates against all pairs."""

import re

import numpy as np
import pyarrow as pa

from tidemark.llm import near_dup
from tidemark.llm import words as W

from .conftest import LOW


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(zip(*[w[k:] for k in range(5)]))


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=str)


def test_components_are_those_of_all_pairs(frame, words):
    got = [tuple(r) for r in near_dup.near_duplicates(frame(words)).collect()]
    assert sorted(got, key=str) == brute(words)


def test_a_large_group_of_edited_copies(frame):
    import random

    rnd = random.Random(2)
    base = [f"w{rnd.randrange(40)}x{k}" for k in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(20)}"
        rows.append((i, " ".join(w)))
    got = [tuple(r) for r in near_dup.near_duplicates(frame(rows)).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert 1 < len({r[2] for r in got}) < 150


def test_empty_table(frame):
    assert near_dup.near_duplicates(frame([(1, "a")]).limit(0)).collect() == []
    assert near_dup.near_duplicates(frame([(1, None), (2, "")])).count() == 2


def test_one_document_of_each_group_stays(frame, words):
    df = frame(words)
    left = near_dup.drop_near_duplicates(df)
    assert left.columns == df.columns
    want = {r[0] for r in brute(words) if r[3] and r[0] is not None}
    ids = [r["doc_id"] for r in left.collect()]
    assert {i for i in ids if i is not None} == want and len([i for i in ids if i is not None]) == len(want)
    assert ids.count(None) == 2


def test_signatures_do_not_depend_on_the_block():
    texts = ["a b c d e f g h i j", "k l m n o p", "a b c d e f g h i j"]
    one = [b for _, b in W.blocks(pa.array(texts), W.SPACES, True)][0]
    alone = [b for _, b in W.blocks(pa.array(texts[2:]), W.SPACES, True)][0]
    h, f = near_dup.shingle_sets(one)
    g, e = near_dup.shingle_sets(alone)
    assert np.array_equal(h[f[0]:f[1]], h[f[2]:f[3]]) and np.array_equal(h[f[2]:f[3]], g)


def test_min_max_estimates_the_similarity():
    rng = np.random.default_rng(3)
    shared, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    sets = np.concatenate([shared, a, shared, b])
    sig = near_dup.min_max(W.mix(sets), np.array([0, 900]), 512)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.05


def test_other_texts_of_a_clashing_id_stay(frame):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    left = near_dup.drop_near_duplicates(frame([(1, a), (1, b), (2, a), (2, b + " end"), (3, a), (2, "else"), (2, "else"), (1, None)]))
    assert sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == [(1, ""), (1, a), (1, b), (2, "else")]


def test_a_large_group_is_measured_in_copies_of_its_centre(frame, monkeypatch):
    """All rows of one star, with a copy of the centre's set for each three pairs."""
    monkeypatch.setattr(near_dup, "STAR_ROWS", 3)
    base = [f"w{k}" for k in range(80)]
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(30)] + [(100 + i, " ".join(f"v{i}x{k}" for k in range(20))) for i in range(3)]
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(frame(rows)).collect()}
    assert got == {i: 0 if i < 30 else i for i, _ in rows}

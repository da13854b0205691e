"""The trie of conversation prefixes against a plain Python trie."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import prefix_trie as P

SCHEMA = "conv_id long, turn int, role string, text string, c string, depth int, n string"


def frame_of(spark, rows):
    """Rows (conv_id, turn, role, text) with columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def rebuilt_brute(rows, every=20, most=3):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    for c in turns:
        turns[c] = [x[2:] for x in sorted(turns[c], key=lambda x: x[:2])]  # cases have no ties but equal rows
    if not every:
        return dict(turns)
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        out[c] = turns.get(c - int(np.fmod(c, every)), [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members[p]) - 1) * words
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def result(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def conversations(seed, n):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.choice([1, 1, 2, 3, 5, 9])):
            text = rnd.choice(["a", "b b", "c\tc c", "", None]) if rnd.random() < 0.85 else f"own {c} {t}"
            rows.append((c, t if t or rnd.random() < 0.7 else None, rnd.choice(["user", "assistant", None]) if rnd.random() < 0.2 else "user", text))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("every,least,nodes", [(20, 1, 10), (20, 256, 100_000), (None, 3, 50), (None, 1000, 5)])
def test_nodes_match_brute_force(spark, every, least, nodes):
    rows = conversations(least, 150)
    turns = P.turn_digests(frame_of(spark, rows))
    rebuilt = P.with_shared_heads(turns, every, 3) if every else P.whole(turns)
    assert result(P.prefix_trie(rebuilt, least, nodes)) == brute(rebuilt_brute(rows, every))


def test_edges(spark):
    """Equal conversations, prefixes of others, negative and absent first ids, a
    conversation without turns of its own, rows without an id."""
    rows = [(21, 0, "user", "x y"), (22, 0, "user", "x y"), (23, 0, "user", "x y"), (23, 1, "user", "z"), (-3, 1, None, None), (-3, 2, "", ""),
            (40, 0, "user", "q"), (41, 0, "u", "gone"), (42, 0, "u", "gone"), (43, 0, "u", "gone"), (None, 0, "user", "nobody"), (40, 1, "user", "q")]
    rebuilt = P.with_shared_heads(P.turn_digests(frame_of(spark, rows)), 20, 3)
    assert result(P.prefix_trie(rebuilt, 1, 2)) == brute(rebuilt_brute(rows))
    assert any(not turns for turns in rebuilt_brute(rows).values())


def test_repeated_turn_numbers_and_one_long_conversation(spark):
    rows = [(1, 0, "user", f"w{k % 3}") for k in range(3000)] + [(2, 0, "user", "w0"), (2, 0, "user", "w0"), (3, None, "user", "w0")]
    got = result(P.prefix_trie(P.whole(P.turn_digests(frame_of(spark, rows)))))
    assert max(r[1] for r in got) == 3000 and sum(r[3] for r in got if r[1] == 0) == 3
    assert got == result(P.prefix_trie(P.whole(P.turn_digests(frame_of(spark, rows[::-1])))))


def test_empty_table(spark):
    assert P.prefix_trie(P.with_shared_heads(P.turn_digests(frame_of(spark, []).limit(0)), 20, 3)).collect() == []


def test_slots_are_minimal_and_lookups_are_checked():
    rnd = np.random.default_rng(5)
    a, b = rnd.integers(0, 1 << 63, 5000).astype(np.uint64), rnd.integers(0, 1 << 63, 5000).astype(np.uint64)
    a[:50] = a[0]  # half of a digest alone doesn't tell nodes apart
    table = P.SlotTable(a, b)
    assert sorted(table.slots.tolist()) == list(range(5000))
    assert (table.find(a, b) == table.slots).all()
    assert (table.find(a[:100], b[100:200]) == -1).all() and len(P.SlotTable(a[:0], b[:0]).find(a, b)) == 5000
    with pytest.raises(ValueError):
        P.SlotTable(a[[1, 1]], b[[1, 1]])


def test_ids_of_one_node_are_hashed_piece_by_piece(monkeypatch):
    monkeypatch.setattr(P, "PIECE_BYTES", 21 * 7)
    ids = np.arange(100)
    batches = [pa.RecordBatch.from_pydict({"pa": [1] * 50, "pb": [2] * 50, "c": ids[:50]}), pa.RecordBatch.from_pydict({"pa": [1] * 50 + [3], "pb": [2] * 51, "c": [*ids[50:], 7]})]
    pieces = list(P._pieces(iter(batches)))
    assert sum(p.num_rows for p in pieces) == 8 + 8 + 1
    rows = [tuple(r.values()) for p in P._hashed(iter(pieces)) for r in p.to_pylist()]
    assert rows == [(1, 2, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()), (3, 2, hashlib.sha256(b"7").hexdigest())]

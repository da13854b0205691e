"""Language-model scores by a weighted backoff automaton over words.

States are the last words of the history (up to ``ORDER - 1``, or none, the
root). A state has arcs for the smoothed n-grams that start with it, and a
failure arc, with the weight of what smoothing took off, to the state without
its oldest word. The root has an arc for every word of the learning texts; its
failure arc is the unknown word. Each text is traversed once from left to
right: the state goes along, arcs and failure arcs add up their
log-probabilities. Vectorised over the tokens of a block, a token's state is
looked up from its history, as the state of a backoff automaton is a function
of the last words.

Smoothing is interpolated absolute discounting; the root's discount is chosen
so that the unknown word gets the Good-Turing mass, singletons / tokens. The
probabilities of all known words and the unknown one sum to one in each state.

Every n-gram of two or three tokens that occurs at least ``LEAST`` times in the
learning texts has an arc, at every size of the corpus; nothing is ranked or
cut by a share of the tokens.

Texts are read once, where they lie, in chunks of about ``CHUNK_BYTES``; no text
is shuffled. A chunk is written as its distinct words and its tokens as ranks
among them. Counts are made where they are asked for, in two rounds of packed
arrays, with no table that must fit in one place:

* A chunk asks for its distinct words and pairs, with their learnt counts, by
  parts of their hashes. A part sums the counts of all chunks and answers in the
  order of the questions, and numbers the keys that may have arcs, by which they
  are known from then on; one of the chunks that hold a pair is marked to own it.
* A triple occurs twice only if both its pairs do, so only such triples are asked
  for: under their first pair, whose part has all that follows it, and answers
  with the sums of its arcs too. The sums of a word's arcs are added up from
  the pairs that chunks own. At the start of a text a triple is its pair.
* With these answers a chunk has every arc and failure weight that its texts
  use, and traverses them.

Frequent keys are not hot: a chunk sends each of its keys once. Shuffle files of
a round go when its answers are written.

Null and empty texts are one end token. Repeated rows are each scored and each
counted. Rows whose ``may_learn`` is null are not learnt from. Without learning
texts N, V and all counts are 0 and every word is unknown, at probability one.
An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import cut, give_back, map_arrow, without_old_shuffles

ORDER = 3
#: Least count of an n-gram of two or three tokens that has an arc.
LEAST = 2
DISCOUNT = 0.75
#: Text of a chunk, and about as much of all texts in a part.
CHUNK_BYTES = 8 << 20

#: The end token's hash, also the history of a text's first words.
END = np.uint64(0x5E3D0F1A2B4C6D7F)


class Tokens:
    """Words and end tokens of a block: ``key[m]`` is the hash of each token
    with the m tokens before it, ``state[m]`` that of those m alone."""

    def __init__(self, block: W.Words):
        token = np.insert(block.hash, block.first[1:], END)
        counts = block.counts() + 1
        self.owner = np.repeat(np.arange(len(block)), counts)
        place = np.arange(len(token)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.key, self.state, empty = [token], [np.zeros(len(token), np.uint64)], END
        for _ in range(1, ORDER):
            # the state is the last token's key of one order less, at a text's start that of end tokens
            last = self.key[-1]
            state = np.where(place > 0, np.append(empty, last[:-1]) if len(last) else last, empty)
            self.state.append(state)
            self.key.append(_join(state, token))
            empty = _join(np.array([empty]), np.array([END]))[0]


def _join(state: np.ndarray, token: np.ndarray) -> np.ndarray:
    return W.mix(state * np.uint64(0x9E3779B97F4A7C15) + W.mix(token))


#: State keys of a text's start, by order.
START = [np.uint64(0), END]
for _m in range(2, ORDER):
    START.append(_join(np.array([START[-1]]), np.array([END]))[0])


def _among(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in the sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class Root:
    """The state without a history, from the numbers of tokens, words and words seen once."""

    def __init__(self, n: int, v: int, singles: int):
        self.n, self.v = n, v
        self.discount = min(0.95, max(0.05, singles / v)) if v else 0.0
        self.unknown = self.discount * v / n if n else 1.0

    def root(self, count: np.ndarray) -> np.ndarray:
        return np.maximum(count - self.discount, 0.05) / max(self.n, 1)


def along(p: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log probabilities from those at the root, through the failure arcs'
    weights and the arcs' shares of each longer history."""
    for back, share in steps:
        p = p * back + share
    return np.log10(p)


class Model(Root):
    """The automaton as sorted tables, built on the driver from bounded counts.

    ``arcs[m]`` and ``share[m]``: n-grams of m + 1 tokens and what they add to
    their state's probability; ``states[m]`` and ``back[m]``: keys of states of
    m tokens and the weight of their failure arc."""

    def __init__(self, n: int, v: int, singles: int, grams: list[list[np.ndarray]]):
        super().__init__(n, v, singles)
        self.word, self.count = grams[0]
        self.arcs, self.share = [self.word], [self.root(self.count)]
        self.states, self.back = [np.zeros(0, np.uint64)], [np.zeros(0)]
        for m in range(1, ORDER):
            key, count, state = grams[m]
            below, there = _among(grams[m - 1][0], state)
            total = np.where(there, grams[m - 1][1][below], 0) if len(grams[m - 1][0]) else np.zeros(len(key))
            ends, has = _among(self.word, np.array([END]))
            if has[0]:  # as often as texts begin
                total = np.where(state == START[m], self.count[ends[0]], total)
            share = np.where(total > 0, np.maximum(count - DISCOUNT, 0) / np.maximum(total, 1), 0.0)
            states, inverse = np.unique(state, return_inverse=True)
            self.arcs.append(key)
            self.share.append(share)
            self.states.append(states)
            self.back.append(np.maximum(1 - np.bincount(inverse, weights=share, minlength=len(states)), 1e-9) if len(states) else np.zeros(0))

    def traverse(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """For every token its log probability and count. For a token without a
        root arc in the table the count is 0, and the log only that of the
        failure arcs down to the root."""
        at, own = _among(self.word, tokens.key[0])
        count = np.where(own, self.count[at], 0) if len(self.word) else np.zeros(len(own), np.int64)
        p = np.where(own, self.share[0][at], 1.0) if len(self.word) else np.ones(len(own))
        steps = []
        for m in range(1, ORDER):
            if not len(self.arcs[m]):
                continue
            at, there = _among(self.states[m], tokens.state[m])
            back = np.where(there, self.back[m][at], 1.0)
            at, there = _among(self.arcs[m], tokens.key[m])
            steps.append((back, np.where(there, self.share[m][at], 0.0)))
        return along(p, steps), count


class Chunk:
    """Texts of one chunk. ``words`` are its distinct words, sorted; ``word`` and
    ``pair`` the numbers of each token and of it with the one before it (at a
    text's start the end token) among ``words`` and the pairs. ``hashes`` are the
    pairs', ``asked`` their order by hash, ``history`` and ``last`` their words."""

    def __init__(self, words: np.ndarray, word: np.ndarray, counts: np.ndarray, learn: np.ndarray):
        self.words, self.word, self.counts, self.learn = words, word, counts, learn
        self.owner = np.repeat(np.arange(len(counts)), counts)
        self.learnt = learn[self.owner]
        self.fresh = np.zeros(len(word), bool)
        self.fresh[np.cumsum(counts) - counts] = True
        self.end = int(np.searchsorted(words, END))
        before = np.where(self.fresh, self.end, np.roll(word, 1))
        pairs, self.pair = np.unique(before * len(words) + word, return_inverse=True)
        self.history, self.last = pairs // len(words), pairs % len(words)
        self.hashes = _join(words[self.history], words[self.last])
        self.asked = np.argsort(self.hashes)

    def triples(self, pair_n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct triples whose two pairs have arcs, inside texts: their first
        pairs and last words; the tokens that end one, and which it is."""
        before = np.roll(self.pair, 1)
        at = np.flatnonzero(~self.fresh & (pair_n[before] > 0) & (pair_n[self.pair] > 0))
        found, which = np.unique(before[at] * len(self.words) + self.word[at], return_inverse=True)
        return found // len(self.words), found % len(self.words), at, which


def _pack(values: np.ndarray) -> bytes:
    """Eight-byte numbers, byte by byte of all, compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    if not n:
        return np.zeros(0, np.uint64)
    raw = pa.decompress(blob[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.uint64).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob), dtype=np.uint64)


def _joined(blobs: list[bytes], unpack: Callable[[bytes], np.ndarray] = _unpack) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *map(unpack, blobs)])


#: Kinds of rows. TEXTS: a chunk (words, their counts, tokens as ranks by count,
#: tokens of each text, whether it is learnt from, ids). Asked of a part and
#: answered to a chunk, for its keys in order:
#: WORDS (words, counts): counts; numbers, for those of LEAST and more
#: PAIRS (pairs, counts): twice the count, and one more where the chunk owns the
#: pair, zero below LEAST; numbers of the others
#: WORD_ARCS (numbers, sum and number of the arcs that the chunk owns): sum, number
#: PAIR_ARCS (numbers, number of triples, triples' last words, counts): sum and
#: number of arcs, counts of triples
TEXTS, WORDS, PAIRS, WORD_ARCS, PAIR_ARCS = range(5)
_PACKED = "kind int, part long, chunk long, a binary, b binary, c binary, d binary, e binary, f binary, n long, v long, singles long"
_ARROW = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("chunk", pa.int64()), *((x, pa.binary()) for x in "abcdef"),
                    *((x, pa.int64()) for x in ("n", "v", "singles"))])


def _row(kind: int, part: int, chunk: int, *arrays: np.ndarray | bytes) -> dict:
    return {"kind": kind, "part": part, "chunk": chunk, **{x: y if isinstance(y, bytes) else _pack(y) for x, y in zip("abcdef", arrays, strict=False)}, "n": 0, "v": 0, "singles": 0}


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _ARROW)


def _parts(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Parts of sorted keys by their first bits, in order."""
    part = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    begins = np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)])
    for begin, end in zip(begins, np.append(begins, len(part))[1:], strict=True):
        yield int(part[begin]), slice(begin, end)


def _pack_ids(ids: list[pa.Array]) -> bytes:
    out = pa.BufferOutputStream()
    table = pa.table({"_id": pa.chunked_array(ids)})
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
        to.write_table(table)
    return out.getvalue().to_pybytes()


def _ask(batches: Iterator[pa.RecordBatch], bits: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Chunks of a partition's texts, and what they ask for first."""
    number, size, held = TaskContext.get().partitionId() << 32, 0, []
    for batch in batches:
        learn = batch.column("_learn").to_numpy(zero_copy_only=False).astype(bool)
        for begin, block in W.blocks(batch.column("_text"), W.SPACES, fold=True, block_bytes=min(W.BLOCK_BYTES, chunk_bytes)):
            of = slice(begin, begin + len(block))
            held.append((batch.column("_id").slice(begin, len(block)), np.insert(block.hash, block.first[1:], END), block.counts() + 1, learn[of]))
            size += len(block.data)
            if size >= chunk_bytes:
                yield from _asked(number, held, bits)
                number, size, held = number + 1, 0, []
    if held:
        yield from _asked(number, held, bits)


def _asked(number: int, held: list[tuple], bits: int) -> Iterator[pa.RecordBatch]:
    ids, tokens, counts, learn = zip(*held, strict=True)
    words, word = np.unique(np.concatenate(tokens), return_inverse=True)
    chunk = Chunk(words, word, np.concatenate(counts), np.concatenate(learn))
    often = np.bincount(word, minlength=len(words))
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(words))
    rows = [_row(TEXTS, number, number, _pack_sorted(words), often, rank[word], chunk.counts, chunk.learn.astype(np.int64), _pack_ids(list(ids)))]
    count = np.bincount(word[chunk.learnt], minlength=len(words))
    rows += [_row(WORDS, part, number, _pack_sorted(words[at]), count[at]) for part, at in _parts(words, bits)]
    pairs, count = chunk.hashes[chunk.asked], np.bincount(chunk.pair[chunk.learnt], minlength=len(chunk.hashes))[chunk.asked]
    rows += [_row(PAIRS, part, number, _pack_sorted(pairs[at]), count[at]) for part, at in _parts(pairs, bits)]
    yield from _table(rows).to_batches()


def _sums(at: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Whole numbers added up by place."""
    return np.bincount(at, weights=weights.astype(np.int64), minlength=n).astype(np.int64)


def _count(table: pa.Table) -> pa.Table:
    """Answers of a part; texts go on as they are."""
    kind = table.column("kind")[0].as_py()
    if kind == TEXTS:
        return table
    part, chunks = table.column("part")[0].as_py(), table.column("chunk").to_pylist()
    blobs = {x: table.column(x).to_pylist() for x in "abcd"}
    asked = [_unpack_sorted(x) for x in blobs["a"]]
    keys, first, at = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
    ends = np.append(0, np.cumsum([len(x) for x in asked]))
    mine = [at[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    if kind == WORD_ARCS:
        total, number = (_sums(at, len(keys), _joined(blobs[x])) for x in "bc")
        return _table([_row(kind, part, c, total[x], number[x]) for c, x in zip(chunks, mine, strict=True)])
    if kind == PAIR_ARCS:
        return _count_triples(part, chunks, blobs, keys, at, mine)
    count = _sums(at, len(keys), _joined(blobs["b"]))
    often = count >= LEAST
    number = np.cumsum(often).astype(np.uint64)
    numbers = [_pack_sorted(number[x[often[x]]]) for x in mine]
    if kind == WORDS:
        rows = [_row(kind, part, c, count[x], y) for c, x, y in zip(chunks, mine, numbers, strict=True)]
        rows[0] |= {"n": int(count.sum()), "v": int((count > 0).sum()), "singles": int((count == 1).sum())}
        return _table(rows)
    found = np.where(often, 2 * count, 0)[at]
    found[first] += found[first] > 0
    return _table([_row(kind, part, c, found[a:b], y) for c, a, b, y in zip(chunks, ends[:-1], ends[1:], numbers, strict=True)])


def _count_triples(part: int, chunks: list[int], blobs: dict, keys: np.ndarray, at: np.ndarray, mine: list[np.ndarray]) -> pa.Table:
    history = np.repeat(at, _joined(blobs["b"]).astype(np.int64))
    last = [_unpack(x) for x in blobs["c"]]
    triples, one, under = np.unique(_join(keys[history], np.concatenate(last)), return_index=True, return_inverse=True)
    often = _sums(under, len(triples), _joined(blobs["d"]))
    often[often < LEAST] = 0
    history = history[one]
    total, arcs = _sums(history, len(keys), often), np.bincount(history[often > 0], minlength=len(keys))
    ends = np.append(0, np.cumsum([len(x) for x in last]))
    return _table([_row(PAIR_ARCS, part, c, total[x], arcs[x], often[under[a:b]])
                   for c, x, a, b in zip(chunks, mine, ends[:-1], ends[1:], strict=True)])


def _answered(table: pa.Table) -> tuple[Chunk, Callable[..., np.ndarray], dict]:
    """A chunk, what is answered to it, and its row of texts."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    texts = next(r for r in rows if r["kind"] == TEXTS)
    words, often, rank, counts, learn = (f(texts[x]) for x, f in zip("abcde", (_unpack_sorted, _unpack, _unpack, _unpack, _unpack), strict=True))
    by_rank = np.argsort(-often.astype(np.int64), kind="stable")
    chunk = Chunk(words, by_rank[rank.astype(np.int64)], counts.astype(np.int64), learn.astype(bool))

    def take(kind: int, column: str, unpack: Callable[[bytes], np.ndarray] = _unpack) -> np.ndarray:
        return _joined([r[column] for r in rows if r["kind"] == kind], unpack).astype(np.int64)

    return chunk, take, texts


def _counts(chunk: Chunk, take: Callable[..., np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the words and of the pairs with an arc, and the pairs owned."""
    word_n, found = take(WORDS, "a"), take(PAIRS, "a")
    if (len(word_n), len(found)) != (len(chunk.words), len(chunk.hashes)):
        raise RuntimeError("the documents changed while they were read")
    of_pair = np.empty(len(found), np.int64)
    of_pair[chunk.asked] = found
    return word_n, of_pair // 2, of_pair % 2 > 0


def _states(chunk: Chunk, word_n: np.ndarray, pair_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and pairs (by hash) whose arcs are asked for."""
    return np.flatnonzero(word_n >= LEAST), chunk.asked[(pair_n[chunk.asked] > 0) & (chunk.last[chunk.asked] != chunk.end)]


def _ask_arcs(table: pa.Table, bits: int) -> pa.Table:
    """What a chunk asks for once it knows its pairs."""
    chunk, take, texts = _answered(table)
    word_n, pair_n, owned = _counts(chunk, take)
    words, pairs = _states(chunk, word_n, pair_n)
    total, arcs = (_sums(chunk.history[owned], len(word_n), x[owned])[words] for x in (pair_n, np.ones_like(pair_n)))
    number = take(WORDS, "b", _unpack_sorted).astype(np.uint64)
    rows = [_row(WORD_ARCS, part, texts["chunk"], _pack_sorted(number[at]), total[at], arcs[at]) for part, at in _parts(chunk.words[words], bits)]
    history, last, at, which = chunk.triples(pair_n)
    count = np.bincount(which[chunk.learnt[at]], minlength=len(history))
    place = np.empty(len(pair_n), np.int64)
    place[pairs] = np.arange(len(pairs))
    place = place[history]
    by = np.argsort(place, kind="stable")
    number = np.empty(len(pair_n), np.uint64)
    number[chunk.asked[pair_n[chunk.asked] > 0]] = take(PAIRS, "b", _unpack_sorted)
    number, kids = number[pairs], np.bincount(place, minlength=len(pairs))
    last, count, ends = _short(chunk.words[last[by]]), count[by], np.append(0, np.cumsum(kids))
    for part, at in _parts(chunk.hashes[pairs], bits):
        under = slice(ends[at.start], ends[at.stop])
        rows.append(_row(PAIR_ARCS, part, texts["chunk"], _pack_sorted(number[at]), kids[at], last[under], count[under]))
    return _table(rows)


def _short(words: np.ndarray) -> np.ndarray:
    """48 bits of a word's hash, which tell apart what follows one pair."""
    return words >> np.uint64(16)


def _back(count: np.ndarray, total: np.ndarray, arcs: np.ndarray) -> np.ndarray:
    """Weight of the failure arc of states seen ``count`` times."""
    return np.maximum(1 - np.where(arcs > 0, (total - DISCOUNT * arcs) / np.maximum(count, 1), 0.0), 1e-9)


def _share(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    """What arcs seen ``count`` times add to their state, itself seen ``of`` times."""
    return np.where(count > 0, (count - DISCOUNT) / np.maximum(of, 1), 0.0)


def _score(table: pa.Table, n: int, v: int, singles: int) -> pa.Table:
    """Scores of a chunk's texts by the arcs that its answers name."""
    chunk, take, texts = _answered(table)
    word_n, pair_n, _ = _counts(chunk, take)
    words, pairs = _states(chunk, word_n, pair_n)
    history, _, at, which = chunk.triples(pair_n)
    place = np.empty(len(pair_n), np.int64)
    place[pairs] = np.arange(len(pairs))
    triple_n = np.empty(len(history), np.int64)
    triple_n[np.argsort(place[history], kind="stable")] = take(PAIR_ARCS, "c")
    word_back, pair_back = np.ones(len(word_n)), np.ones(len(pair_n))
    word_back[words] = _back(word_n[words], take(WORD_ARCS, "a"), take(WORD_ARCS, "b"))
    pair_back[pairs] = _back(pair_n[pairs], take(PAIR_ARCS, "a"), take(PAIR_ARCS, "b"))
    root, count = Root(n, v, singles), word_n[chunk.word]
    back, share = word_back[chunk.history][chunk.pair], _share(pair_n, word_n[chunk.history])[chunk.pair]
    # at a text's start the longer history is the end token again
    longer, more = np.where(chunk.fresh, back, pair_back[np.roll(chunk.pair, 1)]), np.where(chunk.fresh, share, 0.0)
    more[at] = _share(triple_n, pair_n[history])[which]
    log = along(np.where(count > 0, root.root(count), 1.0), [(back, share), (longer, more)])
    log = np.where(count > 0, log, log + np.log10(root.unknown))
    z = np.log10(n + 0.5 * (v + 1))
    sums = [np.bincount(chunk.owner, weights=x, minlength=len(chunk.counts)) for x in (np.ones(len(log)), count > 0, np.log10(count + 0.5) - z, log)]
    ids = pa.ipc.open_stream(texts["f"]).read_all().column("_id")
    return pa.table([ids, *(pa.array(x.astype(np.int64)) for x in sums[:2]), pa.array(sums[2]), pa.array(sums[3])],
                    names=["_id", "n_tokens", "n_known", "base_score", "score"])


def _tidy(fn: Callable, *args) -> Callable[[pa.Table], pa.Table]:
    """``fn`` of a group's table, with the worker's memory given back."""
    def one(table: pa.Table) -> pa.Table:
        try:
            return fn(table, *args)
        finally:
            give_back()

    return one


def score_texts(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) per row. The
    model learns from the rows where ``may_learn`` is true."""
    source = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"), F.coalesce(may_learn, F.lit(False)).alias("_learn"))
    bits = int((source.agg(F.sum(F.octet_length("_text"))).first()[0] or 0) // chunk_bytes).bit_length()

    def ask(batches):
        yield from _ask(batches, bits, chunk_bytes)

    with without_old_shuffles(docs.sparkSession):
        asked = map_arrow(source, ask, _PACKED)
        found = cut(asked.groupBy("kind", "part").applyInArrow(_tidy(_count), _PACKED))
        asked = found.groupBy("chunk").applyInArrow(_tidy(_ask_arcs, bits), _PACKED)
        arcs = cut(asked.groupBy("kind", "part").applyInArrow(_tidy(_count), _PACKED))
    n, v, singles = found.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in ("n", "v", "singles"))).first()
    kind = source.schema["_id"].dataType.simpleString()
    scored = found.unionAll(arcs).groupBy("chunk").applyInArrow(
        _tidy(_score, n, v, singles), f"_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("_id").alias(id_col), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")

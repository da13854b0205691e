"""Byte-level BPE encoding and decoding.

Encoding splits each text into pre-tokens and encodes each distinct one of a
task once: a chunk of texts is one row, the pre-tokens that are new in it an
array of byte arrays, and a Spark higher-order function folds the ranked merges
over each of them, with the ranks of all pairs in a literal map. The map is a
constant array of each row: as a literal of the plan, its text and its boxed
numbers would take more memory on the driver than all else. The results are
then laid out along the texts again, by a worker that keeps those of the task's
earlier rows, as rows of a task stay in order. Chunks are runs of whole texts
of one task, so nothing is shuffled, nothing grows with the corpus, and a task
that is run again does all its work again. Decoding concatenates the byte
strings of the ids.

A pre-token that is itself in the vocabulary is that one token, as in the
tiktoken library. Pre-tokens of more than ``LONG_BYTES`` bytes, for which the
fold's steps would grow with the square of their length, take the same merges
from a heap.

The map is packed: the rank of the pair (x, y) is in cell
``base[x] + y`` if that cell is marked with x. A pre-token is an array of
``rank << 40 | index << 17 | id``, rank being that of the piece with the next
one, so the least element is the merge that comes next, leftmost among equals.

Null texts are empty and have no tokens. Bytes that aren't UTF-8 count as
U+FFFD. Repeated rows are each encoded; ids may be null; an empty table gives
an empty result. Further columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import map_arrow, text_frame

CHUNK_BYTES = 1 << 20
#: Text that is split at once, as its work arrays take about 60 bytes a byte.
SPLIT_BYTES = 1 << 18
#: Distinct pre-tokens that a task remembers.
KNOWN_WORDS = 1 << 18
LONG_BYTES = 256
#: No rank; also the mask of an id.
NONE = (1 << 17) - 1
_LOW = (1 << 40) - 1

_LETTER, _NUMBER, _OTHER, _SPACE = range(4)


class Pieces:
    """Token bytes by rank, which is all that decoding needs."""

    def __init__(self, pieces: list[bytes]):
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_start = np.append(0, np.cumsum([len(p) for p in pieces]))


class Ranks:
    """A rank file: token bytes by rank, and the ranks of pairs of tokens."""

    def __init__(self, lines: list[bytes]):
        pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if len({*self.rank.values()}) != len(self.rank) or max(self.rank.values(), default=0) >= NONE:
            raise ValueError(f"ranks must be distinct and below {NONE}")
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"no token for the bytes {missing[:5]}")
        self.size = max(self.rank.values()) + 1
        pieces = [b""] * self.size
        for token, rank in self.rank.items():
            pieces[rank] = token
        self.pieces = Pieces(pieces)
        self.byte_rank = np.array([self.rank[bytes([b])] for b in range(256)])
        self.base, self.cells = self._packed()

    def _packed(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the pair table (by left token) laid over each other where
        their cells leave room."""
        rows: dict[int, list[tuple[int, int]]] = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    rows.setdefault(left, []).append((right, rank))
        room = 1 << max(12, (4 * sum(map(len, rows.values()))).bit_length())
        random = np.random.default_rng(7)
        used, cells = np.zeros(room + self.size, bool), np.zeros(room + self.size, np.int64)
        base = np.zeros(self.size, np.int64)
        for left in sorted(rows, key=lambda x: (-len(rows[x]), x)):
            right, rank = np.array(rows[left]).T
            at = int(random.integers(room))
            while used[at + right].any():
                at = int(random.integers(room))
            used[at + right], base[left] = True, at
            cells[at + right] = (left + 1) << 17 | rank
        return base, cells

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        cell = self.cells[self.base[left] + right]
        return np.where(cell >> 17 == left + 1, cell & NONE, NONE)

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges by a heap of pairs over a linked list."""
        ids: list[int | None] = [int(self.byte_rank[b]) for b in word]
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]

        def rank(i: int) -> int:
            cell = int(self.cells[self.base[ids[i]] + ids[after[i]]])
            return cell & NONE if cell >> 17 == ids[i] + 1 else NONE

        heap = [(r, i, ids[i], ids[after[i]]) for i in range(len(ids) - 1) if (r := rank(i)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = r, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (q := rank(k)) != NONE:
                    heapq.heappush(heap, (q, k, ids[k], ids[after[k]]))
        return [x for x in ids if x is not None]


def read_ranks(spark: SparkSession, path: str) -> Ranks:
    """A rank file, read on the driver; its size is that of the vocabulary.
    ``path`` may be local or anything that Spark reads."""
    try:
        with open(path, "rb") as f:
            return Ranks(f.read().splitlines())
    except FileNotFoundError:
        return Ranks([r[0].encode() for r in spark.read.text(path).collect()])


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point: letter, number, white space, other."""
    table = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        found = "".join(regex.findall(pattern + "+", every))
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def split_texts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of the pre-tokens of the texts
    ``data[offsets[i]:offsets[i+1]]``; text i has those from first[i] on.

    The spans are the matches of the pattern: contractions; runs of letters, of
    numbers and of other signs, each with one space before; runs of white space
    less a last one that stands before something else.
    """
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(code)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    if n == len(data):
        place = np.arange(n + 1)
    else:
        place = np.zeros(n + 1, np.int64)
        np.cumsum(1 + (code >= 0x80).astype(np.int8) + (code >= 0x800) + (code >= 0x10000), out=place[1:])
    kind = _classes()[code]
    begin = np.zeros(n + 1, bool)  # the texts' first characters
    begin[np.searchsorted(place, offsets)] = True
    begin[n] = True
    run = begin.copy()
    run[0] = True
    run[1:n] |= kind[1:] != kind[:-1]
    starts = run[:n].copy()
    # white space before something else in the same text: its last character stands alone or goes with what follows
    after = np.flatnonzero(run[1:n] & ~begin[1:n] & (kind[:-1] == _SPACE)) + 1
    starts[after - 1] = True
    starts[after[code[after - 1] == 0x20]] = False
    # contractions: a lone apostrophe that starts a match, then letters
    at = np.flatnonzero((code[:n - 1] == 0x27) & starts[:n - 1] & run[:n - 1] & run[1:n] & ~begin[1:n] & (kind[1:] == _LETTER)) if n > 1 else np.zeros(0, np.int64)
    if len(at):
        one = code[at + 1]
        third = np.minimum(at + 2, n - 1)
        two = np.where((at + 2 < n) & ~run[np.minimum(at + 2, n)], code[third], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for pair in ("re", "ve", "ll"):
            size[(one == ord(pair[0])) & (two == ord(pair[1]))] = 3
        at, size = at[size > 0], size[size > 0]
        starts[at + 1] = False
        rest = (at + size)[at + size < n]
        starts[rest[~run[rest]]] = True
    first = np.flatnonzero(starts)
    edges = place[np.append(first, n)]
    return edges[:-1], edges[1:], np.searchsorted(edges[:-1], offsets)


def clean_utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts, with what isn't UTF-8 replaced."""
    data, offsets = W.text_buffer(texts)
    try:
        texts.validate(full=True)
        return data, offsets
    except pa.ArrowInvalid:
        fixed = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return np.frombuffer(b"".join(fixed), np.uint8), np.append(0, np.cumsum([len(x) for x in fixed]))


class _Chunks:
    """Texts of one task as numbers of pre-tokens. A chunk's row brings the
    pre-tokens that the task's earlier rows haven't brought; after
    ``KNOWN_WORDS`` of them the numbers start again."""

    def __init__(self, ranks: Ranks):
        self.ranks, self.known = ranks, {}
        self._next()
        self.restart = True

    def _next(self) -> None:
        self.ids, self.sizes, self.numbers, self.fresh, self.bytes, self.restart = [], [], [], [], 0, False

    def add(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> None:
        start, end, first = split_texts(data, offsets)
        _, which, inverse = np.unique(W.byte_span_hashes(data, start, end), return_index=True, return_inverse=True)
        raw, known, fresh = data.tobytes(), self.known, self.fresh
        numbers = np.empty(len(which), np.int32)
        for k, (a, b) in enumerate(zip(start[which].tolist(), end[which].tolist(), strict=True)):
            word = raw[a:b]
            number = known.get(word)
            if number is None:
                number = known[word] = len(known)
                fresh.append(word)
            numbers[k] = number
        self.ids.append(ids)
        self.sizes.append(np.diff(first).astype(np.int32))
        self.numbers.append(numbers[inverse] if len(inverse) else numbers)
        self.bytes += len(data)

    def row(self) -> pa.RecordBatch:
        ranks = self.ranks
        ready: list[list[int]] = []
        folded: list[bytes] = []
        is_ready = np.zeros(len(self.fresh), bool)
        for i, word in enumerate(self.fresh):
            whole = ranks.rank.get(word)
            if whole is not None or len(word) > LONG_BYTES:
                is_ready[i] = True
                ready.append([whole] if whole is not None else ranks.merge_long(word))
            else:
                folded.append(word)
        order = np.flatnonzero(is_ready).astype(np.int32)
        # byte arrays with the rank of each neighbouring pair
        ids = ranks.byte_rank[np.frombuffer(b"".join(folded), np.uint8)]
        sizes = np.array([len(w) for w in folded], np.int64)
        first = np.append(0, np.cumsum(sizes))
        place = np.arange(len(ids)) - np.repeat(first[:-1], sizes)
        pair = np.full(len(ids), NONE, np.int64)
        pair[:-1] = ranks.pair_ranks(ids[:-1], ids[1:]) if len(ids) else pair[:-1]
        pair[first[1:] - 1] = NONE
        pieces = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(pair << 40 | place << 17 | ids))
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        out = pa.RecordBatch.from_arrays(
            [pa.array([self.restart]), one(pa.concat_arrays(self.ids)), one(pa.array(np.concatenate(self.sizes))), one(pa.array(np.concatenate(self.numbers))),
             one(pa.array(order)), one(pa.array(ready, pa.list_(pa.int32()))), one(pieces), one(pa.array(ranks.cells)), one(pa.array(ranks.base.astype(np.int32)))],
            names=["restart", "ids", "sizes", "numbers", "places", "ready", "pieces", "cells", "bases"])
        self._next()
        if len(self.known) >= KNOWN_WORDS:
            self.known, self.restart = {}, True
        return out


def _chunks(batches: Iterator[pa.RecordBatch], ranks: Ranks, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    chunk = _Chunks(ranks)
    for batch in batches:
        data, offsets = clean_utf8(batch.column("_text"))
        begin, n = 0, len(offsets) - 1
        while begin < n:
            stop = int(np.searchsorted(offsets, offsets[begin] + SPLIT_BYTES, side="right")) - 1
            stop = min(n, max(begin + 1, stop))
            chunk.add(batch.column("_id").slice(begin, stop - begin), data[offsets[begin]:offsets[stop]], offsets[begin:stop + 1] - offsets[begin])
            begin = stop
            if chunk.bytes >= chunk_bytes:
                yield chunk.row()
    if chunk.ids:
        yield chunk.row()


def fold_merges(pieces: Column, cells: Column, bases: Column) -> Column:
    """One pre-token: its byte array after all merges, as ids. ``cells`` and
    ``bases``: the packed rank map, a constant of the query."""

    def rank(left: Column, right: Column) -> Column:
        """In the place of a piece's rank; NONE also if either is null."""
        cell = F.get(cells, F.get(bases, left) + right)
        found = F.when(F.shiftright(cell, 17) == left + 1, cell.bitwiseAND(NONE)).otherwise(F.lit(NONE).cast("long"))
        return F.shiftleft(found, 40)

    def ident(piece: Column) -> Column:
        return piece.bitwiseAND(NONE).cast("int")

    def let(value: Column, state: Column, then) -> Column:
        """``then(state, value)``, with the value evaluated once."""
        return F.aggregate(F.array(value), state, then)

    def merge(state: Column, least: Column, at: Column) -> Column:
        """Pieces ``at`` and ``at + 1`` become one; those after it move up."""
        new = F.shiftright(least, 40)

        def piece(old: Column, i: Column) -> Column:
            joined = rank(new.cast("int"), ident(F.get(state, at + 2))) + least.bitwiseAND(_LOW - NONE) + new
            before = rank(ident(old), new.cast("int")) + old.bitwiseAND(_LOW)
            return F.when(i > at, F.get(state, i + 1) - (1 << 17)).when(i == at, joined).when(i == at - 1, before).otherwise(old)

        return F.transform(F.slice(state, 1, F.size(state) - 1), piece)

    def step(state: Column, _) -> Column:
        index = lambda least: F.shiftright(least, 17).bitwiseAND((1 << 23) - 1).cast("int")
        return let(F.array_min(state), state, lambda s, least: F.when(F.shiftright(least, 40) >= NONE, s).otherwise(
            let(index(least), s, lambda t, at: merge(t, least, at))))

    return F.transform(F.aggregate(F.slice(pieces, 2, F.size(pieces)), pieces, step), ident)


def _bytes_of(ids: np.ndarray, cuts: np.ndarray, pieces: Pieces) -> pa.Array:
    """The byte strings of ``ids[cuts[i]:cuts[i+1]]``, concatenated."""
    many = np.diff(pieces.piece_start)[ids]
    ends = np.append(0, np.cumsum(many))
    at = np.arange(ends[-1]) + np.repeat(pieces.piece_start[ids] - ends[:-1], many)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(ends[cuts].astype(np.int32)), pa.py_buffer(pieces.piece_bytes[at])])


def _lay_out(batches: Iterator[pa.RecordBatch], pieces: Pieces | None) -> Iterator[pa.RecordBatch]:
    """The tokens of each text of a chunk, from those of its pre-tokens; with
    ``pieces`` also what they decode to."""
    start, tokens = np.zeros(1, np.int64), np.zeros(0, "<u4")  # of the pre-tokens so far
    for batch in batches:
        for i in range(batch.num_rows):
            of = {x: batch.column(x).slice(i, 1).flatten() for x in ("ids", "sizes", "numbers", "places", "ready", "folded")}
            if batch.column("restart")[i].as_py():
                start, tokens = np.zeros(1, np.int64), np.zeros(0, "<u4")
            # the fresh pre-tokens in their order: ready ones at ``places``, folded ones between them
            count = len(of["ready"]) + len(of["folded"])
            is_ready = np.zeros(count, bool)
            is_ready[of["places"].to_numpy()] = True
            take = np.empty(count, np.int64)
            take[is_ready], take[~is_ready] = np.arange(len(of["ready"])), len(of["ready"]) + np.arange(len(of["folded"]))
            lists = pa.concat_arrays([of["ready"], of["folded"].cast(of["ready"].type)]).take(pa.array(take))
            start = np.append(start, start[-1] + np.cumsum(lists.value_lengths().to_numpy()))
            tokens = np.append(tokens, lists.flatten().to_numpy().astype("<u4"))
            length = np.diff(start)
            sizes, numbers = of["sizes"].to_numpy(), of["numbers"].to_numpy()
            first = np.append(0, np.cumsum(sizes))
            begin = 0
            while begin < len(sizes):
                stop = int(np.searchsorted(first, first[begin] + (1 << 18), side="right")) - 1
                stop = min(len(sizes), max(begin + 1, stop))
                mine = numbers[first[begin]:first[stop]]
                many = length[mine]
                ends = np.cumsum(many)
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[mine] - (ends - many), many)
                cuts = np.append(0, ends)[first[begin:stop + 1] - first[begin]]
                out = tokens[at]
                columns = [of["ids"].slice(begin, stop - begin), pa.array(np.diff(cuts)),
                           pa.Array.from_buffers(pa.binary(), stop - begin, [None, pa.py_buffer((4 * cuts).astype(np.int32)), pa.py_buffer(out)])]
                if pieces is not None:
                    columns.append(_bytes_of(out, cuts, pieces))
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "n_tokens", "ids", "decoded"][:len(columns)])
                begin = stop


def encode(docs: DataFrame, ranks: Ranks, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
           with_decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids) per row; ids are little-endian unsigned 32-bit.
    ``with_decoded`` adds ``decoded``, as ``decode`` does, in the same pass."""
    source = text_frame(docs, id_col, text_col)
    kind = source.schema["_id"].dataType.simpleString()
    shared, pieces = (source.sparkSession.sparkContext.broadcast(x) for x in (ranks, ranks.pieces))

    def chunks(batches):
        yield from _chunks(batches, shared.value, chunk_bytes)

    rows = map_arrow(source, chunks, f"restart boolean, ids array<{kind}>, sizes array<int>, numbers array<int>, places array<int>, ready array<array<int>>, pieces array<array<long>>, "
                     "cells array<long>, bases array<int>")
    folded = rows.select("restart", "ids", "sizes", "numbers", "places", "ready", F.transform("pieces", lambda p: fold_merges(p, F.col("cells"), F.col("bases"))).alias("folded"))

    def laid_out(batches):
        yield from _lay_out(batches, pieces.value if with_decoded else None)

    out = f"_id {kind}, n_tokens long, ids binary" + ", decoded binary" * with_decoded
    return map_arrow(folded, laid_out, out).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, ranks: Ranks, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with a binary column of the ids' byte strings, concatenated.
    Null ids give an empty string; ids beyond the vocabulary an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks.pieces)

    def decoded(batches):
        for batch in batches:
            data, offsets = W.text_buffer(batch.column(ids_col))
            begin, n = 0, len(offsets) - 1
            while begin < n:
                stop = int(np.searchsorted(offsets, offsets[begin] + (1 << 20), side="right")) - 1
                stop = min(n, max(begin + 1, stop))
                ids = np.frombuffer(data[offsets[begin]:offsets[stop]].tobytes(), "<u4")
                found = _bytes_of(ids, (offsets[begin:stop + 1] - offsets[begin]) // 4, shared.value)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(begin, stop - begin) for i in range(batch.num_columns)), found],
                                                 names=[*batch.schema.names, out_col])
                begin = stop

    schema = T.StructType([*(f for f in encoded.schema.fields), T.StructField(out_col, T.BinaryType())])
    return map_arrow(encoded, decoded, schema)

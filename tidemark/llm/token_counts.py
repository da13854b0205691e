"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. Each node has a failure link and the
number of tokens that are popped on the way: if the text can't go on from a
node, the greedy (longest match first) tokens of the node's string are counted,
and matching goes on at the node of what is left of it. So each byte of a word
is looked at once, no position is tried again, and no piece is built.

Every byte is a token, so every word has a count. The distinct pre-tokens of a
block of texts step through the automaton together, those of more than
``LONG_BYTES`` bytes one after the other; counts are then summed by text.
Documents stay in their task: no shuffle, no group.

Null and empty texts have no words and no tokens. Bytes that aren't UTF-8
count as U+FFFD. Repeated rows are each counted; ids may be null; an empty
table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as W
from .bpe import clean_utf8, split_texts
from .common import map_arrow, text_frame


#: Bytes of a pre-token from which on it is stepped through alone.
LONG_BYTES = 1024


class Automaton:
    """Trie with failure links. Node 0 is the root. ``edges`` are sorted keys
    ``node << 8 | byte`` and ``to`` their nodes; ``fail`` and ``pops`` say where
    a node that can't go on leads, and how many tokens that counts."""

    def __init__(self, vocabulary: Iterable[bytes]):
        children: list[dict[int, int]] = [{}]
        ends: list[bool] = [False]
        for token in {*vocabulary, *(bytes([b]) for b in range(256))}:
            node = 0
            for byte in token:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(False)
                node = children[node][byte]
            ends[node] = bool(token)
        fail, pops = [-1] * len(children), [0] * len(children)
        level = [0]
        while level:
            below = []
            for parent in level:
                for byte, node in children[parent].items():
                    below.append(node)
                    if ends[node]:
                        fail[node], pops[node] = 0, 1
                        continue
                    at, popped = fail[parent], pops[parent]
                    while byte not in children[at]:  # ends at the root at the latest, which has every byte
                        popped += pops[at]
                        at = fail[at]
                    fail[node], pops[node] = children[at][byte], popped
            level = below
        edges = sorted((node << 8 | byte, to) for node, of in enumerate(children) for byte, to in of.items())
        self.edges, self.to = (np.array(x, np.int64) for x in zip(*edges, strict=True))
        self.fail, self.pops = np.array(fail), np.array(pops)
        self._plain = None

    def __getstate__(self):
        return {**self.__dict__, "_plain": None}

    def count_long(self, span: bytes) -> int:
        """Greedy token count of one span, byte by byte."""
        if self._plain is None:  # as Python's own numbers, once a worker
            self._plain = dict(zip(self.edges.tolist(), self.to.tolist(), strict=True)), self.fail.tolist(), self.pops.tolist()
        to, fail, pops = self._plain
        node = total = 0
        for byte in span:
            while (go := to.get(node << 8 | byte)) is None:
                total += pops[node]
                node = fail[node]
            node = go
        while node:
            total += pops[node]
            node = fail[node]
        return total

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Greedy token counts of the byte spans ``data[start:end]``."""
        total, node = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for k in np.flatnonzero(end - start > LONG_BYTES):
            total[k] = self.count_long(data[start[k]:end[k]].tobytes())
        live, step = np.flatnonzero((end > start) & (end - start <= LONG_BYTES)), 0
        while len(live):
            byte = data[start[live] + step].astype(np.int64)
            todo = np.arange(len(live))
            while len(todo):
                who = live[todo]
                key = node[who] << 8 | byte[todo]
                at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
                found = self.edges[at] == key
                node[who[found]] = self.to[at[found]]
                lost = who[~found]
                total[lost] += self.pops[node[lost]]
                node[lost] = self.fail[node[lost]]
                todo = todo[~found]
            step += 1
            live = live[start[live] + step < end[live]]
        rest = np.flatnonzero(node)
        while len(rest):
            total[rest] += self.pops[node[rest]]
            node[rest] = self.fail[node[rest]]
            rest = rest[node[rest] > 0]
        return total


def _counted(batches: Iterator[pa.RecordBatch], automaton: Automaton) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = clean_utf8(batch.column("_text"))
        begin, n = 0, len(offsets) - 1
        while begin < n:
            stop = int(np.searchsorted(offsets, offsets[begin] + W.BLOCK_BYTES, side="right")) - 1
            stop = min(n, max(begin + 1, stop))
            part = data[offsets[begin]:offsets[stop]]
            start, end, first = split_texts(part, offsets[begin:stop + 1] - offsets[begin])
            _, which, inverse = np.unique(W.byte_span_hashes(part, start, end), return_index=True, return_inverse=True)
            tokens = np.append(0, np.cumsum(automaton.counts(part, start[which], end[which])[inverse]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").slice(begin, stop - begin), pa.array(np.diff(first)), pa.array(tokens[first[1:]] - tokens[first[:-1]])],
                names=["_id", "n_words", "n_tokens"])
            begin = stop


def count_tokens(docs: DataFrame, vocabulary: Iterable[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens) per row: pre-tokens, and the greedy pieces of them all."""
    source = text_frame(docs, id_col, text_col)
    shared = source.sparkSession.sparkContext.broadcast(Automaton(vocabulary))

    def counted(batches):
        yield from _counted(batches, shared.value)

    kind = source.schema["_id"].dataType.simpleString()
    return map_arrow(source, counted, f"_id {kind}, n_words long, n_tokens long").withColumnRenamed("_id", id_col)

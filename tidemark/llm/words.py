"""Words of whole texts as numpy arrays: spans and 64-bit hashes.

A block of texts stays the byte buffer that Arrow hands over; nothing is
decoded and no word becomes a Python object. Word classes are sets of bytes,
so UTF-8 needs no decoding: bytes of 0x80 and up either all belong to words or
the class is not used here.

Empty and null texts have no words. Two different words share a hash with a
chance of about 2**-64; operators that must be certain compare the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEED = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Bytes of text handled at a time: whole documents, one longer document alone.
BLOCK_BYTES = 1 << 20
BLOCK_TEXTS = 1 << 13

#: Bytes that are no part of a word, by word class.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_SEED))
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of an odd base modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = np.uint64(pow(self.base, len(self.table), 1 << 64))
            self.table = np.concatenate([self.table, self.table * step])
        return self.table[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_BASE_INVERSE)


class Words:
    """Words of a block of texts. ``first[i]:first[i+1]`` are the words of text
    ``i``; ``start``/``end`` are byte positions in ``data``; ``hash`` is 64 bits."""

    __slots__ = ("data", "first", "start", "end", "hash")

    def __init__(self, data, first, start, end, hashes):
        self.data, self.first, self.start, self.end, self.hash = data, first, start, end, hashes

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text's number for each word."""
        return np.repeat(np.arange(len(self)), self.counts())


def fold_ascii(data: np.ndarray) -> np.ndarray:
    return _FOLD[data]


def byte_span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans ``data[start:end]``, the same wherever they lie."""
    n = len(data)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_VALUES[data] * _POWERS.upto(n), out=total[1:])
    return mix((total[end] - total[start]) * _INVERSES.upto(n + 1)[start])


def find_words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray, hashed: bool = True) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i+1]]`` (already folded)."""
    n = len(data)
    inside = ~breaks[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    at = offsets[:-1][offsets[:-1] < n]
    opens[at] = inside[at]
    at = offsets[1:][offsets[1:] > 0] - 1
    closes[at] = inside[at]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets)
    if not hashed or not len(start):
        return Words(data, first, start, end, np.zeros(len(start), np.uint64))
    return Words(data, first, start, end, byte_span_hashes(data, start, end))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if places is not None and places.size else np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, breaks: np.ndarray, fold: bool, hashed: bool = True,
           block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, Words]]:
    """(number of the first text, Words) for consecutive runs of whole texts of
    about ``block_bytes`` bytes, so that work arrays stay small."""
    data, offsets = text_buffer(texts)
    begin, n = 0, len(offsets) - 1
    while begin < n:
        stop = int(np.searchsorted(offsets, offsets[begin] + block_bytes, side="right")) - 1
        stop = min(n, begin + BLOCK_TEXTS - 1, max(begin + 1, stop))
        part = data[offsets[begin]:offsets[stop]]
        yield begin, find_words(fold_ascii(part) if fold else part, offsets[begin:stop + 1] - offsets[begin], breaks, hashed)
        begin = stop


_WINDOW = _Powers(0xA24BAED4963EE407)
_WINDOW_INVERSE = _Powers(pow(0xA24BAED4963EE407, -1, 1 << 64))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``hashes[i:i+width]`` for each i with a whole window. Equal
    windows have equal hashes, in whichever text or task."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(hashes * _WINDOW.upto(n), out=total[1:])
    return mix((total[width:] - total[:-width]) * _WINDOW_INVERSE.upto(n)[:n - width + 1])


def span_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``hashes[start:end]`` for spans of any length."""
    n = len(hashes)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(hashes * _WINDOW.upto(n), out=total[1:])
    widths = (end - start).astype(np.uint64)
    return mix((total[end] - total[start]) * _WINDOW_INVERSE.upto(n + 1)[start] + widths * np.uint64(_SEED))


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return values.view(np.int64)

"""Alignment of two tokenizers' tokens over the same bytes.

Tokens of both tokenizers have ends, byte offsets in one text. Where both have
an end, the tokens fall into groups; most groups are one token of each side, in
long stretches in which the index of one side is that of the other plus a fixed
shift, a diagonal. ``align`` follows the diagonals: at the current shift it
compares stretches of both end arrays, twice as long each time, until one
differs, halves back to the place, and takes all before it in one jump. The
irregular group there is resolved token by token, and its sizes are the new
shift. The resolver visits just the pairs of tokens that overlap, so groups and
links come from one pass, in linear time.

Documents are encoded where they lie, in chunks of about ``CHUNK_BYTES`` of text
(whole documents; a longer one alone). A chunk is one row: figures of each
document, the distinct id pairs of the links with their counts, and each link's
place among them, compressed. Counts of the whole corpus are one aggregate over
the chunks' distinct pairs; each chunk is joined with the counts of its own
pairs and scores its links by them. Frequent pairs are not hot, as a chunk sends
each pair once, and nothing is broadcast but the highest count of each id of the
second tokenizer, at most one row for each of its ids.

Null and empty texts have no tokens; nor have texts that one of the tokenizers
changes, so that its tokens' bytes are not the text's with a space before it.
Their figures are 0 and their hash is ''. Repeated rows are each aligned and each
counted; ids may be null. An empty table gives an empty result. Further columns
are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, give_back, map_arrow

CHUNK_BYTES = 8 << 20
#: Text that is encoded and aligned at a time.
BLOCK_BYTES = 1 << 20
#: Bytes of a run without a break from which on its text is encoded by the
#: tokenizer library, whose merges take no time square to a pre-token's length.
LONG_RUN = 2000

#: The pattern of byte-level BPE's pre-tokens where the file asks for its default (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The letter that stands for a space in a piece (fixed value).
SPACE = "\u2581"
#: Encoded runs of the second tokenizer that a worker remembers.
KNOWN_RUNS = 1 << 18
_RUNS = re.compile(" *[^ ]+| +")
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes stand for themselves, the others are letters from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + k): b for k, b in enumerate(other)}}


class ByteLevelTokens:
    """The first tokenizer, from its JSON. Where the file is plain byte-level BPE
    whose ids are in the order of its merges, ``tiktoken`` makes the same ids in
    a fifth of the time; other files and very long runs go by ``tokenizers``."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        text = content.decode()
        self.slow = Tokenizer.from_str(text)
        self.slow.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.slow.get_vocab(with_added_tokens=False)
        self.pieces: list[bytes] = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, k in vocabulary.items():
            self.pieces[k] = bytes(letters[x] for x in token) if all(x in letters for x in token) else token.encode()
        self.quick = self._quick(json.loads(text))

    def _quick(self, spec: dict):
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
                 and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
                 and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
        if not plain:
            return None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = [model["vocab"].get("".join(m), -1) for m in merges]
        if len(model["vocab"]) != 256 + len(made) or made != sorted(set(made)) or made[:1] != [256]:
            return None
        import tiktoken

        ranks = {self.pieces[k]: k for k in model["vocab"].values()}
        return tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of the texts, each with a space before it."""
        texts = [" " + t for t in texts]
        slow = [k for k, t in enumerate(texts) if self.quick is None or _longest_run(t) > LONG_RUN]
        done = dict(zip(slow, (e.ids for e in self.slow.encode_batch([texts[k] for k in slow], add_special_tokens=False)), strict=True)) if slow else {}
        return [done[k] if k in done else self.quick.encode_ordinary(t) for k, t in enumerate(texts)]


def _longest_run(text: str) -> int:
    """Longest run of bytes that are all breaks or all not."""
    breaks = _BREAK[np.frombuffer(text.encode(), np.uint8)]
    edges = np.flatnonzero(breaks[1:] != breaks[:-1])
    return int(np.diff(np.concatenate([[-1], edges, [len(breaks) - 1]])).max()) if len(breaks) else 0


class PieceTokens:
    """The second tokenizer, from its model file. Where no piece has a space
    after another letter, no merge goes over the place before a run of spaces, so
    runs of spaces with their word are encoded on their own, each once."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.pieces = [self._bytes(x) for x in names]
        self.known: dict[str, list[int]] = {" ": [self.model.piece_to_id(SPACE)]}
        self.apart = SPACE in names and not any(SPACE in x.lstrip(SPACE) for x in names)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of the texts; the model itself adds the space before them."""
        if not self.apart:
            return self.model.encode(texts, num_threads=1)
        parts = [_RUNS.findall(" " + t) for t in texts]
        fresh = list(set(itertools.chain.from_iterable(parts)) - self.known.keys())
        self.known.update(zip(fresh, self.model.encode([x[1:] for x in fresh], num_threads=1), strict=True))
        # the space's own letter in a text is no space, but the model can't tell
        found = [self.model.encode(t) if SPACE in t else list(itertools.chain.from_iterable(map(self.known.__getitem__, p))) for t, p in zip(texts, parts, strict=True)]
        if len(self.known) > KNOWN_RUNS or max(map(len, fresh), default=0) > LONG_RUN:
            self.known = {" ": self.known[" "]}
        return found


# ---------------------------------------------------------------- alignment


def align(left: list[int], right: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, closes) of all pairs of tokens that overlap, in order; ``closes``
    where both end. ``left`` and ``right`` are ends that rise to the same last one.

    A walk goes over the pairs. It notes only the steps on which one side goes on
    alone; along a diagonal both do, so stretches leave nothing to note."""
    i = j = at = 0  # at: number of the pair (i, j)
    n = len(left)
    steps_i, steps_j = [], []
    while i < n:
        a, b = left[i], right[j]
        if a == b:
            # a stretch of ends that agree at the shift j - i
            k, step = 1, 1
            while left[i + k:i + k + step] == right[j + k:j + k + step] and i + k < n:
                k += step
                step += step
            while step > 1:
                step >>= 1
                if left[i + k:i + k + step] == right[j + k:j + k + step]:
                    k += step
            i += k
            j += k
            at += k
            continue
        # an irregular group: both sides go on, the one behind first, until they meet
        while a != b:
            if a < b:
                steps_i.append(at)
                i += 1
                a = left[i]
            else:
                steps_j.append(at)
                j += 1
                b = right[j]
            at += 1
        i += 1
        j += 1
        at += 1
    total = n + len(steps_j)
    goes_i, goes_j = np.ones(total, np.int64), np.ones(total, np.int64)
    goes_j[steps_i] = 0
    goes_i[steps_j] = 0
    return np.cumsum(goes_i) - goes_i, np.cumsum(goes_j) - goes_j, (goes_i & goes_j).astype(bool)


class _Writer:
    """Groups as text: ids in decimal, a mark after each."""

    def __init__(self, size_a: int, size_b: int):
        marks = [(size_a, ","), (size_a, "|"), (size_b, ","), (size_b, ";")]
        # of one width, filled up with zero bytes that are taken out of the whole
        self.words = np.array([f"{k}{mark}".encode() for size, mark in marks for k in range(size)])
        self.begin = np.cumsum([0, size_a, size_a, size_b])

    def words_of(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
        """The words of the groups; ``end_a``, ``end_b``: places after each group's last token."""
        word = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[end_a - 1] = last_b[end_b - 1] = 1
        # all of a group's first tokens stand before its second ones
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        word[np.arange(len(a)) + np.append(0, end_b)[group_a]] = a + self.begin[last_a]
        word[np.arange(len(b)) + end_a[group_b]] = b + self.begin[2 + last_b]
        return word

    def text(self, words: np.ndarray) -> bytes:
        return self.words[words].tobytes().translate(None, b"\0")[:-1]


@dataclass
class Aligner:
    """Both tokenizers, loaded once a worker."""

    first: ByteLevelTokens
    second: PieceTokens

    def __post_init__(self):
        self.size_b = len(self.second.pieces)
        self.bytes_a, self.bytes_b = (np.array([len(p) for p in side.pieces], np.int64) for side in (self.first, self.second))
        self.writer = _Writer(len(self.first.pieces), self.size_b)

    def block(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Figures (n_a, n_b, n_groups, n_links) and group hash of each text, and
        the id pairs of all links in order, as ``a * size_b + b``."""
        asked = [k for k, t in enumerate(texts) if t]
        given = [texts[k] for k in asked]
        figures, hashes = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
        kept, all_a, all_b = [], [], []
        for k, t, a, b in zip(asked, given, self.first.encode(given), self.second.encode(given), strict=True):
            want = b" " + t.encode()
            if b"".join(map(self.second.pieces.__getitem__, b)) == want == b"".join(map(self.first.pieces.__getitem__, a)):
                kept.append(k)
                all_a.append(a)
                all_b.append(b)
        if not kept:
            return figures, hashes, np.zeros(0, np.int64)
        a, b = (np.fromiter(itertools.chain.from_iterable(x), np.int64, sum(map(len, x))) for x in (all_a, all_b))
        i, j, closes = align(np.cumsum(self.bytes_a[a]).tolist(), np.cumsum(self.bytes_b[b]).tolist())
        at_a, at_b = np.cumsum([0, *map(len, all_a)]), np.cumsum([0, *map(len, all_b)])
        at_link = np.searchsorted(i, at_a)
        group_end = np.flatnonzero(closes)
        at_group = np.searchsorted(group_end, at_link)
        figures[kept] = np.diff([at_a, at_b, at_group, at_link]).T
        words, at_word = self.writer.words_of(a, b, i[group_end] + 1, j[group_end] + 1), at_a + at_b
        for x, k in enumerate(kept):
            hashes[k] = hashlib.sha256(self.writer.text(words[at_word[x]:at_word[x + 1]])).hexdigest()
        return figures, hashes, a[i] * self.size_b + b[j]


_ALIGNERS: dict[str, Aligner] = {}


def _aligner(files) -> Aligner:
    name, first, second = files.value
    if name not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[name] = Aligner(ByteLevelTokens(first), PieceTokens(second))
    return _ALIGNERS[name]


# ---------------------------------------------------------------- chunks


def _blob(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unblob(blob: bytes, count: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not count:
        return np.zeros(0, kind)
    raw = pa.decompress(blob, decompressed_size=width * count, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, count).T).view(kind).ravel()


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _chunk_row(number: int, ids: list[pa.Array], found: list[tuple]) -> pa.RecordBatch:
    """One row for the blocks of a chunk."""
    id_array = pa.concat_arrays(ids)
    figures = np.concatenate([f for f, _, _ in found])
    hashes = [h for _, hs, _ in found for h in hs]
    coded = pa.array(np.concatenate([p for _, _, p in found])).dictionary_encode()
    pairs, at = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(pairs)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    pairs, at, counts = pairs[order], rank[at], np.bincount(rank[at], minlength=len(order))
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), one(id_array), *(one(pa.array(figures[:, k])) for k in range(4)), one(pa.array(hashes, pa.string())),
         pa.array([len(pairs)]), pa.array([_blob(pairs)], pa.binary()), pa.array([_blob(counts.astype(np.int64))], pa.binary()),
         pa.array([_blob(at.astype(np.int32))], pa.binary())],
        names=["chunk", "ids", *_FIGURES, "hashes", "n_pairs", "pairs", "counts", "links"])


def _encoded(batches: Iterator[pa.RecordBatch], files, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    aligner, number, size, ids, found = _aligner(files), None, 0, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        if number is None:
            number = batch.column("part")[0].as_py() << 32
        texts = batch.column("_text").to_pylist()
        begin = 0
        while begin < len(texts):
            end, block = begin, 0
            while end < len(texts) and (end == begin or block + len(texts[end] or "") <= BLOCK_BYTES):
                block += len(texts[end] or "")
                end += 1
            if found and size + block > chunk_bytes:
                yield _chunk_row(number, ids, found)
                number, size, ids, found = number + 1, 0, [], []
            found.append(aligner.block(texts[begin:end]))
            ids.append(batch.column("_id").slice(begin, end - begin))
            size, begin = size + block, end
    if found:
        yield _chunk_row(number, ids, found)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's distinct pairs as rows (chunk, pair, n)."""
    for batch in batches:
        for row in batch.to_pylist():
            pairs, counts = (_unblob(row[x], row["n_pairs"], np.int64) for x in ("pairs", "counts"))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row["chunk"])), pa.array(pairs), pa.array(counts)], names=["chunk", "pair", "n"])


def _scored(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one chunk with the sums over their links."""
    row = chunk.slice(0, 1)
    listed = lambda x: row.column(x).combine_chunks().flatten()
    total = row.column("n_pairs")[0].as_py()
    pairs = _unblob(row.column("pairs")[0].as_py(), total, np.int64)
    if chunk.num_rows != 1 or counts.num_rows != total:
        raise RuntimeError("a chunk's pairs and their counts must agree")
    at = np.searchsorted(pairs, counts.column("pair").to_numpy())
    count, best = np.zeros(total, np.int64), np.zeros(total, np.int64)
    count[at], best[at] = counts.column("total").to_numpy(), counts.column("best").to_numpy()
    n_links = listed("n_links").to_numpy()
    links = _unblob(row.column("links")[0].as_py(), int(n_links.sum()), np.int32)
    edges = np.append(0, np.cumsum(n_links))
    sums = [np.append(0, np.cumsum(x[links]))[edges] for x in (best, count)]
    try:
        return pa.table([listed("ids"), *(listed(x) for x in _FIGURES), *(pa.array(s[1:] - s[:-1]) for s in sums), listed("hashes")],
                        names=["_id", *_FIGURES, "n_best", "count_sum", "groups_sha256"])
    finally:
        give_back()


def read_file(spark: SparkSession, path: str) -> bytes:
    """A tokenizer's file, whose size is that of its vocabulary."""
    return spark.read.format("binaryFile").load(path).select("content").first()[0]


def align_tokens(docs: DataFrame, first: bytes, second: bytes, id_col: str = "doc_id", text_col: str = "text",
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one
    row per row of ``docs``. ``first``: JSON of a byte-level BPE, which encodes a
    space and the text; ``second``: a piece model that adds this space itself.
    ``n_best`` counts the links whose pair is as frequent in the corpus as any
    pair of its second id; ``count_sum`` adds the links' pair counts."""
    spark = docs.sparkSession
    size_b = len(PieceTokens(second).pieces)
    files = spark.sparkContext.broadcast((hashlib.sha256(first + second).hexdigest(), first, second))
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"), F.spark_partition_id().cast("long").alias("part"))
    longs = ", ".join(f"{x} array<long>" for x in _FIGURES)

    def encoded(batches):
        yield from _encoded(batches, files, chunk_bytes)

    found = cut(map_arrow(source, encoded, f"chunk long, ids array<{kind}>, {longs}, hashes array<string>, n_pairs long, pairs binary, counts binary, links binary"))
    pairs = map_arrow(found.select("chunk", "n_pairs", "pairs", "counts"), _pair_rows, "chunk long, pair long, n long")
    totals = cut(pairs.groupBy("pair").agg(F.sum("n").alias("total")))
    # one row for each id of the second tokenizer at most
    highest = totals.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("total").alias("high"))
    judged = totals.join(F.broadcast(highest), F.col("pair") % size_b == F.col("b")).select("pair", "total", (F.col("total") == F.col("high")).cast("long").alias("best"))
    asked = pairs.select("chunk", "pair").join(judged, "pair")
    scored = found.drop("counts").groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(
        _scored, f"_id {kind}, {', '.join(f'{x} long' for x in (*_FIGURES, 'n_best', 'count_sum'))}, groups_sha256 string")
    return scored.withColumnRenamed("_id", id_col)

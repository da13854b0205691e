"""Removal of long word sequences that occur elsewhere, by a compacted de
Bruijn graph.

Windows of ``WINDOW`` words are grouped into *k-mers* of varying length: the
consecutive windows that share one minimiser (the least hash among the words'
``ANCHOR``-grams inside the window). A window's minimiser depends on its own
words alone, so a repeated passage has the same k-mers in every document but for
the first and the last one, about one for 14 words:

1. Minimisers that occur once are dropped; no repeated window has one.
2. Of the rest, each distinct k-mer is counted and keeps one source coordinate.
   Where a minimiser has one k-mer only, all its windows are in that k-mer.
   Where it has several, the windows of one source of each are compared, and
   each k-mer is cut into *pieces*: repeated windows in a row, of which each has
   one next and one last window wherever it occurs. A piece is the same in all
   documents; its first window names it.
3. Pieces are the edges of the graph. Those that are followed by one piece
   wherever they occur, which always follows them, compact into one path: a join
   brings each piece what its predecessor's occurrences say. A path lies whole in
   every document that holds any of it, so its name, its first piece, is the same
   in all of them.
4. The paths, at the coordinates of their pieces, are the spans of a document;
   their words go.

Only step 1 moves a row for every k-mer, or run of one k-mer; hot k-mers are counted with partial
aggregation, and joined from written tables, so that adaptive execution can
split them.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts and texts
shorter than a window have no windows and lose nothing. Rows that repeat, or
share an id, are documents of their own: an exact copy of a long text removes
both. Rows are known by 128 bits of hashes of id and text; ids may be null.
Further columns are not read; an empty table gives an empty result. Windows are
judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import cut, map_arrow, small_side

WINDOW = 35
#: Words of a minimiser. A window holds WINDOW - ANCHOR + 1 of them.
ANCHOR = 8
#: Bits of a word's place in the key that finds minimisers.
_PLACE = np.uint64(28)
#: pos = first window's place * 64 + number of windows
_PACK = 64


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text) with the key that rows are joined by, two hashes of id and
    text; the caller's other columns, whatever their names, are inside ``_row``."""
    source = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"),
                         F.struct(F.lit(0).alias(id_col), *[docs[c] for c in docs.columns if c not in (id_col, text_col)]).alias("_row"))
    return source.withColumn("k", F.xxhash64("_id", "_text")).withColumn("h", F.xxhash64(F.lit(1), "_text", "_id"))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i:i+width]`` for each whole window, by doubling."""
    span, least = 1, values
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def kmers(block: W.Words, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, minimiser hash, k-mer hash) of the k-mers."""
    grams = W.window_hashes(block.hash, anchor)
    text = block.text_of()
    whole = len(text) - window + 1
    valid = np.flatnonzero(text[:whole] == text[window - 1:]) if whole > 0 else np.zeros(0, np.int64)
    if not len(valid):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    mask = (np.uint64(1) << _PLACE) - np.uint64(1)
    key = ((grams >> _PLACE) << _PLACE) | (np.arange(len(grams), dtype=np.uint64) & mask)
    place = (sliding_minimum(key, window - anchor + 1)[valid] & mask).astype(np.int64)
    begins = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (text[valid[1:]] != text[valid[:-1]])))
    size = np.diff(np.append(begins, len(valid)))
    start = valid[begins]
    owner = text[start]
    hashes = W.span_hashes(block.hash, start, start + size + window - 1)
    return owner, start - block.first[owner], size, grams[place[begins]], hashes


def _occurrences(batches: Iterator[pa.RecordBatch], window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, block in W.blocks(batch.column("_text"), W.SPACES, fold=False):
            owner, start, size, minimiser, kmer = kmers(block, window, anchor)
            # a k-mer that follows itself, as in a run of one word, is one row
            run = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (kmer[1:] != kmer[:-1]))[:len(owner)])
            times = np.diff(np.append(run, len(owner)))
            at = pa.array(owner[run] + begin)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k").take(at), batch.column("h").take(at), pa.array((start * _PACK + size)[run]), pa.array(times),
                 pa.array(W.signed(minimiser[run])), pa.array(W.signed(kmer[run]))], names=["k", "h", "pos", "times", "anchor", "kmer"])


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Each window of the wanted k-mers of a text: (kmer, n, place in it, hash,
    hashes of the windows before and after it in the k-mer)."""
    for batch in batches:
        wanted = batch.column("wanted")
        cuts, flat = _flat(wanted)
        pos, kmer, n = (flat.field(x).to_numpy() for x in ("pos", "kmer", "n"))
        for begin, block in W.blocks(batch.column("_text"), W.SPACES, fold=False):
            lo, hi = cuts[begin], cuts[begin + len(block)]
            owner = np.repeat(np.arange(len(block)), np.diff(cuts[begin:begin + len(block) + 1]))
            size = pos[lo:hi] % _PACK
            start = block.first[owner] + pos[lo:hi] // _PACK
            at = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
            hashes = W.signed(W.window_hashes(block.hash, window))
            where = start[at] + place
            last = place + 1 == size[at]
            win, before, after = (hashes[np.clip(x, 0, max(len(hashes) - 1, 0))] if len(at) else hashes[:0] for x in (where, where - 1, where + 1))
            yield pa.RecordBatch.from_arrays([pa.array(kmer[lo:hi][at]), pa.array(n[lo:hi][at]), pa.array(place), pa.array(win),
                                              pa.array(before, mask=place == 0), pa.array(after, mask=last)],
                                             names=["kmer", "n", "place", "win", "before", "after"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeated windows of a k-mer, in order, as pieces that don't branch."""
    for batch in batches:
        cuts, flat = _flat(batch.column("wins"))
        owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        place, win, opens, closes = (flat.field(x).to_numpy(zero_copy_only=False) for x in ("place", "win", "opens", "closes"))
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1) | ~opens[:-1] | ~closes[1:]
        at = np.flatnonzero(fresh)
        size = np.diff(np.append(at, len(owner)))
        pieces = pa.StructArray.from_arrays([pa.array(place[at]), pa.array(size), pa.array(win[at])], names=["off", "size", "node"])
        edges = pa.array(np.searchsorted(owner[at], np.arange(len(cuts))), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("kmer"), pa.ListArray.from_arrays(edges, pieces)], names=["kmer", "pieces"])


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each list's elements begin, and all elements; null is empty."""
    sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    return np.append(0, np.cumsum(sizes)).astype(np.int64), lists.flatten()


def _in_place(batch: pa.RecordBatch) -> tuple[int, np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """A batch of documents with ``parts``: their number, each part's document,
    the parts' fields in order, and whether a part follows the one before at once.
    A part that comes ``times`` times, ``step`` words apart, is as many parts."""
    cuts, flat = _flat(batch.column("parts"))
    of = {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}
    times = of.pop("times")
    each = np.repeat(np.arange(len(times)), times)
    owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))[each]
    of = {x: v[each] for x, v in of.items()}
    of["start"] = of["start"] + (np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)) * of.pop("step")
    by = np.lexsort((of["start"], owner))
    of = {x: v[by] for x, v in of.items()}
    follows = np.zeros(len(owner), bool)
    follows[1:] = (owner[1:] == owner[:-1]) & (of["start"][1:] == of["start"][:-1] + of["size"][:-1])
    return len(cuts) - 1, owner, of, follows


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, before, after) of the pieces of each document, null where no piece is next to it."""
    for batch in batches:
        _, _, of, follows = _in_place(batch)
        node = of["node"]
        first, last = ~follows, np.append(~follows[1:], True)[:len(node)]
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.roll(node, 1), mask=first), pa.array(np.roll(node, -1), mask=last)],
                                         names=["node", "before", "after"])


def _spans(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Per document: its paths as spans (words ``start`` to ``end``), and the words under them."""
    for batch in batches:
        n, owner, of, follows = _in_place(batch)
        begins = np.flatnonzero(~(follows & of["goes_on"]))
        ends = np.append(begins, len(owner))[1:] - 1
        who, first, last = owner[begins], of["start"][begins], of["start"][ends] + of["size"][ends] - 1
        at = pa.array(np.searchsorted(who, np.arange(n + 1)), pa.int32())
        spans = pa.StructArray.from_arrays([pa.array(first), pa.array(last + window), pa.array(of["node"][begins])], names=["start", "end", "path"])
        who, start, end = cover(who, first, last + window)
        range_at = pa.array(np.searchsorted(who, np.arange(n + 1)), pa.int32())
        ranges = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=["start", "end"])
        yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("h"), pa.ListArray.from_arrays(at, spans), pa.ListArray.from_arrays(range_at, ranges)],
                                         names=["k", "h", "spans", "ranges"])


def cover(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The words under the spans, as few ranges; spans are in order of owner and start."""
    if not len(owner):
        return owner, start, end
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(owner * far + end)  # a later owner lies beyond all earlier ends
    fresh = np.append(True, owner[1:] * far + start[1:] > reach[:-1])
    begins = np.flatnonzero(fresh)
    return owner[begins], start[begins], reach[np.append(begins[1:], len(owner)) - 1] - owner[begins] * far


def _keep_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cuts, flat = _flat(batch.column("ranges"))
        start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
        for begin, block in W.blocks(batch.column("_text"), W.SPACES, fold=False, hashed=False):
            n, stop = len(block), begin + len(block)
            lo, hi = cuts[begin], cuts[stop]
            owner = np.repeat(np.arange(n), np.diff(cuts[begin:stop + 1]))
            edge = np.zeros(len(block.start) + 1, np.int64)
            np.add.at(edge, block.first[owner] + start[lo:hi], 1)
            np.add.at(edge, block.first[owner] + end[lo:hi], -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed = np.append(0, np.cumsum(gone))
            own = [batch.column(i).slice(begin, n) for i, name in enumerate(batch.schema.names) if name != "ranges"]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(block.counts()), pa.array(removed[block.first[1:]] - removed[block.first[:-1]]), _joined(block, np.flatnonzero(~gone))],
                names=[*(x for x in batch.schema.names if x != "ranges"), "n_words", "n_removed", "kept_text"])


def _joined(block: W.Words, kept: np.ndarray) -> pa.Array:
    """Per text the kept words, joined by one space."""
    text = np.searchsorted(block.first, kept, side="right") - 1
    last = np.append(text[1:] != text[:-1], True)[:len(kept)]
    # a word's bytes, and for all but a text's last kept word the byte after it, made a space
    edge = np.zeros(len(block.data) + 2, np.int32)
    start, end = block.start[kept], block.end[kept] + ~last
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    inside = np.cumsum(edge[:len(block.data)]) > 0
    data = block.data.copy()
    data[block.end[kept[~last]]] = 0x20
    sizes = np.bincount(text, weights=end - start, minlength=len(block)).astype(np.int64)
    offsets = np.append(0, np.cumsum(sizes))
    return pa.Array.from_buffers(pa.string(), len(block), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[inside])])


def find_spans(keyed: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(k, h, spans array<struct<start, end, path>>, ranges) of the documents
    that have repeated windows. Spans of one document may overlap at their
    ends; ranges (start, end) are the words under them."""
    def occurrences(batches):
        yield from _occurrences(batches, window, anchor)

    def windows(batches):
        yield from _windows(batches, window)

    def spans(batches):
        yield from _spans(batches, window)

    every = map_arrow(keyed.select("k", "h", "_text"), occurrences, "k long, h long, pos long, times long, anchor long, kmer long")
    twice = cut(every.groupBy("anchor").agg(F.sum("times").alias("c")).where("c > 1").select("anchor"))
    some = cut(every.join(twice, "anchor"))

    # distinct k-mers, with one source each
    kmers = cut(some.groupBy("kmer").agg(F.sum("times").alias("n"), F.min("anchor").alias("anchor"), F.min(F.struct("k", "h", "pos")).alias("at")))
    mixed = kmers.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    only = kmers.where("n > 1").join(mixed, "anchor", "left_anti").selectExpr(
        "kmer", f"array(named_struct('off', 0L, 'size', at.pos % {_PACK}, 'node', kmer)) as pieces")

    # minimisers with several k-mers: the windows of one source of each
    sources = cut(kmers.join(mixed, "anchor").select("kmer", "n", "at.*").groupBy("k", "h").agg(F.collect_list(F.struct("pos", "kmer", "n")).alias("wanted")))
    size = sources.agg(F.count("*"), F.sum(F.size("wanted"))).first()
    # (a repeated row gives its windows twice, but then its k-mers are repeated anyway)
    found = keyed.select("k", "h", "_text").join(small_side(sources, (size[0] or 0) + (size[1] or 0), 48), ["k", "h"])
    compared = cut(map_arrow(found.select("_text", "wanted"), windows, "kmer long, n long, place long, win long, before long, after long"))
    one = lambda x: (F.count(x) == F.count("*")) & (F.min(x) == F.max(x))
    repeated = cut(compared.groupBy("win").agg(F.sum("n").alias("c"), F.coalesce(one("after"), F.lit(False)).alias("opens"),
                                               F.coalesce(one("before"), F.lit(False)).alias("closes")).where("c > 1").drop("c"))
    wins = (compared.select("kmer", "place", "win").join(repeated, "win").groupBy("kmer")
            .agg(F.array_sort(F.collect_set(F.struct("place", "win", "opens", "closes"))).alias("wins")))
    cut_up = map_arrow(wins, _pieces, "kmer long, pieces array<struct<off: long, size: long, node: long>>")
    pieces = cut(only.unionByName(cut_up))

    # documents as rows of pieces, and paths of pieces that always follow each other
    parts = some.select("k", "h", "pos", "times", "kmer").join(pieces, "kmer").select("k", "h", "pos", "times", F.inline("pieces")).selectExpr(
        "k", "h", f"pos div {_PACK} + off as start", "size", "node", "times", f"pos % {_PACK} as step")
    listed = cut(parts.groupBy("k", "h").agg(F.collect_set(F.struct("start", "size", "node", "times", "step")).alias("parts")))
    nodes = cut(map_arrow(listed.select("parts"), _neighbours, "node long, before long, after long").groupBy("node").agg(
        F.coalesce(one("after"), F.lit(False)).alias("opens"), F.coalesce(one("before"), F.lit(False)).alias("closes"), F.min("before").alias("before")))
    inner = nodes.where("closes").select("node", "before").join(nodes.where("opens").select(F.col("node").alias("before")), "before").select("node")
    inner = cut(inner).withColumn("goes_on", F.lit(True))
    linked = (listed.select("k", "h", F.inline("parts")).join(inner, "node", "left").groupBy("k", "h")
              .agg(F.collect_list(F.struct("start", "size", "node", "times", "step", F.coalesce("goes_on", F.lit(False)).alias("goes_on"))).alias("parts")))
    return map_arrow(linked, spans, "k long, h long, spans array<struct<start: long, end: long, path: long>>, ranges array<struct<start: int, end: int>>")


def _removed(docs: DataFrame, id_col: str, text_col: str, kept: list[str], options: dict) -> DataFrame:
    """The columns ``kept`` of the keyed rows, n_words, n_removed, kept_text."""
    keyed = _keyed(docs, id_col, text_col)
    spans = cut(find_spans(keyed, **options).select("k", "h", "ranges"))
    size = spans.agg(F.count("*"), F.sum(F.size("ranges"))).first()
    joined = keyed.join(small_side(spans, (size[0] or 0) + (size[1] or 0), 48), ["k", "h"], "left").select(*kept, "_text", "ranges")
    schema = T.StructType([*(f for f in joined.schema.fields if f.name != "ranges"), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return map_arrow(joined, _keep_words, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_words, n_removed, kept_text), one row per row of ``docs``;
    kept_text has the kept words joined by one space."""
    found = _removed(docs, id_col, text_col, ["_id"], options)
    return found.select(F.col("_id").alias(id_col), "n_words", "n_removed", "kept_text")


def apply_removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated words taken out of the texts; a text that
    loses nothing stays as it is."""
    found = _removed(docs, id_col, text_col, ["_id", "_row"], options)
    own = {id_col: F.col("_id"), text_col: F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("_text"))}
    return found.select(*[(own.get(c) if c in own else F.col("_row").getField(c)).alias(c) for c in docs.columns])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, start, end, path): the words ``start`` to ``end`` of each compacted
    path in each document. ``path`` names it, the same in every document that
    holds it; the spans of neighbouring paths share words."""
    keyed = _keyed(docs, id_col, text_col)
    spans = cut(find_spans(keyed, window, anchor).select("k", "h", "spans"))
    return keyed.select("_id", "k", "h").join(spans, ["k", "h"]).select(F.col("_id").alias(id_col), F.inline("spans"))

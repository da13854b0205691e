"""Benchmark decontamination with suffix arrays over training shards.

The documents of a partition form shards of about ``SHARD_WORDS`` words. Each
shard is a suffix array over word numbers, cut at document ends; every suffix
of every benchmark item is binary-searched in it. ``find_contamination`` takes
the run of suffixes that hold the item's whole window: the longest match alone
would miss documents with fewer words of the item than another one of the shard.
``longest_matches`` gives the longest verbatim match of each suffix and all the
places where it lies. Documents never leave their partition: no
shuffle, no key that could be hot, and a lost task is simply run again.

The benchmark is sent to the tasks in blocks of bounded size
(``BLOCK_TEXT_BYTES`` of text). A larger benchmark takes a pass for each block:
the documents are then numbered and written to the checkpoint folder, a pass
writes what it hits and its block is destroyed before the next one is read, and
hits are merged by document. ``longest_matches`` is one plan over all blocks.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
Null and empty texts have no words, are never hit and hit nothing. An item
shorter than the window, but not empty, is one window. Repeated documents are
each judged; repeated items with one id count as one item; a document without
an id is judged like any other, and the windows of an item without an id count
as hits, only its id is not listed. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import by_text, cut, join_rows, map_arrow, text_frame

WINDOW = 13
#: 20 * n_hit >= n_words marks a document as contaminated.
PER_HIT = 20
#: A shard's suffix array takes about 350 bytes a word while it is built.
SHARD_WORDS = 1 << 18
BLOCK_TEXT_BYTES = 8 << 20


class SuffixArray:
    """Suffixes of a shard's word numbers in order, each ending with its
    document. Numbers start at 1; 0 stands for the end of a document."""

    def __init__(self, ids: np.ndarray, first: np.ndarray):
        """``ids``: word numbers of all documents; ``first``: where each begins."""
        n = len(ids)
        self.first, self.n = first, n
        self.ids = np.append(ids, 0).astype(np.int64)
        self.stop = np.repeat(first[1:], np.diff(first))  # end of the own document
        bits = int(n + 1).bit_length()
        fold = max(2, min(3, 63 // bits))  # so many ranks fit in one key
        rank = self.ids[:n].copy()

        def keys(at: np.ndarray, steps: range) -> np.ndarray:
            wide = np.zeros(len(at), np.int64)
            for k in steps:
                wide = (wide << bits) | np.where(at + k < self.stop[at], rank[np.minimum(at + k, n - 1)], 0)
            return wide

        # first by ``fold`` words; rank = place of the first equal suffix, plus 1
        wide = keys(np.arange(n), range(fold))
        order = np.argsort(wide, kind="stable")
        slots, group = np.arange(n), np.zeros(n, np.int64)
        wide, depth = wide[order], fold
        while len(slots):
            fresh = np.append(True, (group[1:] != group[:-1]) | (wide[1:] != wide[:-1]))
            begins = np.flatnonzero(fresh)
            run = np.cumsum(fresh) - 1
            rank[order[slots]] = slots[begins[run]] + 1
            # go on with runs of equal suffixes of which any goes on beyond the depth
            longer = order[slots] + depth < self.stop[order[slots]]
            shared = np.diff(np.append(begins, len(slots))) > 1
            slots = slots[(shared & np.logical_or.reduceat(longer, begins))[run]]
            at = order[slots]
            group = rank[at]
            wide = keys(at, range(depth, (fold + 1) * depth, depth))
            by = np.lexsort((wide, group))
            order[slots], group, wide = at[by], group[by], wide[by]
            depth *= fold + 1
        self.order = order

    def compare(self, at: np.ndarray, query: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sign of (suffix at ``at``) - (query row), by ``width`` words, and the
        number of equal words. Query rows are padded; a document's end is 0."""
        sign = np.zeros(len(at), np.int8)
        same = np.zeros(len(at), np.int64)
        live = np.arange(len(at))
        for k in range(query.shape[1]):
            live = live[k < width[live]]
            if not len(live):
                break
            where = at[live] + k
            mine = np.where(where < self.stop[at[live]], self.ids[np.minimum(where, self.n)], 0)
            other = query[live, k]
            sign[live] = np.sign(mine - other)
            equal = mine == other
            live = live[equal]
            same[live] += 1
        return sign, same

    def bound(self, query: np.ndarray, width: np.ndarray, right: bool) -> np.ndarray:
        """Binary search: the first place whose suffix is not below the query
        (``right``: above it), comparing ``width`` words."""
        low, high = np.zeros(len(query), np.int64), np.full(len(query), self.n)
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low
            mid = (low[live] + high[live]) // 2
            sign, _ = self.compare(self.order[mid], query[live], width[live])
            up = (sign < 0) | ((sign == 0) & right)
            low[live[up]] = mid[up] + 1
            high[live[~up]] = mid[~up]


class TestSet:
    """Benchmark items as word hashes, with the suffixes to look for."""

    __test__ = False

    def __init__(self, ids: list[str | None], texts: list[str | None], window: int):
        self.ids, self.window = ids, window
        data, offsets = W.text_buffer(pa.array(texts, pa.large_string()))
        block = W.find_words(W.fold_ascii(data), offsets, W.NON_ALNUM)
        self.hash, self.first = block.hash, block.first
        counts = block.counts()
        #: the item of each suffix, where it starts and ends
        self.item = np.repeat(np.arange(len(counts)), counts)
        self.start = np.arange(len(self.item))
        self.end = block.first[1:][self.item] if len(self.item) else self.item
        #: words of a window that starts here; 0: no whole window starts here
        left = self.end - self.start
        size = np.minimum(counts, window)[self.item] if len(self.item) else self.item
        self.size = np.where(left >= size, size, 0)
        #: fewest words of a match that is reported
        self.least = size


class Shard:
    """Documents of one shard: their ids, where their words begin, the suffix
    array, and the numbers of the words that occur."""

    def __init__(self, ids: list, counts: list, hashes: list):
        self.ids = pa.concat_arrays(ids)
        self.first = np.append(0, np.cumsum(np.concatenate(counts)))
        coded = pa.array(np.concatenate(hashes)).dictionary_encode()
        self.array, self.found = SuffixArray(coded.indices.to_numpy().astype(np.int64) + 1, self.first), coded.dictionary

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; -1 for words that this shard lacks."""
        if not len(self.found):
            return np.full(len(hashes), -1)
        at = pc.index_in(pa.array(hashes), value_set=self.found).fill_null(-1).to_numpy().astype(np.int64)
        return np.where(at < 0, -1, at + 1)

    def windows(self, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
        """For each test suffix the run ``low:high`` of suffixes that start with
        its whole window (empty where it has none)."""
        numbers = self.numbers(tests.hash)
        at = tests.start[:, None] + np.arange(tests.window)[None, :]
        query = numbers[np.minimum(at, max(len(numbers) - 1, 0))]
        low = self.array.bound(query, tests.size, right=False)
        return low, np.where(tests.size > 0, self.array.bound(query, tests.size, right=True), low)

    def owners(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Shard]:
    """Shards of about ``most`` words, of whole documents."""
    ids, counts, hashes, held = [], [], [], 0
    for batch in batches:
        column = batch.column("_id")
        for begin, block in W.blocks(batch.column("_text"), W.NON_ALNUM, fold=True):
            ids.append(column.slice(begin, len(block)))
            counts.append(block.counts())
            hashes.append(block.hash)
            held += len(block.hash)
            if held >= most:
                yield Shard(ids, counts, hashes)
                ids, counts, hashes, held = [], [], [], 0
    if ids:
        yield Shard(ids, counts, hashes)


def _hit(shard: Shard, tests: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words of the shard are in a window, and the documents and ids of
    the items they hold, by document, each pair once."""
    edge = np.zeros(shard.array.n + 1, np.int64)
    if not shard.array.n or not len(tests.hash):
        return edge[:-1] > 0, np.zeros(0, np.int64), np.zeros(0, object)
    low, high = shard.windows(tests)
    # equal windows of the benchmark have one run of suffixes: each run counts once,
    # so its places are no more than the shard's words for each window size
    held = np.flatnonzero(high > low)
    wide = tests.window + 1
    key, first, run = np.unique(low[held] * wide + tests.size[held], return_index=True, return_inverse=True)
    low, high, size = low[held][first], high[held][first], key % wide
    lengths = high - low
    source = np.repeat(np.arange(len(lengths)), lengths)
    starts = shard.array.order[low[source] + np.arange(len(source)) - np.repeat(np.cumsum(lengths) - lengths, lengths)]
    edge += np.bincount(starts, minlength=len(edge)) - np.bincount(starts + size[source], minlength=len(edge))
    named = np.array([x is not None for x in tests.ids], bool)[tests.item[held]]
    owner, item = _item_pairs(_distinct(source, shard.owners(starts)), _distinct(run[named], tests.item[held][named]), len(key))
    return np.cumsum(edge[:-1]) > 0, owner, np.asarray(tests.ids, object)[item]


#: Pairs of one step, when documents and items of the same windows are paired.
_PAIRS = 1 << 22


def _distinct(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, in order."""
    wide = int(right.max()) + 1 if len(right) else 1
    return tuple(np.divmod(np.unique(left * wide + right), wide))


def _item_pairs(docs: tuple[np.ndarray, np.ndarray], items: tuple[np.ndarray, np.ndarray], runs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, item) that share a run, from the documents and the
    items of each run; in steps, so that long common passages of many items and
    documents take no more memory than their distinct pairs."""
    n_docs, n_items = (np.bincount(x[0], minlength=runs) for x in (docs, items))
    at_doc, at_item = (np.append(0, np.cumsum(n)) for n in (n_docs, n_items))
    done = np.zeros((2, 0), np.int64)
    step = np.cumsum(n_docs * n_items) // _PAIRS
    for k in np.unique(step[(n_docs * n_items) > 0]):
        some = np.flatnonzero((step == k) & (n_docs * n_items > 0))
        count = (n_docs * n_items)[some]
        of = np.repeat(some, count)
        place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        pair = np.stack([docs[1][at_doc[of] + place // n_items[of]], items[1][at_item[of] + place % n_items[of]]])
        done = np.stack(_distinct(*np.concatenate([done, pair], axis=1)))
    return done[0], done[1]


def _lists(owner: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), values)


def _hits(batches: Iterator[pa.RecordBatch], tests: Broadcast, shard_words: int) -> Iterator[pa.RecordBatch]:
    for shard in _shards(batches, shard_words):
        within, owner, names = _hit(shard, tests.value)
        hit, first = np.append(0, np.cumsum(within)), shard.first
        yield pa.RecordBatch.from_arrays(
            [shard.ids, pa.array(np.diff(first)), pa.array(hit[first[1:]] - hit[first[:-1]]), _lists(owner, pa.array(names, pa.string()), len(shard.ids))],
            names=["_id", "n_words", "n_hit", "items"])


def _ranges(batches: Iterator[pa.RecordBatch], tests: Broadcast, shard_words: int, every: bool) -> Iterator[pa.RecordBatch]:
    """Words hit by one block as ranges of each document; ``every``: also of
    documents without a hit."""
    for shard in _shards(batches, shard_words):
        within, owner, names = _hit(shard, tests.value)
        fresh = np.zeros(len(within) + 1, bool)
        fresh[shard.first] = True
        begin = np.flatnonzero(within & (fresh[:-1] | ~np.append(False, within[:-1])))
        end = np.flatnonzero(within & (fresh[1:] | ~np.append(within[1:], False))) + 1
        of, n = shard.owners(begin), len(shard.ids)
        spans = pa.StructArray.from_arrays([pa.array(x - shard.first[of]) for x in (begin, end)], names=["begin", "end"])
        rows = pa.RecordBatch.from_arrays([shard.ids, pa.array(np.diff(shard.first)), _lists(of, spans, n), _lists(owner, pa.array(names, pa.string()), n)],
                                          names=["_id", "n_words", "spans", "items"])
        yield rows if every else rows.take(pa.array(np.unique(of)))


def _longest(batches: Iterator[pa.RecordBatch], tests: TestSet, shard_words: int) -> Iterator[pa.RecordBatch]:
    for shard in _shards(batches, shard_words):
        array = shard.array
        if not array.n or not len(tests.hash):
            continue
        numbers, left = shard.numbers(tests.hash), tests.end - tests.start
        best = np.zeros(len(left), np.int64)
        # the longest match is next to the place where the test suffix belongs
        place = _place(array, numbers, tests.start, left)
        for near in (place - 1, place):
            ok = np.flatnonzero((near >= 0) & (near < array.n))
            best[ok] = np.maximum(best[ok], _common(array, array.order[near[ok]], numbers, tests.start[ok], left[ok]))
        # and lies wherever a suffix begins with as many words
        long = np.flatnonzero(best >= tests.least)
        low = _place(array, numbers, tests.start[long], best[long])
        lengths = _place(array, numbers, tests.start[long], best[long], right=True) - low
        test = np.repeat(long, lengths)
        where = array.order[np.repeat(low, lengths) + np.arange(len(test)) - np.repeat(np.cumsum(lengths) - lengths, lengths)]
        owner = shard.owners(where)
        # a suffix inside a longer match of the same item at the same place adds nothing
        inner = (tests.start[test] > tests.first[tests.item[test]]) & (where > shard.first[owner])
        inner &= array.ids[where - 1] == numbers[tests.start[test] - 1]
        test, where, owner = test[~inner], where[~inner], owner[~inner]
        yield pa.RecordBatch.from_arrays(
            [shard.ids.take(pa.array(owner)), pa.array([tests.ids[i] for i in tests.item[test]], pa.string()),
             pa.array(tests.start[test] - tests.first[tests.item[test]]), pa.array(where - shard.first[owner]), pa.array(best[test])],
            names=["_id", "item_id", "item_word", "doc_word", "n_words"])


def _common(array: SuffixArray, at: np.ndarray, numbers: np.ndarray, start: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``at`` share with the test suffixes."""
    same, live = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(live):
        k = same[live]
        where = at[live] + k
        ok = (k < most[live]) & (where < array.stop[at[live]])
        ok &= array.ids[np.minimum(where, array.n)] == numbers[np.minimum(start[live] + k, len(numbers) - 1)]
        live = live[ok]
        same[live] += 1
    return same


def _place(array: SuffixArray, numbers: np.ndarray, start: np.ndarray, width: np.ndarray, right: bool = False) -> np.ndarray:
    """Where the first ``width`` words of each test suffix belong in the array
    (``right``: after all suffixes that begin with them)."""
    low, high = np.zeros(len(start), np.int64), np.full(len(start), array.n)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        mid = (low[live] + high[live]) // 2
        at = array.order[mid]
        same = _common(array, at, numbers, start[live], width[live])
        whole = same >= width[live]
        over = at + same >= array.stop[at]
        mine = np.where(over, 0, array.ids[np.minimum(at + same, array.n)])
        other = np.where(whole, 0, numbers[np.minimum(start[live] + same, len(numbers) - 1)])
        below = (mine < other) & ~whole | whole & right
        low[live[below]] = mid[below] + 1
        high[live[~below]] = mid[~below]


def count_blocks(benchmark: DataFrame, text_col: str, block_bytes: int) -> int:
    total = benchmark.agg(F.sum(F.octet_length(benchmark[text_col].cast("string")))).first()[0] or 0
    return int(total // block_bytes) + 1


def test_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int,
                block_bytes: int = BLOCK_TEXT_BYTES) -> Iterator[TestSet]:
    """The benchmark in blocks of about ``block_bytes`` of text, one at a time
    on the driver; always at least one."""
    items = text_frame(benchmark, id_col, text_col).select(F.col("_id").cast("string").alias("_id"), "_text")
    n = count_blocks(benchmark, text_col, block_bytes)
    for k in range(n):
        rows = (items if n == 1 else items.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(n)) == k)).collect()
        yield TestSet([r[0] for r in rows], [r[1] for r in rows], window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_TEXT_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id, n_words, n_hit, items, contaminated) per document; ``items`` are the
    ids of the items with an occurring window, sorted as strings.

    A word hit by windows of several blocks counts once.
    """
    source = text_frame(docs, id_col, text_col)
    kind = source.schema["_id"].dataType.simpleString()
    blocks = test_blocks(benchmark, item_col, item_text_col, window, block_bytes)
    if count_blocks(benchmark, item_text_col, block_bytes) == 1:
        shared = source.sparkSession.sparkContext.broadcast(next(blocks))

        def hits(batches):
            yield from _hits(batches, shared, shard_words)

        found = map_arrow(source, hits, f"_id {kind}, n_words long, n_hit long, items array<string>")
    else:
        found = _merged(source, kind, blocks, shard_words)
    return found.select(F.col("_id").alias(id_col), "n_words", "n_hit", F.sort_array(F.array_distinct("items")).alias("items"),
                        ((F.col("n_hit") > 0) & (PER_HIT * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def _merged(source: DataFrame, kind: str, blocks: Iterator[TestSet], shard_words: int) -> DataFrame:
    """(_id, n_words, n_hit, items) after one pass for each block, of which one
    at a time is with the tasks."""
    # row numbers hold for all passes, as the rows are read from the written table from here on
    rows = cut(source.withColumn("row", F.monotonically_increasing_id())).select(F.struct("row", "_id").alias("_id"), "_text")

    def one(tests: TestSet, every: bool) -> DataFrame:
        shared = source.sparkSession.sparkContext.broadcast(tests)

        def ranges(batches):
            yield from _ranges(batches, shared, shard_words, every)

        found = cut(map_arrow(rows, ranges, f"_id struct<row: long, _id: {kind}>, n_words long, spans array<struct<begin: long, end: long>>, items array<string>"))
        shared.destroy()
        return found

    found = one(next(blocks), True)
    for tests in blocks:
        found = found.unionAll(one(tests, False))
    merged = found.groupBy(F.col("_id.row").alias("row")).agg(
        F.first("_id._id").alias("_id"), F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    longer = lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["begin"], a["end"]))).alias("n"),
                                   F.greatest(a["end"], x["end"]).alias("end"))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return merged.select("_id", "n_words", F.aggregate("spans", none, longer, lambda a: a["n"]).alias("n_hit"), "items")


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                    shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id, item_id, item_word, doc_word, n_words): in each shard, the longest
    verbatim match of every test suffix of at least ``window`` words, or all of
    a shorter item, at each place where it lies, less those that only end a
    longer match there."""
    source = text_frame(docs, id_col, text_col)
    kind = source.schema["_id"].dataType.simpleString()
    sets = [source.sparkSession.sparkContext.broadcast(t) for t in test_blocks(benchmark, item_col, item_text_col, window)]

    def one(block):
        def matches(batches):
            yield from _longest(batches, block.value, shard_words)
        return map_arrow(source, matches, f"_id {kind}, item_id string, item_word long, doc_word long, n_words long")

    out = one(sets[0])
    for block in sets[1:]:
        out = out.unionAll(one(block))
    return out.withColumnRenamed("_id", id_col)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents. The verdict goes by id and
    text: other texts of the same id stay, as do rows without an id."""
    verdicts = find_contamination(by_text(docs, id_col, text_col), benchmark, id_col, text_col, **options)
    return join_rows(docs, verdicts.where("contaminated").select(id_col), id_col, text_col, "left_anti")

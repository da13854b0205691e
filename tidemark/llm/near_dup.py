"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum
and its maximum, so ``PERMUTATIONS`` evaluations fill a signature of twice as
many values. Bands of ``BAND_VALUES`` values make buckets; documents of one
bucket are candidates and every link is confirmed on the full shingle sets.
With 96 permutations (32 bands of 6) a pair at similarity 0.85 misses all
bands with a chance of 3e-7, and likelier pairs with less.

How large groups are kept from giving all their pairs, without losing a link:

* Documents with the same word sequence are one node from the start.
* A node's *private* shingles occur in no other candidate, so they are in no
  intersection, which bounds the similarity of a node with any other one. A
  node that can't reach the threshold leaves the buckets.
* Each bucket is first linked as a star: every node is measured against the
  bucket's node of the least private share, which in a group of edited copies
  is the text nearest to the original.
* Only then are pairs formed, and only between nodes of one star that are not
  connected yet: its smaller components against the rest, where the two
  measured intersections with the centre still allow a link (``_unconnected``).

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Fewer words than a
shingle make one shingle of all words. Null and empty texts have no shingles
and are linked with nothing, as are rows without an id. Rows that share an id
are one document. Repeated rows are each returned. Further columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import by_text, cut, join_rows, map_arrow, small_side, text_frame
from .graph import connected

SHINGLE = 5
PERMUTATIONS = 96
BAND_VALUES = 6
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 31, 1024, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 1 << 32, 1024, dtype=np.uint32)


def shingle_sets(block: W.Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingles of text i are
    ``hashes[first[i]:first[i+1]]``, in order."""
    n, counts = len(block), block.counts()
    windows = W.window_hashes(block.hash, width)
    text = block.text_of()
    at = np.flatnonzero(text[:len(windows)] == text[width - 1:]) if len(windows) else np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    whole = W.span_hashes(block.hash, block.first[short], block.first[short + 1])
    owner, hashes = np.concatenate([text[at], short]), np.concatenate([windows[at], whole])
    # text number and hash in one sort key; as many bits for the number in every
    # block, so that a shingle has the same hash everywhere
    bits = np.uint64(int(W.BLOCK_TEXTS).bit_length())
    key = np.sort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits))
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    owner = (key >> (np.uint64(64) - bits)).astype(np.int64)
    first = np.searchsorted(owner, np.arange(n + 1))
    return W.mix(key << bits), first


def min_max(hashes: np.ndarray, first: np.ndarray, permutations: int) -> np.ndarray:
    """Signature (texts x 2 * permutations) of texts with at least one shingle:
    minimum and maximum under each permutation, side by side."""
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((2 * permutations, len(first)), np.uint32)
    work = np.empty_like(values)
    for p in range(permutations):
        np.multiply(values, _FACTORS[p], out=work)
        np.add(work, _SHIFTS[p], out=work)
        np.minimum.reduceat(work, first, out=out[2 * p])
        np.maximum.reduceat(work, first, out=out[2 * p + 1])
    return out.T


def band_keys(signature: np.ndarray, band_values: int) -> np.ndarray:
    """64-bit key of every band of every signature."""
    n, size = signature.shape
    bands = size // band_values
    keys = np.zeros((n, bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    cut_ = signature[:, :bands * band_values].reshape(n, bands, band_values)
    for k in range(band_values):
        keys = W.mix(keys.ravel() ^ W.mix(cut_[:, :, k].ravel().astype(np.uint64) + np.uint64(k + 1))).reshape(n, bands)
    return keys


def _node_keys(block: W.Words) -> np.ndarray:
    """64-bit hash of each text's word sequence."""
    return W.span_hashes(block.hash, block.first[:-1], block.first[1:])


def _signatures(batches: Iterator[pa.RecordBatch], permutations: int, band_values: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("_id")
        for begin, block in W.blocks(batch.column("_text"), W.SPACES, fold=True):
            n = len(block)
            hashes, first = shingle_sets(block)
            sizes = np.diff(first)
            some = np.flatnonzero(sizes)
            keys = band_keys(min_max(hashes, first[some], permutations), band_values) if len(some) else np.zeros((0, 1), np.uint64)
            cuts = np.append(0, np.cumsum((sizes > 0) * keys.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(begin, n), pa.array(sizes), pa.array(W.signed(_node_keys(block))),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(W.signed(np.ascontiguousarray(keys).ravel())))],
                names=["_id", "n", "node", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the rows whose text is their node's."""
    for batch in batches:
        wanted = batch.column("own").to_numpy()
        for begin, block in W.blocks(batch.column("_text"), W.SPACES, fold=True):
            hashes, first = shingle_sets(block)
            nodes = W.signed(_node_keys(block))
            found = pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(W.signed(hashes)))],
                names=["node", "n", "shingles"])
            yield found.filter(pa.array(nodes == wanted[begin:begin + len(block)]))


#: Pairs of one node that are joined with one copy of its set.
STAR_ROWS = 512


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, both): the sizes and the intersection of the full sets.
    A node that is ``b`` of many pairs, the centre of a large group, has its set
    copied, one copy for ``STAR_ROWS`` of them, so that its pairs spread."""
    of = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"s_{x}"))
    pairs = cut(pairs.select("a", "b"))
    copies = cut(pairs.groupBy("b").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("copies")).where("copies > 1"))
    hot = small_side(copies.withColumnRenamed("b", "_hot"), copies.count(), 24)
    salted = pairs.join(hot, F.col("b") == F.col("_hot"), "left").select(
        "a", "b", F.coalesce(F.pmod(F.xxhash64("a"), F.col("copies")), F.lit(0)).cast("int").alias("copy"))
    centres = (of("b").join(hot, F.col("b") == F.col("_hot"), "left")
               .withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("_hot", "copies"))
    return (salted.join(of("a"), "a").join(centres, ["b", "copy"])
            .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("s_a", "s_b")).cast("long").alias("both")))


def _linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))


def find_links(source: DataFrame, signed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between nodes that connect all nodes which any chain of
    links between different texts connects. ``source``: _id, _text; ``signed``:
    the signatures, one row for each document."""
    nodes = signed.groupBy("node").agg(F.min(F.struct("_id", "n", "bands")).alias("x"))
    rows = nodes.select("node", F.col("x.n").alias("n"), F.explode("x.bands").alias("band"))
    shared = cut(rows.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("band"))
    buckets = cut(rows.join(shared, "band"))
    wanted = cut(buckets.select("node").distinct().join(nodes.select("node", "x._id"), "node"))
    count = wanted.count()
    if not count:
        return source.sparkSession.createDataFrame([], "a long, b long")

    texts = source.join(small_side(wanted.select(F.col("_id"), F.col("node").alias("own")), count, 32), "_id").select("own", "_text")
    sets = cut(map_arrow(texts, _sets, "node long, n long, shingles array<long>").dropDuplicates(["node"]))
    # private shingles: 32 bits of the hash will do, as a clash only makes one look shared
    alone = (sets.select("node", F.explode("shingles").alias("s")).select("node", F.shiftright("s", 32).cast("int").alias("s"))
             .groupBy("s").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
             .groupBy("node").agg(F.count("*").alias("private")))
    sized = (sets.select("node", "n").join(alone, "node", "left").withColumn("private", F.coalesce("private", F.lit(0)))
             .where(100 * (F.col("n") - F.col("private")) >= percent * F.col("n")))
    open_ = cut(buckets.select("band", "node").join(sized, "node"))

    centre = cut(open_.groupBy("band").agg(F.min(F.struct((F.col("private") / F.col("n")).alias("share"), "node")).alias("c"))
                 .select("band", F.col("c.node").alias("b")))
    stars = cut(open_.join(centre, "band").select(F.col("node").alias("a"), "b", "n", "private").distinct())
    measured = cut(_measured(stars.where("a <> b"), sets))
    links = measured.where(_linked(percent)).select("a", "b")
    rest = cut(_unconnected(stars, measured, connected(links), percent))
    if rest.isEmpty():
        return links
    return links.unionAll(_measured(rest, sets).where(_linked(percent)).select("a", "b"))


def _unconnected(stars: DataFrame, measured: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a star, are in different components and may link.

    With the centre c known, sets u and v share at most min(|u&c|, |v&c|) of
    its shingles, and beside it at most as many as the one with fewer other
    shingles that aren't private.
    """
    rows = (stars.join(measured.select("a", "b", "both"), ["a", "b"], "left").join(comps.withColumnRenamed("node", "a"), "a", "left")
            .select("b", "a", "n", "private", F.coalesce("both", "n").alias("both"), F.coalesce("comp", "a").alias("comp")))
    rows = cut(rows.withColumn("other", F.col("n") - F.col("both") - F.when(F.col("a") == F.col("b"), 0).otherwise(F.col("private"))))

    def mixed(rows: DataFrame) -> DataFrame:
        groups = rows.groupBy("b", "comp").agg(F.count("*").alias("c"), F.min("n").alias("n"))
        of = groups.groupBy("b").agg(F.max(F.struct("c", "comp")).alias("most"), F.count("*").alias("comps"), F.min("n").alias("least"))
        return rows.join(cut(of.where("comps > 1").select("b", F.col("most.comp").alias("main"), "least")), "b")

    some = mixed(rows)
    # with any other node of the star, the union is at least the larger of n and least + private
    some = some.where(100 * (F.col("n") - F.col("private")) >= percent * F.greatest("n", F.col("least") + F.col("private")))
    some = cut(mixed(some.drop("main", "least")).where("a <> b"))  # the centre's own pairs are measured
    sides = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("a", "n", "both", "other", "comp")]
    left, right = some.where("comp <> main").select("b", *sides("l")), some.select("b", "main", *sides("r"))
    most = F.least("both_l", "both_r") + F.least("other_l", "other_r")
    pairs = left.join(right, "b").where("comp_l <> comp_r and (comp_r = main or a_l < a_r)")
    pairs = pairs.where(100 * most >= percent * (F.col("n_l") + F.col("n_r") - most))
    return pairs.select(F.col("a_l").alias("a"), F.col("a_r").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    permutations: int = PERMUTATIONS, band_values: int = BAND_VALUES) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``docs``.

    component_id is the smallest id that links lead to, its own included; kept
    marks the document of that id. Without an id it is null and kept is true.
    """
    source = text_frame(docs, id_col, text_col)
    kind = source.schema["_id"].dataType.simpleString()

    def signatures(batches):
        yield from _signatures(batches, permutations, band_values)

    every = cut(map_arrow(source, signatures, f"_id {kind}, n long, node long, bands array<long>"))
    linkable = every.where("n > 0 and _id is not null")
    links = find_links(source.where("_id is not null"), linkable, percent)
    # rows of one id with different texts are one document
    several = linkable.groupBy("_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    same_id = linkable.select("_id", "node").join(several.select("_id", "a"), "_id").select("a", F.col("node").alias("b")).where("a <> b")
    comps = connected(links.unionAll(same_id))
    lowest = linkable.groupBy("node").agg(F.min("_id").alias("lowest"))
    named = lowest.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    first = named.groupBy("comp").agg(F.min("lowest").alias("component"))
    of_node = cut(named.select("node", "comp").join(first, "comp").select("node", "component"))
    found = every.select("_id", "n", F.when((F.col("n") > 0) & F.col("_id").isNotNull(), F.col("node")).alias("node"))
    return (found.join(of_node, "node", "left")
            .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group; rows without an id stay, and
    of repeated rows of a kept id and text one stays. Different texts of one id
    are different documents here."""
    found = cut(near_duplicates(by_text(docs, id_col, text_col), id_col, text_col, **options).select(F.col(id_col).alias("_key"), "kept"))
    left = join_rows(docs, found.where(~F.col("kept")).select("_key"), id_col, text_col, "left_anti")
    again = cut(found.where("kept and _key is not null").groupBy("_key").agg(F.count("*").alias("c")).where("c > 1").select("_key"))
    if again.isEmpty():
        return left
    repeated = join_rows(left, again, id_col, text_col, "left_semi").dropDuplicates([id_col, text_col])
    return join_rows(left, again, id_col, text_col, "left_anti").unionByName(repeated)

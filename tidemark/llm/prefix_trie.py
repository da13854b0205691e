"""Trie of conversation prefixes, by node tables with minimal perfect hashes.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that begin with it. The steps:

1. Each turn becomes a digest of 128 bits and its number of words; texts are
   not moved. Turns are ordered per conversation, and a prefix's digest is the
   running xor of the digests of (place, turn), so a parent's digest is known
   from a node's own row. Both are windows that stay parallel when one
   conversation holds a third of all turns (``SplitWindow``).
2. Distinct prefix digests are enumerated by one aggregate over all paths:
   members, ends, smallest member.
3. Nodes of one member are chains: one leaf, nothing saved; they need no table.
   The others are dealt to shards by whole subtrees of at most ``limit`` members.
   The nodes above these, the *crown*, have more members each, so they are no
   more than turns / limit.
4. A shard gives its digests slots by a minimal perfect hash, checks each lookup
   against the digest in the slot, scatters the counts into flat arrays by slot
   and adds leaves and saved tokens along parent slots in depth order. Then the
   crown does the same with the totals of the subtrees under it.

``limit`` is the greater of ``LEAST_MEMBERS`` and conversations / ``CROWN``, so
shard and crown keep a bounded size: the first by the members of a subtree, the
second by ``CROWN`` nodes for each turn of a conversation on average.

Ids of the conversations that end at a node are hashed in order: range
partitions of (node, id) write them as text pieces, one task for each node feeds
the pieces to SHA-256 as they come. SHA-256 is sequential, so the pieces of one
node pass through one task, a piece at a time.

Turns are ordered by the turn number, nulls first; ties by the digests of role
and text, an arbitrary order that is the same in every run. Null roles and texts
are empty. Repeated rows are turns of their own. Rows without a conversation
are left out, as they belong to none. Conversation ids are whole numbers. An empty
table has no node, not even a root. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.split_window import Lead, RowNumber, RunningXor, SplitWindow
from . import words as W
from .common import cut, map_arrow, small_side

WORD = r"[^\x20\x09-\x0D]+"
#: Least number of members above which a node belongs to the crown.
LEAST_MEMBERS = 256
#: Crown nodes at one depth, at most, once conversations / CROWN is the greater bound.
CROWN = 1 << 14
#: Nodes of a shard, about; and the least number of shards.
SHARD_NODES = 100_000
LEAST_SHARDS = 32
#: Bytes of ids in one piece.
PIECE_BYTES = 1 << 20

NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- turns and paths


def turn_digests(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(c, r, a, b, w): conversation, place from 1, digest and words of each turn."""
    role, text = (F.coalesce(conversations[x].cast("string"), F.lit("")) for x in (role_col, text_col))
    turns = conversations.where(conversations[conv_col].isNotNull()).select(
        conversations[conv_col].cast("long").alias("c"), conversations[turn_col].alias("t"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("w"))
    turns = cut(turns)
    order = SplitWindow(turns, ["c"], ["t", "a", "b"])
    return order.finish(order.add(order.prepare(turns), r=RowNumber())).select("c", "r", "a", "b", "w")


def with_shared_heads(turns: DataFrame, every: int, most: int) -> DataFrame:
    """(c, o, a, b, w): conversations whose first turns come from the first one of
    each run of ``every`` ids, ``c - c % every``: h of them, or as many as there
    are, in place of their own first h; h is crc32(c) % (``most`` + 1). Order is
    by ``o``; a row with o = 0 and no turn stands for the conversation itself."""
    turns = cut(turns)
    h = F.crc32(F.col("c").cast("string").cast("binary")) % F.lit(most + 1)
    head = (turns.where((F.col("c") % every == 0) & (F.col("r") <= most)).groupBy(F.col("c").alias("base"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("r").alias("o"), "a", "b", "w"))).alias("head")))
    starts = _roots(turns).join(head, F.col("c") - F.col("c") % every == F.col("base"), "left")
    taken = starts.select("c", F.inline_outer(F.slice("head", F.lit(1), h.cast("int")))).where("o is not null")
    own = turns.where(F.col("r") > h).select("c", (F.col("r") + most).alias("o"), "a", "b", "w")
    return _roots(turns).unionByName(taken).unionByName(own)


def _roots(turns: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return turns.where("r = 1").select("c", zero.alias("o"), zero.alias("a"), zero.alias("b"), zero.alias("w"))


def whole(turns: DataFrame) -> DataFrame:
    """(c, o, a, b, w) of the conversations as they are."""
    turns = cut(turns)
    return _roots(turns).unionByName(turns.select("c", F.col("r").alias("o"), "a", "b", "w"))


def paths(rebuilt: DataFrame) -> DataFrame:
    """(c, depth, pa, pb, qa, qb, w, ends): each prefix of each conversation, its
    digest and its parent's; ``ends`` if the conversation has no further turn."""
    rebuilt = cut(rebuilt)
    order = SplitWindow(rebuilt, ["c"], ["o"])
    x = order.add(order.prepare(rebuilt), n=RowNumber(), more=Lead(F.col("o")))
    depth = F.col("n") - 1
    x = x.withColumn("xa", F.when(depth > 0, F.xxhash64(depth, "a", "b"))).withColumn("xb", F.when(depth > 0, F.xxhash64("b", "a", depth)))
    x = order.finish(order.add(x, pa=RunningXor(F.col("xa")), pb=RunningXor(F.col("xb"))))
    return x.select("c", depth.alias("depth"), "pa", "pb", F.col("pa").bitwiseXOR(F.col("xa")).alias("qa"),
                    F.col("pb").bitwiseXOR(F.col("xb")).alias("qb"), "w", F.col("more").isNull().alias("ends"))


# ---------------------------------------------------------------- a shard's node table


class SlotTable:
    """Minimal perfect hash of distinct digests: numbers 0 to n - 1.

    Level by level the digests that are left fall into twice as many places; a
    digest alone in its place has it, the others go on. A slot is the number of
    taken places before it, over all levels. Each lookup ends at the first taken
    place it meets and compares the digest there."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, used = np.arange(len(a)), 0
        slots = np.zeros(len(a), np.int64)
        while len(left):
            if len(self.levels) == 128:
                raise ValueError("digests of a shard must be distinct")
            at = self._places(a[left], b[left], len(self.levels), max(2 * len(left), 64))
            alone = np.bincount(at, minlength=max(2 * len(left), 64)) == 1
            slot = np.cumsum(alone) - 1 + used
            self.levels.append((alone, slot))
            mine = alone[at]
            slots[left[mine]] = slot[at[mine]]
            used, left = used + int(alone.sum()), left[~mine]
        self.slots = slots
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        self.a[slots], self.b[slots] = a, b

    @staticmethod
    def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return (W.mix(a + W.mix(b + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the digests; -1 for those that are not in the table."""
        out, left = np.full(len(a), -1), np.arange(len(a))
        for level, (alone, slot) in enumerate(self.levels):
            at = self._places(a[left], b[left], level, len(alone))
            met = alone[at]
            out[left[met]] = slot[at[met]]
            left = left[~met]
        known = out >= 0
        known[known] = (self.a[out[known]] == a[known]) & (self.b[out[known]] == b[known])
        return np.where(known, out, -1)


#: What a shard is given for its nodes; the last four are totals of children in other shards.
_NODE = "c long, depth long, pa long, pb long, qa long, qb long, n long, w long, n_end long, end_c long"
_BELOW = ("below", "below_n", "below_leaves", "below_saved")
_DONE = f"{_NODE}, parent long, n_children long, n_leaves long, saved_tokens long"


def accumulate(table: pa.Table) -> pa.Table:
    """Counts of the nodes of one shard (or of the crown)."""
    of = {x: table.column(x).to_numpy() for x in table.column_names if x not in ("qa", "qb", "end_c")}
    digest = lambda x: table.column(x).fill_null(0).to_numpy().view(np.uint64)
    nodes = SlotTable(digest("pa"), digest("pb"))
    slot, size = nodes.slots, len(nodes.slots)
    up = nodes.find(digest("qa"), digest("qb"))
    up[of["depth"] == 0] = -1

    def scattered(values):
        flat = np.zeros(size, np.int64)
        flat[slot] = values
        return flat

    n, depth, parent, conv = scattered(of["n"]), scattered(of["depth"]), scattered(up), scattered(of["c"])
    kids, kids_n, leaves, saved = (scattered(of[x]) for x in _BELOW)
    inner = np.flatnonzero(parent >= 0)
    kids += np.bincount(parent[inner], minlength=size)
    np.add.at(kids_n, parent[inner], n[inner])
    alone = n - scattered(of["n_end"]) - kids_n  # children of one member
    kids += alone
    leaves += alone + (kids == 0)
    saved += (n - 1) * scattered(of["w"])
    inner = inner[np.argsort(-depth[inner], kind="stable")]
    edges = np.flatnonzero(np.append(True, depth[inner][1:] != depth[inner][:-1])[:len(inner)])
    for begin, end in zip(edges, np.append(edges, len(inner))[1:], strict=True):
        level = inner[begin:end]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    own = table.select([x.split()[0] for x in _NODE.split(", ")])
    parent_conv = pa.array(conv[np.maximum(up, 0)], mask=up < 0)
    for name, values in (("parent", parent_conv), *((x, pa.array(y[slot])) for x, y in (("n_children", kids), ("n_leaves", leaves), ("saved_tokens", saved)))):
        own = own.append_column(name, values)
    return own


# ---------------------------------------------------------------- ends


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (pa, pb, c) as text pieces (pa, pb, first, ids), one or more a node."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, c = (batch.column(x).to_numpy() for x in ("pa", "pb", "c"))
        step = max(1, PIECE_BYTES // 21)
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        begins = np.union1d(np.flatnonzero(fresh), np.arange(0, len(a), step))
        ends = np.append(begins[1:], len(a))
        text = [",".join(map(str, c[x:y].tolist())).encode() for x, y in zip(begins, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(a[begins]), pa.array(b[begins]), pa.array(c[begins]), pa.array(text, pa.binary())],
                                         names=["pa", "pb", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 a node from its pieces, which come in order."""
    node, state = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist(), batch.column("ids"), strict=True):
            if (a, b) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
        yield _digests(out)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.string())], names=["pa", "pb", "sha"])


def end_hashes(found: DataFrame) -> DataFrame:
    """(pa, pb, sha) of the nodes at which some path of ``found`` ends."""
    by = ["pa", "pb", "c"]
    sorted_ids = found.where("ends").select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
    pieces = map_arrow(sorted_ids, _pieces, "pa long, pb long, first long, ids binary")
    return map_arrow(pieces.repartition("pa", "pb").sortWithinPartitions("pa", "pb", "first"), _hashed, "pa long, pb long, sha string")


# ---------------------------------------------------------------- the trie


def _same(left: str, a: str, b: str) -> Column:
    return (F.col(f"{left}a") == F.col(a)) & (F.col(f"{left}b") == F.col(b))


def prefix_trie(rebuilt: DataFrame, least_members: int = LEAST_MEMBERS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), one row per node. ``rebuilt`` as ``whole`` or
    ``with_shared_heads`` return it."""
    found = cut(paths(rebuilt))
    nodes = cut(found.groupBy("pa", "pb").agg(
        F.min("c").alias("c"), F.min("depth").alias("depth"), F.min("qa").alias("qa"), F.min("qb").alias("qb"), F.count("*").alias("n"),
        F.max("w").alias("w"), F.count_if("ends").alias("n_end"), F.min(F.when(F.col("ends"), F.col("c"))).alias("end_c")))
    total = nodes.agg(F.max("n"), F.count_if((F.col("n") > 1) & (F.col("depth") > 0))).first()
    limit = max(least_members, math.ceil((total[0] or 0) / CROWN))
    in_crown = (F.col("n") > limit) | (F.col("depth") == 0)
    crown = cut(nodes.where(in_crown))
    size = crown.count()
    top = small_side(crown.select(F.col("pa").alias("ta"), F.col("pb").alias("tb"), F.col("c").alias("top_c")), size, 64)

    # subtrees under the crown: where each conversation leaves it
    leaving = (found.select("c", "pa", "pb", "qa", "qb").join(top, _same("q", "ta", "tb"), "left_semi").join(top, _same("p", "ta", "tb"), "left_anti")
               .select(F.col("c").alias("of"), F.xxhash64("pa", "pb").alias("subtree")))
    shards = max(LEAST_SHARDS, math.ceil((total[1] or 0) / shard_nodes))
    below = nodes.where((F.col("n") > 1) & ~in_crown).join(leaving, F.col("c") == F.col("of"))
    below = below.withColumn("shard", F.pmod("subtree", F.lit(shards))).drop("of", "subtree").withColumns({x: F.lit(0).cast("long") for x in _BELOW})
    done = cut(below.groupBy("shard").applyInArrow(accumulate, _DONE))

    # the crown, with what lies under it
    roots = (done.where("parent is null").groupBy(F.col("qa").alias("ua"), F.col("qb").alias("ub"))
             .agg(F.count("*").alias("below"), F.sum("n").alias("below_n"), F.sum("n_leaves").alias("below_leaves"), F.sum("saved_tokens").alias("below_saved")))
    upper = crown.join(roots, _same("p", "ua", "ub"), "left").drop("ua", "ub").fillna(0, subset=list(_BELOW))
    upper = upper.withColumn("shard", F.lit(0)).groupBy("shard").applyInArrow(accumulate, _DONE)

    # nodes of one member: chains, whose first node has a parent of more members
    single = nodes.where((F.col("n") == 1) & (F.col("depth") > 0))
    under_top = single.join(top, _same("q", "ta", "tb"))
    rest = single.join(top, _same("q", "ta", "tb"), "left_anti")
    shared = done.select(F.col("pa").alias("sa"), F.col("pb").alias("sb"), F.col("c").alias("shared_c"))
    rest = rest.join(shared, _same("q", "sa", "sb"), "left")
    chains = under_top.select("*", F.col("top_c").alias("parent")).drop("ta", "tb", "top_c").unionByName(
        rest.select("*", F.coalesce("shared_c", "c").alias("parent")).drop("sa", "sb", "shared_c"))
    chains = chains.select("c", "depth", "parent", "n", (1 - F.col("n_end")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                           F.lit(0).cast("long").alias("saved_tokens"),
                           F.when(F.col("n_end") == 0, F.lit(NO_ENDS)).otherwise(F.sha2(F.col("end_c").cast("string").cast("binary"), 256)).alias("sha"))

    inner = done.join(top, (F.col("parent").isNull()) & _same("q", "ta", "tb"), "left").withColumn("parent", F.coalesce("parent", "top_c")).drop("ta", "tb", "top_c")
    many = inner.unionByName(upper).join(end_hashes(found).select(F.col("pa").alias("ea"), F.col("pb").alias("eb"), "sha"), _same("p", "ea", "eb"), "left")
    many = many.select("c", "depth", "parent", "n", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(NO_ENDS)).alias("sha"))
    return many.unionByName(chains).select(
        F.col("c").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
        "saved_tokens", F.col("sha").alias("ends_sha256"))

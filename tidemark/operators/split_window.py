"""Ordered windows that stay parallel when one record key is huge.

A window partitioned by the record key puts every row of a key into one
task; a key holding a third of the table would run in a single task. When a
key has more than ``hot_rows`` rows, the whole frame goes through a segmented
prefix scan instead:

1. rows are range-partitioned by (keys, order, tie id) into partitions of about
   ``chunk_rows`` rows and written once to the shared checkpoint folder with
   the partition's number. Neither a huge key nor rows that tie on the whole
   order keep together, as the tie id is part of the range;
2. a *segment* is a key's part of one partition. Each window runs per segment;
3. a key that lies in several partitions has an open segment at either end of
   them: at most two a partition. These alone are summarised, a scan over the
   summaries in partition order gives each its *carry*, and the carry completes
   the segment's rows:

====================  ==============================  =========================
function              summary of an open segment      carry into a segment
====================  ==============================  =========================
row_number            row count                       sum of earlier counts
running xor           xor of its values               xor of earlier summaries
first non-null        earliest non-null value         first of earlier segments
last non-null (<=,<)  latest non-null value           last of earlier segments
lag(x, n)             last n values                   last n of earlier ones
lead(x, n)            first n values                  first n of later ones
later non-null        latest non-null value           last of later segments
====================  ==============================  =========================

"First non-null" has peers (a RANGE frame): if rows that tie are spread over
partitions, the last peer group of a segment also takes the first non-null of
its peers further on.

A chain of rounds keeps the partitions: the plan deals the written rows to
tasks by their number, in one exchange for all its rounds, and joins the carries
by broadcast. A round's carries are written when it is added, by a job that
reads the open segments' rows and columns alone. There is no list of hot keys
and no array of bounds. The carry table has at most two rows for a partition, so
its size is known before; beyond ``broadcast_limit`` rows it is joined by
shuffle.

Whether a key is hot is judged on a seeded Bernoulli sample of the keys
(fraction ``sample_per_chunk / chunk_rows``, capped at 1) with one partially
aggregated count per key; two numbers return to the driver. Without a hot key
the plan is the plain one: one hash exchange on the keys, one sort, the window
chain. ``policy=None`` skips the detection.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.names import col
from ..session import checkpoint_dir

#: Number of the range partition a row lies in, and its place among rows that tie.
CHUNK = "__tm_chunk"
TIE = "__tm_tie"
UNB_P = Window.unboundedPreceding
UNB_F = Window.unboundedFollowing


@dataclass(frozen=True)
class SplitPolicy:
    """When and how finely to split.

    hot_rows:   a key with more rows than this has the frame split;
    chunk_rows: target rows per partition of a split frame;
    broadcast_limit: most carry rows (two a partition) that are broadcast;
    sample_per_chunk: expected sampled rows per partition when detecting
                hot keys (the sample fraction is sample_per_chunk/chunk_rows);
    partitions: number of range partitions, in place of rows / chunk_rows.
    """

    hot_rows: int = 2_000_000
    chunk_rows: int = 500_000
    broadcast_limit: int = 200_000
    sample_per_chunk: int = 200
    seed: int = 17
    partitions: int | None = None


DEFAULT_POLICY = SplitPolicy()


# ------------------------------------------------------------------ functions


@dataclass(frozen=True)
class Op:
    kind: str
    x: Column | None = None
    n: int = 1


def RowNumber() -> Op:  # noqa: N802
    return Op("row_number")


def FirstNonNull(x: Column) -> Op:  # noqa: N802
    """Running first non-null (default RANGE frame, peers included)."""
    return Op("first", x)


def LastNonNullUpTo(x: Column) -> Op:  # noqa: N802
    return Op("last_upto", x)


def LastNonNullBefore(x: Column) -> Op:  # noqa: N802
    return Op("last_before", x)


def Lag(x: Column, n: int = 1) -> Op:  # noqa: N802
    return Op("lag", x, n)


def Lead(x: Column, n: int = 1) -> Op:  # noqa: N802
    return Op("lead", x, n)


def LaterNonNull(x: Column) -> Op:  # noqa: N802
    """Last non-null value among the rows after this one (else NULL)."""
    return Op("later", x)


def RunningXor(x: Column) -> Op:  # noqa: N802
    """Bitwise xor of the values up to this row; NULLs count as 0."""
    return Op("xor", x)


def _tmp(name: str, part: str) -> str:
    return f"__tm_{name}_{part}"


def _local(name: str, op: Op, w: WindowSpec, peers: WindowSpec) -> dict[str, Column]:
    """Columns evaluated on the window of a key or segment. ``peers`` is ``w``
    without the tie id, so that rows that tie are peers."""
    t = lambda p: _tmp(name, p)
    whole = w.rowsBetween(UNB_P, UNB_F)
    if op.kind == "row_number":
        return {t("v"): F.row_number().over(w)}
    if op.kind == "xor":
        return {t("v"): F.coalesce(F.bit_xor(op.x).over(w.rowsBetween(UNB_P, 0)), F.lit(0).cast("long"))}
    if op.kind == "first":
        return {t("v"): F.first(op.x, ignorenulls=True).over(peers)}
    if op.kind == "last_upto":
        return {t("v"): F.last(op.x, ignorenulls=True).over(w.rowsBetween(UNB_P, 0))}
    if op.kind == "last_before":
        return {t("v"): F.last(op.x, ignorenulls=True).over(w.rowsBetween(UNB_P, -1))}
    if op.kind in ("lag", "lead"):
        fn = F.lag if op.kind == "lag" else F.lead
        pos = F.row_number().over(w)
        return {t("v"): fn(op.x, op.n).over(w), t("pos"): pos,
                t("rpos"): F.count(F.lit(1)).over(whole) - pos + 1, t("x"): op.x}
    if op.kind == "later":
        later = F.count(op.x).over(whole) - F.count(op.x).over(w.rowsBetween(UNB_P, 0))
        return {t("k"): later, t("v"): F.when(later > 0, F.last(op.x, ignorenulls=True).over(whole)),
                t("x"): op.x}
    raise ValueError(op.kind)


def _local_x(name: str, op: Op) -> Column:
    return F.col(_tmp(name, "x")) if op.kind in ("lag", "lead", "later") else op.x


def _summary(name: str, op: Op, pos: Column, head: Column, order: list[Column]) -> list[Column]:
    """Aggregates per open segment over the local output; all partial-aggregable
    and bounded (lag/lead keep at most n values). ``pos`` is the row's place in
    its segment, so "earliest"/"latest" follow the window order whatever its
    directions; ``head`` is true for the peers of the segment's first row."""
    t = lambda p: _tmp(name, p)
    if op.kind == "row_number":
        return [F.count(F.lit(1)).alias(t("s"))]
    x = _local_x(name, op)
    if op.kind == "xor":
        return [F.bit_xor(x).alias(t("s"))]
    if op.kind == "first":
        tuple_ = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
        first_peers = F.min_by(F.struct(x.alias("x"), tuple_.alias("at")), F.when(x.isNotNull() & head, pos))
        return [F.min_by(x, F.when(x.isNotNull(), pos)).alias(t("s")), first_peers.alias(t("h")),
                F.max_by(tuple_, pos).alias(t("end"))]
    if op.kind in ("last_upto", "last_before", "later"):
        return [F.max_by(x, F.when(x.isNotNull(), pos)).alias(t("s"))]
    if op.kind in ("lag", "lead"):
        # lag: the segment's last n rows (largest rpos first = oldest first);
        # lead: its first n rows (smallest pos first)
        rank = F.col(t("rpos")) if op.kind == "lag" else F.col(t("pos"))
        picked = F.collect_list(F.when(rank <= op.n, F.struct(rank.alias("p"), x.alias("x"))))
        ordered = F.sort_array(picked, asc=(op.kind == "lead"))
        return [F.transform(ordered, lambda e: e["x"]).alias(t("s"))]
    raise ValueError(op.kind)


def _carry(name: str, op: Op, cw: WindowSpec, cw_desc: WindowSpec) -> dict[str, Column]:
    """Window over the open segments of a key. Every frame is linear in their
    number: growing frames, or offsets (a segment holds at least one row, so n
    segments back/ahead always supply n values)."""
    t = lambda p: _tmp(name, p)
    s = F.col(t("s"))
    before, after = cw.rowsBetween(UNB_P, -1), cw_desc.rowsBetween(UNB_P, -1)
    if op.kind == "row_number":
        return {t("c"): F.coalesce(F.sum(s).over(before), F.lit(0))}
    if op.kind == "xor":
        return {t("c"): F.bit_xor(s).over(before)}
    if op.kind == "first":
        # of the later segments that begin with non-null peers the nearest one; it
        # counts if these are peers of this segment's end (no further one can be)
        return {t("c"): F.first(s, ignorenulls=True).over(before),
                t("d"): F.last(F.col(t("h")), ignorenulls=True).over(after), t("end"): F.col(t("end"))}
    if op.kind in ("last_upto", "last_before"):
        return {t("c"): F.last(s, ignorenulls=True).over(before)}
    if op.kind == "later":
        # the last non-null of the later segments is the first one met walking
        # back from the end
        return {t("c"): F.first(s, ignorenulls=True).over(after)}
    if op.kind == "lag":
        prev = [F.lag(s, k).over(cw) for k in range(op.n, 0, -1)]  # oldest first
        vals = F.flatten(F.filter(F.array(*prev), lambda a: a.isNotNull()))
        return {t("c"): F.slice(vals, F.greatest(F.size(vals) - op.n + 1, F.lit(1)), op.n)}
    if op.kind == "lead":
        nxt = [F.lead(s, k).over(cw) for k in range(1, op.n + 1)]
        vals = F.flatten(F.filter(F.array(*nxt), lambda a: a.isNotNull()))
        return {t("c"): F.slice(vals, 1, op.n)}
    raise ValueError(op.kind)


def _final(name: str, op: Op, split: bool, order: list[Column]) -> Column:
    t = lambda p: F.col(_tmp(name, p))
    v = t("v")
    if not split:
        return v.cast("bigint") if op.kind == "row_number" else v
    c = t("c")
    if op.kind == "row_number":
        return v + F.coalesce(c, F.lit(0)).cast("bigint")
    if op.kind == "xor":
        return v.bitwiseXOR(F.coalesce(c, F.lit(0).cast("long")))
    if op.kind == "first":
        same = [v.isNotNull() | t("d").isNotNull()]
        for i, o in enumerate(order):
            same += [t("end")[f"o{i}"].eqNullSafe(o), t("d")["at"][f"o{i}"].eqNullSafe(o)]
        return F.coalesce(c, v, F.when(functools.reduce(Column.__and__, same), t("d")["x"]))
    if op.kind in ("last_upto", "last_before"):
        return F.coalesce(v, c)
    if op.kind == "later":
        # the last non-null of all later rows lies in the latest segment that has one
        return F.coalesce(c, v)
    if op.kind == "lag":
        pos = t("pos")
        idx = (F.size(c) - op.n + pos).cast("int")
        return F.when((pos <= op.n) & c.isNotNull(),
                      F.when(idx >= 1, F.try_element_at(c, F.greatest(idx, F.lit(1))))).otherwise(v)
    if op.kind == "lead":
        rpos = t("rpos")
        idx = (op.n - rpos + 1).cast("int")
        return F.when((rpos <= op.n) & c.isNotNull(),
                      F.when(idx <= F.size(c), F.try_element_at(c, F.greatest(idx, F.lit(1)))))\
            .otherwise(v)
    raise ValueError(op.kind)


# ------------------------------------------------------------------ driver


def _join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str,
                  broadcast: bool = False) -> DataFrame:
    """Join on ``keys`` with NULL matching NULL (a NULL record key is a key
    like any other - and a likely hot one). ``broadcast`` only for a right
    side whose size is known."""
    alias = {k: f"__tm_r_{i}" for i, k in enumerate(keys)}
    r = right.select(*[col(c).alias(alias.get(c, c)) for c in right.columns])
    if broadcast:
        r = F.broadcast(r)
    cond = None
    for k in keys:
        term = left["`" + k.replace("`", "``") + "`"].eqNullSafe(r[alias[k]])
        cond = term if cond is None else cond & term
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*alias.values())


class SplitWindow:
    """Window over ``keys`` ordered by ``order`` (column names, ascending, or
    ``(name, "desc")``); a frame with a hot key is split into range partitions.

    >>> sw = SplitWindow(df, ["user_id"], ["ts", "event_id"])
    >>> x = sw.prepare(df)
    >>> x = sw.add(x, rn=RowNumber(), prev=Lag(F.col("v")))
    >>> out = sw.finish(x)
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str | tuple[str, str]],
                 policy: SplitPolicy | None = DEFAULT_POLICY):
        if not keys:
            raise ValueError("SplitWindow needs at least one record key column")
        self.keys = list(keys)
        # column name, or (name, "asc" | "desc"); Spark's default NULL places
        # (first when ascending, last when descending)
        self._order = [(o, True) if isinstance(o, str) else (o[0], o[1].lower() != "desc")
                       for o in order]
        self.order = [name for name, _ in self._order]
        self.partitions = 0
        self.broadcast_carry = False
        #: (chunk, keys) of the open segments, once a split frame is prepared
        self.open: DataFrame | None = None
        if policy is not None:
            self._detect(df, policy)

    @property
    def split(self) -> bool:
        return self.partitions > 0

    def _order_columns(self) -> list[Column]:
        return [col(c).asc() if asc else col(c).desc() for c, asc in self._order]

    def _detect(self, df: DataFrame, p: SplitPolicy) -> None:
        # the sample only steers the plan, never results
        fraction = min(1.0, p.sample_per_chunk / p.chunk_rows)
        probe = df.select(*[col(k) for k in self.keys])
        if fraction < 1.0:
            probe = probe.sample(withReplacement=False, fraction=fraction, seed=p.seed)
        sizes = probe.groupBy(*[col(k) for k in self.keys]).agg(F.count(F.lit(1)).alias("__tm_n"))
        most, rows = sizes.agg(F.max("__tm_n"), F.sum("__tm_n")).first()
        if not most or most <= p.hot_rows * fraction:
            return
        self.partitions = p.partitions or max(2, math.ceil(rows / fraction / p.chunk_rows))
        self.broadcast_carry = 2 * self.partitions <= p.broadcast_limit

    def prepare(self, df: DataFrame) -> DataFrame:
        """A frame that is split is laid out here, with the partition's number
        and the tie id; another one stays as it is."""
        if not self.split:
            return df
        checkpoint_dir(df.sparkSession)
        keys = [col(k) for k in self.keys]
        placed = (df.withColumn(TIE, F.monotonically_increasing_id())
                  .repartitionByRange(self.partitions, *keys, *self._order_columns(), F.col(TIE))
                  .withColumn(CHUNK, F.spark_partition_id()).checkpoint(eager=True))
        # a key is open where a partition ends with it and the next one begins with it
        key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
        edges = placed.groupBy(CHUNK).agg(F.min(key).alias("first"), F.max(key).alias("last"))
        along = Window.orderBy(CHUNK)  # one row a partition
        edges = edges.select(CHUNK, "first", "last", F.lag("last").over(along).alias("was"), F.lead("first").over(along).alias("next"))
        open_ = F.array_distinct(F.array_compact(F.array(F.when(F.col("first") == F.col("was"), F.col("first")),
                                                         F.when(F.col("last") == F.col("next"), F.col("last")))))
        self.open = (edges.select(CHUNK, F.explode(open_).alias("key"))
                     .select(CHUNK, *[F.col("key")[f"k{i}"].alias(k) for i, k in enumerate(self.keys)]).checkpoint(eager=True))
        return placed.repartitionById(self.partitions, F.col(CHUNK))

    def add(self, df: DataFrame, **ops: Op) -> DataFrame:
        """Add one column per op (all evaluated on the same window)."""
        return self._segmented(df, ops) if self.split else self._plain(df, ops)

    def _window(self, parts: list[str], tie: list[str]) -> WindowSpec:
        return Window.partitionBy(*[col(c) for c in [*parts, *self.keys]]).orderBy(*self._order_columns(), *tie)

    def _plain(self, df: DataFrame, ops: dict[str, Op]) -> DataFrame:
        w, local = self._window([], []), {}
        for name, op in ops.items():
            local.update(_local(name, op, w, w))
        out = df.select("*", *[c.alias(k) for k, c in local.items()])
        return out.select(*[col(c) for c in df.columns], *[_final(n, op, False, []).alias(n) for n, op in ops.items()])

    def _segmented(self, df: DataFrame, ops: dict[str, Op]) -> DataFrame:
        """One round: the window per segment, the summaries and carries of the
        open segments, the carries joined back."""
        w, peers = self._window([CHUNK], [TIE]), self._window([CHUNK], [])
        order = [col(c) for c in self.order]
        local_cols: dict[str, Column] = {"__tm_pos": F.row_number().over(w), "__tm_head": F.rank().over(peers) == 1}
        aggs, carry_cols = [], {}
        cw = Window.partitionBy(*[col(k) for k in self.keys]).orderBy(CHUNK)
        cw_desc = Window.partitionBy(*[col(k) for k in self.keys]).orderBy(F.col(CHUNK).desc())
        for name, op in ops.items():
            local_cols.update(_local(name, op, w, peers))
            aggs.extend(_summary(name, op, F.col("__tm_pos"), F.col("__tm_head"), order))
            carry_cols.update(_carry(name, op, cw, cw_desc))
        local = df.select("*", *[c.alias(k) for k, c in local_cols.items()])
        segment = [CHUNK, *self.keys]
        summed = _join_on_keys(local, self.open, segment, "left_semi", self.broadcast_carry)
        keys = [col(k) for k in segment]
        carry = summed.groupBy(*keys).agg(*aggs).select(*keys, *[c.alias(k) for k, c in carry_cols.items()])
        # at most two rows a partition, written here: this round's windows over the
        # open segments' rows alone (the semi-join goes below them), one job
        joined = _join_on_keys(local, carry.checkpoint(eager=True), segment, "left", self.broadcast_carry)
        return joined.select(*[col(c) for c in df.columns], *[_final(n, op, True, order).alias(n) for n, op in ops.items()])

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(CHUNK, TIE) if self.split else df

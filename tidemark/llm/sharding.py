"""Shards by rendezvous hashing of stable record keys.

Each (key, shard) pair has a hash of its own, read as a number u between 0 and
1; a record goes to the shard with the greatest ``-weight / ln(u)``. A shard gets
its weight's share of the keys, and the choice needs no table: it depends on the
key and the list of weights alone. With one more shard a record either stays or
goes to the new one; without the last shard only that shard's records move.

The key is the id: whole numbers of all widths hash alike, other types by their
text. Rows that share an id, repeated rows too, lie in one shard; so do all rows
without an id. Texts don't count: equal texts of two ids may lie in two shards.

Slots number a shard's rows from 0 without a gap, in the order of (hash of the
key, id, CRC-32, size), so they don't depend on how the input is partitioned. A
shard is a third of all rows or more when there are few, so slots come from a
segmented scan over range partitions (``SplitWindow``), whatever the sizes; rows
that agree in all of these are interchangeable and are spread as well.

Only ids, sizes and checksums are shuffled, no texts. Null texts have no bytes:
size ``OVERHEAD``, CRC-32 0. An empty table gives an empty result; further
columns are not read by ``assign_shards``, and kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.split_window import RowNumber, SplitPolicy, SplitWindow
from .common import cut

#: Bytes of a record beside its text.
OVERHEAD = 8
#: Narrow rows of one range partition, when slots are numbered.
SLOT_ROWS = 200_000


def stable_key(id_col: Column, kind: T.DataType) -> Column:
    """Whole numbers as long, so that a wider column moves no row; else the text."""
    return id_col.cast("long") if isinstance(kind, T.IntegralType) else id_col.cast("string")


def _weights(weights: int | list[float]) -> list[float]:
    listed = [1.0] * weights if isinstance(weights, int) else [float(w) for w in weights]
    if not listed or min(listed) <= 0:
        raise ValueError("shards need a weight above 0 each")
    return listed


def _draw(key: Column, shard: Column, weight: Column) -> Column:
    """Weight over an exponential draw of the pair; the greatest wins."""
    u = (F.shiftrightunsigned(F.xxhash64(key, shard), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -weight / F.ln(u)


def best_shard(key: Column, weights: int | list[float]) -> Column:
    """struct<draw, shard> of the winning shard; the lower number among equals."""
    listed = F.array(*[F.lit(w) for w in _weights(weights)])
    best = F.array_max(F.transform(listed, lambda w, i: F.struct(_draw(key, i, w).alias("draw"), (-i).alias("less"))))
    return F.struct(best["draw"].alias("draw"), (-best["less"]).alias("shard"))


def assign_shards(docs: DataFrame, weights: int | list[float], grown_weight: float | None = None,
                  id_col: str = "doc_id", text_col: str = "text", slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard), one row per row of
    ``docs``. ``weights``: one for each shard, or their number. ``grown_shard``
    is the shard after one of weight ``grown_weight`` is added (None: null)."""
    listed = _weights(weights)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    key = stable_key(F.col("_id"), docs.schema[id_col].dataType)
    rows = docs.select(docs[id_col].alias("_id"), (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("_best", best_shard(key, listed))
    shard = F.col("_best.shard")
    if grown_weight is None:
        grown = F.lit(None).cast("int")
    else:
        added = len(listed)
        grown = F.when(_draw(key, F.lit(added), F.lit(_weights([grown_weight])[0])) > F.col("_best.draw"), F.lit(added)).otherwise(shard)
    rows = cut(rows.select("_id", "size", "text_crc32", F.xxhash64(key).alias("_hash"), shard.cast("int").alias("shard"),
                           grown.cast("int").alias("grown_shard")))
    order = SplitWindow(rows, ["shard"], ["_hash", "_id", "text_crc32", "size"], SplitPolicy(hot_rows=0, chunk_rows=slot_rows))
    numbered = order.finish(order.add(order.prepare(rows), _n=RowNumber()))
    return numbered.select(F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("_n") - 1).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, weights: int | list[float], id_col: str = "doc_id", text_col: str = "text",
                 files: int | None = None) -> None:
    """Whole rows as Parquet under ``path``/shard=<number>/, in the order of the
    slots within a file and from file to file. ``files``: range partitions of the
    whole output (None: as Spark chooses); a shard is cut at their bounds, so
    that a large one is written by many tasks."""
    kind = docs.schema[id_col].dataType
    if "shard" in docs.columns:
        raise ValueError("the column shard is the name of the folders")
    key = stable_key(docs[id_col], kind)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    by = [F.col("shard"), F.xxhash64(key), docs[id_col], F.crc32(text.cast("binary")), F.octet_length(text)]
    placed = docs.withColumn("shard", best_shard(key, weights)["shard"].cast("int"))
    spread = [*by, F.monotonically_increasing_id()]
    ranged = placed.repartitionByRange(files, *spread) if files else placed.repartitionByRange(*spread)
    ranged.sortWithinPartitions(*by).write.partitionBy("shard").parquet(path)

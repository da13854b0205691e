"""What the operators of this subpackage share: frames, checkpoints, sizes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpoint_dir
from ..sources import read_table

#: Bytes that one broadcast may hold; larger sides are joined by shuffle.
BROADCAST_BYTES = 64 << 20
#: Bytes of rows that Spark sends a worker at once, unless the session has its
#: own setting; the task holds them twice, beside the heap and in the worker.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_frame(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under names of this package, so that further columns
    of the caller, whatever their names, can't clash."""
    return docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder. Later plans start
    from those files, so a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made and ``cut`` inside leave no shuffle files behind. They must be
    cut in full, and only once; what is returned to a caller is made outside."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` in batches of about ``BATCH_BYTES``; a worker waits for its
    next task with its memory given back."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, str(BATCH_BYTES))

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Memory that this worker no longer uses goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(mod)


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its counted size is within the bound;
    else unmarked, to be joined by shuffle."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def by_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text, with (id, hash of the text) in place of the id, so that
    different texts of one id are told apart; null without an id."""
    key = F.struct(docs[id_col].alias("id"), F.xxhash64(docs[text_col].cast("string")).alias("hash"))
    return docs.select(F.when(docs[id_col].isNotNull(), key).alias(id_col), docs[text_col].alias(text_col))


def join_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """``docs`` semi- or anti-joined with the keys of ``by_text`` in the one
    column of ``keys``; these are broadcast if they are few enough."""
    found = cut(keys.select(keys[keys.columns[0]].alias("_key")).where("_key is not null").distinct().select(F.col("_key.id").alias("_of"), "_key.hash"))
    same = (docs[id_col] == F.col("_of")) & (F.xxhash64(docs[text_col].cast("string")) == found["hash"])
    return docs.join(small_side(found, found.count(), 64), same, how)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)

"""Global 1-based row numbers without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Here each row keeps its partition: ``monotonically_increasing_id`` gives
(partition, position); a tiny per-partition count is prefix-summed and joined
back by broadcast (one row per input partition, so its size is bounded by the
partition count, not by the data).

Rows of a Parquet scan are numbered by file path and place in the file instead
(``_metadata``): a row's number then depends on the files and the filters alone,
not on how the files are split or packed into tasks, and a numbered batch is
the same under any ``spark.sql.files.maxPartitionBytes``. A task reads its piece
of a file in order, so the counts are per (partition, file).

The count pass and the numbering pass read the same input twice, so both must
see the same partitions. That holds for a scan with filters and projections,
and for a checkpointed frame. Any other plan - a shuffle, whose partitions
adaptive execution may coalesce differently in the two passes, a limit, a
sample, a non-deterministic expression - is first written to the shared
``spark.checkpoint.dir`` (reliable, survives executor loss), and both passes
read that copy. A row whose partition has no count raises an error; it is never
dropped.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_POS_BITS = 33
BROADCAST_PARTITIONS = 2_000_000


# Physical operators that keep a scan's partitions, whatever columns are read.
_NARROW = re.compile(r"^(Scan|FileScan|BatchScan|Project|Filter|ColumnarToRow|LocalTableScan|Range|Union|"
                     r"WholeStageCodegen|InputAdapter|SubqueryAlias)\b")


def has_stable_partitions(df: DataFrame) -> bool:
    """Whether two reads of ``df`` see the same rows in the same partitions:
    the plan is deterministic and has nothing but scans, filters, projections
    and unions. Looks at the plan only; no job runs."""
    execution = df._jdf.queryExecution()
    if not execution.optimizedPlan().deterministic():
        return False
    nodes = [re.sub(r"^[\s:+*()\d-]*", "", line) for line in execution.sparkPlan().toString().splitlines()]
    return all(_NARROW.match(node) for node in nodes if node)


def _file_position(df: DataFrame) -> tuple[Column, Column] | None:
    """(file path, row's place in it) of a plain scan whose source has them."""
    if "_metadata" in df.columns:
        return None
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        df.select(path, place)
    except AnalysisException:
        return None
    return path, place


def with_row_index(
    df: DataFrame,
    col: str = "RowIndex",
    order_by: list[str | Column] | None = None,
    materialize: bool | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``col`` = 1..n.

    * ``order_by=None``: numbers follow the files' paths and the rows' places
      in them where the source has such places (Parquet), else the physical row
      order (partition by partition, as ``monotonically_increasing_id``).
    * ``order_by=[...]``: numbers follow that order (range-partitioned sort
      with a per-row tie-breaker, so a heavily repeated value is still spread
      over partitions; then checkpoint). Ties get consecutive numbers in
      arbitrary order.
    * ``materialize``: checkpoint before numbering; by default when an order is
      requested or the plan is more than a scan with filters and projections.
    """
    if order_by:
        # A per-row tie-breaker lets the range partitioner split a value that
        # many rows share (ties are numbered in arbitrary order anyway). The
        # partition count is AQE's unless given: the checkpoint below fixes
        # whatever layout the sort produced.
        keys = [*order_by, "__tm_tie"]
        ranged = df.withColumn("__tm_tie", F.monotonically_increasing_id())
        ranged = (ranged.repartitionByRange(num_partitions, *keys) if num_partitions
                  else ranged.repartitionByRange(*keys))
        df = ranged.sortWithinPartitions(*keys).drop("__tm_tie")
        if materialize is None:
            materialize = True
    if materialize is None:
        materialize = not has_stable_partitions(df)
    if materialize:
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)

    position = None if materialize else _file_position(df)
    path, place = position or (F.lit(None).cast("string"), F.lit(None).cast("long"))
    base = df.select("*", F.monotonically_increasing_id().alias("__tm_mid"), path.alias("__tm_file"), place.alias("__tm_place"))
    base = base.withColumn("__tm_part", F.shiftright("__tm_mid", _POS_BITS))
    pos = F.col("__tm_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    piece = ["__tm_part", "__tm_file"] if position else ["__tm_part"]
    counts = base.groupBy(*piece).agg(F.count(F.lit(1)).alias("__tm_n"), F.min(pos).alias("__tm_min"), F.min("__tm_place").alias("__tm_at"))
    order = Window.orderBy("__tm_file", "__tm_at") if position else Window.orderBy("__tm_part")
    before = F.coalesce(F.sum("__tm_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(*[F.col(c).alias(f"{c}_") for c in piece], (before - F.col("__tm_min")).alias("__tm_off"))
    # a row for each input partition and file in it: broadcast while that count
    # is moderate (planning only, no job), a shuffle join beyond it
    pieces = df.rdd.getNumPartitions() + (len(df.inputFiles()) if position else 0)
    if pieces <= BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    lost = F.raise_error(F.lit("with_row_index: the input's partitions changed between two reads; "
                               "pass materialize=True")).cast("bigint")
    return (
        base.join(offsets, reduce(Column.__and__, [F.col(c) == F.col(f"{c}_") for c in piece]), "left")
        .withColumn(col, pos + F.coalesce(F.col("__tm_off"), lost) + F.lit(1))
        .drop("__tm_mid", "__tm_part", "__tm_file", "__tm_place", "__tm_off", *[f"{c}_" for c in piece])
    )

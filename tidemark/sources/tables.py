"""Scans: catalog tables, batches, parquet folders, CSV.

All readers return lazy DataFrames so Catalyst can push the batch filter and
the column selection into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col
from ..operators.row_index import with_row_index


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a parquet folder (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_rules_table(spark: SparkSession, table: str) -> DataFrame:
    """The rules catalogue: source_system_id, table_name, field_name,
    expectation, expectation_action, active."""
    return spark.read.table(table)


def batch_of(df: DataFrame, batch_id: str, batch_col: str = "batch_id",
             index_col: str | None = "RowIndex",
             order_by: list[str] | None = None) -> DataFrame:
    """Rows of one batch, numbered 1..n *after* the batch filter."""
    rows = df.where(F.col(batch_col) == F.lit(batch_id))
    if index_col is None:
        return rows
    return with_row_index(rows, index_col, order_by=order_by)


def read_batch(spark: SparkSession, table: str, batch_id: str, batch_col: str = "batch_id",
               index_col: str | None = "RowIndex",
               order_by: list[str] | None = None) -> DataFrame:
    """One batch of a catalog table (the filter reaches the scan)."""
    return batch_of(spark.read.table(table), batch_id, batch_col, index_col, order_by)


def read_csv(spark: SparkSession, path: str, header: bool = True,
             infer_schema: bool = True) -> DataFrame:
    """CSV with a header line and inferred types (local or object-store path).
    Lines that aren't such rows give what fits of them; ``read_csv_checked``
    tells them apart."""
    return spark.read.csv(path, header=header, inferSchema=infer_schema)


#: Name of the column that holds the text of a line that is no row.
REJECTED = "_rejected"

#: Types that text may have, the first that fits all values counts; a pattern
#: where Spark's cast takes more than a CSV writer means (leading zeros and blanks).
CSV_TYPES = (
    (T.BooleanType(), r"(?i)^(true|false)$"),
    (T.IntegerType(), r"^[+-]?(0|[1-9]\d*)$"),
    (T.LongType(), r"^[+-]?(0|[1-9]\d*)$"),
    (T.DoubleType(), r"(?i)^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)(e[+-]?\d+)?$|^[+-]?(nan|inf|infinity)$"),
    (T.DateType(), r"^\d{4}-\d{2}-\d{2}$"),
    (T.TimestampType(), r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?([Zz]|[+-]\d{2}:\d{2})?$"),
)


def _fits(text: Column, kind: T.DataType, pattern: str) -> Column:
    return text.rlike(pattern) & text.try_cast(kind).isNotNull()


def infer_types(texts: DataFrame) -> T.StructType:
    """The type of each text column: the first of ``CSV_TYPES`` that all its
    values have, else string. One mergeable aggregate over all rows, whose only
    row returns to the driver. A column without values is a string."""
    names = texts.columns
    if not names:
        return T.StructType([])
    aggs = [F.every(col(n).isNull() | _fits(col(n), kind, pattern)).alias(f"{i}_{k}")
            for i, n in enumerate(names) for k, (kind, pattern) in enumerate(CSV_TYPES)]
    aggs += [F.count(col(n)).alias(f"{i}_n") for i, n in enumerate(names)]
    found = texts.agg(*aggs).first()
    kind_of = lambda i: next((kind for k, (kind, _) in enumerate(CSV_TYPES) if found[f"{i}_n"] and found[f"{i}_{k}"]), T.StringType())
    return T.StructType([T.StructField(n, kind_of(i)) for i, n in enumerate(names)])


def typed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the types of ``schema``; further columns stay."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return texts.select(*[col(n).try_cast(kinds[n]).alias(n) if n in kinds else col(n) for n in texts.columns])


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, REJECTED]])


def parse_csv_lines(lines: DataFrame, names: list[str], line_col: str = "value", **options: str) -> DataFrame:
    """One row per CSV line: its fields as text under ``names`` and, in
    ``_rejected``, the line itself if it has too few or too many fields; such a
    line's fields are NULL. Further columns stay. ``options`` as for ``from_csv``."""
    schema = _text_schema(names)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    parsed = F.from_csv(col(line_col), F.lit(ddl), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED, **options})
    others = [col(c) for c in lines.columns if c != line_col]
    rows = lines.select(*others, parsed.alias("__tm_row"))
    bad = F.col("__tm_row")[REJECTED]
    return rows.select(*[col(c) for c in lines.columns if c != line_col],
                       *[F.when(bad.isNull(), F.col("__tm_row").getField(n)).alias(n) for n in names], bad.alias(REJECTED))


def read_csv_checked(spark: SparkSession, path: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of CSV files with a header line: rows with types that fit
    all values of all accepted lines, and the lines that are no rows, as text.
    The files are read once for the types and once by whoever uses the result."""
    names = spark.read.options(**options).csv(path, header=True).columns
    if REJECTED in names:
        raise ValueError(f"a column is named {REJECTED}")
    # without column pruning, as what is a row must not depend on the columns asked for
    texts = spark.read.options(**{"columnPruning": "false", **options}).csv(
        path, header=True, schema=_text_schema(names), mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED)
    accepted = texts.where(col(REJECTED).isNull()).select(*[col(n) for n in names])
    # (a scan that is asked for the rejected text alone is refused)
    parsed = F.length(F.concat_ws("", *[col(n) for n in names])) >= 0
    rejected = texts.where(col(REJECTED).isNotNull() & parsed).select(col(REJECTED).alias("line"))
    return typed(accepted, infer_types(accepted)), rejected

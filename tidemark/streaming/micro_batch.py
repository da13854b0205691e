"""``foreachBatch`` adapter for the end-to-end quality check."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.validate import check_data_quality


def quality_batch_writer(
    system_id: int,
    system_name: str,
    table_name: str,
    report_path: str,
    rules: list[dict] | DataFrame | None = None,
    rules_table: str | None = None,
    as_of: _dt.datetime | None = None,
) -> Callable[[DataFrame, int], None]:
    """Function for ``df.writeStream.foreachBatch(...)``: checks each
    micro-batch (batch id = epoch id) and
    writes its report to parquet at ``report_path``, partitioned by
    ``batch_id``.

    Each epoch overwrites only its own partition, so an epoch re-run after a
    failure replaces its report instead of adding a second one.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        _, report = check_data_quality(
            system_id, system_name, table_name, str(epoch_id), rules=rules, df=batch,
            rules_table=rules_table, as_of=as_of, number_rows=False,
        )
        (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(report_path))

    return write

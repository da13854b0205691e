from .tables import (
    batch_of, infer_types, parse_csv_lines, read_batch, read_csv, read_csv_checked, read_rules_table, read_table, typed,
)

__all__ = ["batch_of", "infer_types", "parse_csv_lines", "read_batch", "read_csv", "read_csv_checked", "read_rules_table",
           "read_table", "typed"]

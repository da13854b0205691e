"""tidemark: rule-driven data quality and per-record profile selection on
Spark DataFrames."""

from .functions import RULE_NAMES, RuleError, build_check
from .operators import (
    check_data_quality, component_summary, failing_rows, quality_report, row_report,
    rule_summary, set_state_profile, with_index_rows, with_row_index,
)
from .operators.split_window import SplitPolicy, SplitWindow
from .plans import Suite, compile_rules, expand_rules, lookup_rules, skipped_frame
from .session import checkpoint_dir, get_spark

__all__ = [
    "RULE_NAMES", "RuleError", "build_check",
    "check_data_quality", "component_summary", "failing_rows", "quality_report",
    "row_report", "rule_summary", "set_state_profile", "with_index_rows", "with_row_index",
    "Suite", "compile_rules", "expand_rules", "lookup_rules", "skipped_frame", "checkpoint_dir", "get_spark",
    "SplitPolicy", "SplitWindow",
]

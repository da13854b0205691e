from .row_index import with_row_index
from .profiles import pick_profile, profile_stages, set_state_profile
from .validate import (
    check_data_quality, component_summary, failing_rows, quality_report, row_report,
    rule_summary, with_index_rows,
)

__all__ = [
    "with_row_index", "pick_profile", "profile_stages", "set_state_profile",
    "check_data_quality", "component_summary", "failing_rows", "quality_report",
    "row_report", "rule_summary", "with_index_rows",
]

from .checks import DATA_TYPES, RULE_NAMES, Check, RuleError, UnevaluableError, build_check
from .strftime import bad_format, parses_with, to_regex

__all__ = [
    "DATA_TYPES", "RULE_NAMES", "Check", "RuleError", "UnevaluableError", "build_check",
    "bad_format", "parses_with", "to_regex",
]

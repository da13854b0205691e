from .rules import (
    CompiledRule, Component, Suite, compile_rules, expand_rules, known_rules,
    lookup_rules, rules_frame, skipped_frame, skipped_rules,
)

__all__ = [
    "CompiledRule", "Component", "Suite", "compile_rules", "expand_rules", "known_rules",
    "lookup_rules", "rules_frame", "skipped_frame", "skipped_rules",
]

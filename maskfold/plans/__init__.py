"""Rule planning: rule table, options and the scrub engine."""

from maskfold.plans.engine import rule_expression, scrub, validate
from maskfold.plans.options import AUDIT_COLUMNS, PRESETS, AddressColumns, ScrubOptions, preset
from maskfold.plans.rules import (
    RULE_TYPES,
    Rule,
    RuleViolationError,
    Violation,
    check_rules,
    execution_order,
    load_rules,
    violations_frame,
)

__all__ = [
    "AUDIT_COLUMNS",
    "PRESETS",
    "RULE_TYPES",
    "AddressColumns",
    "Rule",
    "RuleViolationError",
    "ScrubOptions",
    "Violation",
    "check_rules",
    "execution_order",
    "load_rules",
    "preset",
    "rule_expression",
    "scrub",
    "validate",
    "violations_frame",
]

"""maskfold: rule-driven column scrubbing as native Spark DataFrame plans."""

from maskfold.plans import (
    AddressColumns,
    Rule,
    RuleViolationError,
    ScrubOptions,
    check_rules,
    load_rules,
    preset,
    scrub,
    validate,
    violations_frame,
)
from maskfold.plans.job import run_job
from maskfold.sources import infer_schemas, read_addresses, read_inferred, read_manifest, read_table, write_outputs

__all__ = [
    "AddressColumns",
    "Rule",
    "RuleViolationError",
    "ScrubOptions",
    "check_rules",
    "infer_schemas",
    "load_rules",
    "preset",
    "read_addresses",
    "read_inferred",
    "read_manifest",
    "read_table",
    "run_job",
    "scrub",
    "validate",
    "violations_frame",
    "write_outputs",
]

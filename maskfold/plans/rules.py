"""Rule table: loading, trimming, execution order and validation.

A rule table is control data (one row per scrubbed column, tens of rows), so it is collected to the
driver once, with a hard row bound, and everything else is decided before any data job runs.
"""

from __future__ import annotations

import ast
import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The rule vocabulary (exact, case-sensitive) and the reference's report messages.
RULE_TYPES = ("address", "amount", "cross", "fix", "multiple", "numeric", "regex", "single")
MSG_DUPLICATE = (
    "User input error. Invalid scrubbing criteria. Two scrubbing needs mentioned for the same "
    "column. Please check the replace file content!!!!"
)
MSG_COLUMNS = (
    "User input error. Invalid scrubbing criteria. One or more column names mentioned in the "
    "replace file are incorrect. Please check the replace file contents!!!!"
)
MSG_TYPES = (
    "User input error. Invalid scrubbing criteria. One or more values in the TYPE column of "
    "replace file are incorrect. Please check the replace file contents!!!!"
)
MSG_FORMAT = " User input error. Data file needs to be in .txt or .csv format only!!!!"
MSG_DATA_FILE = (
    "User input error. Data file mentioned is not available. Please check the name and re-run the "
    "script!!!!"
)
MSG_RULE_FILE = (
    "User input error. Replace file mentioned is not available. Please check the name and re-run "
    "the script!!!!"
)
MSG_SUCCESS = "Scrubbing process successfully completed"

RULE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in ("Column", "Type", "Value")]
)
MAX_RULES = 100_000  # a rule table is control data; refuse anything that is really data


@dataclass(frozen=True)
class Rule:
    column: str
    type: str
    value: str = ""

    @classmethod
    def of(cls, item) -> Rule:
        if isinstance(item, Rule):
            r = item
        elif isinstance(item, Mapping):
            r = cls(item.get("Column"), item.get("Type"), item.get("Value"))
        else:
            r = cls(*item)
        return cls(_clean(r.column), _clean(r.type), _clean(r.value))


def _clean(v) -> str:
    return "" if v is None else str(v).strip()


@dataclass(frozen=True)
class Violation:
    check: str
    column: str
    type: str
    message: str


class RuleViolationError(ValueError):
    def __init__(self, violations: list[Violation]):
        self.violations = violations
        super().__init__("; ".join(sorted({v.message for v in violations})))


def load_rules(source, spark: SparkSession | None = None) -> list[Rule]:
    """Rules from a list (``Rule``, tuples or dicts), a DataFrame ``(Column, Type, Value)`` or a
    CSV path (header ``Column,Type,Value``, double-quoted values). Blanks around names, types and
    values are trimmed."""
    if isinstance(source, DataFrame):
        rows = source.select("Column", "Type", "Value").limit(MAX_RULES + 1).collect()
        if len(rows) > MAX_RULES:
            raise ValueError(f"rule table has more than {MAX_RULES} rows")
        return [Rule.of(r.asDict()) for r in rows]
    if isinstance(source, str):
        if spark is None:
            spark = SparkSession.active()
        return load_rules(read_rule_table(spark, source))
    return [Rule.of(r) for r in source]


def read_rule_table(spark: SparkSession, path: str) -> DataFrame:
    """The rule CSV as ``(Column, Type, Value)`` strings, matched by header name (any column order,
    blanks around header names ignored, extra columns dropped)."""
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )
    by_name = {c.strip(): c for c in raw.columns}
    missing = [f.name for f in RULE_SCHEMA.fields if f.name not in by_name]
    if missing:
        raise ValueError(f"rule file lacks column(s) {missing}; header must name Column, Type, Value")
    return raw.select(*[F.col(f"`{by_name[f.name]}`").alias(f.name) for f in RULE_SCHEMA.fields])


def execution_order(rules: Iterable[Rule]) -> list[Rule]:
    """Types in first-seen order, columns in table order within a type."""
    groups: dict[str, list[Rule]] = {}
    for r in rules:
        groups.setdefault(r.type, []).append(r)
    return [r for group in groups.values() for r in group]


def parse_int(value: str) -> int:
    """``5`` or ``5.0`` (any float text is truncated, as ``int(float(v))``)."""
    try:
        return int(value)
    except ValueError:
        return int(float(value))


def parse_mapping(value: str) -> dict:
    """A dictionary literal (Python or JSON) -> dict; only literals, nothing is evaluated."""
    try:
        parsed = ast.literal_eval(value)
    except (ValueError, SyntaxError):
        parsed = json.loads(value)
    if not isinstance(parsed, dict):
        raise ValueError("mapping value must be a dictionary literal")
    return parsed


def parse_piece(value: str) -> tuple[str, str, int]:
    """``<source column><one-character delimiter><one digit>`` -> (source, delimiter, index)."""
    if len(value) < 3 or not value[-1].isdigit():
        raise ValueError("single value must be <column><delimiter><digit>")
    return value[:-2], value[-2], int(value[-1])


def _value_problem(rule: Rule, options) -> str | None:
    try:
        if rule.type in ("numeric", "cross") and not (
            rule.type == "numeric" and options.numeric == "sequence" and options.sequence_start is not None
        ):
            parse_int(rule.value)
        elif rule.type == "amount":
            float(rule.value)
        elif rule.type == "multiple" and options.multiple == "map":
            parse_mapping(rule.value)
        elif rule.type == "single":
            parse_piece(rule.value)
    except (ValueError, SyntaxError, TypeError, OverflowError) as e:
        return f"Invalid value {rule.value!r} for rule type {rule.type!r}: {e}"
    return None


def check_rules(columns: list[str], rules: list[Rule], options) -> list[Violation]:
    """Every problem of a rule set against the (audit-dropped) data columns, reported together."""
    out: list[Violation] = []
    seen: set[str] = set()
    for r in rules:
        if r.column in seen:
            out.append(Violation("duplicate", r.column, r.type, MSG_DUPLICATE))
        seen.add(r.column)
    present = set(columns)
    for r in rules:
        if r.column not in present:
            out.append(Violation("column", r.column, r.type, MSG_COLUMNS))
        if r.type not in RULE_TYPES:
            out.append(Violation("type", r.column, r.type, MSG_TYPES))
            continue
        problem = _value_problem(r, options)
        if problem:
            out.append(Violation("value", r.column, r.type, problem))
            continue
        needed = []
        if r.type == "single":
            needed.append(parse_piece(r.value)[0])
        if r.type == "cross":
            needed.append(options.id_col)
        if r.type == "address":
            needed.append(options.id_col if options.address == "keyed" else options.order_col)
        for name in needed:
            if name not in present:
                out.append(Violation("column", name, r.type, MSG_COLUMNS))
    return out


def violations_frame(spark: SparkSession, violations: list[Violation]) -> DataFrame:
    """The run report as a small DataFrame ``(check, column, type, message)``; empty = success."""
    schema = "check string, column string, type string, message string"
    return spark.createDataFrame(
        [(v.check, v.column, v.type, v.message) for v in violations], schema
    )

"""``scrub``: validate a rule set, then fold it into one lazy plan.

Rules run in the reference's order (types in first-seen order, columns in table order). Consecutive
rules are batched into one ``withColumns`` projection unless a rule reads a column an earlier rule
of the batch writes; Catalyst collapses the rest. The address rule is a join at its place in the
order. Nothing runs until the caller writes the result, but for narrow passes of the sampled address mode and of
the sequence mode, which needs positions of the rows that last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from maskfold.functions import masks
from maskfold.functions.names import col
from maskfold.operators.address import prepare_addresses, replace_keyed, replace_sampled
from maskfold.operators.audit import drop_audit
from maskfold.operators.position import with_position
from maskfold.plans.options import ScrubOptions
from maskfold.plans.rules import (
    Rule,
    RuleViolationError,
    check_rules,
    execution_order,
    load_rules,
    parse_int,
    parse_mapping,
    parse_piece,
    violations_frame,
)


POSITION = "__mf_position"


def reads_of(rule: Rule, o: ScrubOptions) -> set[str]:
    """Columns a rule's expression reads."""
    if rule.type == "fix" or (rule.type == "numeric" and o.numeric == "sequence"):
        return set()
    if rule.type == "multiple" and o.multiple == "choice":
        return set()
    if rule.type == "cross":
        return {o.id_col}
    if rule.type == "single":
        return {parse_piece(rule.value)[0]}
    return {rule.column}


def rule_expression(rule: Rule, frame: DataFrame | dict, o: ScrubOptions) -> Column:
    """The native expression for one column rule over the current frame (or its column types)."""
    types = frame if isinstance(frame, dict) else {f.name: f.dataType for f in frame.schema.fields}
    c, dtype, v = col(rule.column), types.get(rule.column), rule.value
    t = rule.type
    if t == "fix":
        m = masks.fix(v, o.fix)
    elif t == "numeric" and o.numeric == "sequence":
        start = o.sequence_start if o.sequence_start is not None else parse_int(v)
        m = masks.numeric_sequence(start, col(POSITION) if POSITION in types else None)
    elif t == "numeric":
        m = masks.numeric_digits(c, dtype, parse_int(v))
    elif t == "amount":
        m = masks.amount(c, float(v))
    elif t == "cross":
        m = masks.cross_shift(col(o.id_col), types.get(o.id_col), parse_int(v))
    elif t == "multiple" and o.multiple == "choice":
        m = masks.choose_constant(masks.parse_list(v), o.choice_suffix, o.seed)
    elif t == "multiple":
        m = masks.map_values(c, dtype, parse_mapping(v))
    elif t == "regex" and o.regex == "index":
        m = masks.regex_index(c, dtype, v, o.regex_pattern)
    elif t == "regex":
        m = masks.regex_reverse(c, dtype, v, o.regex_pattern, o.regex_shift)
    elif t == "single":
        src, delim, idx = parse_piece(v)
        m = masks.piece(col(src), types[src], delim, idx)
    else:
        raise ValueError(f"no expression for rule type {t!r}")
    return m.resolve(o.on_error, f"scrub rule {t} failed on column {rule.column}")


def apply_address(df: DataFrame, addresses: DataFrame | None, o: ScrubOptions) -> DataFrame:
    if addresses is None:
        raise ValueError("an address rule needs an address table")
    c = o.columns
    needed = [c.number, c.street, c.city, c.region, c.postcode]
    needed += [c.unit] if o.include_unit else []
    needed += [o.id_col] if o.address == "keyed" else []
    missing = [name for name in needed if name not in addresses.columns]
    if missing:
        raise ValueError(f"address table lacks column(s) {missing}")
    if o.address == "keyed":
        return replace_keyed(df, prepare_addresses(addresses, o, key=o.id_col), o)
    return replace_sampled(df, prepare_addresses(addresses, o), o)


def validate(df: DataFrame, rules, options: ScrubOptions | None = None) -> DataFrame:
    """The run report for a rule set against ``df`` (after the audit drop) as a small DataFrame
    ``(check, column, type, message)``; empty means the rules are valid. No data job runs."""
    o = options or ScrubOptions()
    spark = df.sparkSession
    rule_list = load_rules(rules, spark)
    return violations_frame(spark, check_rules(drop_audit(df, o.audit_cols).columns, rule_list, o))


def scrub(
    df: DataFrame,
    rules,
    addresses: DataFrame | str | None = None,
    options: ScrubOptions | None = None,
) -> DataFrame:
    """Scrub ``df`` by ``rules`` (list, rule DataFrame or CSV path). Raises
    ``RuleViolationError`` with every problem before any data job runs."""
    o = options or ScrubOptions()
    spark = df.sparkSession
    rule_list = load_rules(rules, spark)
    df = drop_audit(df, o.audit_cols)
    problems = check_rules(df.columns, rule_list, o)
    if problems:
        raise RuleViolationError(problems)
    if isinstance(addresses, str):
        from maskfold.sources.readers import read_addresses

        addresses = read_addresses(spark, addresses)

    batch: dict[str, Column] = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    address_done = False
    streams = df.isStreaming
    for rule in execution_order(rule_list):
        if rule.type == "address":
            if address_done:
                continue
            if batch:
                df, batch = df.withColumns(batch), {}
            df = apply_address(df.drop(POSITION), addresses, o)  # a join can multiply rows
            types = {f.name: f.dataType for f in df.schema.fields}
            address_done = True
            continue
        if rule.type == "numeric" and o.numeric == "sequence" and POSITION not in types and not streams:
            df, batch = with_position(df.withColumns(batch) if batch else df, POSITION), {}
            types = {f.name: f.dataType for f in df.schema.fields}
        if reads_of(rule, o) & batch.keys():
            df, batch = df.withColumns(batch), {}
            types = {f.name: f.dataType for f in df.schema.fields}
        batch[rule.column] = rule_expression(rule, types, o)
    if batch:
        df = df.withColumns(batch)
    return df.drop(POSITION)

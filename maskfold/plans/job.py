"""The whole batch job: read, validate, scrub, write three formats, report."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from maskfold.plans.engine import scrub
from maskfold.plans.options import ScrubOptions
from maskfold.plans.rules import (
    MSG_DATA_FILE,
    MSG_RULE_FILE,
    MSG_SUCCESS,
    RuleViolationError,
    load_rules,
    violations_frame,
)
from maskfold.sources.readers import read_addresses, read_inferred, read_table
from maskfold.sources.sinks import FORMATS, write_outputs


def run_job(
    spark: SparkSession,
    input_path: str,
    rules_path: str,
    output_dir: str,
    address_path: str | None = None,
    options: ScrubOptions | None = None,
    schema=None,
    address_schema=None,
    formats=FORMATS,
    single_file: bool = False,
    codes: str = "number",
):
    """Scrub a ``.txt``/``.csv`` table by a rule file and write ``csv``, ``pipe`` and ``parquet``
    under ``output_dir``. Returns ``(message, report)``: the reference's success message and an
    empty report, or raises ``RuleViolationError`` (its ``violations`` are the report rows) before
    any output is replaced. With both schemas given no file is read to infer types, and codes keep
    their leading zeros. With neither, one pass over both files infers them, and ``codes`` says whether leading zeros
    are kept (``text``) or not (``number``, as the reference's inference does)."""
    try:
        rules = load_rules(rules_path, spark)
    except AnalysisException as e:
        raise FileNotFoundError(MSG_RULE_FILE) from e
    try:
        if schema is None and address_schema is None:
            df, addresses = read_inferred(spark, input_path, address_path or None, codes)
        else:
            df = read_table(spark, input_path, schema=schema)
            addresses = read_addresses(spark, address_path, schema=address_schema) if address_path else None
    except AnalysisException as e:
        raise FileNotFoundError(MSG_DATA_FILE) from e
    out = scrub(df, rules, addresses, options)
    write_outputs(out, output_dir, formats, single_file=single_file)
    return MSG_SUCCESS, violations_frame(spark, [])


__all__ = ["RuleViolationError", "run_job"]

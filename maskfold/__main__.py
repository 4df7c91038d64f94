"""spark-submit entry: ``maskfold INPUT ADDRESS RULES OUTPUT`` (latest form) or
``maskfold --preset v2 INPUT RULES OUTPUT`` (earlier forms, sampled addresses from
``--addresses GLOB``)."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from maskfold.plans.job import run_job
from maskfold.plans.options import PRESETS
from maskfold.plans.rules import RuleViolationError


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="maskfold")
    p.add_argument("paths", nargs="+", help="INPUT [ADDRESS] RULES OUTPUT")
    p.add_argument("--preset", default="latest", choices=sorted(PRESETS))
    p.add_argument("--addresses", help="address table (file, folder or glob)")
    p.add_argument("--schema", help="DDL of the input's columns; without it types are inferred")
    p.add_argument("--address-schema", help="DDL of the address table's columns")
    p.add_argument("--keep-codes", action="store_true", help="inferred columns with leading zeros stay text")
    p.add_argument("--single-file", action="store_true", help="one file per output format")
    a = p.parse_args(argv)
    if len(a.paths) == 4:
        input_path, address, rules, output = a.paths
    elif len(a.paths) == 3:
        input_path, rules, output = a.paths
        address = a.addresses
    else:
        p.error("expected INPUT [ADDRESS] RULES OUTPUT")
    spark = SparkSession.builder.appName("maskfold").getOrCreate()
    try:
        msg, _ = run_job(
            spark, input_path, rules, output, address, PRESETS[a.preset], schema=a.schema,
            address_schema=a.address_schema, single_file=a.single_file, codes="text" if a.keep_codes else "number",
        )
    except RuleViolationError as e:
        for v in e.violations:
            print(f"{v.check}\t{v.column}\t{v.type}\t{v.message}", file=sys.stderr)
        return 2
    except (ValueError, FileNotFoundError) as e:
        print(str(e), file=sys.stderr)
        return 2
    print(msg)
    return 0


if __name__ == "__main__":
    sys.exit(main())

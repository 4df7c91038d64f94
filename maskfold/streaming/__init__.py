"""Streaming: the reference is batch-only, so nothing here adds behaviour.

The column rules are stateless expressions and the keyed address rule is a stream-static join,
so ``scrub`` accepts a streaming DataFrame as it is. Two modes need the whole table at once and
are refused on a stream: the sampled address pairing (global numbering) and the sequence mode of
``numeric`` (ids restart per micro-batch and would repeat).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from maskfold.plans.engine import scrub
from maskfold.plans.options import ScrubOptions
from maskfold.plans.rules import load_rules


def scrub_stream(df: DataFrame, rules, addresses=None, options: ScrubOptions | None = None) -> DataFrame:
    o = options or ScrubOptions()
    if not df.isStreaming:
        raise ValueError("scrub_stream expects a streaming DataFrame; use scrub for batch")
    rule_list = load_rules(rules, df.sparkSession)
    types = {r.type for r in rule_list}
    if "address" in types and o.address == "sample":
        raise ValueError("sampled address replacement needs the whole table; not on a stream")
    if "numeric" in types and o.numeric == "sequence":
        raise ValueError("sequence numbering is not unique across micro-batches")
    return scrub(df, rule_list, addresses, o)

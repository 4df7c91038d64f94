"""Literal tables inside an expression, searched in a few steps per row instead of entry by entry.

``dictionary`` finds the value of a key among any number of keys: the keys are dealt to as many buckets
as there are keys, by a checksum of their text, and only a key's own bucket is looked through.
``place_among`` finds the place of a key among sorted bounds, by a coarse and a fine list.

Tables travel as one JSON text each, which Spark folds into a constant when it plans the query, so
thousands of entries cost one literal and no join.
"""

from __future__ import annotations

import base64
import json
import math
import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def table(value, schema: str) -> Column:
    """A constant of a nested type, from plain Python lists and dictionaries."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {schema}", {"mode": "FAILFAST"})["v"]


def _bucket_text(key) -> str:
    """Text whose checksum deals a key to its bucket; keys that compare equal have the same."""
    if isinstance(key, float):
        key = 0 if math.isnan(key) else max(-(2**63), min(2**63 - 1, math.floor(key))) if math.isfinite(key) else (2**63 - 1 if key > 0 else -(2**63))
    return str(key).lower() if isinstance(key, bool) else str(key)


def dictionary(probe: Column, key_type: str, entries: Sequence[tuple]) -> tuple[Column, Column]:
    """(whether ``probe`` is a key, its value as text). ``key_type``: string, bigint, double or boolean.
    ``entries`` are (key, text, number) with different keys: the value is the text, or the number as Spark prints it, or
    null where both are None. A null probe is no key."""
    size = 1 << max(0, (len(entries) - 1).bit_length())
    buckets: list[dict] = [{"k": [], "t": [], "n": []} for _ in range(size)]
    for key, text, number in entries:
        own = buckets[zlib.crc32(_bucket_text(key).encode()) % size]
        own["k"].append(key)
        own["t"].append(text)
        own["n"].append(number)
    lists = table(buckets, f"array<struct<k:array<{key_type}>,t:array<string>,n:array<double>>>")
    text = F.floor(probe).cast("string") if key_type == "double" else probe.cast("string")
    own = F.get(lists, F.pmod(F.crc32(text.cast("binary")), F.lit(size)).cast("int"))
    at = F.array_position(own["k"], probe)
    value = F.coalesce(F.get(own["t"], (at - 1).cast("int")), F.get(own["n"], (at - 1).cast("int")).cast("string"))
    return F.coalesce(at > 0, F.lit(False)), value


def plain(value):
    """A key as ``table`` reads it: binaries as base64, decimals and local times as text."""
    if isinstance(value, bytes | bytearray):
        return base64.b64encode(value).decode()
    return value if value is None or isinstance(value, bool | int | float | str) else value.isoformat() if hasattr(value, "isoformat") else str(value)


def place_among(key: Column, schema: str, bounds: Sequence[dict]) -> Column:
    """How many of the ascending ``bounds`` are at most ``key``, a struct of the given schema (an int); structs compare
    field by field, by Spark's own order of values, nulls first. About twice the root of the bounds' number are
    looked at."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    groups = [list(bounds[i : i + step]) for i in range(0, len(bounds), step)]
    coarse = table([g[0] for g in groups], f"array<struct<{schema}>>")
    fine = table(groups, f"array<array<struct<{schema}>>>")

    def upto(list_: Column, k: Column) -> Column:
        return F.size(F.filter(list_, lambda b: b <= k))

    def found(k: Column) -> Column:
        place = F.transform(F.array(upto(coarse, k)), lambda g: F.when(g == 0, 0).otherwise((g - 1) * step + upto(F.get(fine, g - 1), k)))
        return F.element_at(place, 1)

    # key and group are bound, so that each is computed once a row
    return F.element_at(F.transform(F.array(key), found), 1)

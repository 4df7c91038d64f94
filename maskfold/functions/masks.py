"""One native Column expression per rule mode.

Every function returns a plain Spark ``Column``: no Python worker, whole-stage codegen intact.
Where one bad row would stop the reference run (null amount, missing regex input, a piece index
out of range, no digits to keep) the expression yields null for that row; ``Masked.resolve`` turns the same
condition into a task failure for callers that want the strict behaviour.
"""

from __future__ import annotations

import random
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold.functions.pytext import (
    FRACTIONAL,
    INTEGRAL,
    falsy,
    is_string,
    python_digits,
)
from maskfold.functions.search import dictionary

# Fixed values of the reference's account-number rewrite: the first ``digits-digits`` match,
# and the amount subtracted from its first group.
ACCOUNT_PATTERN = r"(\d+)-(\d+)"
ACCOUNT_SHIFT = 123
CHOICE_SUFFIX = "123"


class Masked:
    """A rule's output expression plus the condition under which the reference run would fail."""

    __slots__ = ("value", "failure")

    def __init__(self, value: Column, failure: Column | None = None):
        self.value = value
        self.failure = failure

    def resolve(self, on_error: str, message: str) -> Column:
        if on_error == "fail" and self.failure is not None:
            return F.when(self.failure, F.raise_error(F.lit(message))).otherwise(self.value)
        return self.value


def fix(value: str, mode: str = "literal") -> Masked:
    """Constant column. ``comma_to_space``: the comma list joined by one blank (``a,b`` -> ``a b``)."""
    if mode == "comma_to_space":
        value = " ".join(parse_list(value))
    return Masked(F.lit(value).cast("string"))


def parse_list(value: str) -> list[str]:
    return [item.strip() for item in value.split(",")]


def numeric_digits(c: Column, dtype: T.DataType, start: int) -> Masked:
    """Keep the digits of the value's Python text, read them as a double, truncate, add ``start``.

    Null, empty text, zero and ``False`` give null; so does text without digits.
    """
    if isinstance(dtype, INTEGRAL):
        # the digits of an integer are its absolute value; read through a double, as Python does
        number = F.abs(c.cast("double")).try_cast("bigint")
    else:
        number = F.nullif(python_digits(c, dtype), F.lit("")).try_cast("double").try_cast("bigint")
    shifted = F.try_add(number, F.lit(start).cast("bigint"))
    skip = falsy(c, dtype)
    value = F.when(skip, F.lit(None).cast("bigint")).otherwise(shifted)
    return Masked(value, ~skip & shifted.isNull())


def numeric_sequence(start: int, position: Column | None = None) -> Masked:
    """A unique, increasing (not dense) long per row, offset by ``start``; no shuffle. ``position``: a stored number of the
    row, so that the result stays the same when it is computed again; else numbers by partition."""
    place = F.monotonically_increasing_id() if position is None else position
    return Masked(place + F.lit(start).cast("bigint"))


def amount(c: Column, factor: float) -> Masked:
    """Multiply by ``factor``; 32-bit float result. Null (or text that is no number) gives null."""
    value = (c.try_cast("double") * F.lit(float(factor))).cast("float")
    return Masked(value, c.isNull() | value.isNull())


def cross_shift(id_col: Column, dtype: T.DataType, start: int) -> Masked:
    """The row's id plus ``start`` as a long, so a copied foreign key follows a shifted id. Ids of
    another type than integer or boolean give null: the reference's long-typed function does so for
    fractions and fails on text."""
    if not isinstance(dtype, INTEGRAL + (T.BooleanType,)):
        return Masked(F.lit(None).cast("bigint"), F.lit(True))
    value = F.try_add(id_col.cast("bigint"), F.lit(start).cast("bigint"))
    return Masked(value, value.isNull())


def value_text(v) -> str | None:
    """Driver-side text of a non-float mapped value (floats are printed by Spark)."""
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def typed_keys(mapping: Mapping, dtype: T.DataType) -> tuple[str, dict]:
    """Keys that can equal a value of this column type, in the type Spark compares them with."""
    if is_string(dtype):
        return "string", {k: v for k, v in mapping.items() if isinstance(k, str)}
    if isinstance(dtype, INTEGRAL):
        keys = {}
        for k, v in mapping.items():
            if isinstance(k, bool | int) or (isinstance(k, float) and k.is_integer()):
                keys[int(k)] = v
        return "bigint", {k: v for k, v in keys.items() if -(2**63) <= k < 2**63}
    if isinstance(dtype, FRACTIONAL + (T.DecimalType,)):
        return "double", {
            float(k): v for k, v in mapping.items() if isinstance(k, bool | int | float)
        }
    if isinstance(dtype, T.BooleanType):
        return "boolean", {bool(k): v for k, v in mapping.items() if k in (0, 1)}
    return "string", {}


def map_values(c: Column, dtype: T.DataType, mapping: Mapping) -> Masked:
    """Replace by dictionary; unmapped values pass through as text, a key mapped to None gives null.

    Keys match by type as in a Python dict: text keys only text columns, numeric keys only
    numeric columns. The result column is a string. The keys are one literal, in which a value looks at its own
    bucket only, whatever their number.
    """
    key_type, keys = typed_keys(mapping, dtype)
    text = c.cast("string")
    if not keys:
        return Masked(text)
    # doubles are printed by Spark, as literals are
    entries = [(k, None, v) if isinstance(v, float) else (k, value_text(v), None) for k, v in keys.items()]
    hit, value = dictionary(c.cast(key_type), key_type, entries)
    return Masked(F.when(hit, value).otherwise(text))


def choose_constant(items: list[str], suffix: str = CHOICE_SUFFIX, seed: int | None = 42) -> Masked:
    """One item of the list, picked once for the whole column, with ``suffix`` appended."""
    return Masked(F.lit(random.Random(seed).choice(items) + suffix))


def _text(c: Column, dtype: T.DataType) -> Column:
    return c if is_string(dtype) else c.cast("string")


def _stepped(digits: Column, up: bool) -> Column:
    """Text of a run of digits plus or minus one: the last digit that does not carry changes, and
    those behind it turn over. Minus one needs a digit other than zero."""
    turning, turned = ("9", "0") if up else ("0", "9")
    tail = F.length(F.regexp_extract(digits, f"({turning}*)$", 1))
    at = F.length(digits) - tail
    one = F.substring(digits, at, F.lit(1)).cast("int") + (1 if up else -1)
    stepped = F.concat(
        F.substring(digits, F.lit(1), at - 1), one.cast("string"), F.repeat(F.lit(turned), tail)
    )
    return F.when(at > 0, stepped).otherwise(F.concat(F.lit("1"), F.repeat(F.lit("0"), tail)))


def _minus(pre: Column, shift: int) -> Column:
    """Text of ``int(pre) - shift`` for a run of ASCII digits of any length; '' -> null. The last 18
    digits are subtracted as a long, and the digits before them give or take one on text."""
    if abs(shift) >= 10**18:
        raise ValueError("the account shift must have at most 18 digits")
    own = F.regexp_replace(pre, "^0+(?=[0-9])", "")
    n = F.length(own)
    short = (own.cast("bigint") - F.lit(shift).cast("bigint")).cast("string")
    head = F.substring(own, F.lit(1), n - 18)
    low = F.substring(own, n - 17, F.lit(18)).cast("bigint") - F.lit(shift).cast("bigint")
    base = F.lit(10**18).cast("bigint")
    kept = F.when(low < 0, _stepped(head, False)).when(low >= base, _stepped(head, True)).otherwise(head)
    rest = F.when(low < 0, low + base).when(low >= base, low - base).otherwise(low)
    long = F.concat(kept, F.lpad(rest.cast("string"), 18, "0"))
    return (
        F.when(n == 0, F.lit(None).cast("string"))
        .when(n <= 18, short)
        .otherwise(F.regexp_replace(long, "^0+(?=[0-9])", ""))
    )


def _groups(txt: Column, pattern: str) -> tuple[Column, Column]:
    """Both groups of the first match, '' without one. The default pattern's match holds one hyphen, so
    it is searched once and cut there."""
    if pattern == ACCOUNT_PATTERN:
        match = F.regexp_extract(txt, pattern, 0)
        return F.substring_index(match, "-", 1), F.substring_index(match, "-", -1)
    return F.regexp_extract(txt, pattern, 1), F.regexp_extract(txt, pattern, 2)


def regex_reverse(
    c: Column,
    dtype: T.DataType,
    value: str,
    pattern: str = ACCOUNT_PATTERN,
    shift: int = ACCOUNT_SHIFT,
) -> Masked:
    """Account rewrite: first ``(digits)-(digits)`` match; first group minus ``shift``, whose first
    character stays and the rest is reversed; then the rule value, then the second group.

    Text around the match is dropped; no match gives the rule value alone; a first group that is
    not all digits (possible with a custom pattern) is kept as it is. The shared parts are
    unconditional so Spark evaluates each regex group once per row.
    """
    txt = _text(c, dtype)
    pre, post = _groups(txt, pattern)
    d = _minus(pre, shift)
    rewritten = F.concat(F.substring(d, 1, 1), F.reverse(F.substring(d, 2, 2147483647)))
    if pattern == ACCOUNT_PATTERN:
        head = F.coalesce(rewritten, F.when(pre == F.lit(""), F.lit("")))
    else:
        head = F.when(pre.rlike("^[0-9]+$"), rewritten).otherwise(pre)
    out = F.concat(head, F.lit(value), post)
    return Masked(out, c.isNull() | (txt.isNotNull() & out.isNull()))


# Fixed rule, not data: 0, 1, ..., 999 written out one after another; the counting part of the
# earlier account rewrite is a prefix of it (longer runs fall back to an array expression).
_COUNTING = "".join(str(i) for i in range(1000))


def _counting_length(last: Column) -> Column:
    """Characters in ``0 1 ... last`` written out without separators (0 <= last <= 999)."""
    return (
        F.when(last < 10, last + 1)
        .when(last < 100, F.lit(10) + (last - 9) * 2)
        .otherwise(F.lit(190) + (last - 99) * 3)
    )


def regex_index(c: Column, dtype: T.DataType, value: str, pattern: str = ACCOUNT_PATTERN) -> Masked:
    """Earlier account rewrite: first character of the first group, then ``0,1,...,n-2`` written
    out (``5678`` -> ``5012``), then the rule value, then the second group."""
    txt = _text(c, dtype)
    pre, post = _groups(txt, pattern)
    n = F.length(pre)
    counting = (
        F.when(n <= 1, F.lit(""))
        .when(n <= 1001, F.substring(F.lit(_COUNTING), F.lit(1), _counting_length(n - 2)))
        .otherwise(
            F.array_join(F.transform(F.sequence(F.lit(0), n - 2), lambda i: i.cast("string")), "")
        )
    )
    return Masked(F.concat(F.substring(pre, 1, 1), counting, F.lit(value), post))


def piece(src: Column, dtype: T.DataType, delimiter: str, index: int) -> Masked:
    """The ``index``-th (0-based) piece of the source text split by a literal delimiter.

    Out of range, null or non-text source gives null.
    """
    if not is_string(dtype):
        return Masked(F.lit(None).cast("string"), F.lit(True))
    pattern = r"\Q" + delimiter.replace(r"\E", r"\E\\E\Q") + r"\E"
    out = F.get(F.split(src, pattern), F.lit(index))
    return Masked(out, out.isNull())

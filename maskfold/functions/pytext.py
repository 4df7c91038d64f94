"""Digits of the text Python's ``str()`` gives a value, built from native Spark expressions.

The ``numeric`` rule keeps only the digit characters of a value's Python text. Spark prints some
types differently (``1.0E7`` for a double, ``.5`` fractions of timestamps), so each type gets an
expression that yields exactly the digit string Python would print, without a Python worker.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)
STRINGS = (T.StringType, T.CharType, T.VarcharType)


def is_string(dtype: T.DataType) -> bool:
    return isinstance(dtype, STRINGS)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, INTEGRAL + FRACTIONAL + (T.DecimalType,))


def falsy(c: Column, dtype: T.DataType) -> Column:
    """True where Python's ``if x`` would be false: null, empty text, zero, ``False``."""
    if is_string(dtype):
        return c.isNull() | (c == F.lit(""))
    if is_numeric(dtype):
        return c.isNull() | (c == F.lit(0))
    if isinstance(dtype, T.BooleanType):
        return c.isNull() | ~c
    return c.isNull()


def _layout(text: Column) -> Column:
    """Digits of Python's text for a ``%e`` text (bound once through a one-element array)."""
    m = F.regexp_replace(F.translate(F.substring_index(text, "e", 1), ".", ""), "0+$", "")
    e = F.substring_index(text, "e", -1).try_cast("int")
    m_len = F.length(m)
    exp_text = F.abs(e).cast("string")
    exp_text = F.when(F.length(exp_text) < 2, F.concat(F.lit("0"), exp_text)).otherwise(exp_text)
    return (
        F.when((e >= 16) | (e < -4), F.concat(m, exp_text))
        .when(e < 0, F.concat(F.repeat(F.lit("0"), -e), m))
        .when(m_len <= e + 1, F.concat(m, F.repeat(F.lit("0"), e + 1 - m_len), F.lit("0")))
        .otherwise(m)
    )


def _whole_text(x: Column, digits: int) -> Column:
    """``%e`` text of a whole number below 2**63 rounded to so many digits, ties to even: exact, where
    the JVM's formatting starts from an already rounded text."""
    v = x.try_cast("bigint")
    size = F.length(v.cast("string"))
    cut = F.lit(1).cast("bigint")
    for spare in range(1, 20 - digits):
        cut = F.when(size >= digits + spare, F.lit(10**spare).cast("bigint")).otherwise(cut)
    rest = v % cut
    even = F.pmod(F.call_function("div", v, cut), F.lit(2)) == 0
    up = (rest * 2 > cut) | ((rest * 2 == cut) & ~even)
    text = (v - rest + F.when(up, cut).otherwise(F.lit(0).cast("bigint"))).cast("string")
    return F.concat(
        F.substring(text, 1, 1), F.lit("."), F.substring(text, 2, digits - 1), F.lit("e+"),
        F.lpad((F.length(text) - 1).cast("string"), 2, "0"),
    )


def _double_digits(x: Column) -> Column:
    """Digits of ``repr(float)``.

    Python prints the shortest decimal that reads back as the same double. The JVM's text reads back as well, and
    where it has 15 digits at most no other text of so few does, as different decimals of up to 15 digits are
    different doubles: its digits are Python's. For the others, round to 15, 16, then 17
    significant digits (``%.14e`` ... ``%.16e``) and keep the first that parses back equal (15
    digits is exact for any decimal of up to 15 digits). From that text's digits ``m`` and exponent
    ``e`` rebuild Python's layout: plain for -4 <= e < 16 (zeros before, or zeros and ``.0``
    after), else ``m`` and at least two exponent digits (``1e-05``, ``1e+16``). NaN and infinity
    give no digits.

    From 1e16 to 9.2e18 a double is a whole number, whose digits are rounded exactly. Residue: elsewhere
    a 16-17 digit tie that the JVM's own shortest text already rounded can pick the other neighbour, and
    subnormal doubles (below 2.2e-308) can come out longer than Python's.
    """
    ax = F.abs(x)
    java = ax.cast("string")  # the JVM's text: plain from 1e-3 to 1e7, else d.dddEx
    size, last = F.length(java), F.substring(java, -2, 2)
    plain = (ax >= F.lit(1e-3)) & (ax < F.lit(1e7)) & (size <= 16) & ((last == F.lit(".0")) | ~last.endswith("0"))
    short = (F.length(F.substring_index(java, "E", 1)) <= 16) & (ax >= F.lit(sys.float_info.min)) & (size > 0)
    whole = (ax >= F.lit(1e16)) & (ax < F.lit(9.2e18))
    r15, r16, r17 = (
        F.when(whole, _whole_text(ax, p)).otherwise(F.format_string(f"%.{p - 1}e", ax)) for p in (15, 16, 17)
    )
    text = (
        F.when(short & java.contains("E"), F.lower(java))
        .when(r15.try_cast("double") == ax, r15)
        .when(r16.try_cast("double") == ax, r16)
        .otherwise(r17)
    )
    digits = F.when(plain, F.translate(java, ".", "")).otherwise(F.element_at(F.transform(F.array(text), _layout), 1))
    finite = ~F.isnan(x) & (ax != F.lit(float("inf")))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(~finite, F.lit(""))
        .when(ax == F.lit(0.0), F.lit("00"))
        .otherwise(digits)
    )


@functools.cache
def _digit_tables() -> tuple[str, str, str]:
    """Built by rule from the Unicode tables, once: decimal digits of other scripts, which
    Python's float() reads, with their values; and digits that are not decimal (superscripts,
    circled digits), which isdigit() keeps but float() refuses."""
    decimals, others = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if ch.isdecimal():
            decimals.append(ch)
        elif ch.isdigit():
            others.append(ch)
    values = "".join(str(unicodedata.decimal(ch)) for ch in decimals)
    return "".join(decimals), values, "".join(others)


def _text_digits(c: Column) -> Column:
    """Digits Python keeps from a text (``isdigit``), in ASCII, for ``float()``.

    ASCII text (character count equals byte count) takes the plain path. Other text keeps the
    decimal digits of every script, translated to ASCII; a non-decimal digit such as a superscript
    makes ``float()`` fail in Python, so the result is empty (null later).
    """
    decimals, values, non_decimal = _digit_tables()
    ascii_digits = F.regexp_replace(c, "[^0-9]", "")
    other = F.when(c.rlike("[" + non_decimal + "]"), F.lit("")).otherwise(
        F.translate(F.regexp_replace(c, "[^0-9" + decimals + "]", ""), decimals, values)
    )
    return F.when(F.length(c) == F.octet_length(c), ascii_digits).otherwise(other)


def python_digits(c: Column, dtype: T.DataType) -> Column:
    """The digit characters of ``str(x)`` for a value of Spark type ``dtype`` (null stays null)."""
    if is_string(dtype):
        return _text_digits(c)
    if isinstance(dtype, FRACTIONAL):
        return _double_digits(c.cast("double"))
    if isinstance(dtype, INTEGRAL):
        return F.regexp_replace(c.cast("string"), "[^0-9]", "")
    if isinstance(dtype, T.DecimalType):
        # Python prints a decimal below 1e-6 with an exponent (0.00000010 -> 1.0E-7): all digits
        # of the unscaled value, then the exponent's digits; otherwise the plain text
        plain = F.regexp_replace(c.cast("string"), "[^0-9]", "")
        unscaled = F.regexp_replace(plain, "^0+", "")
        adjusted = F.length(unscaled) - 1 - F.lit(dtype.scale)
        return F.when(
            (unscaled != F.lit("")) & (adjusted < -6), F.concat(unscaled, (-adjusted).cast("string"))
        ).otherwise(plain)
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyyMMdd")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # Python prints microseconds as six digits, or not at all when they are zero.
        micros = F.date_format(c, "SSSSSS")
        return F.concat(
            F.date_format(c, "yyyyMMddHHmmss"),
            F.when(micros == F.lit("000000"), F.lit("")).otherwise(micros),
        )
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNotNull(), F.lit(""))  # 'True' / 'False' carry no digits
    return F.regexp_replace(c.cast("string"), "[^0-9]", "")

"""Randomised checks of each rule against a plain-Python model of its semantics."""

import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold.functions import masks

RNG = random.Random(11)
ALPHABET = "0123456789-#. abXZ"


def _texts(n=400):
    out = [None, "", "0", "-", "--", "0-0"]
    for _ in range(n):
        out.append("".join(RNG.choice(ALPHABET) for _ in range(RNG.randint(0, 14))))
    return out


def _run(spark, values, dtype, build):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))
    return [r[0] for r in df.select(build(F.col("x"), dtype).value).collect()]


def _numeric_model(x, start):
    if not x:
        return None
    digits = re.sub(r"[^0-9]", "", x)
    if not digits:
        return None
    v = int(float(digits)) + start
    return v if -(2**63) <= v < 2**63 else None


def _regex_model(x, value):
    if x is None:
        return None
    m = re.search(r"([0-9]+)-([0-9]+)", x)
    if not m:
        return value
    pre, post = m.groups()
    d = str(int(pre) - 123)
    return d[:1] + d[1:][::-1] + value + post


def _index_model(x, value):
    if x is None:
        return None
    m = re.search(r"([0-9]+)-([0-9]+)", x)
    pre, post = m.groups() if m else ("", "")
    return pre[:1] + "".join(str(i) for i in range(len(pre) - 1)) + value + post


def _piece_model(x, delim, i):
    if x is None:
        return None
    parts = x.split(delim)
    return parts[i] if i < len(parts) else None


def test_numeric_text_model(spark):
    vals = _texts()
    got = _run(spark, vals, T.StringType(), lambda c, t: masks.numeric_digits(c, t, 77))
    assert got == [_numeric_model(v, 77) for v in vals]


def test_regex_reverse_model(spark):
    vals = _texts()
    got = _run(spark, vals, T.StringType(), lambda c, t: masks.regex_reverse(c, t, "#"))
    assert got == [_regex_model(v, "#") for v in vals]


def test_regex_index_model(spark):
    vals = _texts()
    got = _run(spark, vals, T.StringType(), lambda c, t: masks.regex_index(c, t, "@"))
    assert got == [_index_model(v, "@") for v in vals]


def test_piece_model(spark):
    vals = _texts()
    for delim, i in ((".", 0), ("-", 2), ("#", 1), (" ", 3)):
        got = _run(spark, vals, T.StringType(), lambda c, t: masks.piece(c, t, delim, i))
        assert got == [_piece_model(v, delim, i) for v in vals], (delim, i)


def test_amount_model(spark):
    import struct

    vals = [None, 0.0, -1.5] + [RNG.uniform(-1e9, 1e9) for _ in range(300)]
    got = _run(spark, vals, T.DoubleType(), lambda c, t: masks.amount(c, 1.1))

    def f32(v):
        return None if v is None else struct.unpack("f", struct.pack("f", v * 1.1))[0]

    assert got == [f32(v) for v in vals]


def test_numeric_integers_arithmetic_equals_text_path(spark):
    from maskfold.functions.pytext import python_digits

    vals = [None, 0, 1, -1, 7, -12, 2**53 + 1, -(2**53) - 3, 2**63 - 1, -(2**63), 10**18]
    vals += [RNG.randint(-(2**63), 2**63 - 1) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    fast = masks.numeric_digits(F.col("x"), T.LongType(), 5).value
    text = F.when(F.col("x").isNull() | (F.col("x") == 0), F.lit(None)).otherwise(
        F.try_add(python_digits(F.col("x"), T.LongType()).try_cast("double").try_cast("bigint"), F.lit(5).cast("bigint"))
    )
    rows = df.select(fast.alias("a"), text.alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    assert [_numeric_model(None if v is None else str(v), 5) if v != 0 else None for v in vals] == [r.a for r in rows]


def test_numeric_text_other_scripts(spark):
    vals = ["A١٢3", "٣", "x²1", "１２", "BA8321", "é7", "①2", None, "", "A\U0001D7CF\U0001D7D03", "\U00010A40"]
    got = _run(spark, vals, T.StringType(), lambda c, t: masks.numeric_digits(c, t, 1))

    def model(x):
        if not x:
            return None
        kept = "".join(filter(str.isdigit, x))
        try:
            return int(float(kept)) + 1
        except ValueError:
            return None

    assert got == [model(v) for v in vals]


def test_regex_index_long_runs(spark):
    vals = ["7" * n + "-" + "3" for n in (1, 2, 10, 11, 100, 101, 1000, 1001, 1002, 1500)]
    got = _run(spark, vals, T.StringType(), lambda c, t: masks.regex_index(c, t, "#"))
    assert got == [_index_model(v, "#") for v in vals]


def test_piece_special_delimiters(spark):
    vals = ["a|b|c", "a\\b", "x$y$", "1*2", "plain", None, "|"]
    for delim, i in (("|", 1), ("\\", 1), ("$", 1), ("*", 0), ("|", 0)):
        got = _run(spark, vals, T.StringType(), lambda c, t: masks.piece(c, t, delim, i))
        assert got == [_piece_model(v, delim, i) for v in vals], (delim, i)

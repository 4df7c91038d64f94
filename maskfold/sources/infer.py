"""Types of delimited files by one aggregation over all files of a run.

Each value has a kind (integer, long integer, larger integer, fraction, date, timestamp, boolean, other); the kinds
of a column are one bit set, joined by OR, so partial results merge in any order; and the set names the column's
type. All tables of a run are looked at by one job.

``codes="text"`` keeps columns with values such as ``02134`` as text, where Spark's own inference
makes 2134 of them; ``codes="number"`` reads them as Spark's does.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold.functions.names import col

INT, LONG, LARGE, FRACTION, DATE, TIMESTAMP, BOOLEAN, OTHER, CODE = (1 << i for i in range(9))
MOST_DIGITS = 38


def _kind(v: Column) -> Column:
    """The kind of a value; null has none."""
    integer = v.rlike(r"^[+-]?[0-9]+$")
    fraction = v.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?$") | v.isin("NaN", "Inf", "-Inf")
    code = F.when(v.rlike(r"^0[0-9]+$"), F.lit(CODE)).otherwise(F.lit(0))
    return (
        F.when(v.isNull(), F.lit(0))
        .when(integer & v.try_cast("int").isNotNull(), F.lit(INT).bitwiseOR(code))
        .when(integer & v.try_cast("bigint").isNotNull(), F.lit(LONG).bitwiseOR(code))
        .when(integer & (F.length(F.regexp_replace(v, "^[+-]?0*", "")) <= MOST_DIGITS), F.lit(LARGE).bitwiseOR(code))
        .when(fraction | integer, F.lit(FRACTION).bitwiseOR(code))
        .when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & v.try_cast("date").isNotNull(), F.lit(DATE))
        .when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T]") & v.try_cast("timestamp").isNotNull(), F.lit(TIMESTAMP))
        .when(F.lower(v).isin("true", "false"), F.lit(BOOLEAN))
        .otherwise(F.lit(OTHER))
    )


def _type(kinds: int, digits: int, codes: str) -> T.DataType:
    """The narrowest type that holds all kinds of a column."""
    coded, kinds = kinds & CODE, kinds & ~CODE
    numbers = INT | LONG | LARGE | FRACTION
    if not kinds or kinds & OTHER or (coded and codes == "text"):
        return T.StringType()
    if not kinds & ~numbers:
        if kinds & FRACTION:
            return T.DoubleType()
        if kinds & LARGE:
            return T.DecimalType(min(MOST_DIGITS, max(1, digits)), 0)
        return T.LongType() if kinds & LONG else T.IntegerType()
    if not kinds & ~(DATE | TIMESTAMP):
        return T.TimestampType() if kinds & TIMESTAMP else T.DateType()
    return T.BooleanType() if kinds == BOOLEAN else T.StringType()


def infer_schemas(
    spark: SparkSession, tables: Mapping[str, tuple[str | list[str], str]], codes: str = "text"
) -> dict[str, T.StructType]:
    """The schema of each table, given as (path or paths, separator), by one job over all of them."""
    if codes not in ("text", "number"):
        raise ValueError(f"unknown treatment of codes {codes!r}; use text or number")
    columns: dict[str, list[str]] = {}
    every: DataFrame | None = None
    for name, (path, sep) in tables.items():
        rows = spark.read.option("header", True).option("sep", sep).csv(path)
        columns[name] = rows.columns
        of = [F.struct(F.coalesce(F.bit_or(_kind(col(c))), F.lit(0)).alias("kinds"), F.coalesce(F.max(F.length(F.regexp_replace(col(c), "^[+-]?0*", ""))), F.lit(0)).alias("digits")) for c in rows.columns]
        stats = rows.agg(F.array(*of).alias("of")).select(F.lit(name).alias("name"), "of")
        every = stats if every is None else every.unionByName(stats)
    if every is None:
        return {}
    return {
        r["name"]: T.StructType([T.StructField(c, _type(s["kinds"], s["digits"], codes)) for c, s in zip(columns[r["name"]], r["of"])])
        for r in every.collect()
    }

"""Readers: the data table (pipe text or comma CSV), the address table and the rule table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from maskfold.plans.rules import MSG_FORMAT, read_rule_table
from maskfold.sources.infer import infer_schemas

__all__ = ["infer_schemas", "read_addresses", "read_inferred", "read_rule_table", "read_table", "shared_dir"]


def separator_of(path: str) -> str:
    """The separator that a path's suffix stands for."""
    if path.endswith(".txt"):
        return "|"
    if path.endswith(".csv"):
        return ","
    raise ValueError(MSG_FORMAT.strip())


def read_inferred(
    spark: SparkSession, path: str, addresses: str | list[str] | None = None, codes: str = "text", sep: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The data table and the address table with types that one pass over both infers. ``codes``: whether columns with
    leading zeros stay ``text`` or become a ``number``, as in Spark's own inference."""
    tables = {"data": (path, sep or separator_of(path))} | ({} if addresses is None else {"addresses": (addresses, ",")})
    schemas = infer_schemas(spark, tables, codes)
    data = read_table(spark, path, schema=schemas["data"], sep=tables["data"][1])
    return data, None if addresses is None else read_addresses(spark, addresses, schema=schemas["addresses"])


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    infer_schema: bool = True,
    sampling_ratio: float | None = None,
    sep: str | None = None,
) -> DataFrame:
    """``*.txt`` -> pipe-delimited with header; ``*.csv`` -> comma-delimited with header; anything
    else is refused before a job runs. Pass ``schema`` at scale: inference is an extra full pass
    and turns ZIP ``02134`` into 2134 (``read_inferred`` keeps it, and looks at all tables of a run in one pass). ``path``
    may be a directory or a glob ending in the suffix; an explicit ``sep`` skips the suffix check."""
    sep = sep or separator_of(path)
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
        if sampling_ratio:
            reader = reader.option("samplingRatio", sampling_ratio)
    return reader.csv(path)


def read_addresses(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    infer_schema: bool = True,
) -> DataFrame:
    """Address table: one CSV, a directory, or a glob such as ``addresses_*.csv`` (one table)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts: ``spark.checkpoint.dir`` from the session."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # a remote session has no SparkContext: the conf is the only source
            d = None
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return d.rstrip("/")

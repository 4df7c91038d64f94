"""A position for each row: unique, increasing in input order, and the same whenever the frame is planned or run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskfold.functions.names import col
from maskfold.operators.index import materialised

_FILE, _ROW, _RANK = "__mf_file", "__mf_row", "__mf_rank"
#: Rows of a file have the low bits, so a file may hold 2^40 rows and a table 2^23 files.
ROW_BITS = 40
#: Plan nodes that neither make nor join rows, so that a file's row numbers stay unique above them.
_PLAIN = {"Project", "Filter", "SubqueryAlias", "View"}


def _reads_rows_of_parquet(df: DataFrame) -> bool:
    """Whether each row of ``df`` is a row of a Parquet file, of which Spark knows the number."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in _PLAIN:
        node = node.children().head()
    return node.getClass().getSimpleName() == "LogicalRelation" and "parquet" in node.toString().lower()


def with_position(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: the row's number in its file (from 0), behind the number of the file by name. Rows that do
    not come straight from Parquet files, whose readers number them, are stored first."""
    src = df if _reads_rows_of_parquet(df) else materialised(df)
    found = src.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
    files = found.select(_FILE).distinct()  # reads no column of the data
    names = [r[0] for r in files.limit(2).collect()]
    if len(names) < 2:
        return found.withColumn(name, F.col(_ROW)).drop(_FILE, _ROW)
    ranks = materialised(files.select(_FILE, (F.row_number().over(Window.orderBy(_FILE)) - 1).cast("bigint").alias(_RANK)))
    placed = found.join(ranks, _FILE)  # the planner broadcasts the ranks where they are small
    return placed.select(*[col(c) for c in df.columns], (F.shiftleft(F.col(_RANK), ROW_BITS) + F.col(_ROW)).alias(name))

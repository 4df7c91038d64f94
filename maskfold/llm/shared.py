"""The folder that driver and executors share, lineage cuts, and reading the documents."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, as in tests, a temporary folder
    is set, but only on a local master: on a cluster executors would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """``path``, a folder that goes when the application ends, as no result may hang on it any longer."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store now."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and reread from reliable storage; for narrow frames. Spark removes the
    files when the frame is no longer used (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and reread: columnar, compressed, and of
    a size that the planner knows, so that it broadcasts the table only below its own threshold. The
    table lasts as long as the application."""
    spark = df.sparkSession
    path = removed_at_exit(spark, f"{shared_folder(spark)}/table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster sizes to its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

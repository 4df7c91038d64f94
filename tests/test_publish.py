"""Outputs of a run appear together or not at all; one text file written by many tasks."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from maskfold import read_manifest, write_outputs
from maskfold.sources import sinks


def _seen(spark, base):
    return {f: spark.read.option("header", True).option("sep", "|" if f == "pipe" else ",").format("parquet" if f == "parquet" else "csv").load(f"{base}/{f}").count() for f in ("csv", "pipe", "parquet")}


def _shown(base):
    return sorted(n for n in os.listdir(base) if not n.startswith("."))


def test_a_failed_run_leaves_the_earlier_output(spark, tmp_out, monkeypatch):
    df = spark.range(10).withColumn("s", F.lit("a"))
    write_outputs(df, tmp_out)
    manifest = read_manifest(spark, tmp_out)
    plain = sinks.write_one

    def fails(src, fmt, path, *a, **k):
        if fmt == "pipe":
            raise OSError("disk full")
        return plain(src, fmt, path, *a, **k)

    monkeypatch.setattr(sinks, "write_one", fails)
    with pytest.raises(OSError, match="disk full"):
        write_outputs(df.limit(3), tmp_out)
    assert _seen(spark, tmp_out) == {"csv": 10, "pipe": 10, "parquet": 10}
    assert read_manifest(spark, tmp_out) == manifest and _shown(tmp_out) == ["_manifest.json", "csv", "parquet", "pipe"]


def test_a_run_that_fails_while_it_publishes_puts_the_earlier_output_back(spark, tmp_out, monkeypatch):
    df = spark.range(10)
    write_outputs(df, tmp_out)
    plain, calls = sinks.Store.rename, []

    def fails(self, old, new):
        calls.append(new)
        if len(calls) == 5:  # three set aside, one placed
            raise OSError("no rename")
        return plain(self, old, new)

    monkeypatch.setattr(sinks.Store, "rename", fails)
    with pytest.raises(OSError, match="no rename"):
        write_outputs(df.limit(3), tmp_out)
    assert _seen(spark, tmp_out) == {"csv": 10, "pipe": 10, "parquet": 10}
    assert _shown(tmp_out) == ["_manifest.json", "csv", "parquet", "pipe"]


def test_an_output_can_be_rewritten_from_itself(spark, tmp_out):
    write_outputs(spark.range(10), tmp_out)
    write_outputs(spark.read.parquet(f"{tmp_out}/parquet").where("id < 4"), tmp_out, ["parquet", "csv"])
    assert spark.read.parquet(f"{tmp_out}/parquet").count() == 4
    assert read_manifest(spark, tmp_out)["formats"] == ["parquet", "csv"]
    assert _shown(tmp_out) == ["_manifest.json", "csv", "parquet"]


def test_error_mode_refuses_and_keeps(spark, tmp_out):
    write_outputs(spark.range(5), f"{tmp_out}/o", mode="error")
    with pytest.raises(FileExistsError):
        write_outputs(spark.range(2), f"{tmp_out}/o", mode="error")
    assert spark.read.parquet(f"{tmp_out}/o/parquet").count() == 5
    assert read_manifest(spark, f"{tmp_out}/none") is None


def test_one_text_file_of_many_tasks(spark, tmp_out):
    """All tasks write, the header stands once, rows keep the order of the partitions."""
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartitionByRange(6, "o_orderkey").sortWithinPartitions("o_orderkey")
    wide = df.withColumn('we"ird, name', F.lit('q"uote, and\nbreak'))
    tasks = df.rdd.getNumPartitions()
    write_outputs(wide, tmp_out, ["csv", "pipe"], single_file=True)
    assert tasks == 6
    for fmt, sep in (("csv", ","), ("pipe", "|")):
        (name,) = glob.glob(f"{tmp_out}/{fmt}/part-*")
        got = spark.read.option("header", True).option("sep", sep).option("multiLine", True).option("escape", "\\").csv(name)
        assert got.columns == wide.columns
        assert [int(r[0]) for r in got.select("o_orderkey").collect()] == [r[0] for r in df.select("o_orderkey").orderBy("o_orderkey").collect()]
    assert _shown(tmp_out) == ["_manifest.json", "csv", "pipe"]


def test_one_text_file_of_no_rows_has_its_header(spark, tmp_out):
    write_outputs(spark.createDataFrame([], "a int, b string"), tmp_out, single_file=True)
    (name,) = glob.glob(f"{tmp_out}/csv/part-*")
    assert open(name).read() == "a,b\n"


def test_one_parquet_file_of_many_tasks(spark, tmp_out, monkeypatch):
    """All tasks write row groups of the one file; none is handed all rows."""
    df = spark.range(1000, numPartitions=5).select("id", F.concat(F.lit("n"), "id").alias("s"), (F.col("id") / 2).alias("a"))
    monkeypatch.setattr(type(df), "repartition", lambda *a: pytest.fail("all rows go to one task"))
    write_outputs(df, tmp_out, single_file=True)
    (name,) = glob.glob(f"{tmp_out}/parquet/part-*")
    assert name.endswith(".snappy.parquet") and os.path.exists(f"{tmp_out}/parquet/_SUCCESS")
    back = spark.read.parquet(f"{tmp_out}/parquet")
    assert back.dtypes == df.dtypes and [r.id for r in back.collect()] == list(range(1000))
    assert back.where("id = 700").select("s", "a").collect() == [("n700", 350.0)]
    assert pq.ParquetFile(name).num_row_groups == 5
    assert _seen(spark, tmp_out) == {"csv": 1000, "pipe": 1000, "parquet": 1000}
    assert _shown(tmp_out) == ["_manifest.json", "csv", "parquet", "pipe"]


def test_one_parquet_file_by_mode(spark, tmp_out):
    path, df = f"{tmp_out}/p", spark.range(7, numPartitions=3)
    write = lambda rows, mode: sinks.write_one(rows, "parquet", path, single_file=True, mode=mode)
    write(df.where("id < 0"), "error")
    assert spark.read.parquet(path).dtypes == df.dtypes and spark.read.parquet(path).count() == 0
    with pytest.raises(FileExistsError):
        write(df, "error")
    write(df, "overwrite")
    write(df, "ignore")
    assert len(glob.glob(f"{path}/part-*")) == 1 and spark.read.parquet(path).count() == 7
    write(df, "append")
    assert len(glob.glob(f"{path}/part-*")) == 2 and spark.read.parquet(path).count() == 14
    assert _shown(tmp_out) == ["p"]

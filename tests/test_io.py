"""Readers and writers: suffix dispatch, globs, three formats, overwrite."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from maskfold import Rule, read_table, scrub, write_outputs
from maskfold.sources import read_addresses, shared_dir
from maskfold.sources.sinks import write_one


def test_read_table_dispatch(spark, tmp_out):
    with open(f"{tmp_out}/a.txt", "w") as f:
        f.write("ZIP|N\n02134|1\n")
    with open(f"{tmp_out}/a.csv", "w") as f:
        f.write("ZIP,N\n02134,1\n")
    assert read_table(spark, f"{tmp_out}/a.txt").collect()[0].N == 1
    assert read_table(spark, f"{tmp_out}/a.csv", infer_schema=False).collect()[0].ZIP == "02134"
    with pytest.raises(ValueError, match="txt or .csv"):
        read_table(spark, f"{tmp_out}/a.json")


def test_write_outputs_three_formats_and_overwrite(spark, tmp_out):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    write_outputs(df, tmp_out, ["parquet"])
    out = scrub(df, [Rule("o_orderstatus", "fix", "X")])
    paths = write_outputs(out, tmp_out)
    assert set(paths) == {"csv", "pipe", "parquet"}
    back = spark.read.parquet(paths["parquet"])
    assert back.count() == df.count()
    assert back.select(F.countDistinct("o_orderstatus")).collect()[0][0] == 1
    csv = read_table(spark, paths["csv"] + "/*.csv", schema=back.schema)
    assert sorted(map(tuple, csv.collect())) == sorted(map(tuple, back.collect()))
    pipe = spark.read.text(paths["pipe"]).first()[0]
    assert "|" in pipe


def test_single_file_output(spark, tmp_out):
    import glob

    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    write_outputs(df, tmp_out, ["csv", "pipe"], single_file=True)
    assert len(glob.glob(f"{tmp_out}/csv/part-*")) == 1
    assert len(glob.glob(f"{tmp_out}/pipe/part-*")) == 1


def test_address_glob(spark, tmp_out):
    a = spark.createDataFrame([("1", "Main", "Boston", "MA", "02134")], "NUMBER string, STREET string, CITY string, REGION string, POSTCODE string")
    write_one(a, "csv", f"{tmp_out}/addresses_ma.csv")
    write_one(a.withColumn("REGION", F.lit("TX")), "csv", f"{tmp_out}/addresses_tx.csv")
    both = read_addresses(spark, f"{tmp_out}/addresses_*.csv", infer_schema=False)
    assert sorted(r.REGION for r in both.collect()) == ["MA", "TX"]


def test_shared_dir(spark):
    assert shared_dir(spark)


def test_unknown_output_format_refused_before_writing(spark, tmp_out):
    import os

    df = spark.range(3)
    with pytest.raises(ValueError, match="unknown output format"):
        write_outputs(df, f"{tmp_out}/o", ["csv", "json"])
    assert not os.path.exists(f"{tmp_out}/o")

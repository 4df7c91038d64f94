"""Results that must not depend on caches, on other jobs, on key types or on digit counts."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold import Rule, ScrubOptions, scrub, write_outputs
from maskfold.functions import masks, python_digits
from maskfold.operators import dense_index, map_values_join

from conftest import SF_SMALL


def _is_dense(df, n):
    r = df.agg(F.count("*").alias("n"), F.countDistinct("row_index").alias("d"), F.min("row_index").alias("lo"), F.max("row_index").alias("hi")).first()
    return tuple(r) == (n, n, 1, n)


def test_two_indexed_frames_survive_writes_and_cleared_caches(spark, tmp_out):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    n = li.count()
    one = dense_index(li, ["l_shipdate", "l_orderkey", "l_linenumber"], num_partitions=7)
    two = dense_index(li.repartition(5), ["l_quantity"], num_partitions=3)
    assert _is_dense(one, n) and _is_dense(two, n)
    write_outputs(one, f"{tmp_out}/one", ["parquet", "csv"])
    spark.catalog.clearCache()
    assert _is_dense(one, n) and _is_dense(two, n)
    assert _is_dense(one.select("l_comment" if "l_comment" in one.columns else "l_quantity", "row_index"), n)


def test_sampled_addresses_survive_another_job(spark, tmp_out):
    import __spark_entry__ as E

    out = E._library_queries()["address_sampled"](spark, SF_SMALL)
    first = sorted(map(str, out.collect()))
    write_outputs(dense_index(spark.range(50), ["id"]), f"{tmp_out}/other", ["csv", "pipe"])
    spark.catalog.clearCache()
    assert sorted(map(str, out.collect())) == first


def test_account_subtraction_has_no_digit_limit(spark):
    rng = random.Random(2)
    numbers = ["0", "007", "123", "122", "1" + "0" * 18, "1" + "0" * 60, "9" * 50, "0" * 30 + "5"]
    numbers += ["".join(rng.choice("0019") for _ in range(rng.randint(1, 70))) for _ in range(600)]
    df = spark.createDataFrame([(x,) for x in numbers], "x string")
    for shift in (123, 0, 10**17 + 7, -123):
        got = [r[0] for r in df.select(masks._minus(F.col("x"), shift)).collect()]
        assert got == [str(int(x) - shift) for x in numbers]


def test_ids_of_different_types_join_without_error(spark):
    address = spark.createDataFrame([(1, "1", "S", "U", "C1", "NY", "P"), (3, "3", "S", "U", "C3", "TX", "P")], "ASST_ID long, NUMBER string, STREET string, UNIT string, CITY string, REGION string, POSTCODE string")
    schema = "ASST_ID string, CITY string, STAT string, ZIP string, PRPTY_ADDR_LN1 string, PRPTY_ADDR_LN2 string, STAT_CD_DESC string"
    data = spark.createDataFrame([(i, "c", "s", "z", "a", "b", "d") for i in ("1", "A7", None, "03", "")], schema)
    rule = [Rule("PRPTY_ADDR_LN1", "address", "x")]
    got = scrub(data, rule, address).select("ASST_ID", "CITY").collect()
    assert sorted(map(tuple, got)) == [("03", "C3"), ("1", "C1")]
    assert scrub(data, rule, address, ScrubOptions(address_how="left")).count() == 5
    turned = scrub(data.withColumn("ASST_ID", F.lit(3).cast("long")).limit(1), rule, address.withColumn("ASST_ID", F.when(F.col("ASST_ID") == 3, "3").otherwise("bad")))
    assert turned.first()["CITY"] == "C3"


def test_mapping_keys_of_another_type(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n long")
    mapping = spark.createDataFrame([("1", "one"), ("B2", "bad"), (None, "null")], "key string, value string")
    assert [r[0] for r in map_values_join(df, "n", mapping).collect()] == ["one", "2", None]


def test_cross_takes_integer_ids_only(spark):
    for dtype, value, want in ((T.LongType(), 12, 17), (T.DoubleType(), 12.7, None), (T.StringType(), "12", None), (T.BooleanType(), True, 6)):
        df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype)]))
        assert df.select(masks.cross_shift(F.col("x"), dtype, 5).value).first()[0] == want


def test_unknown_option_values_are_refused():
    for bad in ({"regex": "indx"}, {"on_error": "Fail"}, {"address": "sampled"}, {"address_how": "outer"}):
        with pytest.raises(ValueError, match="unknown"):
            ScrubOptions(**bad)


def test_outputs_hold_one_run(spark, tmp_out):
    df = spark.createDataFrame([(1, "a")], "n long, s string")
    write_outputs(df, f"{tmp_out}/out")
    write_outputs(df.union(df), f"{tmp_out}/out", ["parquet"])
    assert spark.read.parquet(f"{tmp_out}/out/parquet").count() == 2
    import os

    assert sorted(n for n in os.listdir(f"{tmp_out}/out") if n[0] not in "._") == ["parquet"]
    for mode in ("append", "ignore"):
        with pytest.raises(ValueError, match="mode"):
            write_outputs(df, f"{tmp_out}/out", mode=mode)


def test_digits_of_doubles_of_all_sizes(spark):
    rng = random.Random(5)
    values = [round(rng.uniform(-1e5, 1e5), rng.randrange(6)) for _ in range(30_000)] + [float(i) for i in range(-50, 2000)]
    values += [rng.choice([1, -1]) * float(f"{rng.randrange(1, 10**rng.randrange(1, 16))}e{rng.randrange(-300, 290)}") for _ in range(30_000)]
    values += [2e-3, 1e-3, 9.99e-4, 1e7, 9999999.0, 1e22, 1e23, 2e23, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 0.1 + 0.2, 1 / 3, 100.0, 1e-5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(python_digits(F.col("x"), T.DoubleType())).collect()]
    wrong = [(v, g) for v, g in zip(values, got) if g != re.sub("[^0-9]", "", str(v)) and abs(v) >= 2.3e-308]
    assert not wrong, (len(wrong), wrong[:3])


def test_digits_of_large_doubles(spark):
    rng = random.Random(12)
    values = [rng.uniform(1e16, 9.1e18) for _ in range(40_000)] + [10.0 ** rng.uniform(16, 18.95) for _ in range(60_000)]
    values += [1e16, 2.0**60, 2.0**62, 9007199254740993e3, 7.122122167963988e17, -1.2345678901234567e18, 9.999999999999999e17]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(python_digits(F.col("x"), T.DoubleType())).collect()]
    wrong = [(v, g) for v, g in zip(values, got) if g != re.sub("[^0-9]", "", str(v))]
    assert not wrong, (len(wrong), wrong[:3])

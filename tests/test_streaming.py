"""Column rules and the keyed address join run unchanged on a stream."""

import pytest

from conftest import SF_SMALL
from maskfold import Rule, ScrubOptions, preset
from maskfold.streaming import scrub_stream


def test_stream_scrub_matches_batch(spark, tmp_out):
    import shutil

    src = f"{tmp_out}/in"
    shutil.copytree(f"{SF_SMALL}/orders.parquet", src) if __import__("os").path.isdir(
        f"{SF_SMALL}/orders.parquet"
    ) else (__import__("os").makedirs(src), shutil.copy(f"{SF_SMALL}/orders.parquet", src))
    batch = spark.read.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    rules = [Rule("o_totalprice", "amount", "2"), Rule("o_orderpriority", "single", "o_orderpriority-1")]
    q = (
        scrub_stream(stream, rules)
        .writeStream.format("memory")
        .queryName("scrubbed")
        .option("checkpointLocation", f"{tmp_out}/ckpt")
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("SELECT * FROM scrubbed")
    from maskfold import scrub

    want = scrub(batch, rules)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stream_refuses_global_modes(spark):
    stream = spark.readStream.schema("ASST_DIM_ID long, A string").parquet(f"{SF_SMALL}/orders.parquet")
    with pytest.raises(ValueError):
        scrub_stream(stream, [Rule("A", "address", "")], options=ScrubOptions(address="sample"))
    with pytest.raises(ValueError):
        scrub_stream(stream, [Rule("A", "numeric", "1")], options=preset("v2"))


def test_stream_keyed_address_join(spark, tmp_out):
    import os
    import shutil

    import __spark_entry__ as E
    from maskfold import scrub

    src = f"{tmp_out}/orders"
    os.makedirs(src)
    shutil.copy(f"{SF_SMALL}/orders.parquet", src)
    rules = [Rule("PRPTY_ADDR_LN1", "address", "x"), Rule("LOAN_NUM", "numeric", "1")]
    addr = E.address_map(spark, SF_SMALL)

    def assets(orders):
        return orders.selectExpr(
            "o_custkey AS ASST_ID", "o_orderkey AS ASST_DIM_ID", "concat('BA', o_orderkey) AS LOAN_NUM",
            "'x' AS CITY", "'x' AS STAT", "'x' AS ZIP", "'x' AS PRPTY_ADDR_LN1", "'x' AS PRPTY_ADDR_LN2",
        )

    batch = spark.read.parquet(src)
    stream = assets(spark.readStream.schema(batch.schema).parquet(src))
    q = (
        scrub_stream(stream, rules, addr)
        .writeStream.format("memory")
        .queryName("scrubbed_addr")
        .option("checkpointLocation", f"{tmp_out}/ckpt2")
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("SELECT * FROM scrubbed_addr")
    want = scrub(assets(batch), rules, addr)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

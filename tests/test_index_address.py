"""Dense index, exact sample and address replacement: properties from the survey's test plan."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from maskfold import Rule, ScrubOptions, preset, scrub
from maskfold.operators import dense_index, prepare_addresses, sample_exact


def test_dense_index_equals_row_number(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    keys = ["o_orderdate", "o_orderkey"]
    got = dense_index(df, keys, "i").select("o_orderkey", "i").collect()
    want = df.select("o_orderkey", F.row_number().over(Window.orderBy(*keys)).alias("i")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_dense_index_ignores_partition_count(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    a = dense_index(df, ["o_orderkey"], "i", num_partitions=3).select("o_orderkey", "i").collect()
    b = dense_index(df.repartition(7), ["o_orderkey"], "i", num_partitions=11).select("o_orderkey", "i").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_sample_exact_size_seed_and_partitioning(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct()
    a = sample_exact(df, 100, seed=1)
    b = sample_exact(df.repartition(5), 100, seed=1, num_partitions=9)
    c = sample_exact(df, 100, seed=2)
    ra, rb, rc = (sorted(map(tuple, x.collect())) for x in (a, b, c))
    assert len(ra) == 100 and ra == rb and ra != rc
    assert len(set(ra)) == 100
    assert sample_exact(df, df.count()).count() == df.count()
    with pytest.raises(ValueError, match="fewer rows"):
        sample_exact(df, 10**9)


def test_prepare_addresses_filters_none_and_null(spark):
    pool = spark.createDataFrame(
        [
            ("1", "Main", "7", "Boston", "MA", "02134", 1.0),
            ("2", "None", "7", "Boston", "MA", "02134", 1.0),
            ("3", "Elm", None, "Boston", "MA", "02134", 1.0),
            ("4", "Oak", "8", None, "MA", "02134", 1.0),
            ("5", "Pine", "9", "Austin", "None", "73301", 1.0),
            ("1", "Main", "7", "Boston", "MA", "02134", 1.0),
        ],
        "NUMBER string, STREET string, UNIT string, CITY string, REGION string, POSTCODE string, LON double",
    )
    latest = prepare_addresses(pool).collect()
    assert sorted(r.ADDR_LN_1 for r in latest) == ["1 Main", "1 Main", "3 Elm"]
    assert {r.ADDR_LN_2 for r in latest} == {" "}
    old = prepare_addresses(pool, preset("v2")).collect()
    assert [(r.ADDR_LN_1, r.ADDR_LN_2, r.POSTCODE) for r in old] == [("1 Main", "UNIT 7", "02134")]
    assert "LON" not in prepare_addresses(pool).columns


def test_keyed_inner_drops_and_multiplies(spark):
    data = spark.createDataFrame(
        [(1, "a", "x", "x", "x", "x", "x"), (2, "b", "x", "x", "x", "x", "x"), (3, "c", "x", "x", "x", "x", "x")],
        "ASST_ID long, NAME string, CITY string, STAT string, ZIP string, PRPTY_ADDR_LN1 string, PRPTY_ADDR_LN2 string",
    )
    addr = spark.createDataFrame(
        [(1, "10", "Main", "Boston", "MA", "02134"), (1, "11", "Main", "Salem", "MA", "01970"),
         (2, "12", "Elm", "Austin", "TX", "73301")],
        "ASST_ID long, NUMBER string, STREET string, CITY string, REGION string, POSTCODE string",
    )
    rules = [Rule("PRPTY_ADDR_LN1", "address", "")]
    out = scrub(data, rules, addr)
    assert out.columns[0] == "ASST_ID" and out.columns[-1] == "STAT_CD_DESC"
    rows = sorted((r.ASST_ID, r.CITY, r.STAT_CD_DESC) for r in out.collect())
    assert rows == [(1, "Boston", "Massachusetts"), (1, "Salem", "Massachusetts"), (2, "Austin", "Texas")]
    left = scrub(data, rules, addr, ScrubOptions(address_how="left"))
    assert sorted((r.ASST_ID, r.CITY) for r in left.collect())[-1] == (3, None)
    # the shuffle path (no broadcast) gives the same rows
    big = scrub(data, rules, addr, ScrubOptions())
    assert sorted(map(tuple, big.collect())) == sorted(map(tuple, out.collect()))


def test_sampled_keeps_rows_no_address_twice_and_is_stable(spark):
    data = E.asset_suppliers(spark, SF_SMALL)
    pool = E.address_pool(spark, SF_SMALL)
    rules = [Rule("PRPTY_ADDR_LN1", "address", "x")]
    a = scrub(data, rules, pool, preset("v2")).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        b = scrub(data.repartition(3), rules, pool, preset("v2")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(a) == data.count()
    addrs = [(r.CITY, r.STAT, r.ZIP, r.PRPTY_ADDR_LN1, r.PRPTY_ADDR_LN2) for r in a]
    assert len(set(addrs)) == len(addrs)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    # addresses run in city order along the data order
    cities = [r.CITY for r in sorted(a, key=lambda r: r.ASST_DIM_ID)]
    assert cities == sorted(cities)


def test_sampled_pool_too_small_fails(spark):
    data = spark.range(5).withColumnRenamed("id", "ASST_DIM_ID").withColumn("PRPTY_ADDR_LN1", F.lit("x"))
    pool = spark.createDataFrame(
        [("1", "Main", "Boston", "MA", "02134")], "NUMBER string, STREET string, CITY string, REGION string, POSTCODE string"
    )
    with pytest.raises(ValueError, match="address pool"):
        scrub(data, [Rule("PRPTY_ADDR_LN1", "address", "")], pool, ScrubOptions(address="sample"))


def test_dense_index_spreads_copies(spark, monkeypatch):
    from maskfold.operators import index

    monkeypatch.setattr(index, "BLOCK", 100)
    """A third of the rows are copies of one row: they still spread over several range
    partitions (ordered by input position), and the index stays exactly 1..n."""
    base = spark.range(2000).select((F.col("id") % 97).alias("k"), F.col("id").cast("string").alias("v"))
    copies = spark.range(1000).select(F.lit(5).cast("bigint").alias("k"), F.lit("same").alias("v"))
    df = base.unionByName(copies).repartition(4)
    out = dense_index(df, ["k", "v"], "i", num_partitions=6)
    idx = sorted(r.i for r in out.select("i").collect())
    assert idx == list(range(1, 3001))
    per_part = out.filter(F.col("v") == "same").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_part) > 1 and max(r["count"] for r in per_part) < 1000


def test_address_report_matches_joins(spark):
    from maskfold.operators import address_report

    o = ScrubOptions()
    data = E.asset_orders(spark, SF_SMALL)
    addr = E.address_map(spark, SF_SMALL)
    r = address_report(data, prepare_addresses(addr, o, key=o.id_col), o).collect()[0]
    rules = [Rule("PRPTY_ADDR_LN1", "address", "x")]
    inner = scrub(data, rules, addr).count()
    left = scrub(data, rules, addr, ScrubOptions(address_how="left")).count()
    assert r.output_rows == inner and r.output_rows + r.unmatched_rows == left
    assert r.data_rows == data.count() and r.extra_rows > 0 and r.unmatched_rows > 0


def test_address_table_missing_columns_is_refused(spark):
    data = spark.createDataFrame([(1, "x")], "ASST_ID long, PRPTY_ADDR_LN1 string")
    addr = spark.createDataFrame([(1, "Main")], "ASST_ID long, STREET string")
    with pytest.raises(ValueError, match="lacks column"):
        scrub(data, [Rule("PRPTY_ADDR_LN1", "address", "")], addr)


def test_earliest_preset_end_to_end(spark):
    data = E.asset_suppliers(spark, SF_SMALL).withColumn("SEG", F.lit("orig")).withColumn("NOTE", F.lit("n"))
    rules = [
        Rule("s_nationkey", "numeric", "999"),  # value ignored: the earliest form always starts at 5
        Rule("SEG", "multiple", "a, b"),
        Rule("NOTE", "fix", "x, y"),
        Rule("PRPTY_ADDR_LN1", "address", ""),
    ]
    out = scrub(data, rules, E.address_pool(spark, SF_SMALL), preset("v1")).collect()
    assert len(out) == data.count()
    ids = [r.s_nationkey for r in out]
    assert len(set(ids)) == len(ids) and min(ids) >= 5
    assert len({r.SEG for r in out}) == 1 and out[0].SEG in {"a123", "b123"}
    assert {r.NOTE for r in out} == {"x y"}
    assert all(r.PRPTY_ADDR_LN2.startswith("UNIT ") for r in out)


def test_dense_index_counted_total(spark):
    from maskfold.operators import dense_index_counted

    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out, n = dense_index_counted(df, ["o_orderkey"], "i")
    assert n == df.count() == out.count()
    assert out.agg(F.max("i")).collect()[0][0] == n

"""Dense index, exact sample and positions: skew, odd keys, copies, and results that stay the same."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from maskfold import Rule, preset, scrub
from maskfold.operators import dense_index, sample_exact, total_order
from maskfold.operators import index as ix
from maskfold.operators.index import dense_index_counted, row_hash, sample_key


def _check(df, keys, **how):
    """Numbers 1..n, ascending with the keys as Spark orders them."""
    out, n = dense_index_counted(df, keys, "i", **how)
    assert out.columns == [*[c for c in df.columns if c != "i"], "i"]
    rows = out.select("i", F.dense_rank().over(Window.orderBy(*keys)).alias("k")).orderBy("i").collect()
    assert n == len(rows) and [r["i"] for r in rows] == list(range(1, n + 1))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)
    cols = [ix.col(c) for c in df.columns if c != "i"]
    assert Counter(map(str, out.select(*cols).collect())) == Counter(map(str, df.select(*cols).collect()))


def test_a_third_of_all_rows_share_a_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 7).alias("v"))
    _check(df, ["k"], num_partitions=40)
    moved = dense_index(df, ["k"], "i", num_partitions=40)
    # the hot key is spread over ranges
    keys = [F.col("k"), F.shiftrightunsigned(row_hash(df), 1)]
    bounds, heavy = ix._bounds(df, keys, 40, 30_000, hashed=True)
    sizes = [r["count"] for r in df.groupBy(ix._range_of(df, keys, bounds).alias("r")).count().collect()]
    assert not heavy and max(sizes) < 3 * 30_000 / 40
    assert moved.agg(F.max("i")).first()[0] == 30_000


def test_a_mass_of_equal_rows_is_counted_and_made_again(spark, monkeypatch):
    monkeypatch.setattr(ix, "BLOCK", 1000)
    df = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("k"), F.lit(1.5).alias("v"))
    _check(df, ["k"], num_partitions=20)
    _check(df, total_order(df, ["k"]), num_partitions=20)
    out = dense_index(df, ["k"], "i", num_partitions=20)
    same = out.where("k = 'same'").agg(F.min("i"), F.max("i"), F.countDistinct("i")).first()
    assert same[2] == 4000 and same[1] - same[0] == 3999
    assert "Generate explode" in out._jdf.queryExecution().optimizedPlan().toString()


def test_odd_keys(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, float("nan"), float("inf"), -0.0, 0.0, rng.uniform(-5, 5)]), rng.choice([None, "", "ä", "b", "B" * 50]), rng.choice([None, b"", b"\xff", b"a"]), rng.choice([True, False, None]), i) for i in range(800)]
    df = spark.createDataFrame(rows, "d double, s string, b binary, f boolean, `a.b c` long")
    df = df.withColumn("t", F.timestamp_seconds(F.col("`a.b c`") * 1000 - 10**9)).withColumn("dt", F.to_date("t")).withColumn("x", F.col("`a.b c`").cast("decimal(20,3)"))
    df = df.withColumn("ntz", F.expr("timestamp_ntz'2020-02-28 23:59:59.999998'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("`a.b c`") % 50 / 10**6).cast("decimal(18,6)")))
    for keys in (["ntz", "s"], ["d"], ["s", "d"], ["b"], ["f", "a.b c"], ["t"], ["dt", "s"], ["x"], ["a.b c"]):
        _check(df, [ix.col(k) for k in keys], num_partitions=9)
    far = df.withColumn("dt", F.expr("date_add(date'9999-12-31', cast(`a.b c` as int))"))  # beyond Python's dates
    assert dense_index(far, ["dt"], "i", num_partitions=9).where("i = `a.b c` + 1").count() == 800
    nested = df.select(F.struct("s", "d").alias("k"), F.array(F.col("`a.b c`")).alias("a"), F.create_map(F.lit("k"), F.col("s")).alias("m"))
    got = dense_index(nested, ["a"], "i").select(F.col("a")[0].alias("a"), "i").collect()
    assert all(r["i"] == r["a"] + 1 for r in got)
    assert dense_index(df.limit(0), ["d"], "i").count() == 0
    assert dense_index(df.limit(1), ["d"], "i").first()["i"] == 1
    assert sorted(r["d"] for r in dense_index(spark.range(5), [-F.col("id")], "d").collect()) == [1, 2, 3, 4, 5]


def test_maps_are_part_of_a_row(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), F.col("id") % 7).alias("m"))
    assert df.select(row_hash(df)).distinct().count() == 7
    out = dense_index(df, ["k"], "i", num_partitions=5)
    assert sorted(r["i"] for r in out.collect()) == list(range(1, 301))


def test_an_input_that_changes_is_stored_first(spark):
    df = spark.range(5000).withColumn("r", F.rand())
    out = dense_index(df, ["r"], "i", num_partitions=16)
    rows = out.orderBy("i").collect()
    assert [r["i"] for r in rows] == list(range(1, 5001)) and [r["r"] for r in rows] == sorted(r["r"] for r in rows)
    assert out.orderBy("i").collect() == rows


def _brute(rows, n, seed):
    import hashlib

    keyed = sorted((hashlib.md5("|".join([str(seed), *["" if v is None else str(v) for v in r]]).encode()).hexdigest(), str(r)) for r in rows)
    return [h for h, _ in keyed[:n]]


def test_sample_with_copies_and_ties(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(4), rng.choice(["a", "b", None, ""])) for _ in range(3000)] + [(9, "hot")] * 2000
    df = spark.createDataFrame(rows, "n long, s string").repartition(7)
    for n in (0, 1, 17, 1000, 2500, 4999, 5000):
        got = sample_exact(df, n, seed=4)
        keys = [r[0] for r in got.select(sample_key(4, ["n", "s"])).collect()]
        assert sorted(keys) == _brute(rows, n, 4)
        assert not Counter(map(tuple, got.collect())) - Counter(rows)
    with pytest.raises(ValueError, match="fewer rows"):
        sample_exact(df, 5001)
    with pytest.raises(ValueError, match="fewer rows"):
        sample_exact(df.limit(0), 1)


def test_sample_by_some_columns_is_the_same_under_any_partitioning(spark):
    df = spark.range(4000).select((F.col("id") % 40).alias("g"), "id")
    a, b = (sorted(map(tuple, sample_exact(x, 1234, ["g"], seed=2).collect())) for x in (df, df.repartition(11)))
    assert a == b and len(a) == 1234


def test_sampled_addresses_with_repeated_data_rows(spark):
    """Equal rows each get an address of their own, whatever their number."""
    data = spark.range(900).select((F.col("id") % 3).alias("ASST_DIM_ID"), *[F.lit("x").alias(c) for c in ("CITY", "STAT", "ZIP", "PRPTY_ADDR_LN1", "PRPTY_ADDR_LN2")])
    pool = spark.range(2000).select(F.col("id").cast("string").alias("NUMBER"), F.lit("S").alias("STREET"), F.lit("1").alias("UNIT"), F.format_string("C%05d", F.col("id")).alias("CITY"), F.lit("NY").alias("REGION"), F.lit("00001").alias("POSTCODE"))
    out = scrub(data, [Rule("CITY", "address", "")], pool, preset("v2")).collect()
    assert len(out) == 900 and len({r["CITY"] for r in out}) == 900
    by_id = [[r["CITY"] for r in out if r["ASST_DIM_ID"] == k] for k in range(3)]
    assert max(by_id[0]) < min(by_id[1]) and max(by_id[1]) < min(by_id[2])
    assert scrub(data.limit(0), [Rule("CITY", "address", "")], pool, preset("v2")).count() == 0


def _ids(df, column):
    return sorted(tuple(r) for r in df.collect())


def test_sequence_ids_last(spark, tmp_out):
    """The same ids however the files are split, and after the frame is planned again; text input is stored first."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity").repartition(5)
    li.write.parquet(f"{tmp_out}/many")
    li.write.option("header", True).csv(f"{tmp_out}/text")
    rule = [Rule("l_quantity", "numeric", "100")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for df in (spark.read.parquet(f"{tmp_out}/many"), spark.read.schema(li.schema).option("header", True).csv(f"{tmp_out}/text")):
        out = scrub(df, rule, options=preset("v2"))
        assert out.columns == df.columns
        try:
            first = _ids(out, "l_quantity")
            spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
            assert _ids(out, "l_quantity") == first
            assert _ids(out.where("l_linenumber = 1"), "l_quantity") == [r for r in first if r[1] == 1]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        ids = [r[2] for r in first]
        assert len(set(ids)) == len(ids) == df.count() and min(ids) == 100
    # rows that a join multiplied are numbered one by one
    twice = spark.read.parquet(f"{tmp_out}/many").join(spark.createDataFrame([(1,), (1,)], "l_linenumber int"), "l_linenumber")
    got = scrub(twice, rule, options=preset("v2")).select("l_quantity")
    assert got.distinct().count() == twice.count()

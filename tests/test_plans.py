"""Plan shape: native expressions only, no full table in one task, pruning and pushdown."""

import __spark_entry__ as E
from conftest import SF_SMALL
from maskfold import Rule, scrub


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_python_and_no_single_partition(spark):
    plan = _plan(E.scrub_full(spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SinglePartition" not in plan


def test_address_side_broadcast_when_small(spark):
    plan = _plan(E.scrub_full(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_column_rules_prune_and_push_down(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = scrub(df, [Rule("o_totalprice", "amount", "2")]).where("o_orderkey < 100").select("o_totalprice")
    plan = _plan(out)
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,100)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_rules_fold_into_one_projection(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = scrub(
        df,
        [Rule("o_totalprice", "amount", "2"), Rule("o_orderstatus", "fix", "X"),
         Rule("o_orderpriority", "single", "o_orderpriority-1")],
    )
    optimized = out._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Project") == 1


def _exchanges(df) -> list[str]:
    return [line for line in _plan(df).splitlines() if "Exchange" in line and "BroadcastExchange" not in line]


def test_sampled_mode_moves_the_wide_rows_once(spark):
    out = E._library_queries()["address_sampled"](spark, SF_SMALL)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "ExistingRDD" not in plan
    # of all exchanges one is above the scan of the suppliers with their columns
    wide = [line for line, below in zip(plan.splitlines(), plan.splitlines()[1:]) if "Exchange" in line and "s_acctbal" in below]
    assert len(wide) == 1


def test_dense_index_moves_rows_once_and_writes_none(spark):
    from maskfold.operators import dense_index

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    out = dense_index(li, ["l_shipdate", "l_orderkey", "l_linenumber"])
    assert len(_exchanges(out)) == 1 and "ExistingRDD" not in _plan(out) and "SinglePartition" not in _plan(out)
    assert "from_json" not in out._jdf.queryExecution().optimizedPlan().toString()
    # the narrow passes read the keys only
    from maskfold.operators import index

    keys = li.withColumn("r", index._range_of(li, [li["l_orderkey"]], [(3,), (10**4,)])).groupBy("r").count()
    assert "ReadSchema: struct<l_orderkey:bigint>" in _plan(keys)


def test_sample_is_a_filter_by_the_last_key(spark):
    from maskfold.operators import sample_exact

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    assert not _exchanges(sample_exact(li, 500)) and "ExistingRDD" not in _plan(sample_exact(li, 500))


def test_keyed_join_plans_no_job_and_no_single_partition(spark):
    df = E._library_queries()["address_keyed"](spark, SF_SMALL)
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_in_shuffle_join(spark):
    """One asset id holds a third of the rows; beyond the broadcast bound the join shuffles and
    AQE splits the hot partition across tasks (no single task gets the hot key's rows)."""
    from pyspark.sql import functions as F

    from maskfold import ScrubOptions

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sf = "/root/testdata/sf0.01"
        data = E.asset_orders(spark, sf).repartition(16)
        hot = F.when(F.col("ASST_DIM_ID") % 3 == 0, F.lit(7)).otherwise(F.col("ASST_ID"))
        data = data.withColumn("ASST_ID", hot)
        rules = [Rule("PRPTY_ADDR_LN1", "address", "x")]
        out = scrub(data, rules, E.address_map(spark, sf), ScrubOptions())
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        small = scrub(data, rules, E.address_map(spark, sf))
        assert sorted(map(tuple, rows)) == sorted(map(tuple, small.collect()))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_bench_row_udf_baseline_computes_the_same_rows(spark):
    """The bench's row-UDF baseline is the same work as the native flagship."""
    import bench

    a = E.scrub_full(spark, SF_SMALL)
    b = bench._udf_full(spark, SF_SMALL)
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = str
    assert sorted(map(tuple, a.select(*cols).collect()), key=key) == sorted(
        map(tuple, b.select(*cols).collect()), key=key
    )
    plan = _plan(b)
    assert "BatchEvalPython" in plan or "ArrowEvalPython" in plan


def test_no_registered_query_runs_python(spark):
    """Every registered query plans without a Python evaluation node (all rules are native)."""

    for name, fn in E._library_queries().items():
        plan = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_flagship_runs_in_one_codegen_stage(spark):
    df = E.scrub_full(spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Final Plan ==")[1]
    ops = [line.strip(" :+-") for line in final.splitlines() if "Project" in line or "BroadcastHashJoin" in line]
    # the data side (address projection, broadcast join, rule projection, input projection) is one
    # stage; the address side's own scans below the broadcast exchange are separate stages
    data_side = ops[:4]
    assert all(op.startswith("*(") for op in data_side)
    assert len({op.split(")")[0] for op in data_side}) == 1

import duckdb

from maskfold.llm import sharding

from .helpers import SF, documents, empty, odd_rows


def test_shards_against_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for limit in (sharding.SHARD_BYTES, 60_000, 4_000):
        got = {(r["doc_id"], r["shard"], r["shard_bytes"]) for r in sharding.sharded(docs, limit).select("doc_id", "shard", "shard_bytes").collect()}
        sql = sharding._sql(limit).replace("FROM documents", f"FROM '{SF}/documents.parquet'")
        assert got == {(i, s, n) for i, _, s, n in duckdb.sql(f"SELECT doc_id, bytes, shard, shard_bytes FROM ({sql})").fetchall()}


def test_limit_holds_and_prefixes_part_the_rows(spark):
    rows = [(i, "x" * (i % 50)) for i in range(500)] + [(7, "y" * 40)] * 200 + [(None, None)] * 3
    got = sharding.sharded(documents(spark, rows), 1000).collect()
    assert len(got) == len(rows)
    size: dict = {}
    for r in got:
        size.setdefault(r["shard"], []).append(len(r["text"] or ""))
    for shard, sizes in size.items():
        assert sum(sizes) <= 1000 or len(sizes) == 1
        assert not any(other != shard and other.startswith(shard) for other in size)
    assert all(r["shard_bytes"] == sum(size[r["shard"]]) for r in got)


def test_odd_rows(spark):
    docs = documents(spark, odd_rows()).withColumnRenamed("label", "shard")
    out = sharding.sharded(docs, 100_000)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "shard_bytes"]
    assert out.count() == len(odd_rows())
    assert sharding.sharded(empty(docs), 100).count() == 0


def test_write_shards(spark, tmp_out):
    sharding.write_shards(documents(spark, [(i, "z" * 20) for i in range(100)]), f"{tmp_out}/shards", 500)
    assert spark.read.parquet(f"{tmp_out}/shards").count() == 100


def test_query_splits(spark):
    """The registered limit gives shards of several depths on a small table; every row has one."""
    from maskfold.llm.queries import QUERIES

    got = QUERIES["op7_sharding"](spark, "/root/testdata/sf0.01").collect()
    shards = {r["shard"] for r in got}
    assert len(shards) >= 20 and len({len(s) for s in shards}) >= 3 and None not in shards


def test_copies_of_one_id_are_split_the_same_way_in_every_pass(spark):
    """A third of all rows are copies of one id; the input's partitions differ from pass to pass."""
    rows = [(7, "y" * 40)] * 300 + [(i, "x" * 30) for i in range(600)]
    docs = documents(spark, rows).repartition(5)
    out = sharding.sharded(docs, 1000)
    first, again = (sorted((r["doc_id"], r["shard"], r["shard_bytes"]) for r in out.collect()) for _ in range(2))
    assert first == again and len(first) == 900 and all(s is not None and (b <= 1000) for _, s, b in first)
    hot = [s for i, s, _ in first if i == 7]
    assert len(set(hot)) >= 12 and len({s[:60] for s in hot}) == 1


def _against_sql(docs, limit, folder):
    docs.write.parquet(folder)
    got = sorted(sharding.sharded(docs, limit).select("doc_id", "shard", "shard_bytes").collect())
    sql = sharding._sql(limit).replace("FROM documents", f"FROM '{folder}/*.parquet'")
    assert [tuple(r) for r in got] == sorted(duckdb.sql(f"SELECT doc_id, shard, shard_bytes FROM ({sql})").fetchall())
    return got


def test_broadcasts_hold_few_rows(spark, monkeypatch, tmp_out):
    """No join is planned to broadcast a side whose rows were multiplied after the files that the planner goes by, nor one of
    more rows than the bound; the shards are the same."""
    plans, written = [], sharding.written

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df)

    docs = documents(spark, [(i, "x" * (i * i % 41)) for i in range(3000)])
    monkeypatch.setattr(sharding, "written", seen)
    monkeypatch.setattr(sharding, "BROADCAST_ROWS", 300, raising=False)
    got = _against_sql(docs, 150, f"{tmp_out}/docs")
    assert len({r["shard"] for r in got}) > 300
    assert plans and not any("Generate" in p and "BroadcastExchange" in p for p in plans)
    assert "Broadcast" not in sharding.sharded(docs, 150)._jdf.queryExecution().executedPlan().toString()


def test_levels_of_several_steps(spark, monkeypatch, tmp_out):
    """Many levels of few bits, later rounds for uneven sizes, single rows beyond the limit and rows of no bytes."""
    monkeypatch.setattr(sharding, "STEP", 2)
    rows = [(i, None if i % 7 == 0 else "x" * (5000 if i % 90 == 1 else i % 9)) for i in range(800)]
    got = _against_sql(documents(spark, rows), 40, f"{tmp_out}/docs")
    assert len({len(r["shard"]) for r in got}) >= 6

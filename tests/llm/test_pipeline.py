from pyspark.sql import functions as F

import corpus_pipeline
from maskfold.llm.queries import QUERIES
from maskfold.llm.shared import written

from .helpers import SF, documents, empty, odd_rows, shingles


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, at = docs.columns, {"input": docs}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, SF))
        at[name] = docs
        assert docs.columns[: len(columns)] == columns and (len(docs.columns) == len(columns) or k == 4)
    ids = {name: {r["doc_id"] for r in d.collect()} for name, d in at.items()}
    toxic = {r["doc_id"] for r in QUERIES["op8_toxicity"](spark, SF).where("toxic").collect()}
    assert ids["toxicity"] == ids["input"] - toxic
    rows = [(r["doc_id"], shingles(r["text"])) for r in at["toxicity"].collect()]
    up = {i: i for i, _ in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, a) in enumerate(rows):
        for j, b in rows[:x]:
            n = len(a & b)
            if n and 100 * n >= 75 * (len(a) + len(b) - n):
                lo, hi = sorted((top(i), top(j)))
                up[hi] = lo
    assert ids["near_duplicates"] == {i for i in up if top(i) == i}
    leaked = {r["doc_id"] for r in QUERIES["op4_decontaminate"](spark, SF).collect()}
    assert ids["decontamination"] == ids["near_duplicates"] - leaked
    assert ids["mixing"] <= ids["decontamination"]
    assert at["mixing"].groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert at["sharding"].count() == at["mixing"].count()
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, at["sharding"].collect()))


def test_odd_documents(spark):
    docs, at = documents(spark, odd_rows()), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF))
        at[name] = sorted((str(r["doc_id"]) for r in docs.select("doc_id").collect()))
    every = sorted(str(i) for i, _ in odd_rows())
    assert at["toxicity"] == every
    # 6 is a copy of 5, one of the two rows of 7 stays, and the null row is no near copy of it
    assert at["near_duplicates"] == at["decontamination"] == sorted(["1", "2", "3", "4", "5", "7", "8", "None"])
    assert set(at["mixing"]) <= set(at["decontamination"]) and max(map(at["mixing"].count, at["mixing"])) <= 3
    assert at["sharding"] == at["mixing"] and docs.where("shard IS NULL").count() == 0


def test_empty_documents(spark):
    docs = empty(documents(spark, odd_rows()))
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF))
    assert docs.count() == 0

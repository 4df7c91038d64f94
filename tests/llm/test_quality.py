import numpy as np
from pyspark.sql import functions as F

from maskfold.llm import quality
from maskfold.llm.queries import QUERIES

from .helpers import SF, documents, empty, odd_rows


def test_query_on_labels(spark):
    got = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").collect()
    assert np.mean([got[r["doc_id"]]["keep"] == bool(r["quality"]) for r in labels]) >= 0.9


def test_exchange_of_labels_helps():
    """With few labels and a large pool both views get better by the exchange, in nearly every draw."""

    def draw(rng, k):
        y = rng.integers(0, 2, k)
        return y, [rng.normal(y[:, None] * 2.0, 1, (k, 3)) for _ in range(2)]

    gains, after = [], []
    for seed in range(12):
        rng = np.random.default_rng(seed)
        y, views = draw(rng, 12)
        _, pool = draw(rng, 600)
        truth, fresh = draw(rng, 3000)

        def right(fits):
            return np.mean([np.mean((quality.logit(x, w) > 0) == truth) for x, w in zip(fresh, fits)])

        alone = right([quality.fit_logistic(x, y) for x in views])
        after.append(right(quality.co_train(tuple(views), y, tuple(pool))))
        gains.append(after[-1] - alone)
    assert np.mean(gains) > 0.015 and np.mean(np.array(gains) > 0) >= 0.9 and np.mean(after) > 0.94


def test_labels_kept_from_the_fit(spark):
    """Scores of labelled documents whose labels the model never saw."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    unseen = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3)) == 0
    model = quality.fit(docs, labels.where(~unseen))
    got = {r["doc_id"]: r["quality"] for r in quality.score(docs, model).collect()}
    rest = [(got[r["doc_id"]], r["quality"]) for r in labels.where(unseen).collect()]
    good, bad = ([s for s, y in rest if y == k] for k in (1, 0))
    assert len(good) > 60 and len(bad) > 8
    # a good document scores above a bad one
    assert np.mean([g > b for g in good for b in bad]) >= 0.9
    assert np.mean([(s >= quality.KEEP) == bool(y) for s, y in rest]) >= 0.88


def test_odd_rows(spark):
    docs = documents(spark, odd_rows() + [(50, "good text here, with words."), (51, "a | b | c | d")]).withColumnRenamed("label", "keep")
    labels = spark.createDataFrame([(50, 1, 0), (51, 0, 0), (50, 0, 0), (None, 1, 1), (4, None, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    assert quality.score(docs, model).count() == docs.count()
    bare = quality.fit(docs, empty(labels))
    assert {r["keep"] for r in quality.score(docs, bare).collect()} == {True}
    assert quality.score(empty(docs), model).count() == 0
    nulls = spark.createDataFrame([(1, None, None, None, None)], "doc_id long, text string, source string, lang string, n_chars long")
    assert 0 <= quality.score(nulls, model).collect()[0]["quality"] <= 1

import random

import numpy as np
from pyspark.sql import functions as F

from maskfold.llm import toxicity as tox
from maskfold.llm.queries import QUERIES

from .helpers import SF, documents, empty, odd_rows

MEAN = ["grobnik", "snarfel", "vextor"]


def _labelled(spark, n=400, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 12)):
                own.insert(rng.randrange(len(own)), rng.choice(MEAN))
        rows.append((i, " ".join(own)))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_unlabelled_documents_are_told_apart(spark):
    docs, labels = _labelled(spark)
    out = {r["doc_id"]: r for r in tox.score(docs, tox.fit(docs, labels)).collect()}
    wrong = [i for i, r in out.items() if r["toxic"] != (i % 4 == 0)]
    assert len(out) == 400 and len(wrong) <= 4
    assert all(0 <= r["severity"] <= tox.GRADES for r in out.values())
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    density = {i: np.mean([w in MEAN for w in t.split()]) for i, t in text.items()}
    toxic = sorted((i for i in out if i % 4 == 0), key=density.get)
    # more mean words, more severe
    assert np.mean([out[i]["severity"] for i in toxic[-25:]]) > np.mean([out[i]["severity"] for i in toxic[:25]])


def test_thresholds_ascend_and_weights_are_shared():
    rng = np.random.default_rng(3)
    value = rng.random(600)
    grade = np.digitize(value + rng.normal(0, 0.05, 600), [0.4, 0.6, 0.8])
    x = tox._Sparse(np.arange(600), np.zeros(600, np.int64), value, 600, 1)
    w, t = tox.fit_ordinal(x, grade)
    assert w[0] > 0 and (np.diff(t) > 0).all()


def _loss(x, grade, w, t):
    z = x.dot(w)[:, None] - t[None, :]
    above = grade[:, None] > np.arange(tox.GRADES)[None, :]
    return np.mean(np.sum(np.logaddexp(0, -np.where(above, z, -z)), axis=1))


def test_ordinal_fit_against_a_plain_solver():
    """The same optimum as projected gradient steps with halving, written out."""
    rng = np.random.default_rng(1)
    n, f = 300, 4
    v = rng.random((n, f))
    grade = np.digitize(v @ np.array([4.0, 2.0, 0.0, 1.0]) + rng.logistic(0, 0.7, n), [2.5, 3.8, 5])
    row, feature = np.nonzero(np.ones((n, f)))
    x = tox._Sparse(row, feature, v[row, feature], n, f)
    w, t, step = np.zeros(f), np.arange(3.0), 1.0
    for _ in range(3000):
        gw, gt = np.zeros(f), np.zeros(3)
        for k in range(3):
            error = 1 / (1 + np.exp(t[k] - v @ w)) - (grade > k)
            gw += v.T @ error / n
            gt[k] = -error.sum() / n
        while _loss(x, grade, np.maximum(w - step * gw, 0), t - step * gt) > _loss(x, grade, w, t) and step > 1e-9:
            step /= 2
        w, t, step = np.maximum(w - step * gw, 0), t - step * gt, step * 1.5
    got_w, got_t = tox.fit_ordinal(x, grade, steps=5000)
    assert _loss(x, grade, got_w, got_t) <= _loss(x, grade, w, t) + 1e-5
    assert np.abs(got_w - w).max() < 0.05 and np.abs(got_t - t).max() < 0.05 and (np.diff(got_t) > 0).all()


def test_screen_against_plain_counts(spark):
    """Features by their documents among toxic and other ones, counted one by one."""
    docs, labels = _labelled(spark, 160)
    y = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    df: dict = {}
    for r in docs.collect():
        if r["doc_id"] in y:
            words = r["text"].lower().split()
            for f in {w for w in words} | {(k, w[:k]) for w in words for k in tox.PREFIXES if len(w) > k}:
                df.setdefault(f, [0, 0])[y[r["doc_id"]]] += 1
    n = [sum(v == k for v in y.values()) for k in (0, 1)]
    want = {f for f, (a, b) in df.items() if a + b >= tox.LEAST_DOCS and (b + 0.5) / n[1] >= tox.SCREEN * (a + 0.5) / n[0]}
    rows = docs.join(labels.withColumnRenamed("toxic", "y"), "doc_id").selectExpr("text", "y", "false held")
    counted = rows.mapInArrow(tox._count, "y int, held boolean, words binary, times binary")
    assert len(tox.screened(counted, n[1], n[0])) == len(want) > 3
    assert set(MEAN) <= want


def test_toxic_documents_are_caught(spark):
    """Toxic labelled documents whose labels the model never saw, and clean ones."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null")
    unseen = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3)) == 0
    rest = docs.join(labels.where(unseen).select("doc_id", F.col("toxic").alias("y")), "doc_id")
    got = tox.score(rest, tox.fit(docs, labels.where(~unseen))).select("y", "toxic").collect()
    caught, wrong = ([r["toxic"] for r in got if r["y"] == k] for k in (1, 0))
    assert len(caught) > 100 and np.mean(caught) >= 0.75 and np.mean(wrong) <= 0.01


def test_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic is not null").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    clean = [r for r in labels if not r["toxic"]]
    assert np.mean([got[r["doc_id"]]["toxic"] for r in clean]) < 0.05


def test_odd_rows(spark):
    docs, labels = _labelled(spark, 120)
    odd = documents(spark, odd_rows()).withColumnRenamed("label", "toxic")
    model = tox.fit(docs, labels)
    out = tox.score(odd, model).collect()
    assert len(out) == len(odd_rows()) and not any(r["toxic"] for r in out)
    assert tox.clean(odd, empty(labels)).columns == odd.columns
    assert tox.clean(odd, empty(labels)).count() == len(odd_rows())
    assert tox.score(empty(odd), model).count() == 0
    repeated = labels.union(labels).union(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema))
    assert len(tox.fit(docs, repeated).words) == len(model.words)

"""Toxicity by cumulative-link ordinal regression (dealt operator 8).

Features of a text are its words (runs of letters, A-Z in lower case) and the words' first four and five bytes,
which inflected forms share, told by 64-bit hashes, so no two share a weight, with log(1 + count). P(grade > k) = sigmoid(w x - t_k) for ordered thresholds t_1 < t_2 < t_3: all grades share
the weights, none of them negative. A soft threshold chooses the words that the labels support, among those
more frequent in toxic documents. The result is the expected
grade, from 0 (clean) to 3 (severe), and a document is toxic where P(grade > 0) is at least the cut that
separates the held-back labelled documents best.

Labels only say toxic or not. The grade of a toxic labelled document is the third in which the density of its
evident words lies among the toxic ones, 1 where it has none; evident words are those that are many
times as frequent in toxic documents as in others. Documents are counted by feature on Spark, and only features that pass a
screen of their shares among toxic and other documents reach the driver.

The model is fitted on a sample of about ``ROWS`` labelled documents, a documented bound; every document is scored,
in one pass without a shuffle. Rules for odd input: null or empty text, and text without letters, scores as
clean; without labels of both kinds nothing is toxic; ids with several labels count as toxic if one
says so; repeated rows score alike; further columns are ignored, or kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold.llm import tokens
from maskfold.llm.learn import held_back, one_label, sampled, sigmoid, with_sample
from maskfold.llm.shared import written

ROWS = 6_000
GRADES = 3
LEAST_DOCS = 4  # a word's documents in the sample
EVIDENT = 12.0  # times as frequent in toxic documents
STEPS = 200
SPARSE = 0.15  # soft threshold, over the root of the sample's size
SCREEN = 8.0  # least ratio of a feature's shares among toxic and other documents
PREFIXES = (4, 5)
_BUCKETS = 1 << 20
_U = np.uint64


@dataclass
class Model:
    words: np.ndarray  # sorted hashes of the features with a weight
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float  # least P(grade > 0) of a toxic document

    def __post_init__(self):
        self.maybe = np.zeros(_BUCKETS, bool)
        self.maybe[(self.words & _U(_BUCKETS - 1)).astype(np.int64)] = True

    def score(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """P(grade > k) by document and k, of the documents' features."""
        docs = len(bounds) - 1
        eta = np.zeros(docs)
        hits = np.flatnonzero(self.maybe[(hashes & _U(_BUCKETS - 1)).astype(np.int64)])
        if len(hits) and len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes[hits]), len(self.words) - 1)
            known = self.words[at] == hashes[hits]
            doc = np.searchsorted(bounds, hits[known], "right") - 1
            pair, times = np.unique(doc * len(self.words) + at[known], return_counts=True)
            np.add.at(eta, pair // len(self.words), self.weights[pair % len(self.words)] * np.log1p(times))
        return sigmoid(eta[:, None] - self.thresholds[None, :])


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all features in the order of the documents, with repeats, and the documents' bounds."""
    hashes, starts, ends, bounds = tokens.word_spans(data, off, tokens.NOT_LETTER)
    every, owner = [hashes], [np.repeat(np.arange(len(off) - 1), np.diff(bounds))]
    for k in PREFIXES:
        long = ends - starts > k
        every.append(tokens.prefix_hashes(data, starts[long], k))
        owner.append(owner[0][long])
    doc = np.concatenate(owner)
    order = np.argsort(doc, kind="stable")
    return np.concatenate(every)[order], np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(off) - 1))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each text and their counts."""
    for batch in batches:
        words, times = [], []
        for _, _, data, off in tokens.pieces(batch.column(batch.schema.get_field_index("text"))):
            hashes, bounds = features(data, off)
            for a, b in zip(bounds[:-1], bounds[1:]):
                h, n = np.unique(hashes[a:b], return_counts=True)
                words.append(h.tobytes())
                times.append(n.astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("y")), batch.column(batch.schema.get_field_index("held")), pa.array(words, pa.binary()), pa.array(times, pa.binary())], names=["y", "held", "words", "times"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other documents by feature, of a batch."""
    for batch in batches:
        words = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("words")]
        if not words:
            continue
        toxic = np.repeat(batch.column("y").to_numpy() > 0, [len(w) for w in words])
        names, at = np.unique(np.concatenate(words), return_inverse=True)
        df1, df0 = (np.bincount(at, weights=w, minlength=len(names)).astype(np.int64) for w in (toxic, ~toxic))
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(df1), pa.array(df0)], names=["word", "df1", "df0"])


def screened(counted: DataFrame, toxic: int, others: int) -> np.ndarray:
    """Sorted hashes of the features of enough documents whose share of the toxic ones is large against that of the others.
    Documents are counted by feature on Spark; only these features reach the driver."""
    by_word = counted.select("y", "words").mapInArrow(_frequencies, "word long, df1 long, df0 long")
    by_word = by_word.groupBy("word").agg(F.sum("df1").alias("df1"), F.sum("df0").alias("df0"))
    odds = (F.col("df1") + 0.5) / F.lit(float(toxic)) / ((F.col("df0") + 0.5) / F.lit(float(others)))
    rows = by_word.where((F.col("df1") + F.col("df0") >= LEAST_DOCS) & (odds >= SCREEN)).select("word").toArrow()
    return np.sort(rows.column(0).to_numpy().astype(np.int64).view(np.uint64))


def _known(names):
    """Task: the features among ``names`` of each document, by their place there, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = names.value
        for batch in batches:
            places, times = [], []
            for w, n in zip(batch.column("words"), batch.column("times")):
                w, n = np.frombuffer(w.as_buffer(), np.uint64), np.frombuffer(n.as_buffer(), np.uint32)
                at = np.minimum(np.searchsorted(wanted, w), len(wanted) - 1)
                hit = wanted[at] == w
                places.append(at[hit].astype(np.int32).tobytes())
                times.append(n[hit].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("held"), pa.array(places, pa.binary()), pa.array(times, pa.binary())], names=["y", "held", "places", "times"])

    return run


class _Sparse:
    """Rows of (feature, value) pairs, with products by features and by rows."""

    def __init__(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int, features: int):
        self.row, self.feature, self.value, self.rows, self.features = row, feature, value, rows, features

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.feature], self.rows)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, self.value * g[self.row], self.features)


def fit_ordinal(x: _Sparse, grade: np.ndarray, steps: int = STEPS, sparse: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by proximal gradient steps with adaptive rates (numpy)."""
    above = (grade[:, None] > np.arange(GRADES)[None, :]).astype(float)
    share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    first = -np.log(share / (1 - share))
    # thresholds as a start and positive gaps, so that they stay in order
    raw = np.concatenate(([first[0]], np.log(np.maximum(np.diff(first), 1e-2))))
    w, seen_w, seen_t = np.zeros(x.features), np.full(x.features, 1e-10), np.full(GRADES, 1e-10)
    for _ in range(steps):
        t = np.concatenate(([raw[0]], raw[0] + np.cumsum(np.exp(raw[1:]))))
        error = (sigmoid(x.dot(w)[:, None] - t[None, :]) - above) / len(grade)
        g = x.back(error.sum(axis=1))
        gt = -error.sum(axis=0)
        graw = np.concatenate(([gt.sum()], [gt[k:].sum() * np.exp(raw[k]) for k in range(1, GRADES)]))
        seen_w += g * g
        seen_t += graw * graw
        rate = 0.3 / np.sqrt(seen_w)
        w -= rate * g
        w = np.maximum(w - rate * sparse, 0)  # no word makes a text less toxic
        raw -= 0.1 * graw / np.sqrt(seen_t)
    return w, np.concatenate(([raw[0]], raw[0] + np.cumsum(np.exp(raw[1:]))))


def _odds(row: np.ndarray, feature: np.ndarray, features: int, toxic: np.ndarray) -> np.ndarray:
    """For each feature its share of the toxic documents over its share of the others, smoothed."""
    df1 = np.bincount(feature, toxic[row], features) + 0.5
    df0 = np.bincount(feature, ~toxic[row], features) + 0.5
    return df1 / toxic.sum() / (df0 / (~toxic).sum())


def _grades(x: _Sparse, times: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Grades of labelled documents by the density of evident words."""
    toxic = y > 0
    evident = _odds(x.row, x.feature, x.features, toxic) > EVIDENT
    density = np.bincount(x.row, times * evident[x.feature], x.rows) / np.maximum(1, np.bincount(x.row, times, x.rows))
    some = density[toxic & (density > 0)]
    cuts = np.quantile(some, [k / GRADES for k in range(1, GRADES)]) if len(some) else np.zeros(GRADES - 1)
    return np.where(toxic, 1 + np.where(density > 0, np.searchsorted(cuts, density, "right"), 0), 0)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    """A model of about ``rows`` labelled documents, half of them toxic where there are as many."""
    none = Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES, 20.0), 0.5)
    sample = sampled(one_label(labels, "toxic"), rows, "y")
    texts = with_sample(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), sample.withColumn("held", held_back(F.col("doc_id"))))
    counted = texts.select("text", "y", "held").mapInArrow(_count, "y int, held boolean, words binary, times binary")
    # copies among the labelled documents count once
    counted = written(counted.groupBy("y", "words", "times").agg(F.min("held").alias("held")))
    of = {r["y"]: r["n"] for r in counted.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not of.get(1) or not of.get(0):
        return none
    names = screened(counted, of[1], of[0])
    if not len(names):
        return none
    known = _known(docs.sparkSession.sparkContext.broadcast(names))
    got = counted.mapInArrow(known, "y int, held boolean, places binary, times binary").toArrow()
    y, held = got["y"].to_numpy(), got["held"].to_numpy().astype(bool)
    parts = [np.frombuffer(v.as_buffer(), np.int32) for v in got["places"]]
    feature = np.concatenate(parts).astype(np.int64)
    times = np.concatenate([np.frombuffer(v.as_buffer(), np.uint32) for v in got["times"]]).astype(np.float32)
    row = np.repeat(np.arange(len(y)), [len(p) for p in parts])
    grade = _grades(_Sparse(row, feature, times, len(y), len(names)), times, y)
    train = ~held if (y[~held] > 0).any() and (y[~held] == 0).any() else np.ones(len(y), bool)
    order = np.cumsum(train) - 1
    mine = train[row]
    x = _Sparse(order[row[mine]], feature[mine], np.log1p(times[mine]), int(train.sum()), len(names))
    chosen = np.flatnonzero(fit_ordinal(x, grade[train], sparse=SPARSE / np.sqrt(x.rows))[0])
    if not len(chosen):
        return none
    # the soft threshold also shrinks what it keeps, so the chosen words are fitted again without it
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[feature] >= 0
    names, row, times, feature = names[chosen], row[keep], times[keep], place[feature[keep]]
    mine = train[row]
    x = _Sparse(order[row[mine]], feature[mine], np.log1p(times[mine]), int(train.sum()), len(names))
    w, t = fit_ordinal(x, grade[train], steps=5 * STEPS, sparse=1e-2 / x.rows)
    # the sample holds toxic documents more often than the corpus; the cut is set on the odds it was drawn with
    check = held if (y[held] > 0).any() and (y[held] == 0).any() else train
    p = sigmoid(np.bincount(row, np.log1p(times) * w[feature], len(y)) - t[0])[check]
    grid = np.unique(np.clip(np.quantile(p, np.linspace(0, 1, 201)), 0.1, 0.9))
    right = [np.mean((p >= c) == (y[check] > 0)) for c in grid]
    best = np.flatnonzero(np.array(right) >= max(right) - 1e-9)
    cut = float((grid[best[0]] + grid[best[-1]]) / 2)
    used = np.abs(w) > 1e-9
    return Model(names[used], w[used], t, cut)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with severity (expected grade), grade (the most likely) and toxic, in place of columns so named."""
    kept = docs.select(*[docs[c] for c in docs.columns if c not in ("severity", "grade", "toxic")])
    schema = T.StructType([*kept.schema.fields, T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType()), T.StructField("toxic", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            parts = [m.score(*features(data, off)) for _, _, data, off in tokens.pieces(batch.column(batch.schema.get_field_index("text")))]
            p = np.concatenate(parts) if parts else np.zeros((0, GRADES))
            each = np.hstack([np.ones((len(p), 1)), p]) - np.hstack([p, np.zeros((len(p), 1))])
            more = [pa.array(p.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0] >= m.cut)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "severity", "grade", "toxic"])

    return kept.mapInArrow(run, schema)


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the toxic ones, in its own columns."""
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    return score(row, fit(docs, labels)).where(~F.col("toxic")).select("row.*")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Severity of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).drop("text")

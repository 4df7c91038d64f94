"""Language identification by averaged hashed subword embeddings (dealt operator 10).

A text's subwords are the runs of three and of four bytes within its words, a blank marking either end of a word; a
word is a run of letters, in lower case for ASCII and Latin-1 letters. Each subword is hashed to one of ``BUCKETS``
embeddings; the mean of a text's embeddings goes through a linear softmax. Embeddings and softmax are trained
together by stochastic gradient descent in numpy. As the mean and the softmax's scores are both linear, every
bucket's scores are worked out once after training, and a text is scored by adding its buckets' scores.

The held-back fifth of the learning rows sets a temperature, so that the score is a calibrated probability, and a
threshold below which a prediction is marked ``rejected``: the score that all but ``REJECT`` of the right
predictions reach. The prediction stays in its column, as the language is asked for of every text with letters.

Learned from a sample of about ``ROWS`` labelled documents, as many of each language, a documented bound, of which
whole texts are used. All texts are scored whole in one pass without a shuffle. Only the text is an input of a
prediction. Rules for odd input: null text or no letter gives ``und`` with score 1 (certain), not rejected; without any learned
language all is ``und`` with score 0; letters that form no subword score by the softmax's bias; equal texts
score alike; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold.llm import tokens
from maskfold.llm.learn import held_back, sampled, with_sample

ROWS = 6_000
BUCKETS = 1 << 14
DIMS = 16
EPOCHS = 8
BATCH = 32
RATE = 0.5
REJECT = 0.01
UND = "und"
_U = np.uint64
_LETTER = re.compile(r"[^\W\d_]")


def _folded(data: np.ndarray) -> np.ndarray:
    """Bytes in lower case, all but letters as blanks."""
    out = tokens.LOWER[data]
    out[tokens.NOT_LETTER[data]] = 0x20
    after = np.flatnonzero(data[:-1] == 0xC3) + 1  # Latin-1 capitals in UTF-8
    capital = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[capital] += 0x20
    return out


def subwords(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords in order, and the documents' bounds among them."""
    letters = _folded(data)
    n = len(letters)
    doc_of = np.repeat(np.arange(len(off) - 1), np.diff(off))
    found, owner = [], []
    factors = tokens.constants(4, 91)
    for k in (3, 4):
        if n < k:
            continue
        rolled = np.full(n - k + 1, k, np.uint64)
        inner = np.ones(n - k + 1, bool)
        for j in range(k):
            part = letters[j : n - k + 1 + j]
            rolled += part.astype(np.uint64) * factors[j]
            if 0 < j < k - 1:
                inner &= part != 0x20
        inner &= doc_of[: n - k + 1] == doc_of[k - 1 :]
        found.append((tokens.mix(rolled[inner]) >> _U(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
        owner.append(doc_of[: n - k + 1][inner])
    if not found:
        return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
    buckets, doc = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(doc, kind="stable")
    return buckets[order], np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(off) - 1))))


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # by bucket and language
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the likeliest language and its probability, by text."""
        docs = len(off) - 1
        sums, counts = np.zeros((docs, len(self.langs))), np.zeros(docs)
        for a in range(0, docs, 64):  # few texts at a time keep the gathered scores small
            b = min(docs, a + 64)
            buckets, bounds = subwords(data[off[a] : off[b]], off[a : b + 1] - off[a])
            counts[a:b] = np.diff(bounds)
            for i in np.flatnonzero(counts[a:b]).tolist():
                times = np.bincount(buckets[bounds[i] : bounds[i + 1]], minlength=0)
                sums[a + i] = times @ self.scores[: len(times)]
        z = (sums / np.maximum(1, counts)[:, None] + self.bias) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return p.argmax(axis=1), p.max(axis=1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct buckets and their counts."""
    for batch in batches:
        at = batch.schema.get_field_index
        names, times = [], []
        for _, _, data, off in tokens.pieces(batch.column(at("text"))):
            buckets, bounds = subwords(data, off)
            for a, b in zip(bounds[:-1], bounds[1:]):
                u, n = np.unique(buckets[a:b], return_counts=True)
                names.append(u.astype(np.uint16).tobytes())
                times.append(n.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(at("lang")), batch.column(at("held")), pa.array(names, pa.binary()), pa.array(times, pa.binary())], names=["lang", "held", "buckets", "times"])


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (u, n) in enumerate(rows):
        x[i, u] = n / n.sum()
    return x


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket scores and bias, by SGD with rates that adapt to each parameter's past gradients."""
    rng = np.random.default_rng(5)
    e = rng.normal(0, 1.0 / DIMS, (BUCKETS, DIMS)).astype(np.float32)
    w, bias = np.zeros((DIMS, langs), np.float32), np.zeros(langs, np.float32)
    seen = [np.full(p.shape, 1e-8, np.float32) for p in (e, w, bias)]
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            x = _dense([rows[i] for i in some])
            h = x @ e
            z = h @ w + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            p /= len(some)
            grads = (x.T @ (p @ w.T), h.T @ p, p.sum(axis=0))
            for param, g, s in zip((e, w, bias), grads, seen):
                s += g * g
                param -= RATE / (1 + epoch) * g / np.sqrt(s)
    return (e @ w).astype(np.float64), bias.astype(np.float64)


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and the rejection threshold."""

    def probabilities(t: float) -> np.ndarray:
        p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    best = min(np.geomspace(0.05, 20, 61), key=lambda t: -np.log(probabilities(t)[np.arange(len(y)), y] + 1e-12).mean())
    p = probabilities(best)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    return float(best), float(np.quantile(right, REJECT)) if len(right) else 0.0


def fit(docs: DataFrame, rows: int = ROWS) -> Model:
    """A model of (doc_id, text, lang), of about ``rows`` documents."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    keys = sampled(known.select("doc_id", "lang"), rows, "lang").select("doc_id", held_back(F.col("doc_id")).alias("held")).distinct()
    texts = with_sample(known.where(F.col("text").isNotNull()), keys).select("text", "lang", "held")
    got = texts.mapInArrow(_features, "lang string, held boolean, buckets binary, times binary").toArrow()
    x = [(np.frombuffer(u.as_buffer(), np.uint16), np.frombuffer(n.as_buffer(), np.float32)) for u, n in zip(got["buckets"], got["times"])]
    lang, held = np.array(got["lang"].to_pylist(), object), got["held"].to_numpy().astype(bool)
    some = np.array([len(u) > 0 for u, _ in x], bool)
    langs = sorted(set(lang[some].tolist()))
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    y = np.array([langs.index(v) if s else 0 for v, s in zip(lang.tolist(), some)])
    # rows come in no fixed order; the order of training must be the same in every run
    order = sorted(np.flatnonzero(some).tolist(), key=lambda i: (y[i], held[i], x[i][0].tobytes(), x[i][1].tobytes()))
    learn = [i for i in order if not held[i]] or order
    check = [i for i in order if held[i]] or learn
    scores, bias = train([x[i] for i in learn], y[learn], len(langs))
    z = np.array([(x[i][1] @ scores[x[i][0]]) / x[i][1].sum() + bias for i in check])
    return Model(langs, scores, bias, *_calibrate(z, y[check]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and rejected, in place of columns so named."""
    kept = docs.select(*[docs[c] for c in docs.columns if c not in ("lang_pred", "score", "rejected")])
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.langs, UND], object)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index("text"))
            letters = np.array([v is not None and _LETTER.search(v) is not None for v in col.to_pylist()], bool)
            best, score = np.full(len(col), len(m.langs)), np.where(letters, 0.0, 1.0)
            if m.langs:
                parts = [m.predict(data, off) for _, _, data, off in tokens.pieces(col)]
                if parts:
                    best = np.where(letters, np.concatenate([b for b, _ in parts]), best)
                    score = np.where(letters, np.concatenate([p for _, p in parts]), score)
            more = [pa.array(names[best], pa.string()), pa.array(score), pa.array(letters & (score < m.threshold))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "lang_pred", "score", "rejected"])

    return kept.mapInArrow(run, schema)


def op10_language(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = fit(docs.where(fold != 1))
    held_out = F.coalesce(fold == 1, F.lit(False))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")

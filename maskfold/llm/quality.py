"""Quality classifier by co-training of two views (dealt operator 3).

One view is the text's content: shares of pairs of neighbouring character classes, of repeated words and lines, and
lengths of words and lines. The other is the metadata: the source, the language and the stated length. Each view has a logistic
regression. They are first fitted on labelled documents; in each of ``ROUNDS`` rounds either classifier hands its most
confident pseudo-labels among the unlabelled documents, ``GROW`` of them in the proportion of the labels and only those
beyond ``SURE``, to the other, which is fitted again on its labels and these. In the end each view's score is
calibrated (Platt) on a fifth of the labels that no fit saw, and a logistic combination of the two calibrated scores,
fitted on that fifth as well, scores every document.

Fitted on samples of about ``ROWS`` labelled and ``POOL`` unlabelled documents, documented bounds (as in the method's
own form, which draws a pool); every document is scored whole, in one pass without a shuffle. Rules for odd
input: null text reads as empty; null or unseen source and language have no weight of their own; null length
counts as 0; ids with several labels are good if one says so; without labels of both kinds the score is the share of
good labels (1 without any), and all is kept; repeated rows score alike; further columns are ignored.
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
from maskfold.llm.learn import fit_logistic, held_back, logit, one_label, sampled, sigmoid, with_sample

ROWS = 6_000
POOL = 6_000
ROUNDS = 4
GROW = 600
SURE = 0.9
KEEP = 0.5
NAMES = 64  # hashed sources and languages


def _classes() -> np.ndarray:
    """16 classes of bytes."""
    kinds = np.full(256, 15, np.uint8)
    kinds[ord("a") : ord("z") + 1] = 0
    kinds[0x80:] = 0
    kinds[ord("A") : ord("Z") + 1] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    kinds[[0x20, 0x09]] = 3
    kinds[[0x0A, 0x0D]] = 4
    for k, group in enumerate((".", ",;:", "!?", "|", "#$%&*", "-_/\\", "()[]{}", "\"'`", "<>=", "@+~^"), 5):
        kinds[[ord(c) for c in group]] = k
    return kinds


CLASSES = _classes()
CONTENT = 256 + 8


def content(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Content features of a piece's texts."""
    docs = len(off) - 1
    kind = CLASSES[data].astype(np.int64)
    doc = np.repeat(np.arange(docs), np.diff(off))
    x = np.zeros((docs, CONTENT))
    if len(kind) > 1:
        same = doc[1:] == doc[:-1]
        pair = (doc[1:] * 256 + kind[:-1] * 16 + kind[1:])[same]
        x[:, :256] = np.bincount(pair, minlength=docs * 256).reshape(docs, 256)
        x[:, :256] = np.sqrt(x[:, :256] / np.maximum(1, x[:, :256].sum(axis=1, keepdims=True)))
    hashes, starts, ends, bounds = tokens.word_spans(data, off)
    n = np.diff(bounds)
    owner = np.repeat(np.arange(docs), n)
    total = np.maximum(1, n)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(bounds[:-1], bounds[1:])])
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    size = np.bincount(owner, ends - starts, docs)
    lines = np.bincount(doc, kind == 4, docs) + 1 if len(doc) else np.ones(docs)
    x[:, 256] = distinct / total * (n > 0)
    x[:, 257] = np.bincount(owner, again, docs) / total
    x[:, 258] = size / total / 10
    x[:, 259] = np.log1p(n) / 10
    x[:, 260] = np.log1p(n / lines) / 10
    x[:, 261] = (n == 0).astype(float)
    x[:, 262] = (distinct / np.sqrt(total)) / 20
    x[:, 263] = (n < 5).astype(float)
    return x


def metadata(source: list, lang: list, length: list) -> np.ndarray:
    """Metadata features: hashed names, and the stated length."""
    x = np.zeros((len(source), NAMES * 2 + 3))
    for at, names in ((0, source), (NAMES, lang)):
        data, off = tokens.buffers(pa.array([str(v).replace(" ", "_") if v is not None else "" for v in names], pa.string()))
        hashes, bounds = tokens.words(data, off, np.zeros(256, bool))
        some = np.diff(bounds) > 0
        x[np.flatnonzero(some), at + (hashes[bounds[:-1][some]] % np.uint64(NAMES)).astype(np.int64)] = 1
    n = np.array([float(v or 0) for v in length])
    x[:, 2 * NAMES] = np.log1p(np.maximum(n, 0)) / 10
    x[:, 2 * NAMES + 1] = n < 200
    x[:, 2 * NAMES + 2] = n > 20_000
    return x


@dataclass
class Model:
    views: tuple[np.ndarray, np.ndarray] | None
    platt: tuple[np.ndarray, np.ndarray] | None
    blend: np.ndarray | None
    share: float  # of good labels, where there is no model

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.views is None:
            return np.full(len(text), self.share)
        return sigmoid(logit(self.calibrated(text, meta), self.blend))

    def calibrated(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Both views' calibrated scores, as log-odds."""
        return np.column_stack([logit(logit(x, b)[:, None], p) for x, b, p in zip((text, meta), self.views, self.platt)])


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of both views after the rounds of exchange."""
    given: list[dict[int, int]] = [{}, {}]  # by view: labels that the other gave to rows of the pool
    fitted = [fit_logistic(x, y) for x in views]
    good = y.mean()
    for _ in range(ROUNDS):
        for giver, taker in ((0, 1), (1, 0)):
            p = sigmoid(logit(pool[giver], fitted[giver])) if len(pool[0]) else np.zeros(0)
            free = np.array([i not in given[taker] for i in range(len(p))], bool)
            for label, sure, part in ((1, p, good), (0, 1 - p, 1 - good)):
                best = np.flatnonzero(free & (sure >= SURE))
                best = best[np.argsort(-sure[best], kind="stable")][: int(round(GROW * part))]
                given[taker].update((int(i), label) for i in best)
        for k in (0, 1):
            rows = np.array(sorted(given[k]), np.int64)
            x = np.vstack([views[k], pool[k][rows]]) if len(rows) else views[k]
            labels = np.concatenate([y, [given[k][int(i)] for i in rows]])
            # a pseudo-label counts half of a label
            fitted[k] = fit_logistic(x, labels, np.concatenate([np.ones(len(y)), np.full(len(rows), 0.5)]))
    return fitted[0], fitted[1]


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        parts = [content(data, off) for _, _, data, off in tokens.pieces(col["text"])]
        text = np.concatenate(parts) if parts else np.zeros((0, CONTENT))
        meta = metadata(col["source"].to_pylist(), col["lang"].to_pylist(), col["n_chars"].to_pylist())
        rows = [pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary()) for x in (text, meta)]
        yield pa.RecordBatch.from_arrays([col["y"], col["held"], *rows], names=["y", "held", "text", "meta"])


def _matrix(col) -> np.ndarray:
    rows = [np.frombuffer(v.as_buffer(), np.float32) for v in col]
    return np.array(rows, np.float64) if rows else np.zeros((0, 1))


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, pool: int = POOL) -> Model:
    """A model of about ``rows`` labelled and ``pool`` unlabelled documents."""
    known = one_label(labels, "quality")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct()
    some = sampled(known.join(plain, "doc_id", "left_semi"), rows).withColumn("held", held_back(F.col("doc_id")))
    other = sampled(plain.join(known, "doc_id", "left_anti"), pool, seed=13).select("doc_id", F.lit(None).cast("int").alias("y"), F.lit(False).alias("held"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
    texts = with_sample(keyed, some.unionByName(other))
    got = texts.select("y", "held", "text", "source", "lang", "n_chars").mapInArrow(_views, "y int, held boolean, text binary, meta binary").toArrow()
    y = np.array([-1 if v is None else v for v in got["y"].to_pylist()], np.int64)
    held, text, meta = got["held"].to_numpy().astype(bool), _matrix(got["text"]), _matrix(got["meta"])
    order = np.lexsort((meta.sum(axis=1), text[:, :256].sum(axis=1), text[:, 258], y)) if len(y) else np.zeros(0, np.int64)
    y, held, text, meta = y[order], held[order], text[order], meta[order]
    labelled = y >= 0
    learn, check = labelled & ~held, labelled & held
    if len(set(y[learn].tolist())) < 2:
        return Model(None, None, None, float(y[labelled].mean()) if labelled.any() else 1.0)
    if len(set(y[check].tolist())) < 2:
        check = learn
    views = co_train((text[learn], meta[learn]), y[learn], (text[~labelled], meta[~labelled]))
    platt = tuple(fit_logistic(logit(x[check], b)[:, None], y[check], ridge=1e-2) for x, b in zip((text, meta), views))
    model = Model(views, platt, None, 0.0)
    model.blend = fit_logistic(model.calibrated(text[check], meta[check]), y[check], ridge=1e-2)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with quality (probability of good) and keep, in place of columns so named."""
    kept = docs.select(*[docs[c] for c in docs.columns if c not in ("quality", "keep")])
    schema = T.StructType([*kept.schema.fields, T.StructField("quality", T.DoubleType()), T.StructField("keep", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            meta = metadata(*(batch.column(at(c)).to_pylist() for c in ("source", "lang", "n_chars")))
            parts = [shared.value.score(content(data, off), meta[a:b]) for a, b, data, off in tokens.pieces(batch.column(at("text")))]
            p = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array(p >= KEEP)], names=[*batch.schema.names, "quality", "keep"])

    return kept.mapInArrow(run, schema)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text", "source", "lang", "n_chars"), model).select("doc_id", "quality", "keep")

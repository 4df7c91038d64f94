"""Document fingerprints: one-permutation MinHash (dealt operator 1).

The distinct five-word shingles of a text are hashed once. The top bits of a hash choose one of
``BINS`` bins, and a bin keeps its smallest hash. An empty bin takes over the bin that its own fixed
random probe sequence meets first among the filled ones (optimal densification: each empty bin draws
independently, so estimates stay unbiased). Of each bin the four low-order bits are stored, as one
hexadecimal digit. Two bins agree by chance with probability 1/16, which the likeness corrects.

Rules for odd input: null text counts as empty; a text without words has the empty fingerprint; two
empty fingerprints have likeness 1, an empty and a filled one 0; a text of one to four words is one
shingle. Rows with equal ``doc_id`` are ordered by text; a null ``doc_id`` comes last. Further columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from maskfold.llm import tokens
from maskfold.llm.shared import partitions

BINS = 512
BITS = 4
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)
_VALUE = np.zeros(256, np.uint8)
_VALUE[_DIGITS] = np.arange(16)


def _probes() -> np.ndarray:
    """For each bin a random order of all bins."""
    keys = tokens.constants(BINS * BINS, 71).reshape(BINS, BINS)
    return np.argsort(keys, axis=1).astype(np.int32)


PROBES = _probes()
MARKS = tokens.constants(BINS, 83)


def bins_of(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Low-order bits by document and bin, of the documents' sorted distinct shingle hashes. Rows of
    documents without shingles are undefined."""
    docs = len(bounds) - 1
    doc = np.repeat(np.arange(docs), np.diff(bounds))
    slot = doc * BINS + (values >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]  # hashes ascend, so a bin's first is its smallest
    least = np.zeros(docs * BINS, np.uint64)
    filled = np.zeros(docs * BINS, bool)
    least[slot[first]] = values[first]
    filled[slot[first]] = True
    open_ = np.flatnonzero(~filled & np.repeat(np.diff(bounds) > 0, BINS))
    for step in range(BINS):
        if not len(open_):
            break
        donor = open_ - open_ % BINS + PROBES[open_ % BINS, step]
        found = filled[donor]
        least[open_[found]] = least[donor[found]]
        open_ = open_[~found]
    # the bin's number is mixed in, so that bins that share a donor agree by chance independently
    low = tokens.mix(least.reshape(docs, BINS) ^ MARKS)
    return (low & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def fingerprint_column(col: pa.Array) -> pa.Array:
    """Fingerprints of a text column: ``BINS`` hexadecimal digits, or empty for no words."""
    out: list[np.ndarray] = []
    filled: list[np.ndarray] = []
    for _, _, values, bounds in tokens.document_sets(col):
        has = np.diff(bounds) > 0
        out.append(_DIGITS[bins_of(values, bounds)[has]].ravel())
        filled.append(has)
    has = np.concatenate(filled) if filled else np.zeros(0, bool)
    data = np.concatenate(out) if out else np.zeros(0, np.uint8)
    offsets = np.concatenate(([0], np.cumsum(has * BINS))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(has), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def likeness_column(a: pa.Array, b: pa.Array) -> pa.Array:
    """Estimated Jaccard likeness of paired fingerprints, corrected for chance agreement, 0 to 1."""
    out = np.zeros(len(a))
    chance = 1.0 / (1 << BITS)
    for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
        if x == y:
            out[i] = 1.0
        elif x and y:
            same = np.mean(np.frombuffer(x.encode(), np.uint8) == np.frombuffer(y.encode(), np.uint8))
            out[i] = min(1.0, max(0.0, (same - chance) / (1 - chance)))
    return pa.array(out)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the column ``out``; one pass, no shuffle."""
    frame = docs.select(*[docs[c] for c in docs.columns if c != out])
    schema = T.StructType([*frame.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = fingerprint_column(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], names=[*batch.schema.names, out])

    return frame.mapInArrow(run, schema)


def likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with one likeness column for each entry name: (fingerprint column, fingerprint column)."""
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in pairs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            more = [likeness_column(batch.column(at(x)), batch.column(at(y))) for x, y in pairs.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *pairs])

    return df.mapInArrow(run, schema)


def _range_bounds(docs: DataFrame, n: int) -> np.ndarray:
    """At most n - 1 ascending ids that cut the documents into ranges of about equal counts."""
    if n < 2:
        return np.zeros(0, np.int64)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n).alias("q")).first()["q"]
    return np.unique(np.array(cuts or [], np.int64))


def _bucket(ids: np.ndarray, null: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Range numbers along descending ids; null ids have the last."""
    out = len(bounds) - np.searchsorted(bounds, ids, "left")
    out[null] = len(bounds) + 1
    return out


def _ids(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    null = np.asarray(col.is_null().to_numpy(zero_copy_only=False), bool)
    return col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null


def with_next(docs: DataFrame, carried: list[str], source: DataFrame | None = None) -> DataFrame:
    """``docs`` (of a long ``doc_id``, a ``text`` and further columns) with ``next_<c>`` for each
    carried column c: its value in the next row by descending ``doc_id``, after the last the first.

    The ids' quantiles cut the order into ranges, as literals fixed for this run, so a recomputed task
    deals its rows the same way. Every range is put in order by itself, and the rows that begin a range
    are also sent to the range before it, so the texts are shuffled once and no task sees all.
    ``source`` is a frame of the same ids that is cheaper to read.
    """
    spark = docs.sparkSession
    ids = (docs if source is None else source).select(F.col("doc_id").cast("long").alias("doc_id"))
    bounds = _range_bounds(ids, 4 * partitions(spark))

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, int | None] = {}
        for batch in batches:
            values, null = _ids(batch.column(0))
            buckets = _bucket(values, null, bounds)
            for b in np.unique(buckets).tolist():
                top = None if b == len(bounds) + 1 else int(values[buckets == b].max())
                best[b] = top if top is None else max(best.get(b, top), top)
        yield pa.RecordBatch.from_pydict({"b": pa.array(list(best), pa.int32()), "top": pa.array(list(best.values()), pa.int64())})

    # a row for each range at most
    heads = ids.mapInArrow(tops, "b int, top long").groupBy("b").agg(F.max("top").alias("top")).orderBy("b").collect()
    order = [r["b"] for r in heads]
    before = {r["b"]: order[i - 1] for i, r in enumerate(heads)}
    top_of = {r["b"]: r["top"] for r in heads}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, null = _ids(batch.column(batch.schema.get_field_index("doc_id")))
            buckets = _bucket(values, null, bounds)
            head = np.array([n or v == top_of[b] for v, n, b in zip(values.tolist(), null.tolist(), buckets.tolist())], bool)
            for rows, extra in ((batch, False), (batch.filter(pa.array(head)), True)):
                to = np.array([before[b] for b in buckets[head].tolist()], np.int64) if extra else buckets
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(to, pa.int32()), pa.array(np.full(len(to), extra))], names=[*batch.schema.names, "_range", "_extra"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_range", T.IntegerType()), T.StructField("_extra", T.BooleanType())])
    line = W.partitionBy("_range").orderBy("_extra", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    following = {f"next_{c}": F.lead(c).over(line) for c in carried}
    return docs.mapInArrow(deal, schema).withColumns(following).where(~F.col("_extra")).drop("_range", "_extra")


def edited_text(text: Column, following: Column) -> Column:
    """The last third of the code points replaced by the first as many, or all, of the next text."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - third), F.substring(following, F.lit(1), third))


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return compare_with_edited(docs)


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    own = fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    # as bytes a fingerprint takes half the room in the shuffle
    packed = own.withColumn("fingerprint", F.unhex("fingerprint"))
    both = with_next(packed, ["text", "fingerprint"], docs)
    both = both.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "next_fingerprint")})
    edited = both.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
        edited_text(F.col("text"), F.col("next_text")).alias("edited"),
    )
    marked = fingerprints(edited.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_fingerprint")
    near = likeness(marked.drop("edited"), {"near_edited": ("fingerprint", "edited_fingerprint"), "near_next": ("fingerprint", "next_fingerprint")})
    return near.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

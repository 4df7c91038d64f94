"""Fill-in-the-middle transformation (dealt operator 12), a pipeline of ``pyarrow.compute`` in Arrow tasks.

A text is split into units, which two cuts deal to three roles: prefix, middle and suffix. The pieces are put
in another order behind sentinels, so that a model that reads from left to right learns to fill a gap:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text as it is

For each batch the units are split into list arrays, flattened with their parents' indices, numbered within the
parent, filtered by role, rebuilt into lists, and joined (``binary_join``) to one string a role. Texts are worked on
in segments of at most ``SEGMENT`` bytes, cut between units, and pieces of about ``PIECE`` bytes; a second list
array joins a text's segments, so the memory for units is bounded by a piece, however long a text is, and no
text is cut off. Batches are taken in parts of ``SLICE`` bytes.

``restored`` is the inverse. It is exact: a text that holds a sentinel stays plain, and a sentinel can't begin in one
piece and end in the next, because only its first character is ``<``.

Rules for odd input: null text reads as empty; an empty text is plain; a null id is hashed as no digits; equal rows give
equal rows; an empty table gives no rows. Columns of the input that are named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold.llm.tokens import SPACE, buffers

#: Sentinels, forms and shares are fixed values of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
MOVED_PERCENT, SPM_PERCENT = 90, 20
SLICE, PIECE, SEGMENT = 4 << 20, 1 << 18, 1 << 17
NOTHING = pa.scalar("", pa.large_string())
RESULT = ["n", "form", "prefix_chars", "middle_chars", "output"]


def _code_points(data: np.ndarray) -> np.ndarray:
    """True where a unit of one code point begins."""
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray) -> np.ndarray:
    """True where a unit of a word with the blanks behind it begins; blanks that a text begins with are a unit of their own."""
    blank = SPACE[data]
    return ~blank & np.concatenate(([True], blank[:-1]))


UNITS = {"chars": _code_points, "words": _words}


def _segments(begins: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte bounds that cut texts (given by their offsets) into segments of about ``SEGMENT`` bytes, between units."""
    inner = []
    for i in np.flatnonzero(np.diff(off) > SEGMENT):
        at = int(off[i]) + SEGMENT
        while at < off[i + 1]:
            step = int(np.argmax(begins[at : min(at + SEGMENT, off[i + 1])]))
            if begins[at + step]:
                at += step
                inner.append(at)
            at += SEGMENT
    return np.unique(np.concatenate((off, np.array(inner, np.int64))))


@dataclass
class Units:
    """Texts as bytes, where their units begin, and the segments that the texts are cut into."""

    data: np.ndarray
    off: np.ndarray
    begins: np.ndarray
    cuts: np.ndarray  # byte bounds of the segments
    owner: np.ndarray  # the text of each segment; empty texts have none
    count: np.ndarray  # units of each segment

    @classmethod
    def of(cls, text: pa.Array, unit: str) -> Units:
        data, off = buffers(text)
        begins = UNITS[unit](data) if len(data) else np.zeros(0, bool)
        begins[off[:-1][np.diff(off) > 0]] = True  # every text that is not empty begins a unit
        cuts = _segments(begins, off)
        owner = np.searchsorted(off, cuts[:-1], "right") - 1
        count = np.add.reduceat(begins, cuts[:-1], dtype=np.int64) if len(owner) else np.zeros(0, np.int64)
        return cls(data, off, begins, cuts, owner, count)

    def of_texts(self) -> np.ndarray:
        """Units of each text."""
        total = np.concatenate(([0], np.cumsum(self.count)))
        return np.diff(total[np.searchsorted(self.owner, np.arange(len(self.off)))])


def unit_lists(data: np.ndarray, begins: np.ndarray, bounds: np.ndarray) -> pa.LargeListArray:
    """A list array of the units of each segment."""
    starts = np.flatnonzero(begins)
    ends = np.append(starts, len(data)).astype(np.int64)
    flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, bounds), pa.int64()), flat)


def _joined(parts: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), parts), NOTHING)


def three_pieces(texts: Units, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every text: its units before ``low``, from there to ``high``, and the rest."""
    data, begins, cuts, owner = texts.data, texts.begins, texts.cuts, texts.owner
    total = np.cumsum(texts.count) - texts.count
    first = np.searchsorted(owner, owner)
    before = total - total[first]  # units of the text that earlier segments hold
    found: list[list[pa.Array]] = [[], [], []]
    at = 0
    while at < len(owner):
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + PIECE, "right")) - 1)
        piece = slice(cuts[at], cuts[to])
        lists = unit_lists(data[piece], begins[piece], cuts[at : to + 1] - cuts[at])
        units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        bounds = lists.offsets.to_numpy()
        base = pa.array(before[at:to] - bounds[:-1])
        ordinal = pc.add(pa.array(np.arange(len(units))), pc.take(base, parent))
        own_low, own_high = (pc.take(pa.array(x[owner[at:to]]), parent) for x in (low, high))
        in_prefix, past = pc.less(ordinal, own_low), pc.greater_equal(ordinal, own_high)
        roles = (in_prefix, pc.invert(pc.or_(in_prefix, past)), past)
        for role, mask in zip(found, roles):
            held = np.concatenate(([0], np.cumsum(mask.to_numpy(zero_copy_only=False))))[bounds]
            role.append(_joined(pc.filter(units, mask), held))
        at = to
    of_text = np.searchsorted(owner, np.arange(len(texts.off)))
    return [_joined(pa.concat_arrays(role) if role else pa.array([], pa.large_string()), of_text) for role in found]


def arranged(text: pa.Array, form: pa.Array, pieces: list[pa.Array]) -> pa.Array:
    """The output of each text in its form."""
    prefix, middle, suffix = pieces
    p, s, m = (pa.scalar(mark, pa.large_string()) for mark in (PREFIX, SUFFIX, MIDDLE))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, NOTHING)
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, NOTHING)
    return pc.if_else(pc.equal(form, PSM), psm, pc.if_else(pc.equal(form, SPM), spm, text))


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``SLICE`` bytes of a text column; one longer text makes one longer part."""
    for batch in batches:
        _, off = buffers(batch.column(column))
        at, n = 0, batch.num_rows
        while at < n:
            to = max(at + 1, int(np.searchsorted(off, off[at] + SLICE, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def holds_sentinel(text: Column) -> Column:
    return text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 that depend on the id only."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _without(docs: DataFrame, names: list[str]) -> list[str]:
    return [c for c in docs.columns if c not in names]


def fill_in_middle(docs: DataFrame, unit: str = "chars", seed: int = 1) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars and middle_chars (units; null if plain) and output."""
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    kept = [c for c in _without(docs, RESULT) if c != "text"]
    rows = docs.select(
        F.struct(*[docs[c] for c in kept]).alias("row"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    ).withColumn("doc_id", F.col("row.doc_id"))
    form = F.when((F.col("text") == "") | holds_sentinel(F.col("text")) | (h3 % 100 >= MOVED_PERCENT), PLAIN).when(h4 % 100 < SPM_PERCENT, SPM).otherwise(PSM)
    rows = rows.select("row", "text", form.alias("form"), h1.alias("h1"), h2.alias("h2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, text, form, h1, h2 = batch.columns
            text = text.cast(pa.large_string())
            texts = Units.of(text, unit)
            n = texts.of_texts()
            cuts = np.sort([h.to_numpy() % (n + 1) for h in (h1, h2)], axis=0)
            plain = pc.equal(form, PLAIN)
            output = arranged(text, form, three_pieces(texts, cuts[0], cuts[1]))
            sizes = [pc.if_else(plain, pa.scalar(None, pa.int64()), pa.array(x)) for x in (cuts[0], cuts[1] - cuts[0])]
            yield pa.RecordBatch.from_arrays([row, text.cast(pa.string()), pa.array(n), form, *sizes, output.cast(pa.string())], names=["row", "text", *RESULT])

    schema = T.StructType([rows.schema["row"]]).add("text", "string").add("n", "long").add("form", "string")
    out = rows.mapInArrow(run, schema.add("prefix_chars", "long").add("middle_chars", "long").add("output", "string"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "text", *RESULT)


def _split(text: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before the first ``mark``, and behind it; behind is empty where there is none."""
    lists = pc.split_pattern(text, mark, max_splits=1)
    rest = pc.list_slice(lists, 1, 2, return_fixed_size_list=False)
    return pc.list_element(lists, 0), pc.binary_join(rest, NOTHING)


def restored(moved: DataFrame) -> DataFrame:
    """``moved`` with ``restored``, the text that output and form give."""
    kept = _without(moved, ["restored"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output"):
            form, output = (batch.column(c).cast(pa.large_string()) for c in ("form", "output"))
            body = pc.utf8_slice_codeunits(output, len(PREFIX))  # both forms begin with a mark
            prefix, rest = _split(body, SUFFIX)  # psm
            suffix, middle = _split(rest, MIDDLE)
            psm = pc.binary_join_element_wise(prefix, middle, suffix, NOTHING)
            suffix, rest = _split(body, PREFIX)  # spm
            prefix, middle = _split(rest, MIDDLE)
            spm = pc.binary_join_element_wise(prefix, middle, suffix, NOTHING)
            text = pc.if_else(pc.equal(form, PSM), psm, pc.if_else(pc.equal(form, SPM), spm, output))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), text.cast(pa.string())], names=[*kept, "restored"])

    fields = [moved.schema[c] for c in kept]
    return moved.select(*kept).mapInArrow(run, T.StructType([*fields, T.StructField("restored", T.StringType())]))


def op12_fill_middle(spark, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's output, and of the text rebuilt from it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = restored(fill_in_middle(docs).drop("text"))
    digests = [F.sha2(F.col(c), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= {MOVED_PERCENT} THEN '{PLAIN}'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < {SPM_PERCENT} THEN '{SPM}' ELSE '{PSM}' END AS form
  FROM hashed),
pieces AS (
  SELECT doc_id, text, n, form, least(c1, c2) AS a, greatest(c1, c2) AS b,
         substr(text, 1, least(c1, c2)) AS p, substr(text, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS m,
         substr(text, greatest(c1, c2) + 1) AS s
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> '{PLAIN}' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> '{PLAIN}' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN '{PSM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        WHEN '{SPM}' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""

"""Benchmark decontamination by SimHash windows (dealt operator 4).

An item of L words is fingerprinted by SimHash: each pair of neighbouring words gives a 64-bit hash, and a bit of
the fingerprint says whether more than half of the hashes have it. So is every window of L words, at every word of
every document, of whose pairs ``KNOWN_SHARE`` or more occur anywhere in the benchmark; with fewer a window is within the
radius of an item by chance only. Bit counts of windows of all sizes come from one running sum, as arrays.

Candidates are all these windows within ``RADIUS`` bits of an item of their size: the fingerprint is cut into ``BLOCKS``
blocks, and of two fingerprints within the radius one block at least is within RADIUS // BLOCKS bits, so tables of
all blocks that near to an item's block (a multi-index) miss none. Windows that pass a table are compared with the
items whole. Each candidate is verified exactly: the best of all windows of the document, by weighted
Jaccard similarity of the multisets of five-word shingles; a shingle weighs the inverse of the number of items
that hold it, so boilerplate of the benchmark counts little. A pair of ``SIMILARITY`` or more is a match.

A passage that is just as similar as it must be differs from its item in some 14 bits on average, and now and then in more
than the radius: see ``test_recall_of_the_fingerprints`` for the share that is found. With ``complete`` all documents
that hold a seed of an item are candidates as well: its rarest shingles, so many that the others weigh less than
``SIMILARITY`` of it. No match is without one, so this mode misses nothing; the query does not use it.

Windows never span two documents. The index of a block of items is broadcast, ``ITEM_BYTES`` of benchmark text at most
(but for a larger single item); a larger benchmark is worked on in several blocks, each against all documents. No shuffle
of texts.

Rules for odd input: null and empty texts match nothing; an item of fewer than six words has too few pairs for
a fingerprint and is matched where all of its words stand together in a document; equal items of different ids are all
reported, repeated rows of the benchmark count once; rows are reported one for each document row and item, best window
first; further columns are ignored, or kept by ``without_benchmark``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskfold.llm import tokens
from maskfold.llm.shared import written

SIMILARITY = 0.75
WIDTH = 5
RADIUS = 19
BLOCKS = 4
KNOWN_SHARE = 0.5
LEAST_WORDS = 6
ITEM_BYTES = 8 << 20
ROWS = 1 << 10  # places whose windows are fingerprinted at a time
CELLS = 1 << 18  # windows compared with an item at a time
_U = np.uint64


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """A hash for each two neighbouring words."""
    a, b = tokens.constants(2, 61)
    return tokens.mix(words[:-1] * a + words[1:] * b) if len(words) > 1 else np.zeros(0, np.uint64)


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)


def simhash(hashes: np.ndarray) -> int:
    """Fingerprint of a set of hashes: the bits that more than half of them have."""
    ones = _bits(hashes).sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones).view(np.uint64)[0])


def window_fingerprints(total: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """The fingerprints of the windows of ``span`` pairs from some starts; ``total`` has the running sums of the pairs' bits."""
    return np.packbits((total[starts + span] - total[starts]) * 2 > span, axis=1).view(np.uint64).ravel()


def running_bits(hashes: np.ndarray) -> np.ndarray:
    """Running sums of each bit, with a first row of zeros."""
    total = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(_bits(hashes), axis=0, dtype=np.int32, out=total[1:])
    return total


def within(marks: np.ndarray, radius: int) -> np.ndarray:
    """For a table by block which entries are within so many bits of a marked one."""
    for _ in range(radius):
        grown = marks.copy()
        for b in range(64 // BLOCKS):
            grown |= marks.reshape(-1, 2, 1 << b)[:, ::-1].ravel()
        marks = grown
    return marks


class Index:
    """Fingerprints of a block of items by size, and their weighted shingles."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        self.items, self.short = [], []
        holders: dict[int, int] = {}
        for item, text in zip(ids, texts):
            data, off = tokens.buffers(pa.array([text], pa.string()))
            words, _ = tokens.words(data, off)
            if not len(words):
                continue
            shingles, counts = np.unique(tokens.shingles(words, np.array([0, len(words)]), WIDTH)[0], return_counts=True)
            for s in shingles.tolist():
                holders[s] = holders.get(s, 0) + 1
            (self.items if len(words) >= LEAST_WORDS else self.short).append((item, len(words), words, shingles, counts))
        self.weights = holders
        self.spans: dict[int, list[int]] = {}
        for i, (_, n, _, _, _) in enumerate(self.items):
            self.spans.setdefault(n - 1, []).append(i)
        pairs = [pair_hashes(words) for _, _, words, _, _ in self.items]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        self.pair_mask = _U((1 << max(16, len(self.pairs).bit_length() + 4)) - 1)
        self.maybe = np.zeros(int(self.pair_mask) + 1, bool)  # by the last bits of a pair's hash
        self.maybe[(self.pairs & self.pair_mask).astype(np.int64)] = True
        self.prints = {span: np.array([simhash(pairs[i]) for i in rows], np.uint64) for span, rows in self.spans.items()}
        self.tables = {}
        for span, prints in self.prints.items():
            blocks = prints.view(np.uint16).reshape(-1, BLOCKS)
            tables = np.zeros((BLOCKS, 1 << 16), bool)
            for b in range(BLOCKS):
                tables[b, blocks[:, b]] = True
                tables[b] = within(tables[b], RADIUS // BLOCKS)
            self.tables[span] = np.packbits(tables, axis=1, bitorder="little")
        self._seed()

    def _seed(self) -> None:
        """Shingles with their weights, each item's weight, and the items of each seed (as runs of one array)."""
        self.names = np.array(sorted(self.weights), np.uint64)
        self.weight = 1.0 / np.array([self.weights[s] for s in self.names.tolist()])
        self.mask = _U((1 << max(16, len(self.names).bit_length() + 4)) - 1)
        self.known = np.zeros(int(self.mask) + 1, bool)  # by the last bits of a shingle
        self.known[(self.names & self.mask).astype(np.int64)] = True
        self.whole, seeds, rows = [], [], []
        for i, (_, _, _, shingles, counts) in enumerate(self.items):
            at = np.searchsorted(self.names, shingles)
            weight = self.weight[at] * counts
            self.whole.append(float(weight.sum()))
            order = np.argsort(-self.weight[at], kind="stable")
            left = self.whole[i] - np.cumsum(weight[order])
            n = int(np.argmax(left < SIMILARITY * self.whole[i] * (1 - 1e-9))) + 1
            seeds.append(at[order[:n]])
            rows.append(np.full(n, i))
        seed, row = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seeds, rows))
        self.holders = row[np.argsort(seed, kind="stable")]
        self.first = np.searchsorted(np.sort(seed), np.arange(len(self.names) + 1))

    def lookup(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the shingles that an item has."""
        where = np.flatnonzero(self.known[(shingles & self.mask).astype(np.int64)])
        at = np.searchsorted(self.names, shingles[where])
        same = at < len(self.names)
        same[same] = self.names[at[same]] == shingles[where[same]]
        return where[same], at[same]

    def seeded(self, where: np.ndarray, names: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """Documents and items of which the document holds a seed; ``bounds`` of the documents' shingles."""
        n = self.first[names + 1] - self.first[names]
        doc = np.repeat(np.searchsorted(bounds, where, "right") - 1, n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pair = np.unique(doc * max(1, len(self.items)) + self.holders[np.repeat(self.first[names], n) + step])
        return {divmod(p, len(self.items)) for p in pair.tolist()}

    def known_pairs(self, hashes: np.ndarray) -> np.ndarray:
        """Running count of the pairs that an item has, from 0."""
        known = self.maybe[(hashes & self.pair_mask).astype(np.int64)]
        at = np.flatnonzero(known)
        place = np.minimum(np.searchsorted(self.pairs, hashes[at]), len(self.pairs) - 1)
        known[at] = self.pairs[place] == hashes[at]
        return np.concatenate(([0], np.cumsum(known, dtype=np.int32)))

    def _passes(self, span: int, prints: np.ndarray) -> np.ndarray:
        """Which fingerprints have a block near to that of an item of their size."""
        parts = prints.view(np.uint16).reshape(-1, BLOCKS).astype(np.int64)
        hit = np.zeros(len(prints), bool)
        for b in range(BLOCKS):
            hit |= (self.tables[span][b][parts[:, b] >> 3] >> (parts[:, b] & 7) & 1).astype(bool)
        return hit

    def candidates(self, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """First words, by document and item, of all windows within the radius of an item of their size."""
        found: dict[tuple[int, int], list[int]] = {}
        hashes, spans = pair_hashes(words), sorted(self.spans)
        if not len(hashes) or not spans:
            return found
        known = self.known_pairs(hashes)
        # documents stand one behind the other here; a window must end before the next one begins
        ends = np.repeat(bounds[1:], np.diff(bounds))
        starts = {}
        for span in spans:
            if span <= len(hashes):
                open_ = np.flatnonzero(known[span:] - known[:-span] >= KNOWN_SHARE * span)
                starts[span] = open_[open_ + span < ends[open_]]
        every = np.unique(np.concatenate([s // ROWS for s in starts.values()])) if starts else []
        for part in every:
            at = int(part) * ROWS
            total = running_bits(hashes[at : at + ROWS + spans[-1] - 1])
            for span, places in starts.items():
                own = places[np.searchsorted(places, at) : np.searchsorted(places, at + ROWS)]
                if not len(own):
                    continue
                prints = window_fingerprints(total, own - at, span)
                passed = self._passes(span, prints)
                own, prints = own[passed], prints[passed]
                doc = np.searchsorted(bounds, own, "right") - 1
                for row, print_ in zip(self.spans[span], self.prints[span]):
                    near = np.flatnonzero(np.bitwise_count(prints ^ print_) <= RADIUS)
                    for i, d in zip(own[near].tolist(), doc[near].tolist()):
                        found.setdefault((d, row), []).append(i - int(bounds[d]))
        return found

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item's and a window's multisets of shingles."""
        _, _, _, own, counts = self.items[item]
        names, times = np.unique(shingles, return_counts=True)
        both = np.union1d(own, names)
        weight = np.array([1.0 / self.weights.get(s, 1) for s in both.tolist()])
        x, y = np.zeros(len(both)), np.zeros(len(both))
        x[np.searchsorted(both, own)], y[np.searchsorted(both, names)] = counts, times
        return float((weight * np.minimum(x, y)).sum() / (weight * np.maximum(x, y)).sum())

    def best(self, item: int, shingles: np.ndarray, where: np.ndarray, names: np.ndarray) -> tuple[float, int, int]:
        """Similarity, first word and number of words of a document's best window, of those of ``SIMILARITY`` or more.
        ``where`` and ``names``: its shingles that are known. The best begins and ends with a shingle of the item."""
        _, _, _, own, counts = self.items[item]
        whole, none = self.whole[item], (0.0, 0, 0)
        at = np.searchsorted(own, self.names[names])
        at[at == len(own)] = 0
        mine = own[at] == self.names[names]
        place, at, weight = where[mine], at[mine], self.weight[names[mine]]
        # place of the shingle that a window must not hold if this one shall count: as many before as the item has
        order = np.argsort(at, kind="stable")
        rank = np.arange(len(at)) - np.searchsorted(at[order], at[order])
        times, before = counts[at], np.full(len(at), -1)
        more = np.flatnonzero(rank >= times[order])
        before[order[more]] = order[more - times[order[more]]]
        least = SIMILARITY * whole * (1 - 1e-9)
        if weight[before < 0].sum() < least:
            return none
        each = np.ones(len(shingles))
        each[where] = self.weight[names]
        total = np.concatenate(([0.0], np.cumsum(each)))
        # a window that weighs more than this, or less than ``least``, is not similar enough
        low = np.searchsorted(total[place + 1], total[place] + least * (1 - 1e-9))
        high = np.searchsorted(total[place + 1], total[place] + whole / SIMILARITY * (1 + 1e-9), "right")
        starts = np.flatnonzero(low < high)
        top, ends = 0.0, []
        i = 0
        while i < len(starts):
            first = int(starts[i])
            width = int(high[first]) - first
            rows = max(1, int(((width * width + 4 * CELLS) ** 0.5 - width) / 2))  # rows * (rows + width) cells
            some = starts[i : np.searchsorted(starts, first + rows)]
            i += len(some)
            column = np.arange(first, int(high[some].max()))
            counted = (column >= some[:, None]) & (before[column] < some[:, None])
            both = np.cumsum(weight[column] * counted, axis=1)
            union = whole + total[place[column] + 1] - total[place[some]][:, None] - both
            inside = (column >= low[some][:, None]) & (column < high[some][:, None])
            got = np.divide(both, union, out=np.zeros_like(both), where=inside)
            if got.max() > top - 1e-9:
                top = max(top, float(got.max()))
                r, c = np.nonzero(got >= max(top - 1e-9, SIMILARITY - 1e-9))
                ends += list(zip(got[r, c].tolist(), place[some[r]].tolist(), (place[column[c]] + 1).tolist()))
        best = none
        for s, a, b in ends:
            if s >= top - 1e-9:
                best = max(best, (self.similarity(item, shingles[a:b]), -a, b - a + WIDTH - 1))
        return best[0], -best[1], best[2]

    def matches(self, words: np.ndarray, bounds: np.ndarray, complete: bool = False) -> list[tuple[int, int, float, int, int]]:
        """(document, item id, similarity, first word, number of words) of a piece's documents."""
        out = []
        pairs = set(self.candidates(words, bounds))
        shingles, starts = tokens.shingles(words, bounds, WIDTH)
        where, names = self.lookup(shingles) if pairs or complete else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if complete:
            pairs |= self.seeded(where, names, starts)
        for doc, item in sorted(pairs):
            a, b = np.searchsorted(where, starts[doc : doc + 2])
            s, first, n = self.best(item, shingles[starts[doc] : starts[doc + 1]], where[a:b] - starts[doc], names[a:b])
            if s >= SIMILARITY:
                out.append((doc, self.items[item][0], s, first, n))
        for item, n, own, _, _ in self.short:
            at = np.flatnonzero(words[: len(words) - n + 1] == own[0]) if len(words) >= n else np.zeros(0, np.int64)
            for k in range(1, n):
                at = at[words[at + k] == own[k]]
            doc = np.searchsorted(bounds, at, "right") - 1
            whole = at + n <= bounds[doc + 1]
            for d, i in zip(*np.unique(doc[whole], return_index=True)):
                out.append((int(d), item, 1.0, int(at[whole][i] - bounds[d]), n))
        return out


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[DataFrame]:
    """Blocks of items whose texts have about ``limit`` bytes at most, of a size that is checked first."""
    rows = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").dropDuplicates()
    total = rows.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    n = -(-total // limit) or 1
    if n == 1:
        yield rows
        return
    n *= 2  # hashed blocks differ in size
    for i in range(n):
        yield rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)


def _search(shared, complete: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0)
            for first, _, data, off in tokens.pieces(batch.column(1)):
                rows.extend((ids[first + m[0]].as_py(), *m[1:]) for m in index.matches(*tokens.words(data, off), complete))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [ids.type, pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["key", "item_id", "similarity", "first_word", "n_words"])

    return run


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", limit: int = ITEM_BYTES, complete: bool = False) -> DataFrame:
    """(key, item_id, similarity, first_word, n_words) of all documents that hold an item; ``complete``: with the seeds'
    candidates, too."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)[key]
    out = None
    for block in _blocks(benchmark, limit):
        rows = block.orderBy("item_id", "text").collect()  # a block's size is bounded
        shared = spark.sparkContext.broadcast(Index([r["item_id"] for r in rows], [r["text"] for r in rows]))
        found = docs.select(key, "text").mapInArrow(_search(shared, complete), f"key {kind}, item_id long, similarity double, first_word long, n_words long")
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("key", key)


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, in its own columns."""
    found = written(matches(docs, benchmark).select(F.col("doc_id").alias("_found")).distinct())
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_found"]), "left_anti")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    """All matches of the benchmark in the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

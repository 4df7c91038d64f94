"""N-gram Jaccard join by PartEnum signatures (dealt operator 9).

A document's set are the distinct five-word shingles of its text. Documents with equal sets are one class,
told by a 64-bit hash of the set and its size; what follows is done for classes, so copies are never paired.

Two sets link when 100 |A & B| >= 75 |A | B|. Then they differ in at most |A| / 3 shingles (the Hamming
distance of the sets), and their sizes are in the same or in neighbouring bands, whose limits grow by 4/3. Two bands
make a level, and a set signs for its own level, one of the upper band for the next level too. For
a level the shingles' hash domain is cut into partitions; a signature is a level, a partition and the hash of the set's
content there. Of two linked sets each differing shingle spoils one partition only, so if one has more filled
partitions than they can differ in, an equal filled partition is left: they share a signature. By the same
count the first k + 1 filled partitions, k the most that they can differ in, are enough, in any order that
hangs on the signatures alone, as the first shared one is among these in both. The order takes the partitions of most
members first, as a passage that unlike documents share seldom fills those by itself.

Very frequent shingles (boilerplate) would make signatures that thousands of unlike documents share. They are left
out of the domain, which can only lessen the distance. A set with k or fewer filled partitions left is weak:
it also gives the signatures of the whole domain, which two weak sets share when they are linked; and where that
leaves too few as well, one signature for all such sets of the level. So no linked pair is lost whatever is
called frequent, and nothing is capped.

Classes that share a signature form a bucket. Each bucket has a leader, the member with the
largest share of frequent shingles, such as the text that many others are edits of (a hash breaks ties, so that
buckets of the same members agree); a leader's group is whoever shares a bucket with it,
so two linked sets are in one group at least. Leader and member are compared first: odd sketches (the
parities of the members' counts in slots, whose Hamming distance is at most the sets') rule most unlike pairs out without
loss, and the rest are verified on the sets themselves. Components of the verified links are formed. Then the
members of a group that are in different components are compared, in blocks, by their sketches, and what
remains is verified too: first the few nearest of each, which joins most, then all that are still in different
components. Pairs within a component need no look, for they can't change it.

Sets travel as 40-bit hashes: two sets of a thousand shingles are counted wrongly (by one) with a
probability below 10^-6. Rules for odd
input: null or empty text and text without words has the empty set, size 0, links with nothing and is a
component of its own; one to four words are one shingle; repeated rows and repeated ids are rows of their own, of which
``one_of_each`` keeps one a component; a class of null ids only has a null component; further columns are ignored, or kept
by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold.llm import tokens
from maskfold.llm.components import components
from maskfold.llm.shared import partitions, written

WIDTH = 5
SLOTS = (1 << 8, 1 << 15)  # least and most of an odd sketch
FIRST = 2  # pairs of a member and block that the first comparison across components tries
LOCAL = 8  # a batch reports shingles of so many of its classes
FREQUENT_SHARE = 1000  # frequent: in more than a thousandth of the documents ...
FREQUENT_LEAST = 100  # ... and in more than so many
BLOCK = 1024  # members of a group in a row, on average
HELD = 1 << 20  # signatures that a task packs at a time
HASH_BYTES = 5  # of a shingle in a shuffle
SIGNATURE_BYTES = 4  # of a signature, besides the bits that name its reducer
SEEN_BITS = 25  # of the bit map of wanted classes
_U = np.uint64
_MASK48 = _U((1 << 48) - 1)


def linked(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes a and b with so many shared members link."""
    return 100 * shared >= 75 * (a + b - shared)


def band_limits() -> np.ndarray:
    """Largest size of each band; a partner of a member of a band is in it or in a neighbour."""
    tops = [1]
    while tops[-1] < 1 << 40:
        tops.append((tops[-1] + 1) * 4 // 3)
    return np.array(tops, np.int64)


TOPS = band_limits()


def class_ids(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each set and its size."""
    n = np.diff(bounds)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tokens.mix(values ^ _U(0x51ED27)), dtype=np.uint64)))
    return tokens.mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ (n.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))


def odd_sketches(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set's odd sketch, of its size in bits, rounded up to a power of two, and the ends of their bytes."""
    n = np.diff(bounds)
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), *SLOTS)
    off = np.concatenate(([0], np.cumsum(bits)))
    slot = np.repeat(off[:-1], n) + (values & np.repeat((bits - 1).astype(np.uint64), n)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=off[-1]) & 1).astype(np.uint8), bitorder="little"), off[1:] // 8


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """A sketch (64-bit words) with fewer slots; parities of merged slots add up."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _blobs(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    off = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, n, class, sketch) of documents and (class, n) of a batch's frequent shingles."""
    for batch in batches:
        ids, sizes, classes, sketches, ends, sets, done = batch.column(0), [], [], [], [], [], set()
        for _, _, values, bounds in tokens.document_sets(batch.column(1), WIDTH):
            n, c = np.diff(bounds), class_ids(values, bounds)
            sizes.append(n)
            classes.append(c)
            bits, end = odd_sketches(values, bounds)
            ends.append(end + sum(map(len, sketches)))
            sketches.append(bits)
            sets.append(values[np.repeat([not (x in done or done.add(x)) for x in c.tolist()], n)])
        if not sizes:
            continue
        n, c = np.concatenate(sizes), np.concatenate(classes)
        yield pa.RecordBatch.from_arrays([ids, pa.array(n), _signed(c), _blobs(np.concatenate(sketches), np.concatenate(ends)), pa.array(np.zeros(len(n), bool))], names=["doc_id", "n", "class", "sketch", "is_shingle"])
        shingle = np.concatenate(sets)
        del sets, sketches
        shingle.sort()
        starts = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1]))) if len(shingle) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate((starts, [len(shingle)])))
        often = times >= LOCAL
        k = int(often.sum())
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.array(times[often].astype(np.int64)), _signed(shingle[starts[often]]), pa.nulls(k, pa.binary()), pa.array(np.ones(k, bool))], names=["doc_id", "n", "class", "sketch", "is_shingle"])


def profile(docs: DataFrame) -> DataFrame:
    """The written table of documents' classes and of frequent shingles; one pass over the texts."""
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(frame.mapInArrow(_profile, "doc_id long, n long, class long, sketch binary, is_shingle boolean"))


def frequent_shingles(table: DataFrame, docs: int) -> np.ndarray:
    """Sorted hashes of the shingles of more than a thousandth of the documents; as a set's size is bounded
    on average, there are at most some thousand times the average size of them, at any number of documents."""
    least = max(FREQUENT_LEAST, docs // FREQUENT_SHARE)
    rows = table.where("is_shingle").groupBy("class").agg(F.sum("n").alias("n")).where(F.col("n") > least).select("class").toArrow()
    return np.sort(rows.column(0).to_numpy().astype(np.int64).view(np.uint64))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


class Signer:
    """Signatures of sets, in arrays."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = frequent
        self.maybe = np.zeros(1 << 20, bool)  # most shingles are told by one look
        self.maybe[(frequent & _U((1 << 20) - 1)).astype(np.int64)] = True

    def __call__(self, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Signature hashes and the document of each, and the documents' shares of frequent shingles, up to 255."""
        n = np.diff(bounds)
        doc = np.repeat(np.arange(len(n)), n)
        hits = np.flatnonzero(self.maybe[(values & _U((1 << 20) - 1)).astype(np.int64)])
        rare = np.ones(len(values), bool)
        rare[hits[_among(values[hits], self.frequent)]] = False
        band = np.searchsorted(TOPS, n)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for step in (0, 1):
            level = band // 2 + step
            top = TOPS[2 * level + 1]
            # of a level's two bands only the upper one has partners in the next level
            signs = (n > 0) & ((band % 2 == 1) | (step == 0))
            # |A ^ B| <= |A | B| / 4, |A | B| <= (|A| + |B|) / 1.75, |B| <= top and <= 4/3 |A|
            most = (n + np.minimum(top, n * 4 // 3)) // 7
            some = rare & signs[doc]
            filled, signatures = self._domain(values[some], doc[some], top, most, level, 0)
            out.append(signatures)
            weak = (filled <= most) & signs
            if weak.any():
                of_weak = weak[doc]
                whole, signatures = self._domain(values[of_weak], doc[of_weak], top, most, level, 1)
                out.append(signatures)
                bare = np.flatnonzero(weak & (whole <= most))
                out.append((tokens.mix(level[bare].astype(np.uint64) ^ _U(0xBA4E << 32)), bare))
        share = 255 * np.bincount(doc, ~rare, len(n)) // np.maximum(n, 1)
        return np.concatenate([s for s, _ in out]), np.concatenate([d for _, d in out]), share.astype(np.uint8)

    @staticmethod
    def _domain(values, doc, top, most, level, kind):
        """Filled partitions by document, and the signatures of the first most + 1 of each."""
        docs = len(top)
        if not len(values):
            return np.zeros(docs, np.int64), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        parts = (top * 2 // 5 + 4).astype(np.uint64)
        # ascends with the hash, so a partition's members are neighbours
        part = ((values >> _U(32)) * parts[doc]) >> _U(32)
        new = np.ones(len(values), bool)
        new[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])
        starts = np.flatnonzero(new)
        content = np.add.reduceat(values * _U(0xD6E8FEB86659FD93) + _U(1), starts)
        owner, part = doc[starts], part[starts]
        filled = np.bincount(owner, minlength=docs)
        # fullest first: few unlike sets agree in a partition of several members, many in one of a single shingle
        order = np.lexsort((part, -np.diff(np.append(starts, len(values))), owner))
        rank = np.empty(len(starts), np.int64)
        rank[order] = np.arange(len(starts)) - np.concatenate(([0], np.cumsum(filled)))[owner[order]]
        take = rank <= most[owner]
        owner = owner[take]
        where = (part[take] * _U(4) + _U(kind)) * _U(1 << 10) + level[owner].astype(np.uint64)
        return filled, (tokens.mix(tokens.mix(content[take]) ^ where), owner)


def _packed(values: np.ndarray, size: int) -> np.ndarray:
    """The high bytes of each, ``size`` of them."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :size]


def _unpacked(data: pa.Buffer, size: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, size)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 8 - size :] = raw
    return out.view(">u8").ravel().astype(np.int64)


def _dealt(signatures: list, owners: list, classes: list, shares: list, parts: int) -> pa.RecordBatch:
    """Signatures packed by reducer: their hashes, and in their order the classes, shares and counts of each."""
    s, d, c = np.concatenate(signatures), np.concatenate(owners), np.concatenate(classes)
    named = np.hstack([_packed(c, 6), np.concatenate(shares)[:, None]])
    to = (s % _U(parts)).astype(np.int32)
    order = np.lexsort((d, to))
    s, d, to = s[order], d[order], to[order]
    cuts = np.searchsorted(to, np.arange(parts + 1))
    names, sigs, docs, counts = [], [], [], []
    for q in np.flatnonzero(np.diff(cuts)).tolist():
        own = d[cuts[q] : cuts[q + 1]]
        # a document's run, cut where its count would not fit
        run = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        first = run if np.diff(np.append(run, len(own))).max() < 1 << 16 else np.unique(np.concatenate((run, np.arange(0, len(own), 1 << 15))))
        names.append(q)
        sigs.append(_packed(s[cuts[q] : cuts[q + 1]], SIGNATURE_BYTES).tobytes())
        docs.append(named[own[first]].tobytes())
        counts.append(np.diff(np.append(first, len(own))).astype(np.uint16).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(sigs, pa.binary()), pa.array(docs, pa.binary()), pa.array(counts, pa.binary())], names=["part", "sigs", "docs", "counts"])


def _sign(frequent, parts: int):
    """Task: signatures of the classes of its documents, for each of ``parts`` reducers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, done = Signer(frequent.value), set()
        signatures, owners, classes, shares, held = [], [], [], [], 0
        for batch in batches:
            for _, _, values, bounds in tokens.document_sets(batch.column(0), WIDTH):
                c, n = class_ids(values, bounds), np.diff(bounds)
                # copies within a task sign once
                fresh = np.array([not (x in done or done.add(x)) for x in c.tolist()], bool) & (n > 0)
                s, d, share = signer(values[np.repeat(fresh, n)], np.concatenate(([0], np.cumsum(n[fresh]))))
                signatures.append(s)
                owners.append((d + sum(map(len, classes))).astype(np.int32))
                classes.append(c[fresh])
                shares.append(share)
                held += len(s)
                if held >= HELD:
                    yield _dealt(signatures, owners, classes, shares, parts)
                    signatures, owners, classes, shares, held = [], [], [], [], 0
        if held:
            yield _dealt(signatures, owners, classes, shares, parts)

    return run


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task of a reducer: (leader, member) of the buckets of two classes or more."""
    sigs, docs = [], []
    for batch in batches:
        for s, d, c in zip(batch.column(1), batch.column(2), batch.column(3)):
            sigs.append(_unpacked(s.as_buffer(), SIGNATURE_BYTES))
            docs.append(np.repeat(_unpacked(d.as_buffer(), 7), np.frombuffer(c.as_buffer(), np.uint16)))
    if not sigs:
        return
    s, d = np.concatenate(sigs), np.concatenate(docs)
    del sigs, docs
    order = np.argsort(s, kind="stable")
    s, d = s[order], d[order]
    same = s[1:] == s[:-1]
    keep = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    s, d = s[keep], d[keep]
    order = np.lexsort((d, s))
    s, d = s[order], d[order]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    s, d = s[keep], d[keep]
    if not len(s):
        return
    starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(s)])))
    every, place = np.unique(d, return_inverse=True)
    every, share = every >> 8, every & 255
    rank = np.empty(len(every), np.int64)
    rank[np.lexsort((tokens.mix(every.view(np.uint64)), share))] = np.arange(len(every))
    top = np.maximum.reduceat(rank[place], starts)
    by_rank = np.empty(len(every), np.int64)
    by_rank[rank] = np.arange(len(every))
    pairs = np.unique(np.repeat(by_rank[top], sizes) * len(every) + place)
    leader, member = pairs // len(every), pairs % len(every)
    other = leader != member
    yield pa.RecordBatch.from_arrays([pa.array(every[leader[other]]), pa.array(every[member[other]])], names=["leader", "member"])


def groups(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """The written table (leader, member) of shortened class ids."""
    spark = docs.sparkSession
    parts = partitions(spark)
    known = spark.sparkContext.broadcast(frequent)
    packed = docs.select("text").mapInArrow(_sign(known, parts), "part int, sigs binary, docs binary, counts binary")
    return written(packed.repartitionById(parts, "part").mapInArrow(_lead, "leader long, member long").distinct())


def _words(blob: pa.Scalar) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), np.uint64)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that sizes and sketches do not rule out."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (n, m, x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5))):
            if 4 * min(n, m) >= 3 * max(n, m):
                x, y = _words(x), _words(y)
                size = min(len(x), len(y))
                keep[i] = 7 * int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= n + m
        yield batch.filter(pa.array(keep)).select(["a", "b"])


def _short(c: Column) -> Column:
    return F.shiftrightunsigned(c, 16)


def near_leaders(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes (a, b), a < b, of leaders and members that may link."""
    one = classes.select(_short(F.col("class")).alias("leader"), F.col("class").alias("x"), F.col("n").alias("nx"), F.col("sketch").alias("sx"))
    two = classes.select(_short(F.col("class")).alias("member"), F.col("class").alias("y"), F.col("n").alias("ny"), F.col("sketch").alias("sy"))
    pairs = found.join(one, "leader").join(two, "member").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "nx", "ny", "sx", "sy")
    return pairs.mapInArrow(_near, "a long, b long").distinct()


def _sets(wanted):
    """Task: (class, set) of the documents whose class's mark is in the bit map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, done = wanted.value, set()
        for batch in batches:
            for _, _, values, bounds in tokens.document_sets(batch.column(0), WIDTH):
                c = class_ids(values, bounds)
                want = bits[_mark(c)] & np.array([not (x in done or done.add(x)) for x in c.tolist()], bool)
                n = np.diff(bounds)
                data = _packed(values[np.repeat(want, n)], HASH_BYTES)
                yield pa.RecordBatch.from_arrays([_signed(c[want]), _blobs(data.ravel(), np.cumsum(n[want]) * HASH_BYTES)], names=["class", "members"])

    return run


def _mark(c: np.ndarray) -> np.ndarray:
    return (c & _U((1 << SEEN_BITS) - 1)).astype(np.int64)


def sets_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(class, members) of the classes in the pairs. Which texts to look at is told by a bit map of fixed
    size, so that no others are shuffled; where very many are wanted it only lets more through."""
    spark = docs.sparkSession
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    at = F.col("class").bitwiseAND(F.lit((1 << SEEN_BITS) - 1))
    words = ends.groupBy(F.shiftright(at, 5).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(class & 31 as int))")).alias("bits")).toArrow()
    bits = np.zeros(1 << SEEN_BITS, bool).reshape(-1, 32)
    if words.num_rows:
        bits[words["w"].to_numpy()] = (words["bits"].to_numpy()[:, None] >> np.arange(32)) & 1
    seen = spark.sparkContext.broadcast(bits.ravel())
    return docs.select("text").mapInArrow(_sets(seen), "class long, members binary").join(ends, "class", "left_semi").dropDuplicates(["class"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column("ma"), batch.column("mb"))):
            x, y = _unpacked(x.as_buffer(), HASH_BYTES), _unpacked(y.as_buffer(), HASH_BYTES)
            both = np.concatenate((x, y))
            both.sort(kind="stable")  # two ascending runs
            keep[i] = linked(np.count_nonzero(both[1:] == both[:-1]), len(x), len(y))
        yield batch.filter(pa.array(keep)).select(["a", "b"])


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of classes whose sets link; written."""
    sets = sets_of(docs, pairs)  # dealt by class once, for both sides
    a, b = sets.select(F.col("class").alias("a"), F.col("members").alias("ma")), sets.select(F.col("class").alias("b"), F.col("members").alias("mb"))
    return written(pairs.join(a, "a").join(b, "b").select("a", "b", "ma", "mb").mapInArrow(_verify, "a long, b long"))


def _across(best: int | None):
    """Task: pairs of two blocks' members that are in different components and that their sketches do not rule
    out; of these, for each member all or the ``best`` nearest ones."""

    def block(members: list) -> tuple:
        c, label, n = (np.array([m[k] for m in members], np.int64) for k in ("class", "label", "n"))
        return c, label, n, [np.frombuffer(m["sketch"], np.uint64) for m in members]

    def by_length(sketches: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """Members of equal sketch lengths, and their sketches as one array."""
        length = np.array([len(v) for v in sketches])
        return [(rows, np.array([sketches[i] for i in rows.tolist()])) for rows in (np.flatnonzero(length == k) for k in np.unique(length))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for i in range(batch.num_rows):
                one, two = (block(batch.column(k)[i].as_py()) for k in (0, 1))
                lengths = by_length(two[3])
                for j, own in enumerate(one[3]):
                    found, apart = [], []
                    for rows, right in lengths:
                        keep = (two[1][rows] != one[1][j]) & (4 * np.minimum(two[2][rows], one[2][j]) >= 3 * np.maximum(two[2][rows], one[2][j]))
                        rows, right = rows[keep], right[keep]
                        while right.shape[1] > len(own):
                            right = right[:, : right.shape[1] // 2] ^ right[:, right.shape[1] // 2 :]
                        d = np.bitwise_count(right ^ folded(own, right.shape[1])).sum(axis=1, dtype=np.int64)
                        near = 7 * d <= two[2][rows] + one[2][j]
                        found.append(rows[near])
                        apart.append(d[near])
                    other, apart = np.concatenate(found), np.concatenate(apart)
                    if best is not None:
                        other = other[np.argsort(apart, kind="stable")[:best]]
                    xs.append(np.minimum(two[0][other], one[0][j]))
                    ys.append(np.maximum(two[0][other], one[0][j]))
            x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ys))
            pairs = np.unique(np.stack([x, y], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def across(found: DataFrame, classes: DataFrame, labels: DataFrame, best: int | None = None) -> DataFrame:
    """Pairs of classes of one group in different components that may link. A group's members are dealt to
    blocks by a hash, and any two blocks of a group meet in a task."""
    ids = classes.select("class", _short(F.col("class")).alias("member")).join(labels.withColumnRenamed("node", "class"), "class", "left")
    members = found.join(ids.withColumn("label", F.coalesce("label", "class")), "member").select("leader", "class", "label")
    sizes = members.groupBy("leader").agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = sizes.where("low != high").select("leader", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    # sketches only travel for members of groups that need a look
    dealt = written(members.join(mixed, "leader").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks"))).drop("blocks"))
    drawn = classes.join(written(dealt.select("class").distinct()), "class", "left_semi")
    full = dealt.join(drawn, "class")
    blocks = written(full.groupBy("leader", "block").agg(F.collect_list(F.struct("class", "label", "n", "sketch")).alias("members")))
    one = blocks.select("leader", F.col("block").alias("i"), F.col("members").alias("one"))
    two = blocks.select("leader", F.col("block").alias("j"), F.col("members").alias("two"))
    return one.join(two, "leader").where("i <= j").select("one", "two").mapInArrow(_across(best), "a long, b long").distinct()


def link_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profile table, (node, label) of all classes that link with another)."""
    table = profile(docs)
    rows = table.where("not is_shingle")
    classes = written(rows.where("n > 0").groupBy("class").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    found = groups(docs, frequent_shingles(table, rows.count()))
    tried, labels = None, components(verified(docs, written(near_leaders(found, classes))))
    # the nearest pairs across components join most of what is joined; what is left is then tried whole
    for best in (FIRST, None):
        rest = across(found, classes, labels, best)
        rest = written(rest if tried is None else rest.join(tried, ["a", "b"], "left_anti"))
        if rest.isEmpty():
            break
        labels, tried = _merged(labels, verified(docs, rest)), rest
    return table, labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links, by components of components."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    new = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    every = written(labels.unionByName(new))
    side = {k: every.select(F.col("node").alias(k), F.col("label").alias(f"l{k}")) for k in "ab"}
    between = links.join(side["a"], "a").join(side["b"], "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a != b").distinct()
    onward = components(between).select(F.col("node").alias("label"), F.col("label").alias("onward"))
    return written(every.join(onward, "label", "left").select("node", F.coalesce("onward", "label").alias("label")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest linked doc_id, itself included) of every document."""
    table, labels = link_components(docs)
    rows = table.where("not is_shingle").select("doc_id", F.col("n").alias("n_shingles"), F.col("class").alias("c"))
    named = rows.where("n_shingles > 0").join(labels.select(F.col("node").alias("c"), "label"), "c", "left")
    named = written(named.select("doc_id", "n_shingles", F.coalesce("label", "c").alias("label")))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    full = named.join(least, "label").select("doc_id", "n_shingles", "component_id")
    return full.union(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with the class and size of each text's set."""
    for batch in batches:
        text, classes, sizes = batch.column(batch.schema.get_field_index("text")), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, _, values, bounds in tokens.document_sets(text, WIDTH):
            classes.append(class_ids(values, bounds))
            sizes.append(np.diff(bounds))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _signed(np.concatenate(classes)), pa.array(np.concatenate(sizes))], names=["row", "id", "class", "n"])


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that another of their component stands for: one row stays, that of the smallest doc_id
    (nulls last), of rows of that id the one of the smallest class and hash. Rows of the empty set all stay.

    Which rows stay is told by ids; only rows of repeated and null ids are told apart by their sets and columns."""
    table, labels = link_components(docs)
    rows = table.where("not is_shingle").select(F.col("doc_id").alias("id"), "n", "class")
    named = written(rows.where("n > 0").join(labels.select(F.col("node").alias("class"), "label"), "class", "left").withColumn("label", F.coalesce("label", "class")))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "class")
    first = written(named.groupBy("label").agg(F.min(order).alias("first")).select("first.id", "first.class"))
    several = written(rows.groupBy("id").agg(F.count("*").alias("times")).where("times > 1 OR id IS NULL").select("id"))
    own = docs["doc_id"].cast("long")
    # the list of what goes is the shorter one; repeated and null ids go here as well
    goes = named.select("id").join(first.select("id"), "id", "left_anti").where("id IS NOT NULL").join(several, "id", "left_anti")
    out = docs.join(written(goes.select(F.col("id").alias("_goes")).distinct()), own == F.col("_goes"), "left_anti")
    if several.isEmpty():
        return out
    out = out.join(several.select(F.col("id").alias("_several")), own.eqNullSafe(F.col("_several")), "left_anti")
    split = docs.join(several, own.eqNullSafe(several["id"]), "left_semi").select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), own.alias("id"), docs["text"].alias("text"))
    kind = split.schema["row"]
    of = split.mapInArrow(_classed, T.StructType([kind]).add("id", "long").add("class", "long").add("n", "long"))
    hashed = F.xxhash64(*[F.col(f"row.`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)])
    # equal rows are put together before they are dealt by class
    single = of.where("n > 0").groupBy("id", "class").agg(F.min_by("row", hashed).alias("row"))
    single = single.join(first.select(F.col("id").alias("first_id"), "class"), "class").where(F.col("id").eqNullSafe(F.col("first_id")))
    return out.unionByName(single.select("row.*")).unionByName(of.where("n = 0").select("row.*"))


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Components of all documents."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM texts),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.s)
"""

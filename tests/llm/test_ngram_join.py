import random

import numpy as np

from maskfold.llm import ngram_join as nj
from maskfold.llm.queries import QUERIES

from .helpers import SF, documents, empty, odd_rows, shingles


def _components(rows):
    """Brute force over all pairs of different sets; (doc_id, size, component)."""
    sets = [(i, frozenset(shingles(t))) for i, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b:
                n = len(a & b)
                if 100 * n >= 75 * (len(a) + len(b) - n):
                    up[top(x)] = top(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[top(x)] = min(least.get(top(x), i), i)
    return sorted((str(i), len(s), str(least.get(top(x)) if s else i)) for x, (i, s) in enumerate(sets))


def _got(frame):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in frame.collect())


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert _got(QUERIES["op9_ngram_join"](spark, SF)) == _components(rows)


def _edited(rng, base, rate):
    return [w if rng.random() > rate else f"e{rng.randrange(10**9)}" for w in base]


def test_a_large_group_and_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(nj, "FREQUENT_LEAST", 20)  # so that the passage and the group's text count as frequent
    monkeypatch.setattr(nj, "LOCAL", 2)
    monkeypatch.setattr(nj, "BLOCK", 64)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(_edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.04])))) for i in range(250)]
    rows += [(1000 + i, " ".join([f"u{rng.randrange(10**9)}" for _ in range(rng.randint(5, 90))] + passage)) for i in range(250)]
    rows += [(2000 + i, " ".join(_edited(rng, [f"c{k}x{j}" for j in range(k % 30 + 1)], 0.03))) for i, k in enumerate([k % 60 for k in range(240)])]
    assert _got(nj.jaccard_components(documents(spark, rows))) == _components(rows)


def test_signatures_never_miss_a_link():
    rng = np.random.default_rng(2)
    frequent = np.sort(rng.integers(0, 2**63, 4000).astype(np.uint64))
    signer, missed, links = nj.Signer(frequent), 0, 0
    for _ in range(400):
        n = int(rng.integers(1, 120))
        common = rng.choice(frequent, int(rng.integers(0, n + 1)), replace=False)
        a = np.unique(np.concatenate([common, rng.integers(0, 2**63, n - len(common)).astype(np.uint64)]))
        drop = int(rng.integers(0, max(1, len(a) // 5) + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, int(rng.integers(0, len(a) // 6 + 1))).astype(np.uint64)]))
        if not len(b) or not nj.linked(len(np.intersect1d(a, b)), len(a), len(b)):
            continue
        links += 1
        s, d, _ = signer(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        missed += not set(s[d == 0].tolist()) & set(s[d == 1].tolist())
    assert links > 100 and missed == 0


def test_odd_sketches_bound_the_distance():
    rng = np.random.default_rng(4)
    for n, m in ((3, 4), (500, 700), (5000, 4000)):
        a, b = (np.unique(rng.integers(0, 2**63, k).astype(np.uint64)) for k in (n, m))
        bits, ends = nj.odd_sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        x, y = bits[: ends[0]].view(np.uint64), bits[ends[0] :].view(np.uint64)
        size = min(len(x), len(y))
        assert np.bitwise_count(nj.folded(x, size) ^ nj.folded(y, size)).sum() <= len(np.setxor1d(a, b))


def test_odd_rows(spark):
    rows = odd_rows() + [(20, "q w e r t y"), (None, "q w e r t y"), (30, "A b c d e f")]
    docs = documents(spark, rows)
    assert _got(nj.jaccard_components(docs)) == _components(rows)
    kept = nj.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 7, 8, 20]  # of the null rows one is a copy of 20
    assert nj.jaccard_components(empty(docs)).count() == 0 and nj.one_of_each(empty(docs)).count() == 0


def test_one_row_of_each_component_stays(spark):
    """Repeated rows, an id of several texts, null ids and near copies among them, against brute force."""
    rng = np.random.default_rng(6)
    base = [" ".join(f"w{rng.integers(10**6)}" for _ in range(60)) for _ in range(6)]
    near = [t.replace(t.split()[30], "other") for t in base]
    ids = [1, 2, 3, 3, 4, None, None, 9]
    rows = [(ids[rng.integers(len(ids))], (base + near)[rng.integers(12)]) for _ in range(60)]
    rows += [(None, None), (None, ""), (5, " "), (5, " "), (6, None), (3, "A b"), (3, "a B"), (None, "a b")]
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if n and 100 * n >= 75 * (len(a) + len(sets[j]) - n):
                up[top(i)] = top(j)
    groups: dict = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(top(i), []).append((d is None, d or 0))
    docs = documents(spark, rows).repartition(3)
    kept = nj.one_of_each(docs).collect()
    full = [r for r in kept if shingles(r["text"])]
    assert sorted(min(g) for i, g in groups.items() if sets[i]) == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in full)
    where = {t: top(i) for i, (_, t) in enumerate(rows)}
    assert len({where[r["text"]] for r in full}) == len(full) == sum(bool(sets[i]) for i in groups)
    assert len(kept) - len(full) == sum(not s for s in sets)

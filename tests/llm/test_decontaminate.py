import random
from collections import Counter

import numpy as np
import pyarrow as pa

from maskfold.llm import decontaminate as dc
from maskfold.llm import tokens
from maskfold.llm.queries import QUERIES

from .helpers import SF, documents, empty, odd_rows, shingles, words


def test_query_against_brute_force(spark):
    items = {r["item_id"]: shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    held = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        own = shingles(r["text"])
        held |= {(r["doc_id"], i) for i, s in items.items() if len(s & own) >= 0.75 * len(s)}
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in QUERIES["op4_decontaminate"](spark, SF).collect()}
    assert set(got) == held and all(0.75 <= s <= 1 for s in got.values())


def _corpus(spark, seed=9):
    rng = random.Random(seed)

    def text(n):
        return [f"v{rng.randrange(4000)}" for _ in range(n)]

    items = [(i, " ".join(text(rng.randint(8, 90)))) for i in range(40)] + [(90, "short item"), (91, None), (92, "")]
    rows, held = [], set()
    for d in range(300):
        own = text(rng.randint(0, 400))
        if d % 3 == 0:
            i, t = items[rng.randrange(40)]
            part = t.split()
            if d % 2 and len(part) > 40:
                part[len(part) // 2] = "changed"
            at = rng.randint(0, len(own))
            own[at:at] = part
            held.add((d, i))
        if d % 50 == 7:
            own += ["short", "item"]
            held.add((d, 90))
        rows.append((d, " ".join(own)))
    return documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), held


def test_planted_passages_in_any_number_of_blocks(spark):
    docs, items, held = _corpus(spark)
    one = {(r["doc_id"], r["item_id"]): r for r in dc.matches(docs, items).collect()}
    assert set(one) == held
    many = {(r["doc_id"], r["item_id"]) for r in dc.matches(docs, items, limit=2000).collect()}
    assert many == held
    text = {r["doc_id"]: words(r["text"]) for r in docs.collect()}
    item = {r["item_id"]: words(r["text"]) for r in items.collect()}
    for (d, i), r in one.items():
        if r["similarity"] == 1.0:
            assert text[d][r["first_word"] : r["first_word"] + r["n_words"]] == item[i]
    kept = dc.without_benchmark(docs, items)
    assert {r["doc_id"] for r in kept.collect()} == set(text) - {d for d, _ in held} and kept.columns == docs.columns


def test_windows_against_plain_sums():
    hashes = np.random.default_rng(0).integers(0, 2**63, 200).astype(np.uint64)
    total = dc.running_bits(hashes)
    for span in (5, 6, 13, 40, 199, 200):
        starts = np.arange(len(hashes) - span + 1)
        assert dc.window_fingerprints(total, starts, span).tolist() == [dc.simhash(hashes[i : i + span]) for i in starts.tolist()]


def test_blocks_find_all_prints_within_the_radius():
    rng = np.random.default_rng(1)
    text = " ".join(f"x{i}" for i in range(30))
    index = dc.Index([1], [text])
    (span, prints), = index.prints.items()
    for _ in range(2000):
        flip = rng.choice(64, int(rng.integers(0, dc.RADIUS + 1)), replace=False)
        near = np.array([int(prints[0]) ^ sum(1 << int(b) for b in flip)], np.uint64)
        assert index._passes(span, near).all()
    # and the tables rule most others out
    assert index._passes(span, rng.integers(0, 2**63, 4000).astype(np.uint64)).mean() < 0.2


def test_candidates_against_all_windows():
    """Of the windows at every word with enough known pairs, those within the radius, and no others."""
    rng = random.Random(8)
    items = [[f"i{rng.randrange(300)}" for _ in range(n)] for n in (6, 7, 20, 20, 33, 150)]
    index = dc.Index(list(range(len(items))), [" ".join(i) for i in items])
    texts = []
    for _ in range(30):
        own = [f"i{rng.randrange(300)}" if rng.random() < 0.1 else f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(300))]
        item = rng.choice(items)
        cut = rng.randrange(len(item) // 2)
        texts.append(own + [w if rng.random() < 0.95 else "other" for w in item[cut:]] + own[:50])
    words, bounds = tokens.words(*tokens.buffers(pa.array([" ".join(t) for t in texts])))
    pairs = {h for i in items for h in dc.pair_hashes(tokens.words(*tokens.buffers(pa.array([" ".join(i)])))[0]).tolist()}
    want = {}
    for d in range(len(texts)):
        own = dc.pair_hashes(words[bounds[d] : bounds[d + 1]])
        for k, item in enumerate(items):
            span = len(item) - 1
            print_ = index.prints[span][index.spans[span].index(k)]
            for i in range(len(own) - span + 1):
                window = own[i : i + span]
                if sum(h in pairs for h in window.tolist()) >= dc.KNOWN_SHARE * span and (dc.simhash(window) ^ int(print_)).bit_count() <= dc.RADIUS:
                    want.setdefault((d, k), []).append(i)
    assert index.candidates(words, bounds) == want and len(want) > 20


def test_a_window_stays_within_a_document():
    index = dc.Index([1], ["a b c d e f g h"])
    data, off = tokens.buffers(pa.array(["x a b c d", "e f g h y", "a b c d e f g h"]))
    assert [m[0] for m in index.matches(*tokens.words(data, off))] == [2]


def _plants(rng, item):
    """The item whole, cut at either end as far as the threshold allows, and with as many words changed."""
    n = len(item) - 4  # shingles
    least = -(-3 * n // 4)
    yield item
    yield item[: least + 4]
    yield item[len(item) - least - 4 :]
    yield item[(n - least) // 2 : (n - least) // 2 + least + 4]
    for at in {0, len(item) - 1, rng.randrange(len(item))}:
        yield [*item[:at], "changed", *item[at + 1 :]]


def _jaccard(a, b, weights):
    return sum(weights.get(s, 1) * n for s, n in (a & b).items()) / sum(weights.get(s, 1) * n for s, n in (a | b).items())


def _bag(text):
    return Counter(tuple(text[i : i + 5]) for i in range(len(text) - 4))


def _planted(complete):
    """Plants, those missed, and matches in texts that hold none."""
    rng = random.Random(3)
    missed, planted, wrong = [], 0, 0
    for size in [*range(6, 61), 80, 100, 150, 200] * 4:
        item = [f"i{rng.randrange(10**9)}" for _ in range(size)]
        texts, want = [], []
        for part in _plants(rng, item):
            if _jaccard(_bag(item), _bag(part), {}) >= 0.75:
                own = [f"w{rng.randrange(10**9)}" for _ in range(rng.randint(60, 100))]
                at = rng.randint(0, len(own))
                texts.append(" ".join(own[:at] + part + own[at:]))
                want.append((at, len(part), _jaccard(_bag(item), _bag(part), {})))
        clean = len(texts)
        texts.append(" ".join(own + item[: len(item) // 2]))
        got = {m[0]: m for m in dc.Index([1], [" ".join(item)]).matches(*tokens.words(*tokens.buffers(pa.array(texts))), complete)}
        planted += len(want)
        wrong += clean in got
        missed += [(size, k) for k, w in enumerate(want) if k not in got or got[k][2] < w[2] - 1e-12]
    return planted, missed, wrong


def test_recall_of_the_fingerprints():
    """Passages whole, cut to the threshold, and with words changed: what the fingerprints alone find."""
    planted, missed, wrong = _planted(False)
    assert planted > 1000 and not wrong
    assert 1 - len(missed) / planted >= 0.99
    assert not [m for m in missed if m[1] == 0]  # whole ones are all found


def test_the_complete_mode_finds_every_plant():
    planted, missed, wrong = _planted(True)
    assert planted > 1000 and not missed and not wrong


def test_best_window_against_all_windows():
    rng = random.Random(4)
    line = [f"common{i}" for i in range(9)]

    def text(n):
        return [rng.choice("abc") for _ in range(n)]

    items = [text(rng.randint(6, 20)) for _ in range(6)] + [line + [f"q{i}{k}" for k in range(rng.randint(3, 25))] for i in range(6)]
    index = dc.Index(list(range(len(items))), [" ".join(i) for i in items])
    weights = {s: 1 / n for s, n in Counter(s for i in items for s in _bag(i)).items()}
    found = 0
    for _ in range(6):
        own = text(rng.randint(0, 25)) + rng.choice(items)[rng.randint(0, 3) :] + rng.choice([line, text(5)]) + rng.choice(items) + text(rng.randint(0, 9))
        got = {m[1]: m for m in index.matches(*tokens.words(*tokens.buffers(pa.array([" ".join(own)]))), True)}
        for i, item in enumerate(items):
            windows = ((_jaccard(_bag(item), _bag(own[a:b]), weights), -a, b - a) for a in range(len(own)) for b in range(a + 5, len(own) + 1))
            s, a, n = max((round(s, 9), a, n) for s, a, n in windows)
            if s >= 0.75:
                found += 1
                assert (round(got[i][2], 9), got[i][3], got[i][4]) == (s, -a, n)
            else:
                assert i not in got
    assert found > 6


def test_odd_rows(spark):
    docs, items, _ = _corpus(spark)
    odd = documents(spark, odd_rows()).withColumnRenamed("label", "item_id")
    assert dc.matches(odd, items).count() == 0
    assert dc.without_benchmark(odd, empty(items)).count() == len(odd_rows())
    assert dc.matches(empty(docs), items).count() == 0
    same = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "item_id long, text string")
    got = dc.matches(odd, same).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in got) == [(0, 1), (0, 2), (7, 1), (7, 1), (7, 2), (7, 2)]

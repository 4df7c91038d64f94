import hashlib

import numpy as np
import pytest

from maskfold.llm import fingerprints as fp
from maskfold.llm.queries import QUERIES

from .helpers import SF, documents, empty, odd_rows, shingles


def _brute(rows):
    """rows by descending id, nulls last, then text."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for k, (i, t) in enumerate(ordered):
        third, follows = len(t) // 3, ordered[(k + 1) % len(ordered)][1]
        out.append((i, len(t), t[: len(t) - third] + follows[:third], follows))
    return out


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_fingerprints"](spark, SF).collect()}
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert len(got) == len(rows)
    errors = []
    text = dict(rows)
    for i, n, edited, follows in _brute(rows):
        assert got[i]["n_chars"] == n
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text[i]), shingles(edited)
        errors.append(got[i]["near_edited"] - len(a & b) / max(1, len(a | b)))
        assert 0 <= got[i]["near_next"] <= 1
    assert abs(np.mean(errors)) < 0.01 and np.percentile(np.abs(errors), 99) < 0.1


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = fp.compare_with_edited(docs).collect()
    assert len(got) == len(odd_rows())
    expected = sorted((str(i), n, hashlib.sha256(e.encode()).hexdigest()) for i, n, e, _ in _brute([(i, t or "") for i, t in odd_rows()]))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == expected
    by = {r["doc_id"]: r for r in got}
    assert by[5]["fingerprint"] == by[6]["fingerprint"] != by[4]["fingerprint"]
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == by[3]["fingerprint"] == ""
    assert fp.compare_with_edited(empty(docs)).count() == 0


def test_short_texts_agree_by_chance_only(spark):
    docs = documents(spark, [(i, f"word{i}") for i in range(60)])
    near = [r["near_next"] for r in fp.compare_with_edited(docs).collect()]
    assert max(near) < 0.1


@pytest.mark.parametrize("likeness", [0.2, 0.5, 0.8, 0.95])
def test_estimates_are_unbiased(likeness):
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        both = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64) * np.uint64(2))
        k = int(round(len(both) * (1 - likeness) / 2))
        a, b = np.sort(both[k:]), np.sort(np.concatenate([both[:k], both[2 * k :]]))
        # k members are in b only, k in a only
        bits = fp.bins_of(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        same = (np.mean(bits[0] == bits[1]) - 1 / 16) / (15 / 16)
        errors.append(same - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.03

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from maskfold.llm import fill_middle as fm
from maskfold.llm.queries import QUERIES

from .helpers import SF, documents, empty, odd_rows


def _expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op12_fill_middle"](spark, SF).collect()
    assert len(got) == len(docs) and {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        n, form, a, m, output = _expected(r["doc_id"], docs[r["doc_id"]])
        assert tuple(r)[1:] == (n, form, a, m, _sha(output), _sha(docs[r["doc_id"]] or ""))


MARKED = [(20 + i, t) for i, t in enumerate(["<P>", "a<S>b", "x <M>", "<", "<P", "P><S", "<<P<S<M", "S>P>M>", "ü<P", "👩‍👧 <" * 9])]


def test_odd_rows(spark):
    rows = odd_rows() + MARKED + [(100 + i, t) for i, (_, t) in enumerate(MARKED)]
    docs = documents(spark, rows).withColumnRenamed("label", "output")  # a clashing name
    got = fm.restored(fm.fill_in_middle(docs)).collect()
    want = sorted((str(i), *_expected(i, t), t or "") for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in got) == want
    assert fm.fill_in_middle(docs).columns == ["doc_id", "lang", "source", "n_chars", "text", *fm.RESULT]
    assert fm.restored(fm.fill_in_middle(empty(docs))).count() == 0


@pytest.mark.parametrize("unit", ["chars", "words"])
def test_segments_of_long_texts(monkeypatch, unit):
    """Texts of many segments and pieces are cut where the text as a whole is."""
    monkeypatch.setattr(fm, "SEGMENT", 7)
    monkeypatch.setattr(fm, "PIECE", 16)
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab é😀\t") for _ in range(rng.choice([0, 1, 3, 8, 40, 300]))) for _ in range(60)]
    split = {"chars": list, "words": lambda t: re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", t)}[unit]
    cuts = []
    for t in texts:
        units = split(t)
        lead = len(t) - sum(map(len, units))
        units = [t[:lead]] * bool(lead) + units
        cuts.append((units, *sorted((rng.randint(0, len(units)), rng.randint(0, len(units))))))
    low, high = (np.array([c[k] for c in cuts]) for k in (1, 2))
    got = fm.three_pieces(fm.Units.of(pa.array(texts, pa.large_string()), unit), low, high)
    assert fm.Units.of(pa.array(texts, pa.large_string()), unit).of_texts().tolist() == [len(c[0]) for c in cuts]
    for role, part in zip(got, (lambda u, a, b: u[:a], lambda u, a, b: u[a:b], lambda u, a, b: u[b:])):
        assert role.to_pylist() == ["".join(part(*c)) for c in cuts]


def test_words_as_units(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 30))) for i in range(80)] + [(200, "  lead a b "), (201, "   ")]
    got = fm.restored(fm.fill_in_middle(documents(spark, rows), unit="words")).collect()
    assert all(r["restored"] == r["text"] for r in got)
    assert all(r["n"] == len((r["text"] or "").split()) + r["text"].startswith(" ") for r in got)
    moved = [r for r in got if r["form"] == "psm"]
    assert moved and all(len(r["output"].split("<S>")[0][3:].split()) in (r["prefix_chars"], 0) for r in moved)

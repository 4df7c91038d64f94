import itertools
import re

import pytest
from pyspark.sql import functions as F

from maskfold.llm import filter_audit as fa
from maskfold.llm.queries import QUERIES

from .helpers import SF, documents, empty, odd_rows

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _fails(rows):
    """The failing filters of each (doc_id, text)."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        hit = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)}
        hit |= {"D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        out.append({f for f, bad in hit.items() if bad})
    return out


def _brute(rows, labels):
    """rows: (doc_id, text, part); labels: (doc_id, quality, toxic)."""
    fails = _fails([r[:2] for r in rows])
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    out = {}
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                failing, only = sum(f in x[1] for x in own), sum(x[1] == {f} for x in own)
                lost = [sum(i in ids for i, _ in gone) for ids in (good, toxic)]
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), only, *lost]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def _rows(frame):
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in frame.collect()}
    assert frame.columns == ["part", "filter_order", "step", *COLUMNS]
    return got


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    want = _brute([(r["doc_id"], r["text"], r["lang"]) for r in docs], [(r["doc_id"], r["quality"], r["toxic"]) for r in labels])
    assert _rows(QUERIES["op11_filter_audit"](spark, SF)) == want
    assert len(want) == 600 * 4


LABELS = [(1, 1, 0), (5, 0, 1), (5, 1, None), (6, None, 1), (7, 1, 1), (7, 1, 1), (None, 1, 1), (99, 1, 1), (31, 1, 0), (33, None, None)]
MORE = [(30, "A B C #"), (31, "A B C #"), (32, "A B C #"), (33, " ".join(f"w{i}" for i in range(120))), (None, "A B C #"), (None, None), (34, "x " * 300), (34, "y " * 300)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_odd_rows(spark, labels):
    rows = odd_rows() + MORE
    docs = documents(spark, rows).withColumnsRenamed({"label": "done", "n_chars": "part"})  # clashing names
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, "").otherwise("de"))
    parts = [(i, t, None if i is None else "de" if i % 3 == 2 else "") for i, t in rows]
    parts = [(i, t, "de" if i is None else p) for i, t, p in parts]
    assert _rows(fa.audit(docs, labels)) == _brute(parts, LABELS)
    assert _rows(fa.audit(docs, empty(labels))) == _brute(parts, [])
    assert fa.audit(empty(docs), labels).count() == 0


def test_survivors_of_a_prefix(spark, labels):
    rows = odd_rows() + MORE
    found = fa.relations(documents(spark, rows), labels)
    fails = _fails(rows)
    for prefix in ("", "A", "DB", "ECA", "ABCDE"):
        n = fa.survivors(found, prefix).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        assert n == sum(not f & set(prefix) for f in fails)
    found.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("audit_")]


def test_other_filters(spark, labels):
    """The audit takes any conditions over the text, and the filter of copies with them."""
    docs = documents(spark, MORE)
    got = fa.audit(docs, labels, {"S": F.char_length("text") < 10}).collect()
    assert {(r["filter_order"], r["step"]): (r["kept"], r["removed"]) for r in got} == {("SE", 1): (3, 5), ("SE", 2): (3, 0), ("ES", 1): (6, 2), ("ES", 2): (3, 3)}


def test_joins_shuffle_nothing(spark, labels):
    found = fa.relations(documents(spark, MORE), labels)
    plan = fa.survivors(found, "AB").join(found.of("C"), "id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    found.drop()
    assert "hashpartitioning(id" not in plan
    found = fa.relations(documents(spark, MORE), labels)
    tried = found.rows.withColumn("next", F.lit(1)).join(found.failing.withColumnsRenamed({"id": "i", "filter": "f"}), (F.col("id") == F.col("i")) & (F.col("next") - F.col("f") == 0), "left_semi")
    plan = tried._jdf.queryExecution().executedPlan().toString()
    found.drop()
    assert "hashpartitioning(id" not in plan and "LeftSemi" in plan

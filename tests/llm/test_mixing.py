import pytest

from maskfold.llm import mixing
from maskfold.llm.queries import QUERIES

from .helpers import SF, documents, empty, odd_rows, words


def _targets(sizes):
    """Weights 1, 2, 3 in order; caps at three times the size; the excess reshared until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def _check(rows, got, near):
    """rows: (doc_id, source, text)."""
    sizes, taken, size = {}, {}, {}
    for i, s, t in rows:
        size[i] = len(words(t))
        sizes[s] = sizes.get(s, 0) + size[i]
    target, source = _targets(sizes), {i: s for i, s, _ in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(target[s], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= near * max(1, target[s]) + 20, (s, taken[s], target[s])


def test_query(spark):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op5_mixing"](spark, SF).collect()
    assert len(got) == len(rows)
    _check(rows, got, 0.1)
    again = QUERIES["op5_mixing"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_hot_null_and_capped_sources(spark):
    rows = [(i, "hot", "w " * (i % 40 + 1)) for i in range(900)] + [(1000 + i, "tiny", "a b") for i in range(5)]
    rows += [(2000 + i, None, "c d e " * (i % 9)) for i in range(300)] + [(3000, "void", None), (3001, "void", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    _check(rows, got, 0.02)
    out = mixing.mixed(docs).groupBy("doc_id").count().collect()
    copies = {r["doc_id"]: r["copies"] for r in got if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in out} == copies


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    assert mixing.mix(docs).count() == len(odd_rows())
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(empty(docs)).count() == 0 and mixing.mixed(empty(docs)).count() == 0
    assert mixing.mix(docs.where("text is null")).collect()[0]["taken"] == 0


def test_each_search_round_is_a_short_plan(spark, monkeypatch):
    """The plans of all rounds stay in the driver's memory: none of them repeats the work of another."""
    from maskfold.llm import mixing

    docs = spark.createDataFrame([(i, "abc"[i % 3], "w " * (1 + i * i % 23)) for i in range(60)], "doc_id long, source string, text string")
    sizes = docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"), mixing._chance([docs["doc_id"], docs["text"]]).alias("chance"))
    state = mixing.solve(sizes, mixing.source_targets(sizes))
    joins, plain = [], mixing.written

    def counted(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return plain(df)

    monkeypatch.setattr(mixing, "written", counted)
    assert {r["source"] for r in mixing.settle(sizes, state).collect()} == set("abc")
    assert joins and max(joins) <= 2

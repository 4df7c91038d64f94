"""Filter interaction audit (dealt operator 11): what each filter of a chain does in every order.

Each filter has a failing-id relation: the ids of the rows that it fails, a part (folder) of its own in a stored table.
Joins with these relations give the figures of every prefix of every order: a left-anti join of the rows still there
with a filter's relation are the survivors, a left-semi join the rows that it removes at that place. The survivors of a
prefix do not depend on the order of its filters, so each set of filters is worked on once (32 sets and 80 steps of
five filters, not 120 orders of five steps), and the survivors of sets of k filters are made from those of k - 1; all
filters that come next are tried in one join. Redundant rows of a step are those its filter fails less those it removes
there.

The tables are narrow and bucketed by id, and rows of one id meet in one bucket, so the joins shuffle nothing; the
texts are read once. An id stands for the rows of equal ``doc_id``,
text and part, which any filter treats alike and which are counted by their number: 128 bits of a hash of the three,
so that no two of 10^11 ids are mistaken for each other.

Rules for odd input: null text reads as empty, a null part as the empty string; repeated rows count each; a null
``doc_id`` has no labels and fails no copy filter, as it is not larger than any; an id with several labels is good or
toxic where one of them says so; an empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskfold.functions.search import table
from maskfold.llm.shared import partitions, removed_at_exit, shared_folder, written

#: Fixed values of the contract: the filters' limits and patterns.
BLANKS = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 100, 80, 10
SYMBOLS = r"[#$%&*|]"
COPIES = "E"


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure of the filters that look at a text alone."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * distinct.cast("long") < LEAST_DISTINCT_PERCENT * n.cast("long"),
        "C": 100 * capitals.cast("long") > MOST_CAPITALS_PERCENT * F.char_length(text).cast("long"),
        "D": text.rlike(SYMBOLS),
    }


@dataclass
class Relations:
    """``rows`` (id, done, part, n, good, bad), and ``failing`` (id, filter), whose parts are the relations of the filters,
    by their place among ``filters``. Both are tables, which ``drop`` forgets."""

    rows: DataFrame
    failing: DataFrame
    filters: list[str]
    tables: list[str]

    def of(self, name: str) -> DataFrame:
        """The failing ids of a filter."""
        return self.failing.where(F.col("filter") == self.filters.index(name)).select("id")

    def drop(self) -> None:
        for name in self.tables:
            self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _bucketed(df: DataFrame, dealt: bool, tables: list[str], parts: list[str] | None = None) -> DataFrame:
    """``df`` as a table bucketed by id; ``dealt``: its partitions are those buckets already."""
    spark, n, name = df.sparkSession, partitions(df.sparkSession), f"audit_{uuid.uuid4().hex}"
    path = removed_at_exit(spark, f"{shared_folder(spark)}/{name}")
    out = (df if dealt else df.repartition(n, "id")).write.bucketBy(n, "id").option("path", path)
    (out.partitionBy(*parts) if parts else out).saveAsTable(name)
    tables.append(name)
    return spark.table(name)


def relations(docs: DataFrame, labels: DataFrame, conditions: dict[str, Column] | None = None) -> Relations:
    """The rows' and filters' tables; ``conditions``: failure by filter, as columns over ``text``. The filter of
    copies is added: it fails a text that is also a smaller ``doc_id``'s."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conditions = conditions or text_conditions(F.col("text"))
    digest = F.unhex(F.substring(F.sha2("text", 256), 1, 32))
    own = docs.select("doc_id", text.alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    keys = own.select("doc_id", "part", digest.alias("digest"), *[c.alias(f"fails_{f}") for f, c in conditions.items()])
    number = F.when(F.col("doc_id").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("doc_id").cast("string")))
    key = F.concat(number, F.lit("|"), F.hex("digest"), F.lit("|"), F.col("part"))
    grouped = keys.groupBy(*keys.columns).agg(F.count("*").alias("n"))
    base = written(grouped.withColumn("id", F.unhex(F.md5(key))))
    named = base.where(F.col("doc_id").isNotNull())
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    filters = [*conditions, COPIES]
    fails = F.array_compact(F.array(*[F.when(F.col(f"fails_{f}"), k) for k, f in enumerate(conditions)]))
    copies = named.join(first, ["digest", "doc_id"], "left_anti").select("id", F.lit(len(conditions)).alias("filter"))
    failing = base.select("id", F.explode(fails).alias("filter")).unionByName(copies)
    judged = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[(F.max(F.col(c) == 1)).alias(c) for c in ("quality", "toxic")])
    rows = base.join(judged, "doc_id", "left").select(
        "id", F.lit(0).alias("done"), "part", "n", *[F.when(F.col(c), F.col("n")).otherwise(0).cast("long").alias(to) for c, to in (("quality", "good"), ("toxic", "bad"))],
    )
    tables: list[str] = []
    return Relations(_bucketed(rows, False, tables), _bucketed(failing, False, tables, ["filter"]), filters, tables)


def survivors(found: Relations, prefix: str) -> DataFrame:
    """The rows that pass every filter of ``prefix``."""
    rows = found.rows
    for f in prefix:
        rows = rows.join(found.of(f), "id", "left_anti")
    return rows


def _sums(rows: DataFrame, *keys: Column | str) -> DataFrame:
    return rows.groupBy("done", "part", *keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def prefix_counts(found: Relations) -> tuple[DataFrame, DataFrame]:
    """(done, part, n, good, bad) of the survivors of every set of filters but the full one, and (done, part, filter,
    n, good, bad) of the rows that each further filter removes from them; ``done`` has a bit for each filter."""
    k, level, left, removed = len(found.filters), found.rows, [], []
    failing = found.failing.select(F.col("id").alias("failing_id"), F.col("filter").alias("failing_filter"))
    bit = F.expr("shiftleft(1, next)")
    # rows of an id are in one bucket: the filter is compared within, not dealt by
    meets = (F.col("id") == F.col("failing_id")) & (F.col("next") - F.col("failing_filter") == 0)
    for size in range(k):
        tried = level.withColumn("next", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).where(F.col("done").bitwiseAND(bit) == 0)
        left.append(written(_sums(level)))
        removed.append(written(_sums(tried.join(failing, meets, "left_semi"), "next")))
        if size < k - 1:
            # a set is made once, by its last filter
            below = tried.where(F.col("done") < bit).join(failing, meets, "left_anti")
            level = _bucketed(below.withColumn("done", F.col("done") + bit).drop("next"), True, found.tables)
    name = F.element_at(F.array(*[F.lit(f) for f in found.filters]), F.col("next") + 1)
    return _all(left), _all(removed).withColumn("filter", name).drop("next")


def audit(docs: DataFrame, labels: DataFrame, conditions: dict[str, Column] | None = None) -> DataFrame:
    """A row for each part, order of the filters and step; see ``op11_filter_audit``."""
    found = relations(docs, labels, conditions)
    try:
        left, removed = prefix_counts(found)
    finally:
        found.drop()
    letters = found.filters
    k, full = len(letters), (1 << len(letters)) - 1
    bit = {f: 1 << i for i, f in enumerate(letters)}
    steps = [("".join(order), i + 1, f, sum(bit[x] for x in order[:i])) for order in permutations(letters) for i, f in enumerate(order)]
    names = ("filter_order", "step", "filter", "done")
    step = F.explode(table([dict(zip(names, s)) for s in steps], "array<struct<filter_order:string,step:int,filter:string,done:int>>"))
    whole = left.where("done = 0").select("part", step.alias("s")).select("part", "s.*")
    # a set of m filters stands before another one in m! (k - 1 - m)! orders
    weights = F.array(*[F.lit(math.factorial(m) * math.factorial(k - 1 - m)) for m in range(k)])
    own = F.element_at(F.create_map(*[x for f in letters for x in (F.lit(f), F.lit(full - bit[f]))]), F.col("filter"))
    of_filter = removed.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("done") == 0, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("done") == own, F.col("n")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("n") * F.get(weights, F.bit_count("done"))).alias("shapley"),
    )
    lost = removed.select("part", "done", "filter", F.col("n").alias("gone"), F.col("good").alias("good_lost"), F.col("bad").alias("toxic_lost"))
    out = whole.join(left.select("part", "done", F.col("n").alias("open")), ["part", "done"], "left")
    out = out.join(lost, ["part", "done", "filter"], "left").join(of_filter, ["part", "filter"], "left")
    n = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("open", "gone", "failing", "unique_fails", "good_lost", "toxic_lost", "shapley")}
    return out.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), (n["open"] - n["gone"]).alias("kept"), n["gone"].alias("removed"),
        (n["failing"] - n["gone"]).alias("redundant"), *[n[c].alias(c) for c in ("unique_fails", "good_lost", "toxic_lost", "shapley")],
    )


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for five filters."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM texts),
judged AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM split LEFT JOIN judged USING (doc_id)),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, substr(filter_order, i, 1) AS f, substr(filter_order, 1, i - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
figures AS (
  SELECT part, filter_order, step, f,
         sum(n) FILTER (translate(fails, before || f, '') = fails) AS kept,
         sum(n) FILTER (contains(fails, f) AND translate(fails, before, '') = fails) AS removed,
         sum(n) FILTER (contains(fails, f) AND translate(fails, before, '') <> fails) AS redundant,
         sum(n) FILTER (fails = f) AS unique_fails,
         sum(good) FILTER (contains(fails, f) AND translate(fails, before, '') = fails) AS good_lost,
         sum(toxic) FILTER (contains(fails, f) AND translate(fails, before, '') = fails) AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM figures
"""

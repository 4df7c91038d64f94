"""Mixing sources to target weights by entropy balancing (dealt operator 5, native).

Each source has a target number of words. Among all document rates between 0 and ``MOST`` copies that
meet a source's target, the ones with the least relative entropy to "one copy each" are the
exponential tilts ``min(MOST, exp(l * size / scale))``; the source's multiplier l maximises a concave dual,
whose gradient is the target less the words that the rates take. Newton iterations find l for
all sources at once: each is one aggregation over the counts of documents by source and size, kept in
a bracket that is halved where a step would leave it. Sums are fixed-point, so reruns agree exactly.

Rates become whole copies ``floor(rate + v + d / size^2)``, v a fixed pseudo-random number of the row, and d the
one number of its source up to which the copies' words stay within the target; it is found by histograms
of the points where a copy appears, refined in three rounds. Short documents give way first. What is left of
the target is filled twice, by the same search among the documents that fit into it.

The work is on narrow frames; a hot source is pre-aggregated, and the state of the iterations, one
row for each source, is joined as a table whose size the planner knows. The order of the sources by
code point takes one sort of those rows.

Rules for odd input: null or empty text has size 0 and no words to take; null sources are one source,
last in order; equal rows get equal copies; further columns are ignored or, by ``mixed``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from maskfold.llm.shared import written

MOST = 3
WORD = r"[^\x20\x09-\x0D]+"
CLOSE = 1e-6  # of a target; what is left the copies make good
ITERATIONS = 60
BINS = 4096
ROUNDS = 3
FILLS = 2
_FIXED = float(1 << 20)


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than blank, tab to carriage return; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _exact_sum(x: Column) -> Column:
    """A sum in fixed point: the same in whatever order the parts come."""
    return F.sum(F.round(x * _FIXED).cast("decimal(28,0)")).cast("double") / _FIXED


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, least, scale by source, of a frame (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, 1, ...; a target stops at ``MOST`` times
    its source's size. Resharing the excess by weight ends where one level l gives every source
    min(its limit, l * weight), which prefix sums over the sources by limit / weight find at once."""
    by = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
        F.sum((F.col("size") * F.col("size")).cast("decimal(38,0)")).alias("squares"),
    )
    order = W.orderBy(F.asc_nulls_last("source"))
    by = by.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    limit = F.col("source_size") * MOST
    by = by.withColumn("limit", limit).withColumn("at", limit / F.col("weight"))
    below = W.orderBy("at", F.asc_nulls_last("source")).rowsBetween(W.unboundedPreceding, -1)
    rest = W.orderBy("at", F.asc_nulls_last("source")).rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    by = by.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(below), F.lit(0))) / F.sum("weight").over(rest))
    # the first source whose limit is not reached sets the level
    by = by.withColumn("level", F.min(F.when(F.col("level") <= F.col("at"), F.struct("at", "level"))).over(everything)["level"])
    target = F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight"))
    return by.select(
        "source", "source_size", F.coalesce(target, F.col("limit").cast("double")).alias("target"), "least",
        F.try_divide(F.col("squares").cast("double"), F.col("source_size")).alias("scale"),
    )


def _rate(size: Column, multiplier: Column, scale: Column) -> Column:
    tilt = F.coalesce(F.exp(F.least(multiplier * size / scale, F.lit(50.0))), F.lit(1.0))
    return F.least(F.lit(float(MOST)), tilt)


def solve(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``multiplier``, the dual's solution by source."""
    counts = written(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")))
    share = F.log(F.try_divide(F.col("target"), F.col("source_size"))) * F.col("scale") / F.col("least")
    state = written(
        targets.select(
            "*",
            F.lit(0.0).alias("multiplier"),
            F.least(F.lit(0.0), share).alias("low"),
            (F.log(F.lit(float(MOST))) * F.col("scale") / F.col("least")).alias("high"),
            F.lit(False).alias("done"),
        )
    )
    for _ in range(ITERATIONS):
        live = state.where(~F.col("done") & (F.col("source_size") > 0)).select(F.col("source").alias("s"), "multiplier", "scale")
        rated = counts.join(live, _same(counts["source"], live["s"])).select("s", "size", "n", "scale", _rate(F.col("size"), F.col("multiplier"), F.col("scale")).alias("rate"))
        words = F.col("n") * F.col("size") * F.col("rate")
        sums = rated.groupBy("s").agg(
            _exact_sum(words).alias("taken"),
            _exact_sum(F.when(F.col("rate") < MOST, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("curve"),
        )
        step = state.join(sums, _same(state["source"], sums["s"]), "left")
        gap = F.col("target") - F.col("taken")
        low = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("high")).otherwise(F.col("multiplier"))
        newton = F.col("multiplier") + F.try_divide(gap, F.col("curve"))
        moved = F.when((F.col("curve") > 0) & (newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        flat = (high - low) <= 1e-12 * F.greatest(F.abs(low), F.abs(high))
        done = F.col("done") | F.col("taken").isNull() | (F.abs(gap) <= CLOSE * F.col("target")) | flat
        state = written(
            step.select(
                *[c for c in targets.columns],
                F.when(done, F.col("multiplier")).otherwise(moved).alias("multiplier"),
                F.when(done, F.col("low")).otherwise(low).alias("low"),
                F.when(done, F.col("high")).otherwise(high).alias("high"),
                done.alias("done"),
            )
        )
        if state.where(~F.col("done")).isEmpty():
            break
    return state.drop("low", "high", "done")


def _chance(row: list[Column]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(20251), *row), 11) / float(1 << 53)


def _rated(sizes: DataFrame, state: DataFrame) -> DataFrame:
    """(s, size, rate, chance) of the documents with words."""
    s = state.select(F.col("source").alias("s"), "multiplier", "scale")
    rate = _rate(F.col("size"), F.col("multiplier"), F.col("scale"))
    return sizes.where("size > 0").join(s, _same(sizes["source"], s["s"])).select("s", "size", rate.alias("rate"), "chance")


def _points(size: Column, chance: Column, rate: Column) -> Column:
    """For each possible copy the number d from which on it is taken."""
    return F.transform(F.sequence(F.lit(1), F.lit(MOST)), lambda k: (k - rate - chance) * size * size)


def _search(rated: DataFrame, goals: DataFrame, rounds: int) -> DataFrame:
    """``goals`` (source, goal, floor, cap and further columns) with shift and words: the largest shift found up to which a
    source's points d above the floor, of documents of at most ``cap`` words, take no more words than its goal, and
    these words; null where it has no such points. Histograms close in on where the running sum passes the goal."""
    events = rated.select("s", "size", F.explode(_points(F.col("size"), F.col("chance"), F.col("rate"))).alias("d"))
    own = goals.columns
    bounds = goals.select(F.col("source").alias("rs"), "floor", "cap")
    some = events.join(bounds, _same(events["s"], bounds["rs"])).where("d > floor and size <= cap")
    ends = some.groupBy("s").agg(F.min("d").alias("low"), (F.max("d") + F.greatest(F.abs(F.max("d")), F.lit(1.0)) * 1e-9).alias("high"))
    search = goals.join(ends, _same(goals["source"], ends["s"]), "left").select(*own, "low", "high", F.lit(0).cast("long").alias("base"), F.col("low").isNull().alias("all"))
    for _ in range(rounds):
        search = written(search)
        r = search.where(~F.col("all")).select(F.col("source").alias("rs"), "low", "high", "goal", "base", "cap")
        at = events.join(r, _same(events["s"], r["rs"])).where("d >= low and d < high and size <= cap")
        bin_ = F.least(F.floor(F.try_divide(F.col("d") - F.col("low"), F.col("high") - F.col("low")) * BINS), F.lit(BINS - 1)).cast("int")
        sums = at.groupBy("rs", bin_.alias("bin")).agg(F.sum("size").alias("words"), F.min("d").alias("first"), F.max("d").alias("last"), F.first("goal").alias("to"), F.first("base").alias("from"))
        upto = F.col("from") + F.sum("words").over(W.partitionBy("rs").orderBy("bin"))
        over = F.when(F.col("upto") > F.col("to"), F.struct("bin", "first", "last", (F.col("upto") - F.col("words")).alias("before")))
        found = sums.withColumn("upto", upto).groupBy("rs").agg(F.min(over).alias("hit"), F.sum("words").alias("rest"))
        # a source whose events all fit is done
        fits = F.col("all") | F.col("hit").isNull()
        # past the last point by a step that a double of its size can take
        after = F.col("hit.last") + F.greatest(F.abs(F.col("hit.last")), F.lit(1e-9)) * 1e-12
        search = search.join(found, _same(search["source"], found["rs"]), "left").select(
            *own,
            F.when(fits, F.col("low")).otherwise(F.col("hit.first")).alias("low"),
            F.when(fits, F.col("high")).otherwise(after).alias("high"),
            F.when(F.col("all"), F.col("base")).when(fits, F.col("base") + F.coalesce("rest", F.lit(0))).otherwise(F.col("hit.before")).alias("base"),
            fits.alias("all"),
        )
    below = F.col("low") - F.greatest(F.abs(F.col("low")), F.lit(1e-9)) * 1e-12
    return search.select(*own, F.when(F.col("all"), F.col("high")).otherwise(below).alias("shift"), F.col("base").alias("words"))


def settle(sizes: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with ``steps``: a copy is taken where for one of them its document has at most ``cap`` words and its
    d is at most ``shift``. The first step stops before the copy that would pass the target; each of ``FILLS``
    further ones fills the gap that is left from the documents that fit into it.

    The documents' rates are written once, and every round of a search is one short plan over them: the plans of all
    rounds stay in the driver's memory for as long as the application's status does."""
    rated = written(_rated(sizes, state))
    no_step, lowest = F.array().cast("array<struct<cap:double,shift:double>>"), F.lit(float("-inf"))
    steps = state.withColumns({"steps": no_step, "floor": lowest, "goal": F.col("target"), "cap": F.lit(float("inf"))})
    for k in range(FILLS + 1):
        found = _search(rated, steps, ROUNDS if not k else ROUNDS - 1)
        left = F.col("goal") - F.coalesce("words", F.lit(0))
        one = F.struct("cap", "shift")
        steps = written(
            found.select(
                *state.columns,
                F.when(F.col("shift").isNull(), F.col("steps")).otherwise(F.concat("steps", F.array(one))).alias("steps"),
                F.greatest("floor", F.coalesce("shift", lowest)).alias("floor"),
                left.alias("goal"),
                left.alias("cap"),
            )
        )
    return steps.drop("floor", "goal", "cap")


def _copies(size: Column, chance: Column, rate: Column, steps: Column) -> Column:
    """How many of the ``_points`` a step takes; without words one copy."""
    taken = F.filter(_points(size, chance, rate), lambda d: F.exists(steps, lambda t: (size <= t["cap"]) & (d <= t["shift"])))
    return F.when(size > 0, F.size(taken)).otherwise(1)


def balance(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents' (doc_id, source, size, chance), written, and the solved state by source."""
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _chance([F.col("doc_id"), F.col("text")]).alias("chance")))
    state = solve(sizes, source_targets(sizes))
    return sizes, settle(sizes, state)


def _decided(sizes: DataFrame, state: DataFrame) -> DataFrame:
    """``sizes`` with its source's size and target, and ``copies``."""
    s = state.select(F.col("source").alias("_s"), "source_size", "target", "multiplier", "scale", "steps")
    rate = _rate(F.col("size"), F.col("multiplier"), F.col("scale"))
    out = sizes.join(s, _same(sizes["source"], s["_s"]), "left")
    return out.withColumn("copies", _copies(F.col("size"), F.col("chance"), rate, F.col("steps"))).drop("_s", "multiplier", "scale", "steps")


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with every document repeated by its number of copies, in the columns of ``docs``."""
    _, state = balance(docs)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    narrow = row.select("row", F.col("row.source").alias("source"), word_count(F.col("row.text")).alias("size"), _chance([F.col("row.doc_id"), F.col("row.text")]).alias("chance"))
    out = _decided(narrow, state).withColumn("copies", F.coalesce("copies", F.lit(1)))
    return out.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document."""
    sizes, state = balance(docs)
    out = _decided(sizes, state)
    return out.select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"),
        (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("copies").cast("int").alias("copies"),
    )


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))

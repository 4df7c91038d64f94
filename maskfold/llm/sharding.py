"""Sharding by extendible hashing (dealt operator 7, native).

A document's bit string is the hash of its ``doc_id`` (60 bits of MD5). A bucket is a prefix of the bits; the empty
prefix holds all rows. Only a bucket of more than ``limit`` bytes is split on one more bit, until every bucket fits or
holds one row; the buckets that are not split are the shards. No task sees a bucket's rows: one aggregation by a prefix
some bits longer than needed gives the sizes of all shorter prefixes, ``STEP`` bits of them at a time, and only where
such a fine bucket is still too large the next bits are aggregated for its rows alone.

Rows that are still together after all bits of the id, copies of one id that hold more than the limit, are written
once more with a random number each, whose bits follow those of the id; as the numbers are stored, every later pass over
the rows, and every task that is run again, sees the same ones.

The directory maps fine prefixes, as integers, to the depth and size of their shard; it is a written table, and is looked up
by an equi-join: a broadcast at most while it has few rows, else both sides are sorted.

Rules for odd input: null text has 0 bytes; a row of more bytes than the limit is a shard of its own;
null ids hash as the empty string; an empty table has no shards. Columns named ``shard`` or
``shard_bytes`` of the input are replaced; all others are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskfold.llm.shared import written

SHARD_BYTES = 32 << 20
QUERY_BYTES = 64 << 10  # of the registered query, so that tables of some megabytes are split as well
BITS = 60
EXTRA = 3  # bits of the first aggregation beyond the least possible depth
STEP = 8
BROADCAST_ROWS = 1 << 17  # of the directory, of some 80 bytes each in a broadcast


def id_bits(doc_id: Column) -> Column:
    """60 bits of the id's hash, as a long."""
    own = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(own, 1, 15), 16, 10).cast("long")


def _prefix(bits: Column, depth: int | Column) -> Column:
    return F.call_function("shiftright", bits, F.lit(BITS) - depth)


def _name(prefix: Column, depth: Column) -> Column:
    """The prefix as text, a character for each bit."""
    return F.when(depth == 0, "").otherwise(F.lpad(F.bin(prefix), depth, "0"))


def _joined(side: DataFrame) -> DataFrame:
    """``side``, a written table, for an equi-join. The planner goes by the size of its files, which can be a tenth of what a
    broadcast of its rows takes, so a table of more than ``BROADCAST_ROWS`` rows is sorted and merged."""
    return side if side.count() <= BROADCAST_ROWS else side.hint("merge")


def _hits(nodes: DataFrame, top: int, depth: int, limit: int, above: DataFrame | None) -> DataFrame:
    """(prefix, depth, shard_bytes) for every prefix of ``depth`` bits: the shard that holds it, nulls where it is itself too
    large. ``nodes`` has its bytes and rows; ``above`` is the same for the prefixes of ``top`` bits, which are all too
    large where it is None, unless they are the empty one. Only the prefixes below one of ``top`` bits meet."""
    names = [f"p{d}" for d in range(top, depth)]
    cuts = [F.call_function("shiftright", F.col("prefix"), F.lit(depth - d)).alias(f"p{d}") for d in range(top, depth)]
    nodes = nodes.select("prefix", "bytes", "n", *cuts).repartition(F.col(names[0]))
    found = [] if above is None else [F.col("hit")]
    if above is not None:
        hit = F.when(F.col("depth").isNotNull(), F.struct("depth", "shard_bytes"))
        nodes = nodes.join(_joined(above).select(F.col("prefix").alias(names[0]), hit.alias("hit")), names[0], "left")
    nodes = nodes.sortWithinPartitions(*names)  # serves the windows of all depths
    sums = [("bytes", "n", depth)]
    for d in reversed(range(top + (top > 0), depth)):
        own = Window.partitionBy(*names[: d - top + 1])
        nodes = nodes.withColumns({f"b{d}": F.sum("bytes").over(own), f"n{d}": F.sum("n").over(own)})
        sums.insert(0, (f"b{d}", f"n{d}", d))
    for size, n, d in sums:
        found.append(F.when((F.col(size) <= limit) | (F.col(n) == 1), F.struct(F.lit(d).alias("depth"), F.col(size).alias("shard_bytes"))))
    return nodes.select("prefix", F.coalesce(*found).alias("hit")).select("prefix", "hit.depth", "hit.shard_bytes")


def directory(rows: DataFrame, limit: int) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """For each round its depth and a table (fine, depth, shard_bytes) of the fine prefixes whose bucket is in a shard
    found in it, with that shard's depth; and the prefixes of all ``BITS`` bits that are too large. ``rows`` has bits and bytes."""
    total = rows.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    top, depth = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + EXTRA)
    found: list[tuple[int, DataFrame]] = []
    while True:
        fine = rows.groupBy(_prefix(F.col("bits"), F.lit(depth)).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        # the sizes of the prefixes some bits shorter each time, and then, from the shortest on, the shards among them
        cuts, nodes = [*range(depth, top, -STEP), top], [written(fine)]
        for longer, shorter in zip(cuts, cuts[1:-1]):
            cut = F.call_function("shiftright", F.col("prefix"), F.lit(longer - shorter))
            nodes.append(written(nodes[-1].groupBy(cut.alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))))
        hits = None
        for k in reversed(range(len(nodes))):
            hits = written(_hits(nodes[k], cuts[k + 1], cuts[k], limit, hits))
        found.append((depth, hits.where("depth IS NOT NULL").withColumnRenamed("prefix", "fine")))
        left = hits.where("depth IS NULL").select(F.col("prefix").alias("open"))
        if depth == BITS or left.isEmpty():
            return found, left
        rows = rows.join(_joined(left), _prefix(F.col("bits"), F.lit(depth)) == F.col("open"), "left_semi")
        top, depth = depth, min(BITS, depth + STEP)


def _looked_up(rows: DataFrame, rounds: list[tuple[int, DataFrame]]) -> DataFrame:
    """``rows`` (row, bits) with hit, the shard of each and its bytes; null where the directory has none."""
    for k, (depth, table) in enumerate(rounds):
        side = _joined(table).select(F.col("fine").alias(f"fine{k}"), F.struct("depth", "shard_bytes").alias(f"hit{k}"))
        rows = rows.join(side, _prefix(F.col("bits"), F.lit(depth)) == F.col(f"fine{k}"), "left")
    rows = rows.select("row", "bits", F.coalesce(*[F.col(f"hit{k}") for k in range(len(rounds))]).alias("hit"))
    name = _name(_prefix(F.col("bits"), F.col("hit.depth")), F.col("hit.depth"))
    return rows.select("row", F.when(F.col("hit").isNotNull(), F.struct(name.alias("shard"), "hit.shard_bytes")).alias("hit"))


def sharded(docs: DataFrame, limit: int = SHARD_BYTES, size: Column | None = None) -> DataFrame:
    """``docs`` with ``shard`` (its bits, empty for the one shard of a small table) and the shard's bytes. ``size``: the
    bytes of a row, else those of its text."""
    size = F.coalesce(F.octet_length("text") if size is None else size, F.lit(0)).cast("long")
    bits = id_bits(F.col("doc_id"))
    rounds, large = directory(docs.select(bits.alias("bits"), size.alias("bytes")), limit)
    kept = [c for c in docs.columns if c not in ("shard", "shard_bytes")]
    rows = docs.select(F.struct(*[docs[c] for c in kept]).alias("row"), bits.alias("bits"), size.alias("bytes"))
    out = _looked_up(rows.select("row", "bits"), rounds)
    if large.isEmpty():
        return out.select("row.*", F.col("hit.shard").alias("shard"), F.col("hit.shard_bytes").alias("shard_bytes"))
    out = out.where(F.col("hit").isNotNull()).select("row", F.col("hit.shard").alias("shard"), F.col("hit.shard_bytes").alias("shard_bytes"))
    again = rows.join(_joined(large), F.col("bits") == F.col("open"), "left_semi")
    again = written(again.select("row", "bytes", F.col("bits").alias("id_bits"), F.floor(F.rand() * F.lit(float(1 << 53))).cast("long").alias("drawn")))
    # the directory of the second bit string is made for each such id by itself, below all bits of the id
    return out.unionByName(_split_copies(again, limit)).select("row.*", "shard", "shard_bytes")


def _split_copies(rows: DataFrame, limit: int) -> DataFrame:
    """(row, shard, shard_bytes) of the rows (row, bytes, id_bits, drawn) of ids that are too large. As the drawn bits are
    uniform, a number of bits that leaves a quarter of the limit on average is taken at once for each id, and a bucket
    that is still too large is split further."""
    size = written(rows.groupBy("id_bits").agg(F.sum("bytes").alias("b")))
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("b") / F.lit(limit / 4.0)))).cast("int")
    open_, done = rows.join(_joined(size).select("id_bits", depth.alias("depth")), "id_bits"), []
    while True:
        open_ = written(open_.withColumn("prefix", F.call_function("shiftright", F.col("drawn"), F.lit(53) - F.col("depth"))))
        buckets = written(open_.groupBy("id_bits", "depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.count("*").alias("n")))
        fits = (F.col("shard_bytes") <= limit) | (F.col("n") == 1) | (F.col("depth") == 53)
        met = open_.join(_joined(buckets), ["id_bits", "depth", "prefix"])
        name = F.concat(_name(F.col("id_bits"), F.lit(BITS)), _name(F.col("prefix"), F.col("depth")))
        done.append(met.where(fits).select("row", name.alias("shard"), "shard_bytes"))
        open_ = met.where(~fits).select("row", "bytes", "id_bits", "drawn", (F.col("depth") + 1).alias("depth"))
        if open_.isEmpty():
            break
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """One folder ``shard=<bits>`` for each shard, written by one task each."""
    out = sharded(docs, limit).withColumn("shard", F.concat(F.lit("s"), F.col("shard")))
    out.repartition(F.col("shard")).write.partitionBy("shard").parquet(path)


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """doc_id, bytes, shard and shard_bytes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    return sharded(sizes, QUERY_BYTES, F.col("bytes")).select("doc_id", "bytes", "shard", "shard_bytes")


def _sql(limit: int) -> str:
    """The same in DuckDB, for ids that are not repeated beyond the limit."""
    return f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
         lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)), {BITS}, '0') AS bits
  FROM documents),
buckets AS (
  SELECT doc_id, bytes, bits, 0 AS depth, '' AS shard,
         sum(bytes) OVER () AS shard_bytes, count(*) OVER () AS n FROM rows
  UNION ALL
  SELECT doc_id, bytes, bits, depth + 1, substr(bits, 1, depth + 1),
         sum(bytes) OVER (PARTITION BY substr(bits, 1, depth + 1)), count(*) OVER (PARTITION BY substr(bits, 1, depth + 1))
  FROM buckets WHERE shard_bytes > {limit} AND n > 1 AND depth < {BITS})
SELECT doc_id, CAST(bytes AS BIGINT) AS bytes, shard, CAST(shard_bytes AS BIGINT) AS shard_bytes
FROM buckets WHERE NOT (shard_bytes > {limit} AND n > 1 AND depth < {BITS})
"""


SQL = _sql(QUERY_BYTES)

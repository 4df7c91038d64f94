"""Dense row index and exact seeded sample, without moving a table into one task.

``row_number().over(Window.orderBy(k))`` has no partition key, so Spark plans it on a single
partition. ``dense_index`` gives the same 1..n numbering by order statistics: a small random sample of
the keys gives bounds, which become literals of the plan; a narrow pass counts the rows of each range between
bounds; and a row's number is its place in its own range, from a window partitioned by range, plus the rows
of all ranges before. The rows travel once, by range, and nothing is written.

As the bounds are literals and the place depends on the keys only, a task that is run again, and every later
use of the result, numbers its rows the same way, provided the input gives the same rows again; an input that may not
(``rand``, ids by partition) is stored first. Bounds only decide how evenly ranges are filled, never the numbers.

A key that holds many rows is split by a hash of the row. Rows that are equal in all columns cannot be told apart
by any order: a mass of them is not moved at all, but counted, and made again from the count.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskfold.functions.names import col
from maskfold.functions.search import place_among, plain, table

_R = "__mf_range"
_OUT = "__mf_index"
_N = "__mf_n"
_OFF = "__mf_off"
_H = "__mf_hash"
RANGES = 4  # for each shuffle partition, so that ranges that share one even out
SAMPLES = 32  # keys drawn for each range
BLOCK = 1 << 16  # equal rows that one task makes again at a time


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``. Where none is named a temporary
    folder serves on a local master; on a cluster, whose executors would not see it, that is refused."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        folder = tempfile.mkdtemp(prefix="maskfold-local-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialised(df: DataFrame) -> DataFrame:
    """``df`` computed once, now, as a Parquet table in the shared folder, and read back from there. The table
    goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/maskfold-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    names = [f"c{i}" for i in range(len(df.columns))]  # any column names are kept, whatever Parquet takes
    df.toDF(*names).write.parquet(path)
    return spark.read.schema(T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, df.schema.fields)])).parquet(path).toDF(*df.columns)


def steady(df: DataFrame) -> DataFrame:
    """``df`` itself where its plan gives the same rows each time it runs, else stored."""
    return df if df._jdf.queryExecution().analyzed().deterministic() else materialised(df)


def _col(k: str | Column) -> Column:
    return col(k) if isinstance(k, str) else k


def row_hash(df: DataFrame, seed: int | None = None) -> Column:
    """64-bit hash of a whole row; columns with maps, which cannot be hashed, by their JSON text. Another ``seed``
    gives an independent hash."""

    def has_map(t: T.DataType) -> bool:
        inner = [f.dataType for f in t.fields] if isinstance(t, T.StructType) else [t.elementType] if isinstance(t, T.ArrayType) else []
        return isinstance(t, T.MapType) or any(map(has_map, inner))

    parts = [F.to_json(F.struct(col(f.name))) if has_map(f.dataType) else col(f.name) for f in df.schema.fields]
    return F.xxhash64(*([] if seed is None else [F.lit(seed)]), *parts)


def total_order(df: DataFrame, keys: Sequence[str | Column]) -> list[Column]:
    """``keys`` then a hash of the whole row: different rows that tie on ``keys`` are ordered the
    same way on every run."""
    return [_col(k) for k in keys] + [row_hash(df)]


def dense_index(
    df: DataFrame,
    keys: Sequence[str | Column],
    name: str = "row_index",
    num_partitions: int | None = None,
) -> DataFrame:
    """Append ``name`` = 1..n in the order of ``keys`` (ascending, nulls first), like
    ``row_number`` over an unpartitioned window. Pass a total order (see ``total_order``) when the
    result must not depend on how ties are broken."""
    return dense_index_counted(df, keys, name, num_partitions)[0]


def dense_index_counted(
    df: DataFrame,
    keys: Sequence[str | Column],
    name: str = "row_index",
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """``dense_index`` plus the row count. ``num_partitions``: the number of ranges, else ``RANGES`` for each of the
    session's shuffle partitions."""
    df = steady(df)
    ranges = num_partitions or RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.count()
    order = [_col(k) for k in keys]
    bounds, heavy = _bounds(df, order, ranges, total)
    if heavy:  # a key of many rows is split by the rows' hash, of 63 bits so that each has a successor
        order = [*order, F.shiftrightunsigned(row_hash(df), 1)]
        bounds, heavy = _bounds(df, order, ranges, total, hashed=True)
    tagged = df.withColumn(_R, _range_of(df, order, bounds))
    sizes = {r[_R]: r["count"] for r in tagged.groupBy(_R).count().collect()}  # a row for each range
    before = [0, *accumulate(sizes.get(r, 0) for r in range(len(bounds) + 1))]
    start = F.get(table(before, "array<bigint>"), F.col(_R))
    masses = [bounds.index(h) + 1 for h in heavy]
    moved = tagged.where(~F.col(_R).isin(masses)) if masses else tagged
    place = F.row_number().over(Window.partitionBy(_R).orderBy(*order))
    out = moved.withColumn(_OUT, start + place).drop(_R)
    if masses:
        out = out.unionByName(_masses(tagged.where(F.col(_R).isin(masses)), df.columns, start))
    return out.select(*[col(c) for c in df.columns if c != name], F.col(_OUT).alias(name)), total


def _bound_keys(df: DataFrame, order: Sequence[Column]) -> list[Column]:
    """The keys in the form that bounds compare: days and instants as numbers, which have no limits of Python's."""
    types = [f.dataType for f in df.select(*order).schema.fields]
    return [F.unix_date(c) if isinstance(t, T.DateType) else F.unix_micros(c) if isinstance(t, T.TimestampType) else c for c, t in zip(order, types)]


def _range_of(df: DataFrame, order: Sequence[Column], bounds: Sequence[tuple]) -> Column:
    """The number of a row's range: how many of the bounds are at most its key."""
    keys = [c.alias(f"k{i}") for i, c in enumerate(_bound_keys(df, order))]
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    return place_among(F.struct(*keys), schema, [{f"k{i}": plain(v) for i, v in enumerate(b)} for b in bounds])


def _bounds(df: DataFrame, order: Sequence[Column], ranges: int, total: int, hashed: bool = False) -> tuple[list[tuple], list[tuple]]:
    """Ascending bounds that cut the rows into about equal ranges, and those of them that are a key of more rows than a range
    should have. ``hashed``: the last key is a hash, and such a key gets a range of its own. ``SAMPLES`` keys a
    range reach the driver. Keys of nested and other unusual types give one range."""
    keys = df.select(*[c.alias(f"k{i}") for i, c in enumerate(_bound_keys(df, order))])
    simple = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.TimestampNTZType)
    if not all(isinstance(f.dataType, simple) for f in keys.schema.fields) or total <= 1 or ranges <= 1:
        return [], []
    wanted = SAMPLES * ranges
    drawn = keys if total <= wanted else keys.where(F.rand(7) < wanted / total)
    values = [tuple(_plain(v) for v in r) for r in drawn.orderBy(*keys.columns).collect()]
    step = max(1, len(values) // ranges)
    picked = values[step::step]
    heavy = list(dict.fromkeys(a for a, b in zip(picked, picked[1:]) if a == b)) if step > 3 else []
    bounds = list(dict.fromkeys(picked))
    for h in heavy if hashed else []:
        after = (*h[:-1], h[-1] + 1)
        at = bounds.index(h) + 1
        if bounds[at : at + 1] != [after]:
            bounds.insert(at, after)
    return bounds, heavy


_NAN = float("nan")


def _plain(v):
    """A value that equals its equals: bytes for binaries, one NaN."""
    return bytes(v) if isinstance(v, bytearray) else _NAN if v != v else v


def _masses(rows: DataFrame, columns: list[str], start: Column) -> DataFrame:
    """Rows of ranges that hold (but for clashes of hashes) copies of one row each: counted, numbered as groups, and
    made again in blocks that are dealt to all tasks."""
    spark = rows.sparkSession
    groups = rows.groupBy(_R, *[col(c) for c in columns]).agg(F.count(F.lit(1)).alias(_N))
    line = Window.partitionBy(_R).orderBy(F.xxhash64(*[col(c) for c in columns]))
    groups = groups.withColumn(_OFF, start + F.sum(_N).over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col(_N))
    return _copies(groups, int(spark.conf.get("spark.sql.shuffle.partitions")), _OUT).select(*[col(c) for c in columns], _OUT)


def _copies(groups: DataFrame, partitions: int, name: str) -> DataFrame:
    """Each row as many times as its count, with numbers from its offset on."""
    blocks = groups.withColumn("__mf_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col(_N) - 1, F.lit(BLOCK)))))
    first = F.col("__mf_block") * BLOCK
    inside = F.explode(F.sequence(first + 1, F.least(first + BLOCK, F.col(_N))))
    return blocks.repartition(partitions).withColumn("__mf_nth", inside).withColumn(name, F.col(_OFF) + F.col("__mf_nth"))


def sample_key(seed: int, columns: Sequence[str]) -> Column:
    """Seeded pseudo-random order key: md5 of ``seed|c1|c2|...`` (null as empty text)."""
    parts = [F.lit(str(seed))] + [F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def _edge(hist: DataFrame, bucket: str, need: int) -> tuple[str, int] | None:
    """The bucket of a histogram (at most 65,536 rows) in which the running count reaches ``need``, and how many of its
    rows are needed."""
    upto = F.sum(_N).over(Window.orderBy(bucket))
    found = hist.withColumn("upto", upto).where(F.col("upto") >= need)
    row = found.agg(F.min_by(F.struct(F.col(bucket).alias("b"), (F.lit(need) - F.col("upto") + F.col(_N)).alias("need")), F.col(bucket))).collect()[0][0]
    return None if row is None else (row["b"], row["need"])


def sample_exact(
    df: DataFrame,
    n: int,
    columns: Sequence[str] | None = None,
    seed: int = 42,
    num_partitions: int | None = None,
) -> DataFrame:
    """Exactly ``n`` rows without replacement (``ValueError`` when there are fewer): those with the ``n`` smallest seeded
    hash keys ``md5(seed|c1|c2|...)`` (ties by a hash of the row), so the same seed gives the same rows
    under any partitioning.

    The result is a filter on the input by the n-th smallest key, which narrow passes find: a histogram of the keys'
    first four hex digits (an order-preserving bucket) names the bucket that holds it; of that bucket alone, a
    65,536th of the rows, the keys are counted and stored; the next four digits name a part of it,
    whose keys are few. Nothing is sorted, and no row is written. Rows that tie at that key are only looked at
    where not all of them are needed.
    """
    cols = list(columns or df.columns)
    if n <= 0:
        return df.limit(0)
    df = steady(df)
    h = sample_key(seed, cols)
    first, second = F.substring(F.col(_H), 1, 4), F.substring(F.col(_H), 5, 4)
    keys = df.select(h.alias(_H))
    edge = _edge(keys.groupBy(first.alias("b")).agg(F.count(F.lit(1)).alias(_N)), "b", n)
    if edge is None:
        raise ValueError(f"a sample of {n} rows was asked of a table with fewer rows")
    near = materialised(keys.where(first == edge[0]).groupBy(_H).agg(F.count(F.lit(1)).alias(_N)))
    part, need = _edge(near.groupBy(second.alias("b")).agg(F.sum(_N).alias(_N)), "b", edge[1])
    for row in near.where(second == part).orderBy(_H).collect():  # a 2^32th of the rows' keys
        if row[_N] >= need:
            break
        need -= row[_N]
    last, ties = row[_H], row[_N]
    if ties == need:
        return df.where(h <= F.lit(last))
    return df.where(h < F.lit(last)).unionByName(_some_ties(df.where(h == F.lit(last)), need))


def _some_ties(rows: DataFrame, need: int) -> DataFrame:
    """So many of rows of one key: groups of equal rows in the order of their hash, the last one cut. The groups are
    counted, so that a mass of copies is not moved."""
    groups = rows.groupBy(*[col(c) for c in rows.columns]).agg(F.count(F.lit(1)).alias(_N))
    upto = F.sum(_N).over(Window.orderBy(row_hash(rows)).rowsBetween(Window.unboundedPreceding, 0))
    taken = groups.withColumn(_OFF, upto - F.col(_N)).where(F.col(_OFF) < need).withColumn(_N, F.least(F.col(_N), F.lit(need) - F.col(_OFF)))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _copies(taken, partitions, "__mf_nr").select(*[col(c) for c in rows.columns])

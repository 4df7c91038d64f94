"""Sinks: CSV, pipe-delimited text and Parquet under one output folder, published together."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from maskfold.sources.store import Store

FORMATS = ("csv", "pipe", "parquet")
MODES = ("overwrite", "error", "errorifexists")
SEPARATORS = {"csv": ",", "pipe": "|"}
MANIFEST = "_manifest.json"


def write_one(
    df: DataFrame, fmt: str, path: str, single_file: bool = False, mode: str = "overwrite"
) -> None:
    """One output: ``csv`` (header), ``pipe`` (header, ``|``) or ``parquet``. ``single_file``: the file is
    written by all tasks and its parts are put together on the store, so that no task reads the whole output."""
    if fmt == "parquet":
        if single_file:
            _write_one_parquet(df, path, mode)
        else:
            df.write.mode(mode).parquet(path)
    elif fmt in SEPARATORS:
        writer = _write_one_text if single_file else _write_text
        writer(df, path, SEPARATORS[fmt], mode)
    else:
        raise ValueError(f"unknown output format {fmt!r}; use one of {FORMATS}")


def _write_text(df: DataFrame, path: str, sep: str, mode: str, header: bool = True) -> None:
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def _write_one_text(df: DataFrame, path: str, sep: str, mode: str) -> None:
    """A folder with one text file: its header, then the parts of all tasks in the order of the partitions."""
    spark = df.sparkSession

    def parts(store: Store, work: str) -> tuple[list[str], str]:
        _write_text(df, f"{work}/rows", sep, "error", header=False)
        _write_text(spark.createDataFrame([], df.schema).coalesce(1), f"{work}/header", sep, "error")
        return store.files(f"{work}/header", "part-") + store.files(f"{work}/rows", "part-"), ".csv"

    _write_joined(spark, path, mode, parts, Store.joined)


def _write_one_parquet(df: DataFrame, path: str, mode: str) -> None:
    """A folder with one Parquet file: the row groups of all tasks' files, in the order of the partitions."""

    def parts(store: Store, work: str) -> tuple[list[str], str]:
        df.write.mode("error").parquet(f"{work}/rows")
        found = store.files(f"{work}/rows", "part-")
        return found, f".{found[0].rpartition('/')[2].partition('.')[2]}"

    spark, store = df.sparkSession, Store(df.sparkSession, path)
    if mode not in ("append", "ignore") or not store.exists(path):
        _write_joined(spark, path, mode, parts, Store.joined_parquet)
    elif mode == "append":
        more = f"{path.rstrip('/')}._more-{uuid.uuid4().hex}"
        try:
            _write_joined(spark, more, "error", parts, Store.joined_parquet)
            for file in store.files(more, "part-"):
                store.rename(file, f"{path.rstrip('/')}/{file.rpartition('/')[2]}")
        finally:
            store.remove(more)


def _write_joined(spark: SparkSession, path: str, mode: str, parts: Callable, joined: Callable) -> None:
    """Puts the parts that ``parts(store, folder)`` writes together and then in the place of ``path``. It returns the
    files and the suffix of the whole one."""
    store = Store(spark, path)
    if mode != "overwrite" and store.exists(path):
        raise FileExistsError(f"{path} is there already")
    work = f"{path.rstrip('/')}._parts-{uuid.uuid4().hex}"
    try:
        files, suffix = parts(store, work)
        joined(store, files, f"{work}/whole/part-00000-{uuid.uuid4().hex}{suffix}")
        store.touch(f"{work}/whole/_SUCCESS")
        store.remove(path)
        store.rename(f"{work}/whole", path)
    finally:
        store.remove(work)


def write_outputs(
    df: DataFrame,
    out_dir: str,
    formats: Sequence[str] = FORMATS,
    single_file: bool = False,
    mode: str = "overwrite",
) -> dict[str, str]:
    """Write ``df`` once per format under ``out_dir/<format>`` and return the paths.

    All formats are first written to a folder of this run. Only when all of them are whole they are published:
    an earlier run's formats are set aside, the new ones take their places by renames, a manifest names them,
    and what was set aside goes. A run that fails before leaves the earlier output as it was, and one that
    fails while it publishes puts it back. ``df`` may be read from the folder that is replaced. Modes that would
    keep or add to an earlier run's rows are refused.

    The scrub plan runs once: with Parquet among the formats it is written first and the text
    formats are re-read from it (a lineage cut in shared storage that survives lost executors);
    otherwise the result is persisted, filled by the first write, for the others. The remaining
    writes are independent jobs and run concurrently.
    """
    formats = list(dict.fromkeys(formats))
    for fmt in formats:
        if fmt not in FORMATS:
            raise ValueError(f"unknown output format {fmt!r}; use one of {FORMATS}")
    if mode not in MODES:
        # appending to or keeping one of three formats would leave them with different rows
        raise ValueError(f"unknown output mode {mode!r}; use one of {MODES}")
    spark, base = df.sparkSession, out_dir.rstrip("/")
    store = Store(spark, base)
    if mode != "overwrite":
        there = [f for f in formats if store.exists(f"{base}/{f}")]
        if there:
            raise FileExistsError(f"{base} holds {', '.join(there)} already")
    run = uuid.uuid4().hex
    staged = f"{base}/_staged-{run}"
    try:
        _write_staged(df, staged, formats, single_file)
        _publish(store, base, staged, formats, run)
    finally:
        store.remove(staged)
    return {fmt: f"{base}/{fmt}" for fmt in formats}


def _write_staged(df: DataFrame, staged: str, formats: list[str], single_file: bool) -> None:
    def write_rest(src: DataFrame, rest: list[str]) -> None:
        if not rest:
            return
        with ThreadPoolExecutor(max_workers=len(rest)) as pool:
            for future in [pool.submit(write_one, src, f, f"{staged}/{f}", single_file) for f in rest]:
                future.result()

    if len(formats) == 1:
        write_one(df, formats[0], f"{staged}/{formats[0]}", single_file)
    elif "parquet" in formats:
        write_one(df, "parquet", f"{staged}/parquet", single_file)
        written = df.sparkSession.read.parquet(f"{staged}/parquet")
        write_rest(written, [f for f in formats if f != "parquet"])
    else:
        held = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_one(held, formats[0], f"{staged}/{formats[0]}", single_file)
            write_rest(held, formats[1:])
        finally:
            held.unpersist()


def _publish(store: Store, base: str, staged: str, formats: list[str], run: str) -> None:
    """Puts the staged formats in the place of all formats of an earlier run, or leaves things as they were."""
    aside, moved, placed = f"{base}/_replaced-{run}", [], []
    try:
        for fmt in FORMATS:
            if store.exists(f"{base}/{fmt}"):
                store.rename(f"{base}/{fmt}", f"{aside}/{fmt}")
                moved.append(fmt)
        for fmt in formats:
            store.rename(f"{staged}/{fmt}", f"{base}/{fmt}")
            placed.append(fmt)
        store.write_text(f"{base}/{MANIFEST}", json.dumps({"run": run, "formats": formats}))
    except Exception:
        for fmt in placed:
            store.remove(f"{base}/{fmt}")
        for fmt in moved:
            store.rename(f"{aside}/{fmt}", f"{base}/{fmt}")
        raise
    finally:
        store.remove(aside)


def read_manifest(spark: SparkSession, out_dir: str) -> dict | None:
    """The run and formats that ``out_dir`` holds; None where no run was published there."""
    store, path = Store(spark, out_dir), f"{out_dir.rstrip('/')}/{MANIFEST}"
    return json.loads(store.read_text(path)) if store.exists(path) else None

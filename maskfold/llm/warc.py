"""WARC archives by way of a chunked record table (dealt operator 13).

A payload travels as rows (record, chunk number, up to ``CHUNK`` bytes). Tasks read them as a stream and carry what
a record needs from row to row: its SHA-1 so far, its bytes so far and the compressor of its gzip member. Neither
writing nor reading allocates a record as a whole, however large it is; memory is a chunk and an Arrow batch.

Writing takes three steps. Chunk rows are digested where they are read. The narrow table of digests decides the types:
of the records of equal payloads (by length and SHA-256) that have ``least`` bytes or more, the one of the
smallest page id is the response, and the others revisit it. Then the chunk rows of the responses are dealt by
record, put in order and written, each task to files of its own; revisits have no payload and are written from the
narrow table. A record is one gzip member; each file begins with a ``warcinfo`` record. A task that is run again writes
other files, and only those that the returned table names belong to the archive, so a lost executor leaves no
record twice.

Reading streams each file into chunk rows, with running byte count and digest, and fails on a payload that does not
have the digest of its header.

Files are written and read through ``pyarrow.fs``, by the folder's URI (local or mounted, ``hdfs://``, ``s3://``, ``gs://``).

Rules for odd input: null html reads as empty; a null page id is larger than any other, a null url smaller, and both
headers are left out; of equal rows one is the response and the others revisit it, under its own id; control characters
of a url are percent-encoded; an empty table gives an archive without files. Columns other than page_id, url and html are
not written.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskfold.llm.shared import partitions, remove, removed_at_exit, shared_folder, written
from maskfold.llm.spread import hot_keys, spread_join

CHUNK = 32 << 10
FILE_BYTES = 1 << 30
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
#: Fixed values of the file format.
END = b"\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
MOST_HEADER = 1 << 20

RECORD = "record string, type string, page_id long, url string, refers string, digest string, payload_bytes long"
MANIFEST = "file string, records long, bytes long"
CHUNKS = "record string, type string, page_id long, url string, refers string, digest string, chunk_no long, last boolean, payload_bytes long, data binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def filesystem(uri: str):
    """The file system of a folder's URI, and the path within."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri)


# the chunked record table


def _pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, body, content, row_id): content is the payload's SHA-256, row_id names rows of equal columns."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.cast("binary").alias("body"))
    rows = rows.withColumn("content", F.unhex(F.sha2("body", 256)))
    null = F.lit("-")
    name = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), null), F.coalesce(F.concat(F.lit("u"), F.col("url")), null), F.hex("content"))
    return rows.withColumn("row_id", F.md5(name.cast("binary")))


def chunk_rows(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``pages`` as rows of at most ``chunk`` bytes; those of a record follow each other in order. An empty payload is one
    row of no bytes."""
    rows = _pages(pages)
    pieces = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / F.lit(float(chunk))).cast("int"))
    rows = rows.withColumn("pieces", pieces).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    data = F.substring(F.col("body"), F.col("chunk_no") * chunk + 1, F.lit(chunk))
    last = F.col("chunk_no") == F.col("pieces") - 1
    return rows.select("row_id", "page_id", "url", "content", F.col("chunk_no").cast("long").alias("chunk_no"), last.alias("last"), data.alias("data"))


def digests(chunks: DataFrame) -> DataFrame:
    """A row for each record of a chunk table whose records' rows follow each other: its columns, payload_bytes, digest."""
    kept = [c for c in chunks.columns if c not in ("chunk_no", "last", "data")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, size = hashlib.sha1(), 0
        for batch in batches:
            ends: list[int] = []
            sizes: list[int] = []
            found: list[str] = []
            for i, (number, last, data) in enumerate(zip(*(batch.column(c) for c in ("chunk_no", "last", "data")))):
                if number.as_py() == 0:
                    sha, size = hashlib.sha1(), 0
                piece = data.as_buffer()
                sha.update(piece)
                size += piece.size
                if last.as_py():
                    ends.append(i)
                    sizes.append(size)
                    found.append(base32(sha.digest()))
            rows = batch.select(kept).take(pa.array(ends, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sizes, pa.int64()), pa.array(found, pa.string())], names=[*kept, "payload_bytes", "digest"])

    schema = chunks.select(kept).schema
    return chunks.mapInArrow(run, schema.add("payload_bytes", "long").add("digest", "string"))


# types


def _record_id(row_id: Column, copy: Column) -> Column:
    return F.md5(F.concat(row_id, F.lit(":"), copy.cast("string")).cast("binary"))


def record_types(found: DataFrame, least: int = 0) -> DataFrame:
    """The records to write, from digests (a stored table): row_id, content and the columns of ``RECORD``."""
    rows = written(found.groupBy("row_id", "page_id", "url", "content", "payload_bytes", "digest").agg(F.count("*").alias("n")))
    shared = rows.where(F.col("payload_bytes") >= least)
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url", "row_id")
    first = shared.groupBy("content").agg(F.min(order)["row_id"].alias("first_row"))
    marked = spread_join(shared, first, "content").unionByName(rows.where(F.col("payload_bytes") < least).withColumn("first_row", F.lit(None).cast("string")))
    each = marked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    response = F.col("first_row").isNull() | ((F.col("row_id") == F.col("first_row")) & (F.col("copy") == 1))
    refers = F.when(~response, _record_id(F.col("first_row"), F.lit(1)))
    return each.select(
        "row_id", "content", _record_id(F.col("row_id"), F.col("copy")).alias("record"), F.when(response, RESPONSE).otherwise(REVISIT).alias("type"),
        "page_id", "url", refers.alias("refers"), "digest", "payload_bytes",
    )


# writing


def _line(name: str, value) -> bytes:
    return b"" if value is None else f"{name}: {value}\r\n".encode()


def _printable(url: str | None) -> str | None:
    return None if url is None else "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def header(record: str, kind: str, length: int, page_id=None, url=None, refers=None, digest=None) -> bytes:
    """The header of a record, with the blank line that ends it."""
    lines = [b"WARC/1.1\r\n", _line("WARC-Type", kind), _line("WARC-Record-ID", f"<{uuid.UUID(record).urn}>"), _line("WARC-Date", DATE)]
    lines += [_line("WARC-Target-URI", _printable(url)), _line("WARC-Payload-Digest", digest and f"sha1:{digest}"), _line("X-Page-Id", page_id)]
    if refers:
        lines += [_line("WARC-Refers-To", f"<{uuid.UUID(refers).urn}>"), _line("WARC-Profile", PROFILE)]
    lines += [_line("Content-Type", "application/warc-fields" if kind == "warcinfo" else "application/http;msgtype=response"), _line("Content-Length", length)]
    return b"".join(lines) + END


class _Files:
    """Archive files of one task, one gzip member a record."""

    def __init__(self, folder: str):
        self.store, self.path = filesystem(folder)
        self.folder = folder.rstrip("/")
        self.out = self.name = self.member = None
        self.done: list[tuple[str, int, int]] = []

    def begin(self, head: bytes) -> None:
        if self.out is None:
            own = f"{uuid.uuid4().hex}.warc.gz"
            self.name, self.records = f"{self.folder}/{own}", 0
            self.out = self.store.open_output_stream(f"{self.path}/{own}", compression=None)
            info = b"format: WARC File Format 1.1\r\n"
            self._start(header(uuid.uuid4().hex, "warcinfo", len(info)) + info)
            self.end()
        self._start(head)

    def _start(self, head: bytes) -> None:
        self.member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, data) -> None:
        self.out.write(self.member.compress(data))

    def end(self) -> None:
        self.add(END + END)
        self.out.write(self.member.flush())
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            size = self.out.tell()
            self.out.close()
            self.done.append((self.name, self.records - 1, size))
            self.out = None

    def manifest(self) -> pa.RecordBatch:
        columns = list(zip(*self.done)) or [[], [], []]
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["file", "records", "bytes"])


def _writer(folder: str, file_bytes: int):
    """Task that writes chunk rows, in order of record and number, and returns its files. A row that repeats the one
    before it (the same record and number) is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, before, sha = _Files(folder), None, None
        for batch in batches:
            rows = batch.drop_columns(["data"]).to_pylist()
            for row, data in zip(rows, batch.column("data")):
                at = row["record"], row["chunk_no"]
                if at == before:
                    continue
                before = at
                if row["chunk_no"] == 0:
                    length = len(HTTP) + (row["payload_bytes"] if row["type"] == RESPONSE else 0)
                    files.begin(header(row["record"], row["type"], length, row["page_id"], row["url"], row["refers"], row["digest"]) + HTTP)
                    sha = hashlib.sha1()
                piece = data.as_buffer()
                sha.update(piece)
                files.add(piece)
                if row["last"]:
                    if row["type"] == RESPONSE and base32(sha.digest()) != row["digest"]:
                        raise ValueError(f"record {row['record']}: the payload changed between two readings of the pages")
                    files.end()
                    if files.out.tell() >= file_bytes:
                        files.close()
            if files.done:
                yield files.manifest()
        files.close()
        yield files.manifest()

    return run


def _once_a_task(chunks: DataFrame) -> DataFrame:
    """Of equal rows of ``pages`` that one task reads, the chunks of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        keep = True
        for batch in batches:
            mask = []
            for row, number in zip(batch.column("row_id").to_pylist(), batch.column("chunk_no").to_pylist()):
                if number == 0:
                    keep = row not in seen
                    seen.add(row)
                mask.append(keep)
            yield batch.filter(pa.array(mask, pa.bool_()))

    return chunks.mapInArrow(run, chunks.schema)


def write_archive(pages: DataFrame, folder: str, least: int = 0, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a record for each row of ``pages`` to files in ``folder``; returns their table (file, records, bytes)."""
    spark = pages.sparkSession
    store, path = filesystem(folder)
    store.create_dir(path)
    chunks = chunk_rows(pages, chunk)
    records = written(record_types(written(digests(chunks)), least))
    responses = records.where(F.col("type") == RESPONSE).drop("content", "page_id", "url")
    # copies of the payloads that most rows share need not travel: a bounded list of those and their responses
    hot = records.join(F.broadcast(hot_keys(records, "content")), "content", "left_semi")
    common = hot.where((F.col("type") == RESPONSE) & F.col("refers").isNull() & (F.col("payload_bytes") >= least)).select("content", F.col("row_id").alias("kept_row"))
    needed = chunks.join(F.broadcast(common), "content", "left").where(F.col("kept_row").isNull() | (F.col("kept_row") == F.col("row_id")))
    dealt = _once_a_task(needed.drop("content", "kept_row")).repartition(partitions(spark), "row_id")
    payload = dealt.join(responses, "row_id").sortWithinPartitions("record", "chunk_no").select(
        "record", "type", "page_id", "url", "refers", "digest", "payload_bytes", "chunk_no", "last", "data")
    bare = records.where(F.col("type") == REVISIT).select(
        "record", "type", "page_id", "url", "refers", "digest", "payload_bytes", F.lit(0).cast("long").alias("chunk_no"), F.lit(True).alias("last"), F.lit(b"").alias("data"))
    write = _writer(folder, file_bytes)
    return written(payload.mapInArrow(write, MANIFEST).unionByName(bare.mapInArrow(write, MANIFEST)))


# reading


class _Stream:
    """The decompressed bytes of a file of gzip members, by bounded reads."""

    def __init__(self, source, step: int):
        self.source, self.step, self.raw, self.ready = source, step, b"", bytearray()
        self.member = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.member.eof:
            self.raw, self.member = self.member.unused_data or self.raw, zlib.decompressobj(31)
        if not self.raw:
            self.raw = self.source.read(self.step)
            if not self.raw:
                return False
        data, self.raw = self.raw, b""
        self.ready += self.member.decompress(data, self.step)
        self.raw = b"" if self.member.eof else self.member.unconsumed_tail
        return True

    def take(self, most: int) -> bytes:
        """Up to ``most`` bytes; none at the end of the file."""
        while not self.ready and self._more():
            pass
        out = bytes(self.ready[:most])
        del self.ready[: len(out)]
        return out

    def until(self, mark: bytes, most: int = MOST_HEADER) -> bytes:
        """The bytes before ``mark``, which is passed over; what is left, if it does not come."""
        while (at := self.ready.find(mark)) < 0 and self._more():
            if len(self.ready) > most + self.step:
                raise ValueError(f"no end of a header within {most} bytes")
        at = len(self.ready) if at < 0 else at
        out = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _uuid(urn: str | None) -> str | None:
    return urn and uuid.UUID(urn.strip("<>")).hex


def records_of(source, chunk: int, with_data: bool) -> Iterator[tuple]:
    """Rows of ``CHUNKS`` of an open archive file."""
    stream = _Stream(source, max(chunk, 1 << 16))
    while head := stream.until(END + END):
        fields = _fields(head)
        left = int(fields["content-length"])
        if fields["warc-type"] not in (RESPONSE, REVISIT):
            while left and (piece := stream.take(min(left, chunk))):
                left -= len(piece)
            stream.until(END + END)
            continue
        left -= len(stream.until(END + END)) + 4  # the header of the answer, before the payload
        record, page = _uuid(fields["warc-record-id"]), fields.get("x-page-id")
        about = (record, fields["warc-type"], None if page is None else int(page), fields.get("warc-target-uri"), _uuid(fields.get("warc-refers-to")))
        declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        sha, size, number = hashlib.sha1(), 0, 0
        while True:
            data = bytearray()
            while left and len(data) < chunk:
                piece = stream.take(min(left, chunk - len(data)))
                if not piece:
                    raise ValueError(f"record {record}: the file ends within its payload")
                data += piece
                left -= len(piece)
            sha.update(data)
            size += len(data)
            last = left == 0
            if last and fields["warc-type"] == RESPONSE and base32(sha.digest()) != declared:
                raise ValueError(f"record {record}: its payload has not the digest of its header")
            digest = declared if fields["warc-type"] == REVISIT else base32(sha.digest())
            yield (*about, digest, number, last, size, bytes(data) if with_data else None)
            number += 1
            if last:
                break
        if stream.until(END + END):
            raise ValueError(f"record {record}: more bytes than its header says")


def read_archive(spark: SparkSession, manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk rows of all records of the files that ``manifest`` names: ``digest`` and ``payload_bytes`` are those of the
    record so far (a revisit: its header's digest, no bytes), ``data`` is null if not asked for."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for name in files.column("file").to_pylist():
                rows, held = [], 0
                store, path = filesystem(name)
                with store.open_input_stream(path, compression=None) as source:
                    for row in records_of(source, chunk, with_data):
                        rows.append(row)
                        held += len(row[-1] or b"") + 200
                        if held > 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                yield batch(rows)

    return manifest.select("file").repartitionByRange(partitions(spark), "file").mapInArrow(run, CHUNKS)


def page_records(ends: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from the last chunk rows (a stored table): a revisit
    has the bytes of the response that it refers to."""
    answers = ends.where(F.col("type") == RESPONSE)
    own = answers.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    side = answers.select(F.col("record").alias("refers"), F.col("payload_bytes").alias("full"), F.col("digest").alias("full_digest"), F.col("page_id").alias("refers_to"))
    revisits = ends.where(F.col("type") == REVISIT).select("refers", "page_id", "digest", "type")
    met = spread_join(revisits, side, "refers").where(F.col("digest") == F.col("full_digest"))
    return own.unionByName(met.select("page_id", F.col("full").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"))


def op13_warc(spark, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, read back from its archive."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = removed_at_exit(spark, f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    manifest = write_archive(pages, folder)
    ends = written(read_archive(spark, manifest, with_data=False).where("last").drop("data"))
    remove(spark, folder)
    return page_records(ends)


SQL = """
WITH payloads AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
hashed AS (
  SELECT page_id, url, strlen(body) AS payload_bytes, body, sha1(body) AS h,
         row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST, url NULLS FIRST) AS place,
         first_value(page_id) OVER (PARTITION BY body ORDER BY page_id NULLS LAST, url NULLS FIRST) AS first_id
  FROM payloads),
bits AS (
  SELECT *, array_to_string(list_transform(string_split(h, ''), lambda x: lpad(bin(CAST('0x' || x AS INTEGER)), 4, '0')), '') AS b
  FROM hashed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(5), lambda j: CAST(substr(b, 5 * i + j + 1, 1) AS INTEGER) * (16 >> j)))::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to
FROM bits
"""

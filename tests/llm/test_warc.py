import base64
import gzip
import hashlib
import io
import re
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from maskfold.llm import warc
from maskfold.llm.queries import QUERIES
from maskfold.llm.shared import written

from .helpers import SF, empty

BIG = "".join(f"<p>é😀 {i}</p>" for i in range(200_000))
ROWS = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, "<p>x</p>"), (4, "http://a/4", None), (5, "", ""),
    (6, "http://a/\r\nX-Page-Id: 9\r\n\r\n", "y"), (7, "http://ü/😀", BIG), (8, "http://a/8", BIG), (9, "http://a/9", BIG + "z"),
    (10, "http://a/10", "same"), (10, "http://a/10", "same"), (10, "http://a/10", "same"), (10, "http://a/0", "same"), (10, "http://a/10", "other"),
    (None, "http://a/n", "<p>x</p>"), (None, None, "alone"), (None, None, "alone"), (12, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (13, "u", "\r\n\r\n"),
]


def _digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _expected(rows, least=0):
    out, groups = [], {}
    for i, url, html in rows:
        data = (html or "").encode()
        if len(data) < least:
            out.append((i, len(data), _digest(data), "response", None))
        else:
            groups.setdefault(data, []).append((i is None, i or 0, i, url is not None, url or ""))
    for data, members in groups.items():
        members.sort()
        for k, m in enumerate(members):
            out.append((m[2], len(data), _digest(data), "revisit" if k else "response", members[0][2] if k else None))
    return sorted(map(str, out))


def _frame(spark, rows):
    return spark.createDataFrame([(*r, b"d", "r") for r in rows], "page_id long, url string, html string, data binary, record string").repartition(3)


def _result(spark, pages, folder, **how):
    manifest = warc.write_archive(pages, folder, **how)
    ends = written(warc.read_archive(spark, manifest, with_data=False).where("last").drop("data"))
    return manifest, warc.page_records(ends)


def test_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = QUERIES["op13_warc"](spark, SF)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(str(tuple(r)) for r in got.collect()) == _expected([(r["page_id"], r["url"], r["html"]) for r in pages])


@pytest.mark.parametrize("least", [0, 5])
def test_odd_rows(spark, least):
    folder = tempfile.mkdtemp(prefix="warc-")
    manifest, got = _result(spark, _frame(spark, ROWS), folder, least=least, chunk=1000, file_bytes=10_000)
    assert sorted(str(tuple(r)) for r in got.collect()) == _expected(ROWS, least)
    assert manifest.agg(F.sum("records")).first()[0] == len(ROWS)
    # the files, read by a plain parser
    seen = []
    for row in manifest.collect():
        data = gzip.open(row["file"]).read()
        source = io.BytesIO(data)
        while head := source.readline():
            assert head == b"WARC/1.1\r\n"
            fields = {}
            while (line := source.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                assert name not in fields
                fields[name] = value
            block = source.read(int(fields["Content-Length"]))
            assert source.read(4) == b"\r\n\r\n"
            seen.append((fields, block))
    ids = [uuid.UUID(f["WARC-Record-ID"].strip("<>")) for f, _ in seen]
    assert len(set(ids)) == len(ids)
    responses = {f["WARC-Record-ID"]: (f, b.split(b"\r\n\r\n", 1)[1]) for f, b in seen if f["WARC-Type"] == "response"}
    assert all(f["WARC-Payload-Digest"] == f"sha1:{_digest(p)}" for f, p in responses.values())
    assert all(f["WARC-Refers-To"] in responses and b.endswith(b"\r\n\r\n") for f, b in seen if f["WARC-Type"] == "revisit")
    assert sum(f["WARC-Type"] == "warcinfo" for f, _ in seen) == manifest.count() > 2
    assert any(re.search("%0D%0AX-Page-Id", f.get("WARC-Target-URI", "")) for f, _ in seen)


def test_chunks_of_a_record(spark):
    """Chunk rows hold the payload in order with its digest so far, when read as when made."""
    pages = spark.createDataFrame([(1, "u", BIG), (2, "v", ""), (3, "w", "ab")], "page_id long, url string, html string")
    made = warc.chunk_rows(pages, 1000).collect()
    assert max(len(r["data"]) for r in made) == 1000
    assert b"".join(r["data"] for r in sorted((r for r in made if r["page_id"] == 1), key=lambda r: r["chunk_no"])) == BIG.encode()
    manifest = warc.write_archive(pages, tempfile.mkdtemp(prefix="warc-"), chunk=1000)
    rows = sorted(warc.read_archive(spark, manifest, chunk=700).collect(), key=lambda r: (r["page_id"], r["chunk_no"]))
    so_far = {1: b"", 2: b"", 3: b""}
    for r in rows:
        assert len(r["data"]) <= 700
        so_far[r["page_id"]] += bytes(r["data"])
        if r["chunk_no"] % 50 == 0 or r["last"]:
            assert (r["payload_bytes"], r["digest"]) == (len(so_far[r["page_id"]]), _digest(so_far[r["page_id"]]))
    assert so_far == {1: BIG.encode(), 2: b"", 3: b"ab"}


def test_empty_table(spark):
    manifest, got = _result(spark, empty(_frame(spark, ROWS)), tempfile.mkdtemp(prefix="warc-"))
    assert manifest.count() == 0 and got.count() == 0


def test_a_changed_payload_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "payload")], "page_id long, url string, html string")
    manifest = warc.write_archive(pages, str(tmp_path))
    (row,) = manifest.collect()
    data = gzip.open(row["file"]).read().replace(b"payload", b"payl0ad")
    with gzip.open(row["file"], "wb") as f:
        f.write(data)
    with pytest.raises(Exception, match="has not the digest"):
        warc.read_archive(spark, manifest).collect()


def test_members_split_anywhere():
    """The reader's stream gives the same bytes whatever the size of its reads."""
    parts = [b"a" * 10_000, b"", b"b\r\n\r\nc" * 50]
    data = b"".join(gzip.compress(p) for p in parts)
    for step in (1, 7, 64, 1 << 16):
        stream, got = warc._Stream(io.BytesIO(data), step), b""
        while piece := stream.take(13):
            got += piece
        assert got == b"".join(parts)

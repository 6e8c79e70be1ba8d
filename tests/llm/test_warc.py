import gzip
import hashlib
import io

import pytest
from pyarrow import fs

from ledgerline.llm.files import filesystem
from ledgerline.llm.warc import archive_folder, members, read_archives, record_member, records, write_archives

LONG = "<p>é&amp; long page</p>\r\n" * 20000


@pytest.fixture(scope="module")
def pages(spark):
    big = "x" * 100
    rows = [(5, "http://a/1", big, "e"), (3, "http://a/2", big, "e"), (9, None, big, "e"), (9, None, big, "e"),
            (3, "http://a/2", big, "e"), (1, "http://a/\r\nX: y", "x" * 99, "e"), (2, "http://b", "x" * 99, "e"),
            (4, "http://c", None, "e"), (6, "", "", None), (None, "http://d", big, "e"), (None, None, "only here " * 20, "e"),
            (7, "http://é", LONG, "e"), (8, "http://é", LONG, "e"), (10, "u", "\r\n\r\nWARC/1.1\0" * 50, "e")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, first string")


def brute(rows):
    out = []
    for r in rows:
        body = (r.html or "").encode()
        same = [x.page_id for x in rows if (x.html or "").encode() == body and x.page_id is not None]
        first = min(same) if same else None
        revisit = len(body) >= 100 and first is not None and r.page_id != first
        out.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return out


def order(row):
    return tuple((x is not None, x) for x in row)


def test_round_trip(spark, pages):
    folder = archive_folder(spark)
    manifest = write_archives(pages, folder, file_bytes=300)
    rows = read_archives(manifest, folder, with_payload=True).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=order) == sorted(brute(pages.collect()), key=order)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in rows)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in rows if r.payload is not None)
    for path in (r.path for r in manifest.collect()):
        store, _ = filesystem(folder)
        with store.open_input_stream(path, compression=None) as f:
            assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")


def test_empty(spark, pages):
    folder = archive_folder(spark)
    assert read_archives(write_archives(pages.limit(0), folder), folder).count() == 0


def member(payload=b"hello", revisit=False):
    return record_member(1, "http://a", payload, len(payload), hashlib.sha256(payload).digest(), None, revisit)


def test_reader_inflates_in_small_pieces():
    data = member(b"a" * 5000) + b"\0\0" + member(b"b")
    assert len(list(members(io.BytesIO(data), piece=3))) == 2
    got = [r.http[1] for r in records(io.BytesIO(data))]
    assert got == [b"a" * 5000, b"b"]


def test_reader_finds_faults():
    with pytest.raises(EOFError):
        list(records(io.BytesIO(member()[:-9])))
    plain = gzip.decompress(member())
    for bad in (plain.replace(b"hello", b"jello"), plain.replace(b"WARC/1.1", b"WORC/1.1", 1), plain[:-4],
                plain + b"more"):
        with pytest.raises(ValueError):
            list(records(io.BytesIO(gzip.compress(bad))))


def test_file_system_of_folder():
    assert isinstance(filesystem("file:/tmp/x")[0], fs.LocalFileSystem) and filesystem("file:/tmp/x")[1] == "/tmp/x"

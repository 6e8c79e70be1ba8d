"""WARC archives: one gzip member per record, written and read in sequence.

Pages become response records; of records with equal payloads of at least
``revisit_from`` bytes the one of smallest page id is a response and the
others are revisit records (profile identical-payload-digest) without the
payload. Equal payloads are found by length and SHA-256: the digests are
counted with map-side aggregation and joined back by equality, so a payload
that a third of the pages share is one row on the counted side.

The reader takes a file as a stream: it inflates one gzip member after the
other with zlib in pieces, reads the header block, frames the record block
by Content-Length and checks the digests it finds.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize, text_or_empty
from .files import filesystem, own_name

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "path string, records long, bytes long"
PIECE = 1 << 16


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        """Headers and body of the HTTP message in the block."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        return _headers(head.split(b"\r\n")[1:]), body


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8").split(":", 1) for line in lines if line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _field(value: str) -> str:
    """A value that stays on its header line: controls are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def digest_label(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode().rstrip("=")


def record_member(page_id: int | None, url: str | None, payload: bytes, size: int, digest: bytes,
                  refers_to: int | None, revisit: bool, level: int = 6) -> bytes:
    """One record as one gzip member."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}",
             f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
             "Content-Type: application/http; msgtype=response",
             "WARC-Payload-Digest: sha256:" + base64.b32encode(digest).decode().rstrip("="),
             f"WARC-Block-Digest: {digest_label(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}",
                  f"WARC-Refers-To: <urn:page:{'none' if refers_to is None else refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(whole) + pack.flush()


def members(stream, piece: int = PIECE) -> Iterator[bytearray]:
    """The content of each gzip member, inflated in pieces. Zero bytes after
    a member are padding; a stream that ends inside a member is an error."""
    held = b""
    while True:
        while not held.strip(b"\0"):
            held = stream.read(piece)
            if not held:
                return
        inflate, out = zlib.decompressobj(31), bytearray()
        held = held.lstrip(b"\0")
        while not inflate.eof:
            if not held:
                held = stream.read(piece)
            if not held:
                rest = inflate.decompress(b"", 16 * piece)
                if not rest and not inflate.eof:
                    raise EOFError("the archive ends inside a record")
                out += rest
                continue
            out += inflate.decompress(held, 16 * piece)
            held = inflate.unconsumed_tail or inflate.unused_data if inflate.eof else inflate.unconsumed_tail
        yield out


def records(stream, verify: bool = True) -> Iterator[Record]:
    """Records of an archive in order, framed by Content-Length. With
    ``verify`` a wrong block digest, or a response whose payload does not
    have its payload digest, raises ValueError."""
    for content in members(stream):
        at = content.find(b"\r\n\r\n")
        lines = bytes(content[:at]).split(b"\r\n")
        if at < 0 or not lines[0].startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = _headers(lines[1:])
        size = int(headers["content-length"])
        block = bytes(content[at + 4:at + 4 + size])
        if len(block) != size or content[at + 4 + size:] != b"\r\n\r\n":
            raise ValueError("Content-Length does not frame the record")
        record = Record(headers, block)
        if verify:
            if headers.get("warc-block-digest", digest_label(block)) != digest_label(block):
                raise ValueError("block digest differs")
            if headers.get("warc-type") == "response" and "warc-payload-digest" in headers \
                    and headers["warc-payload-digest"] != digest_label(record.http[1]):
                raise ValueError("payload digest differs")
        yield record


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", revisit_from: int = 100, file_bytes: int = 64_000_000) -> DataFrame:
    """Write a record per row; returns the written manifest (path, records,
    bytes of each file).

    NULL html is an empty payload, a NULL url leaves its header out, a NULL
    page id is larger than any other. Rows that repeat the smallest id of
    equal payloads are all responses. Other columns are ignored; an empty
    table gives no files."""
    last = (1 << 63) - 1
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("id"),
                        F.col(url_col).cast("string").alias("url"),
                        F.encode(text_or_empty(html_col), "UTF-8").alias("payload")) \
        .select("id", "url", "payload", F.octet_length("payload").cast("long").alias("size"),
                F.unhex(F.sha2("payload", 256)).alias("digest"))
    first = materialize(rows.filter(F.col("size") >= revisit_from).groupBy("digest", "size")
                        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
                        .filter("n > 1").select("digest", "size", "first"), "warc-first")
    marked = rows.join(first, ["digest", "size"], "left").withColumn("revisit", F.coalesce(F.col("id") > F.col("first"), F.lit(False))) \
        .select("id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "size", "digest",
                F.when(F.col("revisit"), F.col("first")).alias("refers_to"), "revisit")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        out, path, n, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*batch.columns):
                page, url, payload, length, digest, refers, revisit = (x.as_py() for x in row)
                if out is None:
                    path, n, size = f"{base}/{own_name('.warc.gz')}", 0, 0
                    out = store.open_output_stream(path, compression=None)
                member = record_member(None if page == last else page, url, payload, length, digest, refers, revisit)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    out, done = None, done + [(path, n, size)]
        if out is not None:
            out.close()
            done.append((path, n, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["path", "records", "bytes"])

    return materialize(marked.mapInArrow(write, MANIFEST), "warc-files")


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the files of a manifest: page_id, url,
    payload_bytes, payload_digest (hexadecimal), record_type, refers_to, and
    the payload if asked for (NULL for revisits). Lengths and digests are
    those of the full payload, checked for responses."""
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long" + ", payload binary" * with_payload)

    def row(record: Record) -> tuple:
        head, (http, body) = record.headers, record.http
        label = head["warc-payload-digest"].removeprefix("sha256:")
        digest = base64.b32decode(label + "=" * (-len(label) % 8)).hex()
        response = head["warc-type"] == "response"
        size = int(http["content-length"])
        if response and size != len(body):
            raise ValueError("Content-Length of the payload differs")
        return (_page(head["warc-record-id"]), head.get("warc-target-uri"), size, digest, head["warc-type"],
                _page(head["warc-refers-to"]) if "warc-refers-to" in head else None) + ((body if response else None,) if with_payload else ())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None) as raw:
                    some, held = [], 0
                    for record in records(raw):
                        some.append(row(record))
                        held += len(record.block) * with_payload
                        if len(some) >= 5000 or held > 8_000_000:
                            yield _rows(some, with_payload)
                            some, held = [], 0
                    if some:
                        yield _rows(some, with_payload)

    spread = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return manifest.select("path").repartition(spread).mapInArrow(read, schema)


def _page(urn: str) -> int | None:
    name = urn.strip("<>").removeprefix("urn:page:")
    return None if name == "none" else int(name)


def _rows(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def archive_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return scratch_path(spark, "warc")

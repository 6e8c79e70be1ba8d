"""Token-id files: ids end to end, document boundaries in Elias-Fano code.

A file (little-endian) has a header, the Elias-Fano coded document ids, the
Elias-Fano coded ends of the documents, and the ids as unsigned 16- or
32-bit integers. Elias-Fano code keeps the low bits of each value packed
and the high bits as unary gaps in a bit vector, near 2 + log(u/n) bits a
document; every 256th one of the vector is noted, so that ``select`` finds
any offset from there and no table of 64-bit offsets exists.

Documents are range-partitioned by id and sorted, so files in the order of
the manifest hold ascending ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import NO_ID, long_id, materialize, text_or_empty
from .files import filesystem, own_name
from .tokens import encoder, in_small_batches

MAGIC = b"EFTOKEN1"
HEADER = struct.Struct("<8sqqqqB")  # magic, documents, NULL ids, first id, ids (tokens), width
EVERY = 256
END_ID = 0
MANIFEST = "task int, seq int, path string, documents long, ids long"


class EliasFano:
    """A non-decreasing sequence of integers from 0 on."""

    PARTS = struct.Struct("<qBqqq")  # values, low bits, bytes of low bits, of high bits, of samples

    def __init__(self, n: int, low: int, lows: bytes, highs: bytes, samples: np.ndarray):
        self.n, self.low, self.lows, self.highs, self.samples = n, low, lows, highs, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        v = values.astype(np.uint64)
        n = len(v)
        low = max(0, (int(v[-1]) // n).bit_length() - 1) if n else 0
        ones = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        shifts = np.arange(low, dtype=np.uint64)
        lows = ((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        return cls(n, low, np.packbits(lows, bitorder="little").tobytes(),
                   np.packbits(bits, bitorder="little").tobytes(), ones[::EVERY].astype("<u4"))

    def to_bytes(self) -> bytes:
        s = self.samples.tobytes()
        return self.PARTS.pack(self.n, self.low, len(self.lows), len(self.highs), len(s)) + self.lows + self.highs + s

    @classmethod
    def read(cls, f) -> "EliasFano":
        n, low, a, b, c = cls.PARTS.unpack(f.read(cls.PARTS.size))
        return cls(n, low, f.read(a), f.read(b), np.frombuffer(f.read(c), "<u4"))

    def select(self, i: int) -> int:
        """The i-th value, from the noted one at or before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // EVERY])
        bits = np.unpackbits(np.frombuffer(self.highs, np.uint8, offset=at // 8)[:self._span(i)], bitorder="little")
        one = at // 8 * 8 + int(np.flatnonzero(bits[at % 8:])[i % EVERY]) + at % 8
        return (one - i) << self.low | self._low(i)

    def _span(self, i: int) -> int:
        block = i // EVERY
        end = int(self.samples[block + 1]) // 8 + 1 if block + 1 < len(self.samples) else len(self.highs)
        return end - int(self.samples[block]) // 8

    def _low(self, i: int) -> int:
        first, last = i * self.low, (i + 1) * self.low
        word = int.from_bytes(self.lows[first // 8:-(-last // 8)], "little")
        return word >> first % 8 & (1 << self.low) - 1

    def ascending(self) -> Iterator[int]:
        """All values, from one noted one to the next: no table of them."""
        for block, at in enumerate(self.samples.tolist()):
            i, n = block * EVERY, min(EVERY, self.n - block * EVERY)
            bits = np.unpackbits(np.frombuffer(self.highs, np.uint8, offset=at // 8)[:self._span(i)], bitorder="little")
            ones = (at + np.flatnonzero(bits[at % 8:])[:n] - np.arange(i, i + n)).tolist()
            for k, high in enumerate(ones, i):
                yield high << self.low | self._low(k)

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.highs, np.uint8), bitorder="little"))[:self.n]
        bits = np.unpackbits(np.frombuffer(self.lows, np.uint8), bitorder="little")[:self.n * self.low]
        weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
        low = (bits.reshape(self.n, self.low) * weights).sum(axis=1, dtype=np.uint64)
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)) | low


def write_file(out, doc_ids: list[int], ids: list[bytes]) -> int:
    """Write sorted documents (NO_ID for NULL, ids as 32-bit bytes); returns
    the number of ids."""
    all_ids = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(all_ids) or int(all_ids.max()) < 1 << 16 else 4
    nulls = sum(d == NO_ID for d in doc_ids)
    named = doc_ids[nulls:]
    first = named[0] if named else 0
    out.write(HEADER.pack(MAGIC, len(doc_ids), nulls, first, len(all_ids), width))
    out.write(EliasFano.of(np.array([d - first for d in named], np.uint64)).to_bytes())
    out.write(EliasFano.of(np.cumsum([len(x) // 4 for x in ids], dtype=np.uint64)).to_bytes())
    out.write(all_ids.astype(f"<u{width}").tobytes())
    return len(all_ids)


def read_file(f) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, first id's place in the file, ids)`` of each document."""
    magic, n, nulls, first, _, width = HEADER.unpack(f.read(HEADER.size))
    if magic != MAGIC:
        raise ValueError("not a token-id file")
    named, ends = EliasFano.read(f).ascending(), EliasFano.read(f).ascending()
    start = 0
    for i in range(n):
        end = next(ends)
        ids = np.frombuffer(f.read((end - start) * width), f"<u{width}").astype("<u4")
        yield (first + next(named) if i >= nulls else None), start, ids
        start = end


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id",
                      text_col: str = "text", file_ids: int = 4_000_000, remember: int = 1_000_000) -> DataFrame:
    """Write all documents in ascending id order; returns the written
    manifest: path, documents, ids and first_id of each file, the last the
    number of ids in all files before it.

    NULL text counts as empty (the end id alone), NULL ids come first,
    repeated rows are written each; other columns are ignored; an empty
    table gives an empty manifest. A file holds about ``file_ids`` ids, and a
    worker keeps the ids of about ``remember`` words. Rows that share an id
    are spread over tasks by a hash of their text and lie in its order."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encoder(tokenizer, remember), np.array([END_ID], "<u4").tobytes()
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        doc_ids, ids, size, seq = [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, ids, size, seq
            path = f"{base}/{own_name('.eft')}"
            with store.open_output_stream(path, compression=None) as out:
                n = write_file(out, doc_ids, ids)
            row = [[TaskContext.get().partitionId()], [seq], [path], [len(doc_ids)], [n]]
            doc_ids, ids, size, seq = [], [], 0, seq + 1
            kinds = pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)],
                                              ["task", "seq", "path", "documents", "ids"])

        for batch in batches:
            for some in in_small_batches(zip(batch.column(0), batch.column(1)), lambda r: len(r[1].as_buffer() or b"")):
                for row, body in zip(some, code.encode([r[1].as_py() for r in some])):
                    doc_ids.append(row[0].as_py())
                    ids.append(body + end)
                    size += len(body) // 4 + 1
                    if size >= file_ids:
                        yield close()
        if doc_ids:
            yield close()

    rows = docs.select(long_id(id_col).alias("id"), text_or_empty(text_col).alias("text")) \
        .withColumn("mark", F.xxhash64("text")).repartitionByRange("id", "mark").sortWithinPartitions("id", "mark") \
        .select("id", "text").mapInArrow(write, MANIFEST)
    before = Window.orderBy("task", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(materialize(rows, "token-manifest").select(
        "path", "documents", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first_id")), "token-files")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, read from the files of a manifest: doc_id,
    start (ids of all documents before it), n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for path, base in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                with store.open_input_file(path) as raw:
                    rows = [(doc, base + start, len(ids), zlib.crc32(ids.tobytes()))
                            for doc, start, ids in read_file(raw)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return manifest.select("path", "first_id").repartition(spread).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return scratch_path(spark, "token-files")

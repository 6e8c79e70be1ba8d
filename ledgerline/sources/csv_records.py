"""CSV by records: line breaks inside quotes, malformed rows, file order.

A file is read as lines, so that one large file is still split among tasks.
Whether a line begins inside a quoted field depends on all lines before it,
but a line (and so a split) is no more than a function from "outside" or
"inside" to the state after it. A first pass folds each split to that
function; composing them in file order, one row a split, gives the state in
which each split begins. A second pass joins the lines of each record. What a
split leaves open at its end and what it continues at its start are
fragments, at most two a split, and are put together afterwards.

A quote opens a field only at its start and a doubled quote stands for one;
quotes elsewhere are text. Lines end in LF or CRLF, empty lines are skipped,
a leading byte-order mark is dropped, and each file leads with a header.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Where a record begins: file, split and line in the split. Ordering by these is file order.
POSITION = ("source_file", "source_block", "source_line")

_FIELD = r'(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|(?=,|\Z))'
_ENDS_OUTSIDE = (re.compile(rf"{_FIELD}(?:,{_FIELD})*+\Z"),
                 re.compile(rf'(?:[^"]|"")*+"[^,]*+(?:,{_FIELD})*+\Z'))


def line_function(line: str) -> tuple[int, int]:
    """State after a line (1: inside a quoted field) that began outside, and inside."""
    return tuple(0 if rule.match(line) else 1 for rule in _ENDS_OUTSIDE)


def field_count(record: str) -> int:
    """Fields of a whole record."""
    return len(re.findall(rf"(?:\A|,){_FIELD}", record))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _functions(values: pa.Array) -> np.ndarray:
    """The functions of lines as rows (after outside, after inside)."""
    out = np.tile(np.array([0, 1], np.int8), (len(values), 1))
    quoted = np.flatnonzero(pc.fill_null(pc.match_substring(values, '"'), False).to_numpy(zero_copy_only=False))
    for at, line in zip(quoted, values.take(pa.array(quoted)).to_pylist()):
        out[at] = line_function(line)
    return out


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array]]:
    """``(file, block, lines)`` of the splits in a batch, in order."""
    if not len(batch):
        return
    file, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    edges = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(batch)]
    for lo, hi in zip(edges, edges[1:]):
        yield int(file[lo]), int(block[lo]), batch.column(2).slice(lo, hi - lo)


def split_states(lines: DataFrame) -> DataFrame:
    """``(file, block, inside)``: the state in which each split begins."""

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after: dict[tuple[int, int], tuple[int, int]] = {}
        for batch in batches:
            for file, block, values in _runs(batch):
                state = after.get((file, block), (0, 1))
                for to in _functions(values)[_marked(values)]:
                    state = int(to[state[0]]), int(to[state[1]])
                after[file, block] = state
        rows = [(*k, *v) for k, v in after.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i < 2 else pa.int32()) for i in range(4)],
                                         ["file", "block", "f0", "f1"])

    folded = materialize(lines.mapInArrow(fold, "file long, block long, f0 int, f1 int"), "csv-splits")
    # One row a split: compose the functions of the splits before it, from "outside".
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    steps = F.collect_list(F.when((F.col("f0") != 0) | (F.col("f1") != 1), F.struct("f0", "f1"))).over(before)
    state = F.aggregate(steps, F.lit(0), lambda s, f: F.when(s == 0, f["f0"]).otherwise(f["f1"]))
    return folded.select("file", "block", state.alias("inside"))


def _marked(values: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring(values, '"'), False).to_numpy(zero_copy_only=False)


RECORD = "file long, block long, line long, record string, part string, fields int"


def _assembled(begins_inside: dict[tuple[int, int], int]):
    """Records and fragments of the splits of a task. A part is 'whole',
    'tail' (open at the split's end), 'head' (ends a record begun before) or
    'middle' (the split lies inside one field throughout)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        line, state, held, begun, head = 0, 0, [], 0, False

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["file", "block", "line", "record", "part", "fields"])

        def left() -> list[tuple]:
            return [(*at, begun, "\n".join(held), "middle" if head else "tail", -1)] if held else []

        for batch in batches:
            rows: list[tuple] = []
            for file, block, values in _runs(batch):
                if (file, block) != at:
                    rows += left()
                    at, line, held, begun = (file, block), 0, [], 0
                    state = begins_inside.get(at, 0)
                    head = state == 1
                if state == 0 and not held and not _marked(values).any():  # no quotes: each line is a record
                    plain = pc.replace_substring_regex(values, r"\r$", "")
                    counts = pc.add(pc.count_substring(plain, ","), 1).to_pylist()
                    rows += [(*at, line + i, text, "whole", n) for i, (text, n) in enumerate(zip(plain.to_pylist(), counts)) if text]
                    line += len(values)
                    continue
                for text, to in zip(values.to_pylist(), _functions(values)):
                    begun = begun if held else line
                    held.append(text)
                    state, line = int(to[state]), line + 1
                    if state == 0:
                        record = "\n".join(held).removesuffix("\r")
                        if head:
                            rows.append((*at, begun, record, "head", -1))
                        elif record:
                            rows.append((*at, begun, record, "whole", field_count(record)))
                        held, head = [], False
            if rows:
                yield out(rows)
        if at is not None and held:
            yield out(left())
    return run


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(source_file, source_block, source_line, record, fields)``: every
    record of the files, header included, as it stands; fields is -1 for one
    whose quotes never close. No row moves but the fragments of records that
    cross the end of a split."""
    lines = _lines(spark, path)
    # A split that begins inside a field is rare, and there is at most one entry a split.
    inside = {(r["file"], r["block"]): 1 for r in split_states(lines).filter("inside = 1").select("file", "block").collect()}
    found = materialize(lines.mapInArrow(_assembled(inside), RECORD), "csv-records", "zstd")
    pieces = found.filter("part <> 'whole'")
    so_far = Window.partitionBy("file").orderBy("block", "line")
    owner = F.last(F.when(F.col("part") == "tail", F.struct("block", "line")), ignorenulls=True).over(so_far)
    joined = pieces.withColumn("owner", owner).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("block", "line", "record", "part"))).alias("l"))
    whole = joined.select("file", "owner.block", "owner.line", F.concat_ws("\n", F.col("l.record")).alias("record"),
                          (F.element_at("l", -1)["part"] == "head").alias("closed"))
    stitched = whole.select("file", "block", "line", "record",
                            F.when(F.col("closed"), _field_count()("record")).otherwise(-1).alias("fields"))
    named = F.col("_metadata.file_path")  # of the listing alone, no content is read
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64(named).alias("file"), named.alias("source_file"))
    rows = found.filter("part = 'whole'").select("file", "block", "line", "record", "fields").union(stitched)
    return rows.join(F.broadcast(files), "file").select(  # a row a file
        "source_file", F.col("block").alias("source_block"), F.col("line").alias("source_line"), "record", "fields")


def _field_count():
    return F.udf(lambda record: field_count(record), "int")  # for the few records that cross a split's end


@dataclass
class CsvTable:
    """Rows whose field count is the header's, and the records that were refused."""

    rows: DataFrame
    rejected: DataFrame


OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}


def _parsed(record: Column, columns: list[str]) -> Column:
    # One struct, positions as names, so that header names may repeat or be odd.
    return F.from_csv(record, ", ".join(f"c{i} string" for i in range(len(columns))), OPTIONS)


def header_of(first: DataFrame) -> list[str]:
    """The names in the header; files must agree on them."""
    heads = first.groupBy("record").agg(F.min("source_file").alias("file"), F.max("fields").alias("n")).orderBy("file").limit(2).collect()
    if not heads:
        return []
    if len(heads) > 1:
        raise ValueError(f"{heads[1]['file']} has another header than {heads[0]['file']}")
    spark, names = first.sparkSession, [f"c{i}" for i in range(heads[0]["n"])]
    row = spark.createDataFrame([(heads[0]["record"].removeprefix("﻿"),)], "record string") \
        .select(_parsed(F.col("record"), names).alias("h")).first()["h"]
    return [name if name is not None else f"_c{i}" for i, name in enumerate(row)]


def read_csv_table(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                   positions: bool = False) -> CsvTable:
    """CSV files as text columns, by records.

    ``rows`` has the records with as many fields as the header, ``rejected``
    all others: file, block and line where each begins, the record as it
    stands, and the reason: 'too few fields', 'too many fields' or 'unclosed
    quote'. ``positions`` adds :data:`POSITION` to the rows, for file order.
    ``columns`` names the columns in place of the header."""
    records = csv_records(spark, path)
    is_first = (F.col("source_block") == 0) & (F.col("line") == F.col("source_line"))
    # One row a file: broadcast, so that no record moves to meet it.
    lead = records.filter("source_block = 0").groupBy("source_file").agg(F.min("source_line").alias("line"))
    first = records.join(F.broadcast(lead), "source_file").filter(is_first).drop("line")
    names = columns or header_of(first)
    heads = lead.withColumn("source_block", F.lit(0).cast("long")).withColumnRenamed("line", "source_line")
    body = records.join(F.broadcast(heads), list(POSITION), "left_anti")
    n = len(names)
    reason = F.when(F.col("fields") < 0, "unclosed quote").when(F.col("fields") < n, "too few fields").otherwise("too many fields")
    parsed = body.filter(F.col("fields") == n).select(*POSITION, _parsed(F.col("record"), names).alias("r"))
    rows = parsed.select(*(F.col(f"r.c{i}").alias(c) for i, c in enumerate(names)), *(POSITION if positions else ()))
    return CsvTable(rows, body.filter(F.col("fields") != n).select(*POSITION, "record", reason.alias("reason")))

"""CSV records of many files in one scan, whatever their headers, and a table of the bad ones (SRC-1, SRC-3, SRC-5).

Spark's CSV source finds the records: it is read without a header, with a declared schema of a
single column, so every record of several fields comes back whole in the corrupt-record column. A
multi-line file is never split, so a task sees a file's records in order and its first one is the header: each
record is then cut into fields and mapped to columns by its own file's header, row by row, without a join, and the plan
is the same for one header as for thousands.

A record is bad when it has fewer or more fields than its header, text after a closing quote, a quote that
never closes, or a header that lacks a required column. Bad records keep their file, place and raw text.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS, BATCH_CHARS = 1024, 16 << 20

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package


def parse_record(raw: str) -> tuple[list[str], str | None]:
    """The fields of one record as Python's csv module reads them, and what is wrong with its quotes (or None)."""
    if '"' not in raw and "\r" not in raw and "\n" not in raw:
        return raw.split(","), None
    csv.field_size_limit(sys.maxsize)
    try:
        rows = list(csv.reader(io.StringIO(raw, newline=""), strict=True))
        wrong = "line break outside quotes" if len(rows) > 1 else None
    except csv.Error as e:
        rows = list(csv.reader(io.StringIO(raw, newline="")))
        wrong = "open quote" if "end of data" in str(e) else "text after a quote"
    return rows[0] if rows else [""], wrong


class FileRecords:
    """Records of one file after another, each mapped by the header that came first in its file."""

    def __init__(self, fields: Mapping[str, Sequence[str]], required: Sequence[str]):
        self.fields, self.required = fields, required
        self.path, self.header, self.n, self.places, self.lacking = None, [], 0, {}, None

    def read(self, path: str, fields: list[str], wrong: str | None) -> tuple | None:
        """(record_no, values, reason) of one record; None for a header."""
        if path != self.path:
            self.path, self.n = path, 0
            self.header = [fields[0].lstrip("﻿"), *fields[1:]]
            named = {name: i for i, name in enumerate(self.header)}
            self.places = {c: next((named[n] for n in names if n in named), None) for c, names in self.fields.items()}
            absent = sorted(set(self.required) - set(named))
            self.lacking = "no column " + ", ".join(absent) if absent else None
            return None
        self.n += 1
        short, over = len(fields) < len(self.header), len(fields) > len(self.header)
        reason = self.lacking or wrong or ("too few fields" if short else "too many fields" if over else None)
        return self.n, [fields[i] if i is not None and i < len(fields) else None for i in self.places.values()], reason


def csv_records(spark: SparkSession, paths: Sequence[str] | str, fields: Mapping[str, Sequence[str]], required: Sequence[str] = ()) -> DataFrame:
    """(file_path, file_name, row_pos, record_no, n_fields, the ``fields``, reason, raw) of every record below a header.

    ``fields`` names the columns wanted and, for each, the header names it may have, first match first; a column
    that a file lacks is null. ``row_pos`` increases in file order, ``record_no`` counts a file's records from 1.
    ``reason`` is null for a good record; a bad one has whatever fields it holds and its ``raw`` text. Empty lines are no records. File names are decoded.
    """
    scan = (
        spark.read.schema("only string, record string")
        .option("header", False)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("encoding", "UTF-8")
        .option("columnNameOfCorruptRecord", "record")
        .option("columnPruning", False)
        .csv(paths)
    )
    rows = scan.select(
        "only",
        "record",
        F.col("_metadata.file_path").alias("file_path"),
        F.try_url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file_name"),
        F.monotonically_increasing_id().alias("row_pos"),
    )
    kinds = [("file_path", pa.string()), ("file_name", pa.string()), ("row_pos", pa.int64()), ("record_no", pa.int64()), ("n_fields", pa.int32())]
    schema = pa.schema([*kinds, *[(c, pa.string()) for c in fields], ("reason", pa.string()), ("raw", pa.string())])
    names = {c: tuple(n) for c, n in fields.items()}
    needed = tuple(required)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out, chars = FileRecords(names, needed), [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)

        for b in batches:
            for only, raw, path, name, pos in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                found, wrong = ([only or ""], None) if raw is None else parse_record(raw)
                record = files.read(path, found, wrong)
                if record is None:
                    continue
                n, values, reason = record
                raw = (only or "") if raw is None else raw
                out.append((path, name, pos, n, len(found), *values, reason, raw if reason else None))
                chars += len(raw)
                if len(out) >= BATCH_ROWS or chars >= BATCH_CHARS:
                    yield batch()
                    out, chars = [], 0
        if out:
            yield batch()

    columns = ", ".join(f"`{c}` string" for c in fields)
    return rows.mapInArrow(run, f"file_path string, file_name string, row_pos long, record_no long, n_fields int, {columns}, reason string, raw string")


def rejects(records: DataFrame) -> DataFrame:
    """(file_path, record_no, reason, n_fields, raw) of the bad records."""
    return records.where("reason is not null").select("file_path", "record_no", "reason", "n_fields", "raw")


def usable(records: DataFrame, on_bad: str = "keep") -> DataFrame:
    """The records that a build goes on with: all of them, as a lenient reader has it ("keep"), the good ones
    ("drop"), or all unless one is bad ("error")."""
    if on_bad == "keep":
        return records
    if on_bad == "drop":
        return records.where("reason is null")
    if on_bad == "error":
        told = F.concat(F.col("file_path"), F.lit(", record "), F.col("record_no").cast("string"), F.lit(": "), F.col("reason"))
        return records.where(F.when(F.col("reason").isNull(), True).otherwise(F.raise_error(told).cast("boolean")))
    raise ValueError(f"on_bad must be keep, drop or error, not {on_bad!r}")

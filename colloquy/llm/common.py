"""Helpers shared by the training-data operators: words, hashes, stored tables.

A *word* is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``
(``[^\\x20\\x09-\\x0D]+``), which is exactly what ``bytes.split()`` yields.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage: later steps read a table that no executor has to keep,
    and its real size informs the join strategies.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the tables, which ``stored`` returned and nothing reads any more, and let Spark remove the shuffle files that only dropped
    plans refer to: its cleaner waits for the driver's Python and JVM to collect garbage."""
    jvm = spark.sparkContext._jvm
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(t.stored_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()


class Shared:
    """A value broadcast as bytes that carry this package's classes by value, so that executors need no copy of it.

    Spark pickles a broadcast value by reference to its class's module; here it is pickled with the functions' pickler,
    and unpacked once per worker.
    """

    def __init__(self, spark: SparkSession, value):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if not hasattr(self._bytes, "unpacked"):
            self._bytes.unpacked = cloudpickle.loads(self._bytes.value)
        return self._bytes.unpacked


LOOKUP_ROWS = 1_000_000  # ids of one long each (16 MB in memory) that a lookup broadcasts; beyond, it is a shuffle join


def rows_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids``; few ids are broadcast, so that the texts need no shuffle."""
    ids = stored(ids.select("doc_id").distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= LOOKUP_ROWS else ids, "doc_id", "left_semi")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (wrapping 64-bit arithmetic)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive hash of every ``size`` consecutive entries of ``h`` (empty when there are fewer)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, size):
        out *= _STEP
        out += h[j : j + n]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)


def parts(batches: Iterable[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that a worker's arrays stay small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def record_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from an iterator of tuples."""
    part: list[tuple] = []
    for r in rows:
        part.append(r)
        if len(part) >= size:
            yield _batch(part, schema)
            part = []
    if part:
        yield _batch(part, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

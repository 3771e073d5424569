"""Keep-first dedup and progress counters as stateful streams (INC-1, INC-3, WIN-1).

Both run on Spark's state store, so a stream that is stopped, or loses its executors, goes on from its checkpoint with what it
knew, and no earlier input is read again.

* ``start_keep_first_stream``: the state of a copy group, named by its cell, version and text digest, is its first row: the earliest batch, then
  the source order, decide. A batch passes on the first rows of groups that it is the first to hold; it is told from others by its
  time, which the stream's log fixes for a replay too. Only row names pass through the operator, never a text.
* ``start_progress_stream``: running counts per cell in update mode; a batch writes the cells that it changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

GROUP = ("subset", "split", "transcript_version", "digest")
ORDER = ("src_rank", "file_path", "row_pos")
CELL = ("subset", "split")


def _stream(spark: SparkSession, source_dir: str, schema: T.StructType, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source_dir)


def first_rows(rows: DataFrame, keep: Sequence[str] = ("encounter_id",)) -> DataFrame:
    """For every group of a stream (GROUP, ORDER and ``keep`` columns): its first row in ``first``, with the time of its batch ``at``, and the time
    of the group's ``latest`` batch. In update mode, rows whose two times are equal are first of their group."""
    columns = [*ORDER, *(c for c in keep if c not in (*GROUP, *ORDER))]
    order = F.struct("at", *(x for c in ORDER for x in (F.col(c).isNull(), F.col(c))))
    timed = rows.select(*GROUP, *columns, F.current_timestamp().alias("at"))
    return timed.groupBy(*GROUP).agg(F.min_by(F.struct("at", *columns), order).alias("first"), F.max("at").alias("latest"))


def start_keep_first_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    out_dir: str,
    checkpoint: str,
    keep: Sequence[str] = ("encounter_id",),
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Rows landing in ``source_dir`` (with the cell, version, order and dialogue columns) -> names of the rows kept, as Parquet.

    Every batch writes a partition of its own (``epoch``), which a replay replaces. The stream takes what is there and stops; start it again
    for more.
    """
    rows = _stream(spark, source_dir, schema, files_per_batch).withColumn("digest", F.sha2(F.coalesce("dialogue", F.lit("")), 256))

    def store(batch: DataFrame, epoch: int) -> None:
        kept = batch.where("first.at = latest").select(*GROUP, "first.*").drop("at")
        kept.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_dir)

    return first_rows(rows, keep).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()


def start_progress_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    out_dir: str,
    checkpoint: str,
    by: Sequence[str] = CELL,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Rows landing in ``source_dir`` -> running counts per ``by``; each batch stores the counts that it changed."""
    counts = _stream(spark, source_dir, schema, files_per_batch).groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("dialogue")).alias("n_chars"))

    def store(batch: DataFrame, epoch: int) -> None:
        # a replayed batch replaces its own partition
        batch.withColumn("epoch", F.lit(epoch)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_dir)

    return counts.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()


def read_progress(spark: SparkSession, out_dir: str, by: Sequence[str] = CELL) -> DataFrame:
    """The latest counts per ``by``."""
    rows = spark.read.parquet(out_dir)
    last = rows.groupBy(*by).agg(F.max_by(F.struct("n_rows", "n_chars"), "epoch").alias("s"))
    return last.select(*by, "s.n_rows", "s.n_chars")

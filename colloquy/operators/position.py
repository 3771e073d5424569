"""Exact positions in a global order, for any order type, without a one-task sort (WIN-2, SRT-1, SRT-3).

Rows are dealt to range partitions of the order and sorted inside them; every partition's row count, a small table, gives
by a prefix sum the offset of the next ones, and a row's position is its partition's offset plus its place inside it.
The ordered rows are written once, so that a lost executor cannot change a count that offsets were taken from.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.operators.resolve import key_join
from colloquy.session import scratch_path

_IN_PARTITION = (1 << 33) - 1  # the low bits of monotonically_increasing_id count rows inside a partition
GROUP = 1024  # partitions whose offsets one step of the prefix sum adds up


def with_offsets(counts: DataFrame, part: str = "part", n: str = "n", out: str = "offset") -> DataFrame:
    """(part, offset): rows in all partitions of smaller number, from (part, n).

    Two levels, so that the running sum of a great many partitions is no one task's work: sums per ``GROUP`` partitions are added
    up first (one row per group), then the counts inside each group.
    """
    grouped = counts.select(F.col(part), F.col(n), F.floor(F.col(part) / GROUP).alias("_g"))
    groups = grouped.groupBy("_g").agg(F.sum(n).alias("_s"))
    before = Window.partitionBy().orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(F.col("_g"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_g").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = grouped.withColumn("_in", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    return offsets.join(groups, "_g").select(part, (F.col("_before") + F.col("_in")).cast("long").alias(out))


def ordered_table(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` written in global order, with ``_part`` (its range) and ``_at`` (0-based place in it).

    ``order`` names columns, with a leading ``-`` for descending; nulls are smallest. The input's row order breaks ties, so rows of one
    order key, however many, are dealt to several ranges.
    """
    # the row numbers that break ties must not change between the two passes of a range partitioning
    named = _written(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    by = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order] + [F.col("_row")]
    dealt = named.repartitionByRange(partitions, *by) if partitions else named.repartitionByRange(*by)
    at = F.monotonically_increasing_id().bitwiseAND(_IN_PARTITION)
    return _written(dealt.sortWithinPartitions(*by).select(*df.columns, F.spark_partition_id().alias("_part"), at.alias("_at")), "ordered")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_position(df: DataFrame, order: Sequence[str], out: str = "place", partitions: int | None = None) -> DataFrame:
    """``df`` with the 1-based position of every row in the global ``order``."""
    ranked = ordered_table(df, order, partitions)
    offsets = with_offsets(ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("n")), "_part")
    return ranked.join(offsets, "_part").select(*df.columns, (F.col("offset") + F.col("_at") + 1).alias(out))


def with_position_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "line_no", partitions: int | None = None) -> DataFrame:
    """``df`` with every row's 1-based position inside its group, by any order: text, timestamps, sparse numbers.

    A group is a stretch of the global order by (group, order); its rows may lie in many partitions. A row's number is its
    global position less that of the group's first row, a small table of one row per group. Null group values are a group.
    """
    placed = with_position(df, [*group, *order], "_place", partitions)
    first = placed.groupBy(*group).agg(F.min("_place").alias("_first"))
    return key_join(placed, first, list(group)).select(*df.columns, (F.col("_place") - F.col("_first") + 1).alias(out))

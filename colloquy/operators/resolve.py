"""Resolving flagged line ranges to transcript lines (JOIN-7, FN-17, WIN-2).

A range ``[start, end]`` (1-based, inclusive, ``end = -1`` = last line) is
resolved by one equi-join of the findings to their transcript on the
transcript key, then a row-local ``slice`` of the transcript's lines: the
output has exactly the covered lines and no (range x line) pairs are formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT
from colloquy.functions import text as tx
from colloquy.functions import verdict as vd


def key_join(left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` treating null key parts as equal; keeps the left key columns."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in key], *[c for c in right.columns if c not in key])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in key]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in key])


def flagged_ranges(findings: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """One row per actual error item of a finding: key, model, item index, line_start, line_end, reason."""
    per_model = findings.select(*key, F.explode("errors").alias("model", "items"))
    items = per_model.select(*key, "model", F.posexplode("items").alias("item", "e"))
    lines = F.coalesce(F.col("e.lines"), F.array().cast("array<int>"))
    return items.where(vd.is_actual_error(F.col("e"))).select(
        *key,
        "model",
        "item",
        F.get(lines, 0).alias("line_start"),
        F.get(lines, 1).alias("line_end"),
        F.col("e.reason").alias("reason"),
    )


def with_line_counts(
    ranges: DataFrame, corpus: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key
) -> DataFrame:
    """FN-17: attach the transcript's line count and the number of lines each range covers."""
    n = corpus.select(*key, tx.line_count("dialogue").alias("n_lines"))
    j = key_join(ranges, n, key)
    return j.withColumn("n_covered", tx.range_length(F.col("line_start"), F.col("line_end"), F.col("n_lines")))


def resolve_ranges(ranges: DataFrame, corpus: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """JOIN-7: the transcript lines inside every flagged range, with their 1-based numbers."""
    return covered_lines(key_join(ranges, corpus.select(*key, "dialogue"), key), key)


def covered_lines(j: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """The lines inside every range, from ranges that have their transcript's ``dialogue`` beside them."""
    lines = tx.split_lines("dialogue")
    n = F.size(lines)
    start = F.greatest(F.coalesce(F.col("line_start"), F.lit(1)), F.lit(1))
    end = F.least(tx.resolve_end(F.coalesce(F.col("line_end"), F.lit(-1)), n), n)
    covered = F.slice(lines, start, F.greatest(end - start + 1, F.lit(0)))
    return j.select(
        *key,
        "model",
        "item",
        start.alias("_start"),
        F.posexplode(covered).alias("_pos", "line"),
    ).select(*key, "model", "item", (F.col("_start") + F.col("_pos")).alias("line_no"), "line")


def line_table(corpus: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """WIN-2 + FN-16: one row per dialogue line with its number, speaker tag and utterance."""
    exploded = corpus.select(*key, F.posexplode(tx.split_lines("dialogue")).alias("_pos", "line"))
    return exploded.select(
        *key,
        (F.col("_pos") + 1).alias("line_no"),
        tx.speaker_tag(F.col("line")).alias("speaker"),
        tx.utterance(F.col("line")).alias("utterance"),
        "line",
    )


def number_within_group(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    out: str = "line_no",
    bucket_width: int = 1 << 16,
) -> DataFrame:
    """1-based row number of every row inside its group by ``order`` (a numeric key),
    without sending a whole group to one task.

    Rows are cut into buckets of ``bucket_width`` consecutive order values; one
    small aggregation counts rows per (group, bucket), a window over those counts
    (one row per bucket) gives each bucket's offset, and rows are numbered inside
    their bucket only. A conversation with a billion turns becomes ~15k buckets of
    at most ``bucket_width`` rows each (for dense keys such as turn numbers).
    """
    group = list(group)
    bucket = F.floor(F.col(order) / F.lit(bucket_width)).cast("long")
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w_prev = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(w_prev), F.lit(0)).alias("_offset"))
    w_in = Window.partitionBy(*group, "_bucket").orderBy(F.col(order))
    numbered = b.withColumn("_rn", F.row_number().over(w_in))
    return key_join(numbered, offsets, [*group, "_bucket"]).select(
        *[c for c in df.columns], (F.col("_offset") + F.col("_rn")).cast("long").alias(out)
    )

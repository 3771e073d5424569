"""Which lines of a transcript are flagged, and by how many judges: a sweep over the ends of flagged ranges (FN-17).

A judge's ranges are first merged into islands, so that it counts once per line. Then every island is two events, one
more judge from its first line on and one less after its last; a running sum over a transcript's events, in order of the line, gives the
number of judges between one event and the next. Work grows with the ranges, not with the lines they cover.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT
from colloquy.functions import text as tx
from colloquy.functions import verdict as vd
from colloquy.operators.resolve import key_join


def clamped_ranges(ranges: DataFrame, corpus: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(key, n_lines, model, first, last): flagged ranges cut to their transcript's lines; ranges that cover none are left out."""
    n = corpus.select(*key, tx.line_count("dialogue").cast("long").alias("n_lines"))
    j = key_join(ranges, n, key)
    first = F.greatest(F.coalesce(F.col("line_start"), F.lit(1)), F.lit(1)).cast("long")
    last = F.least(tx.resolve_end(F.coalesce(F.col("line_end"), F.lit(-1)), F.col("n_lines")), F.col("n_lines")).cast("long")
    return j.select(*key, "n_lines", "model", first.alias("first"), last.alias("last")).where("first <= last")


def merged_ranges(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, first, last): overlapping or touching ranges of one ``by`` as one (gaps and islands)."""
    before = Window.partitionBy(*by).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    upto = Window.partitionBy(*by).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    islands = ranges.withColumn("_new", opens.cast("int")).withColumn("_island", F.sum("_new").over(upto))
    return islands.groupBy(*by, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_island")


def coverage_segments(ranges: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(key, line_start, line_end, n_judges): the maximal runs of lines flagged by the same number of judges, one or more.

    ``ranges`` has the key, model, first and last.
    """
    key = list(key)
    events = merged_ranges(ranges, [*key, "model"]).select(
        *key, F.inline(F.array(F.struct(F.col("first").alias("at"), F.lit(1).cast("long").alias("step")), F.struct((F.col("last") + 1).alias("at"), F.lit(-1).cast("long").alias("step"))))
    )
    # events of one line that cancel out are no border
    steps = events.groupBy(*key, "at").agg(F.sum("step").alias("step")).where("step <> 0")
    along = Window.partitionBy(*key).orderBy("at")
    depth = F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0))
    return steps.select(*key, F.col("at").alias("line_start"), (F.lead("at").over(along) - 1).alias("line_end"), depth.alias("n_judges")).where("n_judges > 0")


def coverage_totals(segments: DataFrame, ranges: DataFrame, n_models: int, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """Per flagged transcript: its lines, those that some judge flagged, most judges and every judge flagged."""
    key = list(key)
    lines = F.col("line_end") - F.col("line_start") + 1
    covered = segments.groupBy(*key).agg(
        F.sum(lines).alias("n_flagged"),
        F.sum(F.when(vd.majority(F.col("n_judges"), n_models), lines).otherwise(0)).alias("n_majority"),
        F.sum(F.when(F.col("n_judges") == n_models, lines).otherwise(0)).alias("n_unanimous"),
    )
    return key_join(covered, ranges.groupBy(*key).agg(F.max("n_lines").alias("n_lines")), key)

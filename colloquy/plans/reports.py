"""Corpus count reports (J-C).

One scan of the published corpus reads only the partition values and the
``transcript_version`` column; the long counts it yields are vocabulary-sized
and cached, and the four reports are computed from them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from colloquy.config import DEFAULT_VOCAB, Vocabulary
from colloquy.operators import corpus as co
from colloquy.operators import counts as ct
from colloquy.sinks.layout import write_counts_csv
from colloquy.sources.tables import read_corpus


@dataclass
class CountReport:
    long: DataFrame
    overall: DataFrame
    by_split: DataFrame
    by_subset: DataFrame
    by_version: DataFrame
    order: ct.ReportOrder
    cached: DataFrame | None = None

    def unpersist(self) -> None:
        """Release the cached long counts once the reports have been written or shown."""
        if self.cached is not None:
            self.cached.unpersist()


def count_report(
    corpus: DataFrame,
    vocab: Vocabulary = DEFAULT_VOCAB,
    subsets: Sequence[str] | None = None,
    splits: Sequence[str] | None = None,
    complete: bool = True,
    out_csv: str | None = None,
) -> CountReport:
    """J-C on any canonical corpus DataFrame (FIL-4 selections, AGG-1 .. AGG-8, SNK-6)."""
    selected = co.select_subsets_splits(corpus, subsets, splits)
    long = ct.version_counts(selected).cache()
    order = ct.report_order(long, vocab)  # raises on an empty result (FIL-6)
    if out_csv:
        write_counts_csv(long, out_csv)
    return CountReport(
        long=ct.long_sorted(long, order),
        overall=ct.overall_with_totals(long, order, complete),
        by_split=ct.pivot_by_split(long, ["subset", "transcript_version"], order, complete),
        by_subset=ct.pivot_by_split(long, ["subset"], order, complete),
        by_version=ct.pivot_by_split(long, ["transcript_version"], order, complete),
        order=order,
        cached=long,
    )


def count_published(
    spark: SparkSession,
    root: str,
    vocab: Vocabulary = DEFAULT_VOCAB,
    subsets: Sequence[str] | None = None,
    splits: Sequence[str] | None = None,
    out_csv: str | None = None,
) -> CountReport:
    """J-C on a published corpus: partition pruning on the selections, one column read."""
    df = read_corpus(spark, root, subset=subsets, split=splits)
    return count_report(df.select("subset", "split", "transcript_version"), vocab, out_csv=out_csv)

"""Corpus counts and their reports (AGG-1 .. AGG-8, SRT-1 .. SRT-3, SET-5/6).

One ``groupBy(subset, split, transcript_version).count()`` touches the corpus
(partial aggregation, then one small shuffle); every report is a rollup,
grouping-sets or pivot of that tiny long table. Pivot columns and category
orders are read from the long table, whose size is bounded by the
vocabularies, never by the row count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_VOCAB, MISSING_LABEL, TOTAL_LABEL, Vocabulary


def version_counts(corpus: DataFrame) -> DataFrame:
    """AGG-1 / FN-14: rows per (subset, split, transcript_version); a null version is '<missing>'."""
    if "transcript_version" not in corpus.columns:  # FIL-5
        raise KeyError(f"missing 'transcript_version'. Columns: {corpus.columns}")
    return corpus.groupBy(
        "subset",
        "split",
        F.coalesce(F.col("transcript_version"), F.lit(MISSING_LABEL)).alias("transcript_version"),
    ).agg(F.count(F.lit(1)).cast("long").alias("count"))


@dataclass(frozen=True)
class ReportOrder:
    """Category orders read from the long counts (SRT-1, SRT-2, SET-5, SET-6)."""

    subsets: tuple[str, ...]  # category levels, in report order
    subsets_known: bool  # all observed subsets are in the configured order
    versions: tuple[str, ...]  # known versions present, then the rest sorted
    splits: tuple[str, ...]  # canonical splits present, then the rest in first-seen order

    def subset_rank(self, c: Column) -> Column:
        return F.array_position(F.array(*[F.lit(s) for s in self.subsets]), c)

    def version_rank(self, c: Column) -> Column:
        return F.array_position(F.array(*[F.lit(v) for v in self.versions]), c)


def _levels(column: str, known: Sequence[str]) -> Column:
    """The values of ``column`` as one array: configured ones in their order, then the others by name, null last."""
    place = F.nullif(F.array_position(F.array(*map(F.lit, known)), F.col(column)), F.lit(0))
    rank = F.when(F.col(column).isNull(), len(known) + 2).otherwise(F.coalesce(place, F.lit(len(known) + 1)))
    found = F.sort_array(F.collect_set(F.struct(rank.alias("rank"), F.col(column).alias("value"))))
    return F.transform(found, lambda x: x.getField("value")).alias(column)


def report_order(long_counts: DataFrame, vocab: Vocabulary = DEFAULT_VOCAB) -> ReportOrder:
    """Read the category levels: one row with three lists, collected from the counts."""
    got = long_counts.agg(
        _levels("subset", vocab.report_subset_order), _levels("transcript_version", vocab.version_order), _levels("split", vocab.splits)
    ).first()
    if not got.split and not got.subset:  # FIL-6
        raise RuntimeError("the selected subsets and splits hold no rows to count")
    known = set(got.subset) <= set(vocab.report_subset_order)
    return ReportOrder(
        tuple(vocab.report_subset_order if known else got.subset),
        known,
        tuple(got.transcript_version),
        tuple(s for s in got.split if s is not None),  # a null split has no column; its rows still count in the totals
    )


def version_categories(long_counts: DataFrame, vocab: Vocabulary = DEFAULT_VOCAB) -> DataFrame:
    """SET-5 / SET-6 / SRT-1 as a JVM query: every observed version with its report rank,
    whether it is a configured version, and whether all subsets are known."""
    known_versions = F.array(*[F.lit(v) for v in vocab.version_order])
    known_subsets = F.array(*[F.lit(s) for s in vocab.report_subset_order])
    cats = long_counts.agg(
        F.array_sort(F.collect_set("transcript_version")).alias("versions"),
        F.collect_set("subset").alias("subsets"),
    )
    present_known = F.filter(known_versions, lambda v: F.array_contains(F.col("versions"), v))
    extras = F.array_except(F.col("versions"), known_versions)
    ordered = F.concat(present_known, extras)
    return cats.select(
        F.posexplode(ordered).alias("pos", "transcript_version"),
        (F.size(F.array_except(F.col("subsets"), known_subsets)) == 0).alias("all_subsets_known"),
        known_versions.alias("_known"),
    ).select(
        "transcript_version",
        (F.col("pos") + 1).cast("long").alias("version_rank"),
        F.array_contains(F.col("_known"), F.col("transcript_version")).alias("is_known_version"),
        "all_subsets_known",
    )


def _sorted(df: DataFrame, *keys: Column) -> DataFrame:
    """Order a vocabulary-sized report inside one partition (no range-sampling job)."""
    return df.coalesce(1).sortWithinPartitions(*keys)


def _grid(long_counts: DataFrame, order: ReportOrder, index: Sequence[str] = ("subset", "transcript_version")) -> DataFrame:
    """Every combination of the category levels of ``index``, built by generators (no join, no distinct)."""
    levels = {"subset": order.subsets, "transcript_version": order.versions}
    out = long_counts.sparkSession.range(1).select()
    for col in index:
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in levels[col]])).alias(col))
    return out


def overall_with_totals(
    long_counts: DataFrame, order: ReportOrder | None = None, complete: bool = True
) -> DataFrame:
    """AGG-2 .. AGG-4, SRT-3: counts by (subset, version), an 'ALL' row per subset and a
    true grand total (rollup; the published script double-counts it, quirk Q2)."""
    order = order or report_order(long_counts)
    detail = long_counts.groupBy("subset", "transcript_version").agg(F.sum("count").alias("Count"))
    if complete:  # Q17: unobserved (subset, version) pairs show up as 0
        detail = _grid(long_counts, order).join(detail, ["subset", "transcript_version"], "left").fillna(0, ["Count"])
    rolled = detail.rollup("subset", "transcript_version").agg(
        F.sum("Count").alias("Count"), F.grouping_id().alias("_gid")
    )
    out = rolled.select(
        F.when(F.col("_gid") == 3, F.lit(TOTAL_LABEL)).otherwise(F.col("subset")).alias("subset"),
        F.when(F.col("_gid") >= 1, F.lit(TOTAL_LABEL)).otherwise(F.col("transcript_version")).alias(
            "transcript_version"
        ),
        F.col("Count").cast("long").alias("Count"),
        "_gid",
    )
    # Within a subset 'ALL' sorts before the versions (plain string order), the grand total is last.
    return _sorted(
        out, (F.col("_gid") == 3).asc(), order.subset_rank(F.col("subset")), F.col("transcript_version")
    ).drop("_gid")


def _pivot_splits(grouped_long: DataFrame, index: Sequence[str], order: ReportOrder) -> list[Column]:
    return [
        F.coalesce(F.sum(F.when(F.col("split") == s, F.col("count"))), F.lit(0)).cast("long").alias(s)
        for s in order.splits
    ]


def pivot_by_split(
    long_counts: DataFrame,
    index: Sequence[str],
    order: ReportOrder | None = None,
    complete: bool = True,
) -> DataFrame:
    """AGG-5 .. AGG-8: one column per split (canonical order first, SRT-2), a row total
    and a grand-total row labelled 'ALL'. ``index`` is any of (subset, transcript_version),
    (subset,), (transcript_version,)."""
    order = order or report_order(long_counts)
    index = list(index)
    long = long_counts
    if complete:
        grid = _grid(long_counts, order, index)
        zero = grid.select(*index, F.lit(None).cast("string").alias("split"), F.lit(0).cast("long").alias("count"))
        long = long_counts.select(*index, "split", "count").unionByName(zero)
    split_cols = _pivot_splits(long, index, order)
    agg = long.groupingSets([index, []], *index).agg(
        *split_cols, F.sum("count").cast("long").alias("Total"), F.grouping_id().alias("_gid")
    )
    labelled = agg.select(
        *[F.when(F.col("_gid") > 0, F.lit(TOTAL_LABEL)).otherwise(F.col(c)).alias(c) for c in index],
        *order.splits,
        "Total",
        "_gid",
    )
    sort_keys = [(F.col("_gid") > 0).asc()]
    if "subset" in index:
        sort_keys.append(order.subset_rank(F.col("subset")))
    if "transcript_version" in index:
        sort_keys.append(order.version_rank(F.col("transcript_version")))
    return _sorted(labelled, *sort_keys).drop("_gid")


def long_sorted(long_counts: DataFrame, order: ReportOrder | None = None) -> DataFrame:
    """SRT-1: subset and version in category order, then split alphabetically."""
    order = order or report_order(long_counts)
    return _sorted(
        long_counts,
        order.subset_rank(F.col("subset")),
        order.version_rank(F.col("transcript_version")),
        F.col("split"),
    )


def complete_long(long_counts: DataFrame, order: ReportOrder | None = None) -> DataFrame:
    """Q17 in long form: every (subset, version, split) of the category grid, zero-filled."""
    order = order or report_order(long_counts)
    grid = _grid(long_counts, order).select(
        "subset", "transcript_version", F.explode(F.array(*[F.lit(s) for s in order.splits])).alias("split")
    )
    return grid.join(long_counts, ["subset", "transcript_version", "split"], "left").select(
        "subset", "split", "transcript_version", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")
    )

"""Corpus operators: routing, version lookup, union, keep-first dedup, samples.

Each is a ``DataFrame -> DataFrame`` function on the canonical record
(``subset, split, encounter_id, transcript_version, dialogue, note`` plus an
order key). Nothing here collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_VOCAB, Vocabulary
from colloquy.functions import text as tx

DEFAULT_ORDER = ("src_rank", "file_path", "row_pos")
DEFAULT_CELL = ("subset", "split")
DEFAULT_DEDUP_KEY = ("transcript_version", "dialogue")


def _unknown_error(what: str, value: Column, expected: Sequence[str]) -> Column:
    return F.raise_error(
        F.concat(
            F.lit(f"Unknown {what} '"),
            F.coalesce(value, F.lit("")),
            F.lit(f"'. Expected one of: {sorted(expected)}"),
        )
    )


def route_subsets(
    df: DataFrame,
    vocab: Vocabulary = DEFAULT_VOCAB,
    subset_col: str = "subset",
    on_unknown: str = "drop",
) -> DataFrame:
    """FIL-1 / FIL-3: keep rows of configured subsets; unknown rows are dropped or fail the job."""
    known = F.col(subset_col).isin(list(vocab.subsets))
    if on_unknown == "drop":
        return df.where(known)
    if on_unknown == "error":
        checked = F.when(known, F.col(subset_col)).otherwise(
            _unknown_error("subset/dataset", F.col(subset_col), vocab.subsets)
        )
        return df.withColumn(subset_col, checked)
    raise ValueError(f"on_unknown must be 'drop' or 'error', got {on_unknown!r}")


def route_cells(df: DataFrame, vocab: Vocabulary = DEFAULT_VOCAB) -> DataFrame:
    """FIL-2: keep rows whose (split, subset) are both configured (used for variant files)."""
    return df.where(F.col("split").isin(list(vocab.splits)) & F.col("subset").isin(list(vocab.subsets)))


def select_subsets_splits(
    df: DataFrame, subsets: Sequence[str] | None = None, splits: Sequence[str] | None = None
) -> DataFrame:
    """FIL-4: optional user selection; values not present simply match nothing."""
    if subsets:
        df = df.where(F.col("subset").isin(list(subsets)))
    if splits:
        df = df.where(F.col("split").isin(list(splits)))
    return df


def default_version(subset: Column, vocab: Vocabulary = DEFAULT_VOCAB) -> Column:
    """JOIN-3 as a map lookup: the mapping is configuration, so it is a literal map, not a join."""
    mapping = F.create_map(*[F.lit(x) for kv in vocab.challenge_version for x in kv])
    return F.try_element_at(mapping, subset)


def attach_default_version(
    df: DataFrame, vocab: Vocabulary = DEFAULT_VOCAB, on_unknown: str = "error"
) -> DataFrame:
    """JOIN-3 + FIL-3: set transcript_version from the subset; unknown subsets fail or drop."""
    tv = default_version(F.col("subset"), vocab)
    if on_unknown == "drop":
        return df.withColumn("transcript_version", tv).where(F.col("transcript_version").isNotNull())
    known = [k for k, _ in vocab.challenge_version]
    return df.withColumn(
        "transcript_version",
        F.when(tv.isNotNull(), tv).otherwise(_unknown_error("subset/dataset", F.col("subset"), known)),
    )


def with_enumerated(df: DataFrame) -> DataFrame:
    """PRJ-1 helper: add the line-numbered copy of the dialogue (FN-3)."""
    return df.withColumn("enumerated_dialogue", tx.enumerate_dialogue("dialogue"))


def union_sources(*sources: DataFrame) -> DataFrame:
    """SET-1: union by column name; earlier arguments rank first for keep-first dedup."""
    out = None
    for rank, src in enumerate(sources):
        src = src.withColumn("src_rank", F.lit(rank)) if "src_rank" not in src.columns else src
        out = src if out is None else out.unionByName(src, allowMissingColumns=True)
    if out is None:
        raise ValueError("union_sources needs at least one DataFrame")
    return out


def _digest(key: Sequence[str]) -> list[Column]:
    """The dedup key without its texts: a dialogue takes part as its SHA-256, so no text is an exchange or sort key."""
    return [F.sha2(F.col(k), 256) if k == "dialogue" else F.col(k) for k in key]


def dedup_keep_first(
    df: DataFrame,
    cell: Sequence[str] = DEFAULT_CELL,
    key: Sequence[str] = DEFAULT_DEDUP_KEY,
    order: Sequence[str] = DEFAULT_ORDER,
) -> DataFrame:
    """WIN-1: within each cell keep the first row (by ``order``) of every distinct ``key``.

    Planned as ``row_number() = 1``: Spark inserts a partial WindowGroupLimit
    before the shuffle, so a key with millions of copies leaves each map task
    as one row. Texts travel only where the caller keeps them.
    """
    names = [f"_k{i}" for i in range(len(key))]
    keyed = df.select("*", *(c.alias(n) for c, n in zip(_digest(key), names, strict=True)))
    w = Window.partitionBy(*cell, *names).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    return keyed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", *names)


def dedup_keep_first_counted(
    df: DataFrame,
    cell: Sequence[str] = DEFAULT_CELL,
    key: Sequence[str] = DEFAULT_DEDUP_KEY,
    order: Sequence[str] = DEFAULT_ORDER,
) -> DataFrame:
    """WIN-1 as an aggregation that also counts what it removed (AGG-18 in the same pass).

    Every column is the ``min_by`` of the order key, which is unique, so all
    come from the first row of the (cell, key), and columns the caller drops
    are never shuffled. ``n_copies`` records how many input rows a row stands for.
    Both combine map-side: a key with millions of copies leaves each map task
    as one row; the dedup report is a sum over the output.
    """
    names = [f"_k{i}" for i in range(len(key))]
    keyed = df.select("*", *(c.alias(n) for c, n in zip(_digest(key), names, strict=True)))
    first = F.struct(*[F.col(o) for o in order])
    kept = keyed.groupBy(*cell, *names).agg(
        *[F.min_by(c, first).alias(c) for c in df.columns if c not in cell], F.count(F.lit(1)).cast("long").alias("n_copies")
    )
    return kept.select(*df.columns, "n_copies")


def dedup_report_from_counts(kept: DataFrame, cell: Sequence[str] = DEFAULT_CELL) -> DataFrame:
    """AGG-18 from ``dedup_keep_first_counted`` output: rows in = sum of copies, rows out = rows."""
    cell = list(cell)
    per_cell = kept.groupBy(*cell).agg(
        F.sum("n_copies").cast("long").alias("rows_in"), F.count(F.lit(1)).cast("long").alias("rows_out")
    )
    total = per_cell.groupBy().agg(
        *[F.lit(None).cast("string").alias(c) for c in cell],
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_out").alias("rows_out"),
    )
    both = per_cell.withColumn("level", F.lit("cell")).unionByName(total.withColumn("level", F.lit("total")))
    return both.select(
        "level",
        *cell,
        F.col("rows_in").cast("long").alias("rows_in"),
        F.col("rows_out").cast("long").alias("rows_out"),
        (F.col("rows_in") - F.col("rows_out")).cast("long").alias("duplicates_removed"),
    )


def dedup_report(
    before: DataFrame, after: DataFrame, cell: Sequence[str] = DEFAULT_CELL
) -> DataFrame:
    """AGG-18: rows in, rows kept and duplicates removed per cell, plus the overall total.

    Both sides are reduced to one row per cell before they meet, so the join
    is between two tiny tables.
    """
    cell = list(cell)
    rows_in = before.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows_in"))
    rows_out = after.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows_out"))
    per_cell = rows_in.join(rows_out, cell, "left").fillna(0, ["rows_out"])
    total = per_cell.groupBy().agg(
        *[F.lit(None).cast("string").alias(c) for c in cell],
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_out").alias("rows_out"),
    )
    both = per_cell.withColumn("level", F.lit("cell")).unionByName(total.withColumn("level", F.lit("total")))
    return both.select(
        "level",
        *cell,
        F.col("rows_in").cast("long").alias("rows_in"),
        F.col("rows_out").cast("long").alias("rows_out"),
        (F.col("rows_in") - F.col("rows_out")).cast("long").alias("duplicates_removed"),
    )


def sample_per_cell(
    df: DataFrame,
    n: int = 5,
    cell: Sequence[str] = DEFAULT_CELL,
    order: Sequence[str] = DEFAULT_ORDER,
    buckets: int = 1024,
) -> DataFrame:
    """WIN-3 / LIM-1: the first ``n`` rows of every cell in source order.

    Two levels, both planned with a partial WindowGroupLimit before their
    shuffle: first the top ``n`` per (cell, bucket), the bucket the input
    partition, so every task passes on at most ``n`` rows per cell and the first
    shuffle spreads over cells x buckets; then the top ``n`` per
    cell over at most ``n * buckets`` rows. Exact whatever the bucket: a cell's
    first ``n`` rows are among the first ``n`` of their buckets.
    """
    keys = [F.col(o).asc_nulls_first() for o in order]
    # One struct key, so a partitioning on the cell alone cannot satisfy this level:
    # Spark must spread it over (cell, bucket) instead of reusing one per-cell shuffle.
    w1 = Window.partitionBy(F.struct(*[F.col(c) for c in cell], F.col("_bucket"))).orderBy(*keys)
    first = (
        df.withColumn("_bucket", F.spark_partition_id() % buckets)
        .withColumn("_r", F.row_number().over(w1))
        .where(F.col("_r") <= n)
        .drop("_r", "_bucket")
    )
    w2 = Window.partitionBy(*cell).orderBy(*keys)
    return first.withColumn("sample_rank", F.row_number().over(w2)).where(F.col("sample_rank") <= n)


def cell_counts(df: DataFrame, cell: Sequence[str] = DEFAULT_CELL) -> DataFrame:
    """AGG-17 / AGG-19: rows per cell."""
    return df.groupBy(*cell).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


def list_cells(df: DataFrame) -> DataFrame:
    """SRC-9: the (subset, split) pairs present; on a partitioned read this touches only partition values."""
    return df.select("subset", "split").distinct()

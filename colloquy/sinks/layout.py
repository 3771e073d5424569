"""Corpus sinks: partitioned Parquet, per-cell JSON samples, layout manifest, counts CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_VOCAB, Vocabulary
from colloquy.functions.names import layout_path
from colloquy.operators.counts import report_order
from colloquy.operators.corpus import DEFAULT_ORDER, sample_per_cell
from colloquy.operators.resolve import key_join


def write_corpus(df: DataFrame, root: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """SNK-1: one Parquet dataset partitioned by (subset, split); the route column is not stored.

    The rebalance hint lets AQE bring small pieces of a cell together and split a
    cell that holds a third of all rows, so files are neither tiny nor unbounded.
    Empty cells leave no folder, which the manifest records.
    """
    (
        df.select(*columns, "subset", "split")
        .hint("rebalance", "subset", "split")
        .write.mode(mode)
        .partitionBy("subset", "split")
        .parquet(root)
    )


def write_samples(
    df: DataFrame, root: str, columns: Sequence[str], n: int = 5, order: Sequence[str] = DEFAULT_ORDER
) -> None:
    """SNK-2: the first ``n`` records of every cell as JSON lines.

    The winners, at most ``n`` per cell, are picked on the cell and the (unique) order key alone; their texts are
    read in a second scan and gathered into one partition.
    """
    at = ["subset", "split", *order]
    sample = key_join(df, sample_per_cell(df.select(*at), n=n, order=order), at)
    (
        sample.select(*columns, "subset", "split", "sample_rank")
        .repartition(1)
        .write.mode("overwrite")
        .partitionBy("subset", "split")
        .json(root)
    )


def manifest(spark: SparkSession, cell_counts: DataFrame | None, vocab: Vocabulary = DEFAULT_VOCAB) -> DataFrame:
    """SNK-7 / FN-15: one row per configured (config, split) with its path, the default
    flag (first config) and the rows written (0 for an empty cell).

    The spine comes from two generators over the configured lists; the counts
    (one row per cell) are joined in.
    """
    spine = (
        spark.range(1)
        .select(F.posexplode(F.array(*[F.lit(s) for s in vocab.subsets])).alias("config_rank", "config"))
        .select(
            "config_rank",
            "config",
            F.posexplode(F.array(*[F.lit(s) for s in vocab.splits])).alias("split_rank", "split"),
        )
    )
    out = spine.select(
        "config",
        "split",
        layout_path("config", "split").alias("path"),
        (F.col("config_rank") == 0).alias("is_default"),
        "config_rank",
        "split_rank",
    )
    if cell_counts is not None:
        counts = cell_counts.select(F.col("subset").alias("config"), "split", "n_rows")
        out = out.join(counts, ["config", "split"], "left").withColumn(
            "n_rows", F.coalesce(F.col("n_rows"), F.lit(0)).cast("long")
        )
    # Vocabulary-sized: ordered inside one partition.
    return out.coalesce(1).sortWithinPartitions("config_rank", "split_rank").drop("config_rank", "split_rank")


def write_counts_csv(long_counts: DataFrame, path: str, vocab: Vocabulary = DEFAULT_VOCAB) -> None:
    """SNK-6: long-form counts CSV (subset, split, transcript_version, count) in category order, extras last; tiny input."""
    order = report_order(long_counts, vocab)
    (
        long_counts.select("subset", "split", "transcript_version", "count")
        .coalesce(1)
        .sortWithinPartitions(order.subset_rank(F.col("subset")), order.version_rank(F.col("transcript_version")), "split")
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )

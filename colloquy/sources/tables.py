"""Reading the published layout (SRC-7 .. SRC-9).

The corpus is one Parquet dataset partitioned by ``subset`` and ``split``; a
named read is a partition filter, so Spark opens only the matching folders
(``PartitionFilters`` in the scan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.schemas import EXTENDED_RECORD_COLUMNS, PARTITION_COLUMNS


def parse_split_expr(expr: str | Sequence[str]) -> list[list[str]]:
    """SRC-8: ``"test1+test2+test3"`` -> [[test1, test2, test3]]; a list gives one group per item."""
    items = [expr] if isinstance(expr, str) else list(expr)
    return [[p.strip() for p in item.split("+") if p.strip()] for item in items]


def select_splits(df: DataFrame, expr: str | Sequence[str], label: str = "selection") -> DataFrame:
    """SRC-8 / SET-2 on a DataFrame: rows of the requested splits, tagged with the group they
    were requested in (``a+b`` concatenates; a list keeps groups apart)."""
    out = None
    for group in parse_split_expr(expr):
        part = df.where(F.col("split").isin(group)).withColumn(label, F.lit("+".join(group)))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("empty split expression")
    return out


def read_corpus(
    spark: SparkSession,
    root: str,
    subset: str | Sequence[str] | None = None,
    split: str | Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """SRC-7: read a published corpus; subset/split selections prune partitions."""
    df = spark.read.option("basePath", root).parquet(root)
    if subset is not None:
        subsets = [subset] if isinstance(subset, str) else list(subset)
        df = df.where(F.col("subset").isin(subsets))
    if split is not None:
        groups = parse_split_expr(split)
        df = df.where(F.col("split").isin([s for g in groups for s in g]))
    if columns:
        df = df.select(*PARTITION_COLUMNS, *[c for c in columns if c not in PARTITION_COLUMNS])
    return df


def read_corpus_record(spark: SparkSession, root: str, **kw) -> DataFrame:
    kw.setdefault("columns", EXTENDED_RECORD_COLUMNS)
    return read_corpus(spark, root, **kw)


def available_cells(spark: SparkSession, root: str) -> DataFrame:
    """SRC-9: (subset, split) pairs present in a published corpus."""
    return spark.read.option("basePath", root).parquet(root).select("subset", "split").distinct()

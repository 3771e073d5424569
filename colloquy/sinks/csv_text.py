"""CSV files as other tools write them: RFC 4180 quoting, a header per file, any column order per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def csv_line(fields: Column) -> Column:
    """An array of texts as one CSV record: every field quoted, quotes doubled, null as an empty field."""
    return F.array_join(F.transform(fields, lambda x: F.concat(F.lit('"'), F.replace(F.coalesce(x, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))), ",")


def write_csv_text(rows: DataFrame, root: str, file_no: str, order: Sequence[str], line: str = "line", header: str = "header") -> None:
    """One file per value of the integer column ``file_no`` in ``root/file_no=.../``: its header, then its lines in ``order``.

    ``rows`` holds finished records in ``line`` and the file's header record in ``header``. A header is a row of its own that sorts ahead of the file's lines, so
    a file is written as a stream by the task that its number is dealt to.
    """
    at = [f"_o{i}" for i in range(len(order))]
    lines = rows.select(F.col(file_no).cast("int").alias("file_no"), F.lit(1).alias("_kind"), *[F.col(c).alias(a) for c, a in zip(order, at, strict=True)], F.col(line).alias("value"))
    heads = rows.groupBy(F.col(file_no).cast("int").alias("file_no")).agg(F.min(header).alias("value"))
    heads = heads.select("file_no", F.lit(0).alias("_kind"), *[F.lit(None).cast(lines.schema[a].dataType).alias(a) for a in at], "value")
    out = lines.unionByName(heads).repartition("file_no").sortWithinPartitions("file_no", "_kind", *at)
    out.select("file_no", "value").write.partitionBy("file_no").text(root)

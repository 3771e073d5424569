"""The corpus stored in buckets of its transcript key, and looked up without moving its texts (JOIN-7).

Rows are dealt to buckets by a hash of the key (null parts count as equal) and sorted by it. A join of findings with the stored corpus
then deals only the findings to the same buckets: each task reads its bucket's texts where they lie, and no exchange carries a dialogue.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT

HASH = "_key_hash"


def store_bucketed(corpus: DataFrame, table: str, path: str, buckets: int, key: Sequence[str] = DEFAULT_AUDIT.key) -> None:
    """Write ``corpus`` as the external table ``table`` at ``path``, in ``buckets`` buckets by the key.

    Rows are dealt to the buckets before the write, so that each bucket is one file.
    """
    rows = corpus.withColumn(HASH, F.xxhash64(*key)).repartition(buckets, HASH)
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, HASH).sortBy(HASH).saveAsTable(table)


def with_transcripts(spark: SparkSession, rows: DataFrame, table: str, columns: Sequence[str], key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """``rows`` (few, with the key) with the named columns of their transcripts in the bucketed ``table``.

    The stored side keeps its buckets: a shuffled hash or sort-merge join deals ``rows`` to them; if ``rows`` are small enough to be broadcast, none move.
    """
    stored = spark.table(table)
    left = rows.withColumn(HASH, F.xxhash64(*key))
    # The hash alone is the equi-key, so that the buckets' dealing fits. Compared one by one, the key columns would become
    # equi-keys too; inside a function over an array they are looked at row by row.
    pairs = F.array(*[F.struct(left[k].cast("string").alias("l"), stored[k].cast("string").alias("r")) for k in key])
    on = (left[HASH] == stored[HASH]) & F.forall(pairs, lambda p: p["l"].eqNullSafe(p["r"]))
    return left.join(stored, on).select(*[left[c] for c in rows.columns], *[stored[c] for c in columns if c not in rows.columns])

"""Reading stored findings and progress (SRC-10, SRC-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.schemas import FINDING, PROGRESS, PROGRESS_JSON
from colloquy.sources.csv_files import has_files


def _exists(spark: SparkSession, path: str) -> bool:
    return has_files(spark, path)


def read_findings_json(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: findings in the published shape (one JSON array of records per file);
    a missing file or folder gives an empty table with the finding schema."""
    if not _exists(spark, path):
        return spark.createDataFrame([], FINDING)
    return spark.read.schema(FINDING).option("multiLine", True).json(path)


def read_progress_json(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: the shipped ``{subset: [[split, encounter_id], ...]}`` object as a
    distinct (subset, split, encounter_id) table; a missing file gives an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    raw = spark.read.option("wholetext", True).text(path)
    m = raw.select(F.explode(F.from_json("value", PROGRESS_JSON)).alias("subset", "pairs"))
    pairs = m.select("subset", F.explode("pairs").alias("p"))
    return pairs.select(
        "subset", F.get("p", 0).alias("split"), F.get("p", 1).alias("encounter_id")
    ).distinct()

"""Corpus build jobs (J-A basic, J-B extended).

read CSVs -> normalise -> (J-B: + variant files, union) -> route -> keep-first
dedup per cell (an aggregation that also counts the copies it removed) ->
number the lines -> one partitioned Parquet write -> samples, manifest and the
dedup report from the written table (the write cuts the lineage, so nothing
upstream is recomputed, and the input is read once).

Shuffles: one, for the dedup (J-B), carrying each text once; J-A has none
before the write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_VOCAB, BuildOptions, Vocabulary
from colloquy.operators import corpus as co
from colloquy.schemas import BASIC_RECORD_COLUMNS, EXTENDED_RECORD_COLUMNS
from colloquy.sinks.layout import manifest, write_corpus, write_samples
from colloquy.sources import csv_files as cf

# Provenance kept next to the record columns: which source, file and position a
# record came from (and, in the extended build, how many input rows it stands
# for). They give the keep-first order for samples and the dedup report without
# re-running the build; the named reader leaves them out by default.
PROVENANCE_COLUMNS = ("src_rank", "file_path", "row_pos")


@dataclass
class BuildResult:
    corpus: DataFrame  # the written corpus, read back
    manifest: DataFrame
    dedup_report: DataFrame | None
    data_root: str


def _paths(out_root: str) -> dict[str, str]:
    root = out_root.rstrip("/")
    return {"data": f"{root}/data", "samples": f"{root}/samples", "manifest": f"{root}/manifest"}


def _finish(
    spark: SparkSession, out_root: str, columns, vocab: Vocabulary, options: BuildOptions
) -> tuple[DataFrame, DataFrame]:
    p = _paths(out_root)
    written = spark.read.option("basePath", p["data"]).parquet(p["data"])
    write_samples(written, p["samples"], columns, n=options.sample_size)
    man = manifest(spark, co.cell_counts(written), vocab).withColumn(
        "location", F.concat(F.lit(p["data"] + "/subset="), F.col("config"), F.lit("/split="), F.col("split"))
    )
    man.coalesce(1).write.mode("overwrite").parquet(p["manifest"])
    return written, spark.read.parquet(p["manifest"])


def build_basic(
    spark: SparkSession,
    data_dir: str,
    out_root: str,
    vocab: Vocabulary = DEFAULT_VOCAB,
    options: BuildOptions = BuildOptions(on_unknown_subset="drop"),
) -> BuildResult:
    """J-A: five challenge files -> (subset, split) Parquet dataset; unknown subsets dropped."""
    rows = cf.read_challenge(spark, data_dir, vocab, options, extended=False)
    columns = list(BASIC_RECORD_COLUMNS) + list(PROVENANCE_COLUMNS)
    write_corpus(rows, _paths(out_root)["data"], columns)
    written, man = _finish(spark, out_root, BASIC_RECORD_COLUMNS, vocab, options)
    return BuildResult(written, man, None, _paths(out_root)["data"])


def extended_rows(
    spark: SparkSession,
    data_dir: str,
    vocab: Vocabulary = DEFAULT_VOCAB,
    options: BuildOptions = BuildOptions(),
) -> DataFrame:
    """J-B before dedup: challenge rows then variant rows, routed to configured cells."""
    challenge = cf.read_challenge(spark, data_dir, vocab, options, extended=True)
    variants = cf.read_variants(spark, cf.discover_variants(spark, data_dir, vocab), options)
    rows = challenge if variants is None else co.union_sources(challenge, variants)
    return co.route_cells(rows, vocab)


def build_extended(
    spark: SparkSession,
    data_dir: str,
    out_root: str,
    vocab: Vocabulary = DEFAULT_VOCAB,
    options: BuildOptions = BuildOptions(),
) -> BuildResult:
    """J-B: challenge + variant files, keep-first dedup per cell on (dialogue, version)."""
    rows = extended_rows(spark, data_dir, vocab, options)
    kept = co.with_enumerated(co.dedup_keep_first_counted(rows))
    columns = list(EXTENDED_RECORD_COLUMNS) + list(PROVENANCE_COLUMNS) + ["n_copies"]
    write_corpus(kept, _paths(out_root)["data"], columns)
    written, man = _finish(spark, out_root, EXTENDED_RECORD_COLUMNS, vocab, options)
    report = co.dedup_report_from_counts(written.select("subset", "split", "n_copies"))
    return BuildResult(written, man, report, _paths(out_root)["data"])

"""Canonical views over the driver's test tables.

The test tables hold no clinical corpus, so a fixed mapping turns them into
one (every row is kept; nothing is filtered or capped):

* ``documents`` -> transcript corpus: ``encounter_id = doc_id``,
  ``subset = lang``, ``split`` = one of the five splits chosen by
  ``n_chars mod 5`` (exact copies share a length, so copies share a split the
  way one encounter stays in one split), ``transcript_version`` = one of the
  three versions chosen by the number in ``source`` mod 3, ``dialogue = text``.
* ``conversations`` -> dialogues: ``[role] text`` lines ordered by turn.
* ``labels`` -> the evidence used by three deterministic stand-in judges
  (they are stand-ins for model calls, with no claim to model quality).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import REPORT_SUBSET_ORDER, SPLITS, VERSION_ORDER, AuditConfig, Vocabulary
from colloquy.operators.audit import ColumnJudge

TESTDATA_VOCAB = Vocabulary(
    subsets=("en", "de", "fr", "es"),
    splits=SPLITS,
    version_order=VERSION_ORDER,
    report_subset_order=REPORT_SUBSET_ORDER,
    challenge_version=(("en", "asr"), ("de", "humantrans"), ("fr", "humantrans"), ("es", "asrcorr")),
)

# doc_id is unique in the test tables, so the four published key columns identify a transcript.
TESTDATA_AUDIT = AuditConfig(
    judges=("judge/quality", "judge/toxicity", "judge/length"),
    key=("subset", "split", "encounter_id", "transcript_version"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def split_of(n_chars: Column) -> Column:
    return _pick(SPLITS, F.pmod(n_chars, F.lit(5)))


def version_of(source: Column) -> Column:
    num = F.regexp_extract(source, r"(\d+)$", 1).try_cast("int")
    return _pick(VERSION_ORDER, F.pmod(num, F.lit(3)))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transcript corpus in canonical form with a source-order key."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("encounter_id"),
        F.col("lang").alias("subset"),
        split_of(F.col("n_chars")).alias("split"),
        version_of(F.col("source")).alias("transcript_version"),
        F.coalesce(F.col("text"), F.lit("")).alias("dialogue"),
        F.col("source").alias("note"),
        F.lit(0).alias("src_rank"),
        F.lit("documents").alias("file_path"),
        F.col("doc_id").alias("row_pos"),
        F.col("doc_id"),
        F.col("n_chars"),
    )


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``[role] text`` line per turn; newlines inside a turn become spaces."""
    c = table(spark, sf_dir, "conversations")
    line = F.concat(
        F.lit("["), F.coalesce("role", F.lit("")), F.lit("] "), F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))
    )
    return c.select("conv_id", "turn", line.alias("line"))


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogue text per conversation, lines in turn order: one value per conversation, as the data model requires."""
    lines = conversation_lines(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "line"))).alias("_l"))
    return lines.select("conv_id", F.array_join(F.transform("_l", lambda x: x.getField("line")), "\n").alias("dialogue"))


def labelled_prompt_inputs(spark: SparkSession, sf_dir: str, corpus_df: DataFrame | None = None) -> DataFrame:
    """Corpus rows with the label columns the stand-in judges read.

    ``labels`` grows with the corpus, so this is a plain join: AQE turns it
    into a broadcast only when the runtime size is under the threshold.
    """
    corpus_df = corpus_df if corpus_df is not None else corpus(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return corpus_df.join(labels, "doc_id", "left")


def _resp(*items: tuple[int, int, str]) -> str:
    body = ",".join(f'{{"lines":[{a},{b}],"reason":"{r}"}}' for a, b, r in items)
    return f'{{"errors":[{body}]}}'


# Response texts of the stand-in judges (shared with the SQL oracle).
RESP_QUALITY_FLAG = _resp((2, -1, "low quality from line 2 on"))
RESP_TOXIC_FLAG = _resp((1, -1, "whole transcript flagged"))
RESP_SHORT_FLAG = _resp((1, 1, "first line only"), (-1, -1, "rest is fine"))
RESP_CLEAN = _resp((-1, -1, "no swapped tags"))
RESP_MALFORMED = '{"errors": [{"lines": [3, '
SHORT_TEXT_CHARS = 500
# Answers that break the contract in one way each, given for doc_id mod 17 = 0, 1, 2, ...
ODD_EVERY = 17
ODD_RESPONSES = (
    RESP_MALFORMED,  # cut off
    RESP_CLEAN + " Hope this helps.",  # text after the object
    RESP_CLEAN.replace('"', "'"),  # not JSON
    '{"errors":[{"lines":[-1,-1],"reason":"fine","sure":true}]}',  # parses, with a field too many
    '{"errors":[{"lines":[-1,-1]}]}',  # parses, without a reason
)
ODD_MALFORMED = 3  # so many of them are not one JSON object


def testdata_judges() -> list[ColumnJudge]:
    """Three deterministic judges over label columns; a missing label is a failed call."""
    quality = ColumnJudge(
        "judge/quality",
        lambda: F.when(F.col("quality").isNull(), F.lit(None).cast("string"))
        .when(F.col("quality") == 0, F.lit(RESP_QUALITY_FLAG))
        .otherwise(F.lit(RESP_CLEAN)),
    )
    toxicity = ColumnJudge(
        "judge/toxicity",
        lambda: F.when(F.col("toxic").isNull(), F.lit(None).cast("string"))
        .when(F.col("toxic") == 1, F.lit(RESP_TOXIC_FLAG))
        .otherwise(F.lit(RESP_CLEAN)),
    )
    length = ColumnJudge(
        "judge/length",
        lambda: F.when(
            F.col("doc_id") % ODD_EVERY < len(ODD_RESPONSES), _pick(ODD_RESPONSES, F.least(F.col("doc_id") % ODD_EVERY, F.lit(len(ODD_RESPONSES) - 1)))
        )
        .when(F.col("n_chars") < SHORT_TEXT_CHARS, F.lit(RESP_SHORT_FLAG))
        .otherwise(F.lit(RESP_CLEAN)),
    )
    return [quality, toxicity, length]

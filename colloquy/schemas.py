"""Declared schemas. Nothing is inferred at the source."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# Challenge split file: dataset column routes the row, the rest is payload.
CHALLENGE_CSV = T.StructType(
    [
        T.StructField("dataset", S),
        T.StructField("encounter_id", S),
        T.StructField("dialogue", S),
        T.StructField("note", S),
    ]
)

BASIC_RECORD_COLUMNS = ("encounter_id", "dialogue", "note")
EXTENDED_RECORD_COLUMNS = ("encounter_id", "transcript_version", "dialogue", "enumerated_dialogue", "note")
PARTITION_COLUMNS = ("subset", "split")

ERROR_ITEM = T.StructType(
    [
        T.StructField("lines", T.ArrayType(T.IntegerType())),
        T.StructField("reason", S),
    ]
)
ERROR_LIST = T.ArrayType(ERROR_ITEM)

# What a judge is asked to return.
JUDGE_RESPONSE = T.StructType([T.StructField("errors", ERROR_LIST)])

FINDING = T.StructType(
    [
        T.StructField("subset", S),
        T.StructField("split", S),
        T.StructField("encounter_id", S),
        T.StructField("transcript_version", S),
        T.StructField("models_with_errors", T.ArrayType(S)),
        T.StructField("errors", T.MapType(S, ERROR_LIST)),
    ]
)

PROGRESS = T.StructType(
    [
        T.StructField("subset", S),
        T.StructField("split", S),
        T.StructField("encounter_id", S),
    ]
)

# The shipped progress file: {"subset": [["split", "encounter_id"], ...]}
PROGRESS_JSON = T.MapType(S, T.ArrayType(T.ArrayType(S)))

# Long verdict table: one row per (transcript, judge). Single source of truth
# for progress, findings and metrics.
VERDICT = T.StructType(
    [
        T.StructField("subset", S),
        T.StructField("split", S),
        T.StructField("encounter_id", S),
        T.StructField("transcript_version", S),
        T.StructField("judge_rank", T.IntegerType()),
        T.StructField("model", S),
        T.StructField("status", S),
        T.StructField("response", S),
        T.StructField("n_lines", T.IntegerType()),
    ]
)

COUNTS_LONG = T.StructType(
    [
        T.StructField("subset", S),
        T.StructField("split", S),
        T.StructField("transcript_version", S),
        T.StructField("count", T.LongType()),
    ]
)

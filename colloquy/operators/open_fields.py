"""Findings whose unknown fields are kept (SRC-10, SNK-3, FN-7).

A judge may answer with more than the contract asks for. Responses are parsed once into Variant values: what the audit
needs is taken out by path, and every error item stays as it came, through findings, their JSON files and rewrites. ``field_report`` tells
which fields there are, of which type and how often, so that a drifting judge shows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT, NO_ERROR_RANGE
from colloquy.sources.csv_files import has_files

KNOWN_ITEM_FIELDS = ("lines", "reason")


def answer_items(response: Column) -> Column:
    """The error items of a response that is one JSON object, as Variants; anything else has none."""
    answer = F.try_parse_json(response)
    items = F.try_variant_get(answer, "$.errors", "array<variant>")
    return F.coalesce(F.when(F.schema_of_variant(answer).startswith("OBJECT"), items), F.array().cast("array<variant>"))


def actual_item(item: Column) -> Column:
    """FN-9 on a Variant item: its lines are not [-1, -1]."""
    lines = F.coalesce(F.try_variant_get(item, "$.lines", "array<int>"), F.array().cast("array<int>"))
    return ~((F.size(lines) == 2) & F.coalesce((F.get(lines, 0) == NO_ERROR_RANGE[0]) & (F.get(lines, 1) == NO_ERROR_RANGE[1]), F.lit(False)))


def open_findings(wide: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(key, models_with_errors, errors) of flagged transcripts, errors being judge -> items as the judge wrote them.

    ``wide`` has one row per transcript with its ``verdicts`` (from ``fan_out`` or ``gather_verdicts``); judges without
    items are left out. Each response is parsed once, and no row meets another.
    """
    parsed = F.transform(
        F.array_sort("verdicts"),
        lambda v: F.struct(v["model"].alias("model"), F.when(v["status"] == "ok", answer_items(v["response"])).otherwise(F.array().cast("array<variant>")).alias("items")),
    )
    judged = wide.select(*key, F.filter(parsed, lambda j: F.size(j["items"]) > 0).alias("judges"))
    models = F.transform(F.filter("judges", lambda j: F.exists(j["items"], actual_item)), lambda j: j["model"])
    return judged.select(*key, models.alias("models_with_errors"), F.map_from_entries("judges").alias("errors")).where(F.size("models_with_errors") > 0)


def write_open_findings(findings: DataFrame, path: str) -> None:
    """Findings as JSON lines, a folder per subset; what stands in the map ``extra`` becomes fields of the record again."""
    known = F.to_json(F.struct(*[c for c in findings.columns if c not in ("subset", "extra")]))
    line = known
    if "extra" in findings.columns:
        extra = F.to_json("extra")
        joined = F.concat(F.substring(known, F.lit(1), F.length(known) - 1), F.lit(","), F.substring(extra, F.lit(2), F.length(extra)))
        line = F.when(F.size("extra") > 0, joined).otherwise(known)
    findings.select("subset", line.alias("value")).write.mode("overwrite").partitionBy("subset").text(path)


def read_open_findings(spark: SparkSession, path: str, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(key, models_with_errors, errors, extra): stored findings with error items as Variants, and what other fields a record has in ``extra``.

    A missing folder gives an empty table. Rewriting what was read keeps every field.
    """
    stored = [k for k in key if k != "subset"]
    kinds = ", ".join(f"{k} string" for k in stored)
    if not has_files(spark, path):
        return spark.createDataFrame([], f"subset string, {kinds}, models_with_errors array<string>, errors map<string,array<variant>>, extra map<string,variant>")
    rows = spark.read.option("singleVariantColumn", "v").option("basePath", path).json(path)
    fields = F.col("v").cast("map<string,variant>")
    known = [*stored, "models_with_errors", "errors"]
    return rows.select(
        F.col("subset").cast("string").alias("subset"),
        *[F.try_variant_get("v", f"$.{k}", "string").alias(k) for k in stored],
        F.try_variant_get("v", "$.models_with_errors", "array<string>").alias("models_with_errors"),
        F.try_variant_get("v", "$.errors", "map<string,array<variant>>").alias("errors"),
        F.map_filter(fields, lambda k, _: ~k.isin(known)).alias("extra"),
    )


def item_fields(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, field, kind): every field of every Variant item in the array column ``items``."""
    items = rows.select(*by, F.explode("items").alias("item")).where(F.schema_of_variant("item").startswith("OBJECT"))
    return items.select(*by, F.explode(F.col("item").cast("map<string,variant>")).alias("field", "value")).select(*by, "field", F.schema_of_variant("value").alias("kind"))


def field_report(verdicts: DataFrame) -> DataFrame:
    """(model, field, kind, known, n): which fields the judges' error items have, and how many items have them."""
    found = item_fields(verdicts.where("status = 'ok'").withColumn("items", answer_items(F.col("response"))), ["model"])
    return found.groupBy("model", "field", "kind").agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.col("field").isin(list(KNOWN_ITEM_FIELDS)))

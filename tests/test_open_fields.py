"""Findings with unknown fields, and the processed set as bitmaps."""

import json

from pyspark.sql import functions as F

from colloquy.operators import bitmaps as bm
from colloquy.operators import open_fields as of
from colloquy.operators.audit import pending, progress_counts

KEY = ["subset", "split", "encounter_id"]
ITEM = '{"errors":[{"lines":[1,2],"reason":"x","sure":0.5,"more":{"a":[1,null]}}],"model":"m2"}'
FINE = '{"errors":[{"lines":[-1,-1],"reason":"x"}]}'


def _wide(spark, answers):
    """answers: one list of (model, response) per transcript."""
    rows = [("aci", "train", f"E{i}", [(n, m, "ok" if r else "failed", r) for n, (m, r) in enumerate(a)]) for i, a in enumerate(answers)]
    return spark.createDataFrame(rows, "subset string, split string, encounter_id string, verdicts array<struct<judge_rank:int,model:string,status:string,response:string>>")


def test_unknown_fields_survive_scan_and_rewrite(spark, scratch):
    odd = ["", "[1]", "null", '{"errors":3}', '{"errors":[7,"x"]}', FINE + " more", FINE.replace('"', "'")]
    wide = _wide(spark, [[("a", ITEM), ("b", FINE)], [("a", FINE), ("b", None)], [("a", FINE), ("b", ITEM)], *[[("a", o)] for o in odd]])
    found = of.open_findings(wide, KEY)
    assert {r.encounter_id: r.models_with_errors for r in found.collect()} == {"E0": ["a"], "E2": ["b"], "E7": ["a"]}  # items that are no objects have no lines
    rows = found.withColumn("reviewed_by", F.lit("someone")).withColumn("score", F.when(F.col("encounter_id") == "E0", 3))
    for n in range(3):
        of.write_open_findings(rows, f"{scratch}/{n}")
        rows = of.read_open_findings(spark, f"{scratch}/{n}", KEY)
    got = {r.encounter_id: r for r in rows.select("subset", "split", "encounter_id", F.to_json("errors").alias("errors"), F.to_json("extra").alias("extra")).collect()}
    assert json.loads(got["E0"].errors) == {"a": [{"lines": [1, 2], "reason": "x", "sure": 0.5, "more": {"a": [1, None]}}], "b": [{"lines": [-1, -1], "reason": "x"}]}
    assert json.loads(got["E0"].extra) == {"reviewed_by": "someone", "score": 3} and json.loads(got["E2"].extra) == {"reviewed_by": "someone"}
    assert (got["E2"].subset, got["E2"].split) == ("aci", "train")
    assert of.read_open_findings(spark, f"{scratch}/none", KEY).count() == 0


def test_field_report(spark):
    verdicts = spark.createDataFrame([("a", "ok", ITEM), ("a", "ok", FINE), ("b", "ok", FINE.replace("[-1,-1]", '"all"')), ("b", "failed", ITEM), ("b", "ok", None)], "model string, status string, response string")
    got = {(r.model, r.field, r.kind, r.known): r.n for r in of.field_report(verdicts).collect()}
    assert got == {
        ("a", "lines", "ARRAY<BIGINT>", True): 2,
        ("a", "reason", "STRING", True): 2,
        ("a", "sure", "DECIMAL(1,1)", False): 1,
        ("a", "more", "OBJECT<a: ARRAY<BIGINT>>", False): 1,
        ("b", "lines", "STRING", True): 1,
        ("b", "reason", "STRING", True): 1,
    }


def test_bitmaps_equal_joins(spark):
    rows = [(("aci", "vs", None)[i % 3], ("train", None)[i % 2], f"E{i % 400}") for i in range(900)]
    corpus = spark.createDataFrame(rows, "subset string, split string, encounter_id string").repartition(6)
    first = bm.key_codes(corpus.where("encounter_id like '%1%'"), None, KEY)
    codes = bm.key_codes(corpus, first, KEY).cache()
    assert codes.count() == corpus.distinct().count() == codes.select("subset", "code").distinct().count()
    assert codes.join(first.withColumnRenamed("code", "old"), KEY, "left").where("old is not null and old <> code").count() == 0
    for r in codes.groupBy("subset").agg(F.count("*").alias("n"), F.min("code").alias("low"), F.max("code").alias("top")).collect():
        assert (r.low, r.top) == (0, r.n - 1)
    runs = [corpus.where("encounter_id like '%3'"), corpus.where("split is null and encounter_id < 'E2'"), corpus.where("false")]
    done = bm.merged(bm.bitmaps(runs[0], codes, KEY).unionByName(bm.bitmaps(runs[1], codes, KEY)).unionByName(bm.bitmaps(runs[2], codes, KEY)))
    keys, progress = corpus.distinct(), runs[0].union(runs[1])
    rows_of = lambda d: sorted(map(str, d.collect()))
    assert rows_of(bm.without(codes, done, KEY)) == rows_of(pending(keys, progress, KEY).select(*KEY))
    assert rows_of(bm.set_counts(codes, done)) == rows_of(progress_counts(keys, progress, KEY))
    assert rows_of(bm.without(codes, done.where("false"), KEY)) == rows_of(codes.select(*KEY))
    codes.unpersist()


def test_bits_beyond_one_bucket(spark):
    codes = spark.range(100_000).select(F.lit("s").alias("subset"), F.col("id").cast("string").alias("encounter_id"), F.col("id").alias("code"))
    done = bm.bitmaps(codes.where("code % 7 in (0, 5) or code > 99990").select("subset", "encounter_id"), codes, ["subset", "encounter_id"])
    left = bm.without(codes, done, ["subset", "encounter_id"])
    assert left.count() == codes.where("not (code % 7 in (0, 5) or code > 99990)").count()
    assert left.where("cast(encounter_id as int) % 7 in (0, 5)").count() == 0 and done.count() == 5  # buckets count from 1; code 0 lies in one of its own

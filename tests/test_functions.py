"""Function fixtures (FN-1 .. FN-17) on Spark, checked against the documented cases."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from colloquy.functions import names as nm
from colloquy.functions import text as tx
from colloquy.functions import verdict as vd
from colloquy.functions.prompt import PROMPT_TEMPLATE, render_prompt


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0].r


ASCII_CASES = [
    (None, ""),
    ("\u2019", "'"),
    ("\u201c", '"'),
    ("\u2014", "-"),
    ("\u00a0", " "),
    ("\u200b", ""),
    ("\u2026", "..."),
    ("\u2033", "''"),
    ("\u00bd", "12"),
    ("\u00e9", "e"),
    ("\u00df", ""),
    ("\u2122", "TM"),
    ("\u00b2", "2"),
    ("\u0007", ""),
    ("a\tb\nc\rd\x7f", "a\tb\nc\rd\x7f"),
    ("plain ascii \x01 text", "plain ascii  text"),
    ("caf\u00e9 \u2018ok\u2019 \ufeffx", "cafe 'ok' x"),
]


def test_normalize_text_cases(spark):
    rows = spark.createDataFrame(ASCII_CASES, "v string, want string")
    got = rows.select("want", tx.normalize_text("v").alias("got")).collect()
    assert [(r.got, r.want) for r in got] == [(w, w) for _, w in ASCII_CASES]


def test_normalize_text_flag_off(spark):
    rows = spark.createDataFrame([("caf\u00e9",), (None,)], "v string")
    got = [r.r for r in rows.select(tx.normalize_text("v", ascii_normalize=False).alias("r")).collect()]
    assert got == ["caf\u00e9", ""]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_fold_idempotent_and_ascii(s):
    once = tx.fold_to_ascii(s)
    assert once.isascii()
    assert tx.fold_to_ascii(once) == once


def test_normalize_matches_python_on_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.t for r in d.select("doc_id", tx.normalize_text("text").alias("t")).collect()}
    want = {r.doc_id: tx.fold_to_ascii(r.text or "") for r in d.collect()}
    assert got == want


@pytest.mark.parametrize("raw,want", [(" ACI ", "aci"), (None, ""), ("\tVirtAssist\n", "virtassist")])
def test_dataset_name(spark, raw, want):
    assert one(spark, tx.normalize_dataset_name("v"), raw) == want


@pytest.mark.parametrize("raw,want", [("a\nb", "1 a\n2 b"), ("", "1 "), ("a\n", "1 a\n2 ")])
def test_enumerate(spark, raw, want):
    assert one(spark, tx.enumerate_dialogue("v"), raw) == want


def test_number_for_prompt(spark):
    assert one(spark, tx.prepare_transcript("v"), "a\nb") == "1: a\n2: b"


def test_unify_newlines(spark):
    assert one(spark, tx.unify_newlines("v"), "a\r\nb\rc\nd") == "a\nb\nc\nd"


@pytest.mark.parametrize(
    "name,want",
    [
        ("test1_aci_asr.csv", ("test1", "aci", "asr")),
        ("train_aci_asr_corr.CSV", ("train", "aci", "asr_corr")),
        ("dir/sub/valid_virtscribe_humantrans.csv", ("valid", "virtscribe", "humantrans")),
        ("train.csv", None),
        ("a_b.csv", None),
        ("_aci_asr.csv", None),
        ("x_y_z.txt", None),
    ],
)
def test_parse_variant_name(spark, name, want):
    r = one(spark, nm.parse_variant_name("v"), name)
    got = None if r is None else (r.split, r.subset, r.transcript_version)
    assert got == want


def test_layout_path(spark):
    df = spark.createDataFrame([("aci", "train")], "a string, b string")
    assert df.select(nm.layout_path("a", "b").alias("p")).first().p == "aci/train.parquet"


def test_speaker_parts(spark):
    df = spark.createDataFrame([("[doctor] hello there",), ("[patient_guest] hi",), ("no tag",)], "l string")
    got = df.select(tx.speaker_tag(F.col("l")).alias("s"), tx.utterance(F.col("l")).alias("u")).collect()
    assert [(r.s, r.u) for r in got] == [("doctor", "hello there"), ("patient_guest", "hi"), ("", "no tag")]


@pytest.mark.parametrize(
    "s,e,n,want", [(1, -1, 10, 10), (2, -1, 10, 9), (5, 10, 8, 4), (3, 3, 5, 1), (6, 2, 9, 0)]
)
def test_range_length(spark, s, e, n, want):
    df = spark.createDataFrame([(s, e, n)], "s int, e int, n int")
    assert df.select(tx.range_length(F.col("s"), F.col("e"), F.col("n")).alias("r")).first().r == want


def test_prompt_render_uses_template(spark):
    got = one(spark, render_prompt(tx.prepare_transcript("v")), "[doctor] hi\n[patient] 100%")
    assert got == PROMPT_TEMPLATE.replace("{transcript}", "1: [doctor] hi\n2: [patient] 100%")


@pytest.mark.parametrize(
    "resp,n",
    [
        ("not json", 0),
        ("null", 0),
        ("[1]", 0),
        ("{}", 0),
        ('{"errors": null}', 0),
        ('{"errors": [{"lines": [1, -1], "reason": "x"}]}', 1),
        (None, 0),
    ],
)
def test_parse_errors(spark, resp, n):
    assert len(one(spark, vd.parse_errors("v"), resp)) == n


@pytest.mark.parametrize(
    "lines,want",
    [([1, -1], True), ([2, -1], True), ([5, 10], True), ([-1, -1], False), (None, True), ([None, -1], True)],
)
def test_actual_error(spark, lines, want):
    df = spark.createDataFrame([(lines,)], "l array<int>")
    item = F.struct(F.col("l").alias("lines"), F.lit("r").alias("reason"))
    assert df.select(vd.is_actual_error(item).alias("r")).first().r is want


def test_empty_list_is_not_actual(spark):
    df = spark.createDataFrame([([],)], "e array<struct<lines:array<int>,reason:string>>")
    assert df.select(vd.has_actual("e").alias("r")).first().r is False


@pytest.mark.parametrize("k,n,want", [(1, 3, False), (2, 3, True), (3, 3, True), (1, 2, False), (2, 2, True)])
def test_majority(spark, k, n, want):
    df = spark.createDataFrame([(k,)], "k int")
    assert df.select(vd.majority(F.col("k"), n).alias("r")).first().r is want


@pytest.mark.parametrize(
    "a,b,want", [(68, 224, 30.36), (5, 55, 9.09), (35, 80, 43.75), (3, 0, 0.0), (1, 8, 12.5), (37, 114, 32.46)]
)
def test_percentage(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a long, b long")
    assert df.select(vd.percentage(F.col("a"), F.col("b")).alias("r")).first().r == want


def test_percentage_matches_python_round_off_ties(spark):
    pairs = [(a, b) for b in range(1, 60) for a in range(0, b + 1)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {(r.a, r.b): r.r for r in df.select("a", "b", vd.percentage(F.col("a"), F.col("b")).alias("r")).collect()}
    for (a, b), r in got.items():
        exact = a * 10000 / b
        if abs(exact - round(exact) - 0.5) > 1e-9 and abs(exact - round(exact) + 0.5) > 1e-9:
            assert r == round(a / b * 100, 2), (a, b)


def test_number_within_group_matches_row_number(spark):
    from pyspark.sql import Window

    from colloquy.operators.resolve import number_within_group

    rows = [(g, t) for g in range(4) for t in range(0, 50 * (g + 1), 1 + g)]
    df = spark.createDataFrame(rows, "g long, t long")
    got = number_within_group(df, ["g"], "t", bucket_width=7)
    want = df.withColumn("line_no", F.row_number().over(Window.partitionBy("g").orderBy("t")).cast("long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_map_level_verdict_functions(spark):
    schema = "m map<string, array<struct<lines:array<int>,reason:string>>>"
    m = {
        "a": [{"lines": [-1, -1], "reason": "ok"}],
        "b": [],
        "c": [{"lines": [3, 4], "reason": "swap"}],
        "d": [{"lines": [-1, -1], "reason": "ok"}, {"lines": [1, -1], "reason": "all"}],
    }
    row = spark.createDataFrame([(m,)], schema).select(
        F.map_keys(vd.drop_empty_judges("m")).alias("kept"),
        vd.count_models_with_actual("m").alias("n"),
        vd.models_with_actual("m").alias("models"),
        vd.any_actual("m").alias("any"),
    ).first()
    assert sorted(row.kept) == ["a", "c", "d"] and row.n == 2 and sorted(row.models) == ["c", "d"] and row.any


def test_recommended_conf_sizes_partitions():
    from colloquy.session import recommended_conf

    big = recommended_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // int(big["spark.sql.files.maxPartitionBytes"]))
    assert int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 256 << 20
    assert int(recommended_conf(100 * 10**12, 8000, 1 << 30)["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (1 << 30))
    small = recommended_conf(10 << 20, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64


def test_checkpoint_dir_comes_from_the_session(spark):
    from colloquy.session import ensure_checkpoint_dir, scratch_path

    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured and ensure_checkpoint_dir(spark) == configured
    assert scratch_path(spark, "x") == configured.rstrip("/") + "/x"

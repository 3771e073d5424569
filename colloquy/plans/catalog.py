"""Registered queries over the driver's test tables, each with a DuckDB oracle.

Every query reads whole tables (``documents``, ``conversations``, ``labels``)
through the canonical mapping of ``colloquy.sources.testdata``; none filters
rows to make the check cheaper. Keys are the operator IDs of the survey's
test plan. Aggregates and computed columns carry the same alias on both sides.
"""

from __future__ import annotations

import hashlib
import unicodedata
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import names as nm
from colloquy.functions import text as tx
from colloquy.functions import verdict as vd
from colloquy.functions.fold import CHAR_MAP
from colloquy.functions.prompt import PROMPT_HEAD, PROMPT_TAIL, render_prompt
from colloquy.operators import audit as au
from colloquy.operators import corpus as co
from colloquy.operators import counts as ct
from colloquy.operators import metrics as me
from colloquy.operators.resolve import flagged_ranges, number_within_group, resolve_ranges, with_line_counts
from colloquy.session import scratch_path
from colloquy.sinks.layout import manifest, write_corpus
from colloquy.sources import tables as tb
from colloquy.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
KEY = list(td.TESTDATA_AUDIT.key)
N_MODELS = td.TESTDATA_AUDIT.n_models


# ---------------------------------------------------------------------------
# Shared building blocks
# ---------------------------------------------------------------------------
def _long(spark: SparkSession, sf: str) -> DataFrame:
    return ct.version_counts(td.corpus(spark, sf))


def _order(long: DataFrame) -> ct.ReportOrder:
    return ct.report_order(long, td.TESTDATA_VOCAB)


def _wide(spark: SparkSession, sf: str, corpus: DataFrame | None = None) -> DataFrame:
    inputs = td.labelled_prompt_inputs(spark, sf, corpus)
    return au.fan_out(au.build_prompts(inputs), td.testdata_judges())


def _findings(spark: SparkSession, sf: str) -> DataFrame:
    return au.findings(_wide(spark, sf), KEY)


def _progress(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in progress: transcripts that already have a label were processed earlier."""
    labels = td.table(spark, sf, "labels").select("doc_id")
    return td.corpus(spark, sf).join(labels, "doc_id", "left_semi").select(*KEY)


def _variant(spark: SparkSession, sf: str) -> DataFrame:
    """A second delivery of the corpus: ASCII-folded text filed as 'asrcorr'."""
    c = td.corpus(spark, sf)
    return c.select(
        "encounter_id",
        "subset",
        "split",
        F.lit("asrcorr").alias("transcript_version"),
        tx.normalize_text("dialogue").alias("dialogue"),
        "note",
        F.lit("variants").alias("file_path"),
        F.col("row_pos"),
    )


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------
def q_counts_long(spark, sf):
    return _long(spark, sf)


def q_counts_rollup(spark, sf):
    long = _long(spark, sf)
    return ct.overall_with_totals(long, _order(long))


def _pivot(index):
    def q(spark, sf):
        long = _long(spark, sf)
        return ct.pivot_by_split(long, index, _order(long))

    return q


def q_counts_complete(spark, sf):
    long = _long(spark, sf)
    return ct.complete_long(long, _order(long))


def q_extra_versions(spark, sf):
    return ct.version_categories(_long(spark, sf), td.TESTDATA_VOCAB)


def q_normalize_ascii(spark, sf):
    d = td.table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", tx.normalize_text("text").alias("text_ascii"))


def q_normalize_ascii_turns(spark, sf):
    c = td.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return c.select("conv_id", "turn", tx.normalize_text("text").alias("text_ascii"))


def q_enumerate_lines(spark, sf):
    d = td.table(spark, sf, "documents")
    return d.select("doc_id", tx.enumerate_dialogue(F.coalesce("text", F.lit(""))).alias("enumerated_dialogue"))


def q_number_lines(spark, sf):
    d = td.table(spark, sf, "documents")
    return d.select("doc_id", tx.prepare_transcript(F.coalesce("text", F.lit(""))).alias("numbered"))


def q_build_dialogues(spark, sf):
    return td.dialogues(spark, sf)


def q_line_table(spark, sf):
    """WIN-2 + FN-16 at turn level: every turn is one dialogue line, numbered inside its
    conversation without gathering the conversation into one group."""
    lines = number_within_group(td.conversation_lines(spark, sf), ["conv_id"], "turn")
    return lines.select(
        "conv_id",
        "line_no",
        tx.speaker_tag(F.col("line")).alias("speaker"),
        tx.utterance(F.col("line")).alias("utterance"),
    )


def q_dedup_keep_first(spark, sf):
    kept = co.dedup_keep_first(td.corpus(spark, sf))
    return kept.select("encounter_id", "subset", "split", "transcript_version")


def q_dedup_counted(spark, sf):
    """WIN-1 + AGG-18 as the build runs them: the kept row of every copy group and how many rows it stands for."""
    kept = co.dedup_keep_first_counted(td.corpus(spark, sf))
    return kept.select("encounter_id", "subset", "split", "transcript_version", "n_copies")


def q_dedup_report(spark, sf):
    """AGG-18 in one pass: the counted keep-first records how many copies each kept row stands for."""
    return co.dedup_report_from_counts(co.dedup_keep_first_counted(td.corpus(spark, sf)))


def q_sample_per_cell(spark, sf):
    s = co.sample_per_cell(td.corpus(spark, sf), n=5)
    return s.select("encounter_id", "subset", "split", F.col("sample_rank").cast("long").alias("sample_rank"))


def q_union_sources(spark, sf):
    both = co.union_sources(td.corpus(spark, sf).drop("src_rank"), _variant(spark, sf))
    kept = co.dedup_keep_first(both)
    return kept.select(
        "encounter_id", "subset", "split", "transcript_version", F.col("src_rank").cast("long").alias("src_rank")
    )


def q_route_cells(spark, sf):
    d = td.table(spark, sf, "documents")
    raw = F.concat(F.lit(" "), F.upper("lang"), F.lit("\t"))
    routed = d.select(
        F.col("doc_id").cast("string").alias("encounter_id"),
        tx.normalize_dataset_name(raw).alias("subset"),
        td.split_of(F.col("n_chars")).alias("split"),
    )
    return co.route_cells(co.route_subsets(routed, td.TESTDATA_VOCAB, on_unknown="drop"), td.TESTDATA_VOCAB)


def q_select_splits(spark, sf):
    c = td.corpus(spark, sf).select("encounter_id", "subset", "split")
    return tb.select_splits(c, ["train", "test1+test2+test3"])


def q_list_cells(spark, sf):
    return co.list_cells(td.corpus(spark, sf))


def q_notes_per_cell(spark, sf):
    return co.cell_counts(td.corpus(spark, sf))


def q_rows_per_source(spark, sf):
    """AGG-19: rows loaded per source file (the ``source`` column plays the file)."""
    return td.table(spark, sf, "documents").groupBy(F.col("source").alias("file")).agg(
        F.count(F.lit(1)).cast("long").alias("rows_loaded")
    )


def q_versions_seen(spark, sf):
    """AGG-20: distinct versions among the rows and among the findings, side by side."""
    rows = td.corpus(spark, sf).select("transcript_version").distinct().withColumn("in_rows", F.lit(True))
    found = _findings(spark, sf).select("transcript_version").distinct().withColumn("in_findings", F.lit(True))
    both = rows.join(found, "transcript_version", "full")
    return both.select(
        "transcript_version",
        F.coalesce("in_rows", F.lit(False)).alias("in_rows"),
        F.coalesce("in_findings", F.lit(False)).alias("in_findings"),
    )


def q_version_lookup(spark, sf):
    c = td.corpus(spark, sf).select("encounter_id", "subset")
    return co.attach_default_version(c, td.TESTDATA_VOCAB, on_unknown="error")


def q_manifest(spark, sf):
    return manifest(spark, co.cell_counts(td.corpus(spark, sf)), td.TESTDATA_VOCAB)


def synthetic_file_name(split, subset, source, n_chars):
    """File names exercising every parse branch, built from corpus columns."""
    k = F.pmod(n_chars, F.lit(7))
    return (
        F.when(k == 0, F.concat(split, F.lit(".csv")))
        .when(k == 1, F.concat_ws("_", split, subset, source, F.lit("corr.CSV")))
        .when(k == 2, F.concat(F.concat_ws("_", split, subset, source), F.lit(".txt")))
        .when(k == 3, F.concat(F.lit("_"), subset, F.lit("_"), source, F.lit(".csv")))
        .otherwise(F.concat(F.lit(" "), F.upper(split), F.lit("_"), subset, F.lit("_"), source, F.lit(".csv")))
    )


def q_parse_names(spark, sf):
    c = td.corpus(spark, sf)
    named = c.select(
        "encounter_id",
        synthetic_file_name(F.col("split"), F.col("subset"), F.col("note"), F.col("n_chars")).alias("file_name"),
    )
    p = nm.parse_variant_name("file_name")
    return named.select(
        "encounter_id",
        "file_name",
        p.getField("split").alias("p_split"),
        p.getField("subset").alias("p_subset"),
        p.getField("transcript_version").alias("p_version"),
    )


def q_prompt_render(spark, sf):
    d = td.table(spark, sf, "documents")
    return d.select("doc_id", render_prompt(tx.prepare_transcript(F.coalesce("text", F.lit("")))).alias("prompt"))


def q_judge_fanout(spark, sf):
    long = au.verdicts_long(_wide(spark, sf), KEY)
    return long.select("encounter_id", "model", F.col("judge_rank").cast("long").alias("judge_rank"), "status", "response")


def q_parse_responses(spark, sf):
    long = au.with_parsed_errors(au.verdicts_long(_wide(spark, sf), KEY))
    return long.select(
        "encounter_id",
        "model",
        F.col("n_items").cast("long").alias("n_items"),
        "has_actual",
        "contract_ok",
    )


def q_flagged(spark, sf):
    f = _findings(spark, sf)
    return f.select(
        *KEY,
        F.array_join("models_with_errors", ",").alias("models_with_errors"),
        F.size("models_with_errors").cast("long").alias("n_models_flagging"),
        F.size(F.map_keys("errors")).cast("long").alias("judges_in_map"),
    )


def q_models_flagging(spark, sf):
    f = _findings(spark, sf)
    return f.select("encounter_id", F.explode("models_with_errors").alias("model"))


def q_consensus(spark, sf):
    f = _findings(spark, sf)
    n_flag = F.size("models_with_errors")
    return f.groupBy("subset").agg(
        F.count(F.lit(1)).cast("long").alias("notes_with_errors"),
        F.count_if(vd.unanimous("models_with_errors", N_MODELS)).cast("long").alias("all_models_found_errors"),
        F.count_if(vd.majority(n_flag, N_MODELS)).cast("long").alias("majority_consensus_errors"),
    )


def q_metrics_cube(spark, sf):
    c = td.corpus(spark, sf)
    totals = co.cell_counts(c)
    return me.metrics(_findings(spark, sf), totals, N_MODELS, td.TESTDATA_VOCAB.splits)


def q_pending(spark, sf):
    return au.pending(td.corpus(spark, sf), _progress(spark, sf), KEY).select(*KEY)


def q_progress_counts(spark, sf):
    return au.progress_counts(td.corpus(spark, sf), _progress(spark, sf), KEY)


def q_processed_keys(spark, sf):
    long = au.verdicts_long(_wide(spark, sf), KEY)
    return au.progress_from_verdicts(long, KEY, N_MODELS)


def q_resolve_ranges(spark, sf):
    ranges = flagged_ranges(_findings(spark, sf), KEY)
    lines = resolve_ranges(ranges, td.corpus(spark, sf), KEY)
    return lines.select("encounter_id", "model", F.col("line_no").cast("long").alias("line_no"), "line")


def q_range_lengths(spark, sf):
    ranges = with_line_counts(flagged_ranges(_findings(spark, sf), KEY), td.corpus(spark, sf), KEY)
    return ranges.select(
        "encounter_id",
        "model",
        F.col("line_start").cast("long").alias("line_start"),
        F.col("line_end").cast("long").alias("line_end"),
        F.col("n_covered").cast("long").alias("n_covered"),
    )


def q_resume_two_runs(spark, sf):
    corpus = td.corpus(spark, sf)
    progress = _progress(spark, sf)
    first = corpus.join(progress, KEY, "left_semi")
    second = au.pending(corpus, progress, KEY)
    v1 = au.verdicts_long(_wide(spark, sf, first), KEY).withColumn("run_id", F.lit(1))
    v2 = au.verdicts_long(_wide(spark, sf, second), KEY).withColumn("run_id", F.lit(2))
    merged = au.gather_verdicts(v1.unionByName(v2), KEY)
    return merged.select(*KEY, F.inline("verdicts")).select(
        "encounter_id", "model", F.col("judge_rank").cast("long").alias("judge_rank"), "status", "response"
    )


def q_prompt_judge(spark, sf):
    """UDF-1 / UDF-2: a batch judge that reads the rendered prompt of every document (FN-6)."""

    def answer(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: f'{{"errors":[{{"lines":[1,{len(p)}],"reason":"{hashlib.md5(p.encode()).hexdigest()}"}}]}}')

    prompts = au.build_prompts(td.table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("dialogue")))
    long = au.verdicts_long(au.fan_out(prompts, [au.BatchJudge("judge/prompt", answer)]), ["doc_id"], ())
    return long.select("doc_id", "model", "status", "response")


def q_resume_metrics(spark, sf):
    """INC-2 over two runs through one verdict table: totals and findings both come from all runs."""
    corpus = td.corpus(spark, sf)
    first = corpus.where("subset in ('en', 'de')")
    parts = [first, au.pending(corpus, first.select(*KEY), KEY)]
    runs = [au.verdicts_long(_wide(spark, sf, part), KEY).withColumn("run_id", F.lit(n)) for n, part in enumerate(parts)]
    gathered = au.gather_verdicts(runs[0].unionByName(runs[1]), KEY)
    return me.metrics(au.findings(gathered, KEY), co.cell_counts(gathered), N_MODELS, td.TESTDATA_VOCAB.splits)


def q_pending_null_key(spark, sf):
    """JOIN-1 with null key parts: versions missing for every third document, and equal only to missing ones."""
    version = F.when(F.col("doc_id") % 3 != 0, F.col("transcript_version"))
    corpus = td.corpus(spark, sf).withColumn("transcript_version", version)
    labels = td.table(spark, sf, "labels").select("doc_id")
    return au.pending(corpus, corpus.join(labels, "doc_id", "left_semi").select(*KEY), KEY).select(*KEY)


def q_import_progress(spark, sf):
    """SRC-10 / SRC-11 as state: progress on (subset, split, encounter_id) and findings, read back as findings."""
    progress = _progress(spark, sf).select("subset", "split", "encounter_id")
    rows = au.verdicts_from_state(td.corpus(spark, sf), progress, _findings(spark, sf), td.testdata_judges(), KEY)
    f = au.findings(au.gather_verdicts(rows, KEY), KEY)
    return f.select(
        *KEY,
        F.array_join("models_with_errors", ",").alias("models_with_errors"),
        F.size("models_with_errors").cast("long").alias("n_models_flagging"),
        F.size(F.map_keys("errors")).cast("long").alias("judges_in_map"),
    )


# Every mapped character, two ligatures and digits that only NFKC resolves, and removed and kept controls.
INJECTED = "".join(CHAR_MAP) + "\ufb01\u2460\u00e9" + "\x01\x0b\x1f\t\x7f"


def q_normalize_mapped(spark, sf):
    """FN-1a, FN-1b, FN-1d: the fold on every document with the mapped and control characters put in."""
    d = td.table(spark, sf, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(INJECTED)).alias("text"))
    return d.select("doc_id", tx.normalize_text("text").alias("text_ascii"))


def q_read_cells(spark, sf):
    """SNK-1, SRC-7, FIL-4: the corpus written by cell, and a selection read back from its partitions."""
    root = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    write_corpus(td.corpus(spark, sf), root, ["encounter_id", "transcript_version", "dialogue"])
    picked = co.select_subsets_splits(tb.read_corpus(spark, root), ["en", "fr"], ["train", "test2"])
    return picked.select("encounter_id", "subset", "split", "transcript_version", F.sha2("dialogue", 256).alias("dialogue_sha256"))


def q_counts_order(spark, sf):
    """SRT-1 .. SRT-3: the place of every row of the sorted long counts."""
    rows = ct.long_sorted(_long(spark, sf), _order(_long(spark, sf)))
    return rows.select("subset", "split", "transcript_version", "count", (F.monotonically_increasing_id() + 1).alias("place"))


QUERIES: dict[str, Query] = {
    "counts_long": q_counts_long,
    "counts_rollup": q_counts_rollup,
    "counts_pivot_version": _pivot(["subset", "transcript_version"]),
    "counts_pivot_subset": _pivot(["subset"]),
    "counts_pivot_tv": _pivot(["transcript_version"]),
    "counts_complete": q_counts_complete,
    "extra_versions": q_extra_versions,
    "normalize_ascii": q_normalize_ascii,
    "normalize_ascii_turns": q_normalize_ascii_turns,
    "enumerate_lines": q_enumerate_lines,
    "number_lines": q_number_lines,
    "build_dialogues": q_build_dialogues,
    "line_table": q_line_table,
    "dedup_keep_first": q_dedup_keep_first,
    "dedup_counted": q_dedup_counted,
    "dedup_report": q_dedup_report,
    "sample_per_cell": q_sample_per_cell,
    "union_sources": q_union_sources,
    "route_cells": q_route_cells,
    "select_splits": q_select_splits,
    "list_cells": q_list_cells,
    "notes_per_cell": q_notes_per_cell,
    "rows_per_source": q_rows_per_source,
    "versions_seen": q_versions_seen,
    "version_lookup": q_version_lookup,
    "manifest": q_manifest,
    "parse_names": q_parse_names,
    "prompt_render": q_prompt_render,
    "judge_fanout": q_judge_fanout,
    "parse_responses": q_parse_responses,
    "flagged": q_flagged,
    "models_flagging": q_models_flagging,
    "consensus": q_consensus,
    "metrics_cube": q_metrics_cube,
    "pending": q_pending,
    "progress_counts": q_progress_counts,
    "processed_keys": q_processed_keys,
    "resolve_ranges": q_resolve_ranges,
    "range_lengths": q_range_lengths,
    "resume_two_runs": q_resume_two_runs,
    "prompt_judge": q_prompt_judge,
    "resume_metrics": q_resume_metrics,
    "pending_null_key": q_pending_null_key,
    "import_progress": q_import_progress,
    "normalize_mapped": q_normalize_mapped,
    "read_cells": q_read_cells,
    "counts_order": q_counts_order,
}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------
def _q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


_SPLITS_SQL = "['train','valid','test1','test2','test3']"
_VERSIONS_SQL = "['asr','asrcorr','humantrans']"

CORPUS = rf"""corpus AS (
  SELECT CAST(doc_id AS VARCHAR) AS encounter_id,
         lang AS subset,
         {_SPLITS_SQL}[n_chars % 5 + 1] AS split,
         {_VERSIONS_SQL}[TRY_CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) % 3 + 1] AS transcript_version,
         coalesce(text, '') AS dialogue,
         source AS note, doc_id, n_chars
  FROM documents)"""

LONG = """long AS (
  SELECT subset, split, coalesce(transcript_version, '<missing>') AS tv, count(*) AS n
  FROM corpus GROUP BY ALL)"""

GRID = """grid AS (
  SELECT s.subset, v.tv FROM (SELECT DISTINCT subset FROM long) s, (SELECT DISTINCT tv FROM long) v),
glong AS (
  SELECT g.subset, g.tv, l.split, coalesce(l.n, 0) AS n
  FROM grid g LEFT JOIN long l ON l.subset = g.subset AND l.tv = g.tv)"""

_SPLIT_PIVOT = ",\n  ".join(
    f"CAST(coalesce(sum(n) FILTER (WHERE split = '{s}'), 0) AS BIGINT) AS {s}"
    for s in ("train", "valid", "test1", "test2", "test3")
)


def _pivot_sql(index: list[str]) -> str:
    label = {
        "subset": "CASE WHEN GROUPING(subset) = 1 THEN 'ALL' ELSE subset END AS subset",
        "tv": "CASE WHEN GROUPING(tv) = 1 THEN 'ALL' ELSE tv END AS transcript_version",
    }
    cols = ", ".join(label[i] for i in index)
    keys = ", ".join(index)
    return f"""WITH {CORPUS}, {LONG}, {GRID}
SELECT {cols},
  {_SPLIT_PIVOT},
  CAST(sum(n) AS BIGINT) AS "Total"
FROM glong GROUP BY GROUPING SETS (({keys}), ())"""


def _numbered_sql(expr: str, sep: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({expr}, chr(10)), "
        f"lambda x, i: CAST(i AS VARCHAR) || {_q(sep)} || x), chr(10))"
    )


LABELLED = "x AS (SELECT c.*, l.quality, l.toxic FROM corpus c LEFT JOIN labels l USING (doc_id))"

_J_QUALITY = f"""CASE WHEN quality IS NULL THEN NULL WHEN quality = 0 THEN {_q(td.RESP_QUALITY_FLAG)}
  ELSE {_q(td.RESP_CLEAN)} END"""
_J_TOXIC = f"""CASE WHEN toxic IS NULL THEN NULL WHEN toxic = 1 THEN {_q(td.RESP_TOXIC_FLAG)}
  ELSE {_q(td.RESP_CLEAN)} END"""
_J_ODD = "".join(f" WHEN doc_id % {td.ODD_EVERY} = {i} THEN {_q(r)}" for i, r in enumerate(td.ODD_RESPONSES))
_J_LENGTH = f"""CASE{_J_ODD} WHEN n_chars < {td.SHORT_TEXT_CHARS} THEN {_q(td.RESP_SHORT_FLAG)}
  ELSE {_q(td.RESP_CLEAN)} END"""

FANOUT = f"""fan AS (
  SELECT subset, split, encounter_id, transcript_version, 'judge/quality' AS model, 0 AS judge_rank,
         {_J_QUALITY} AS response, false AS malformed FROM x
  UNION ALL
  SELECT subset, split, encounter_id, transcript_version, 'judge/toxicity', 1, {_J_TOXIC}, false FROM x
  UNION ALL
  SELECT subset, split, encounter_id, transcript_version, 'judge/length', 2, {_J_LENGTH},
         doc_id % {td.ODD_EVERY} < {td.ODD_MALFORMED} FROM x)"""

# Flags per transcript: quality=0, toxic=1, short text. The length judge flags nothing where its answer is
# odd, and its list is empty (left out of the map) where that answer is malformed.
_PLAIN = f"doc_id % {td.ODD_EVERY} >= {len(td.ODD_RESPONSES)}"
FLAGS = f"""fl AS (
  SELECT *, coalesce(quality = 0, false) AS fa, coalesce(toxic = 1, false) AS fb,
         coalesce(n_chars < {td.SHORT_TEXT_CHARS} AND {_PLAIN}, false) AS fc
  FROM x),
f AS (
  SELECT *, CAST(fa AS INT) + CAST(fb AS INT) + CAST(fc AS INT) AS k FROM fl WHERE fa OR fb OR fc)"""


def _pct(a: str, b: str) -> str:
    q = f"(({a}) * 10000 // ({b}))"
    r = f"(({a}) * 10000 % ({b}))"
    return (
        f"CASE WHEN ({b}) > 0 THEN CAST({q} + CASE WHEN 2 * {r} > ({b}) OR (2 * {r} = ({b}) AND {q} % 2 = 1) "
        f"THEN 1 ELSE 0 END AS DOUBLE) / 100.0 ELSE 0.0 END"
    )


ORACLE_SQL: dict[str, str] = {
    "counts_long": f"""WITH {CORPUS}
SELECT subset, split, coalesce(transcript_version, '<missing>') AS transcript_version, count(*) AS "count"
FROM corpus GROUP BY ALL""",
    "counts_rollup": f"""WITH {CORPUS}, {LONG}, {GRID}
SELECT CASE WHEN GROUPING(subset) = 1 THEN 'ALL' ELSE subset END AS subset,
       CASE WHEN GROUPING(tv) = 1 THEN 'ALL' ELSE tv END AS transcript_version,
       CAST(sum(n) AS BIGINT) AS "Count"
FROM glong GROUP BY ROLLUP (subset, tv)""",
    "counts_pivot_version": _pivot_sql(["subset", "tv"]),
    "counts_pivot_subset": _pivot_sql(["subset"]),
    "counts_pivot_tv": _pivot_sql(["tv"]),
    "counts_complete": f"""WITH {CORPUS}, {LONG}, {GRID}
SELECT g.subset, s.split, g.tv AS transcript_version, CAST(coalesce(l.n, 0) AS BIGINT) AS "count"
FROM grid g CROSS JOIN (SELECT DISTINCT split FROM long) s
LEFT JOIN long l ON l.subset = g.subset AND l.tv = g.tv AND l.split = s.split""",
    "extra_versions": f"""WITH {CORPUS}, {LONG},
v AS (SELECT DISTINCT tv FROM long),
s AS (SELECT bool_and(subset IN ('aci', 'virtassist', 'virtscribe')) AS all_known FROM (SELECT DISTINCT subset FROM long))
SELECT tv AS transcript_version,
       CAST(row_number() OVER (ORDER BY CASE tv WHEN 'asr' THEN 1 WHEN 'asrcorr' THEN 2 WHEN 'humantrans' THEN 3
            ELSE 4 END, tv) AS BIGINT) AS version_rank,
       tv IN ('asr', 'asrcorr', 'humantrans') AS is_known_version,
       s.all_known AS all_subsets_known
FROM v, s""",
    "normalize_ascii": """SELECT doc_id, strip_accents(replace(coalesce(text, ''), 'ß', '')) AS text_ascii FROM documents""",
    "normalize_ascii_turns": """SELECT conv_id, turn, strip_accents(replace(coalesce(text, ''), 'ß', '')) AS text_ascii
FROM conversations""",
    "enumerate_lines": f"""SELECT doc_id, {_numbered_sql("coalesce(text, '')", " ")} AS enumerated_dialogue FROM documents""",
    "number_lines": f"""SELECT doc_id, {_numbered_sql("coalesce(text, '')", ": ")} AS numbered FROM documents""",
    "build_dialogues": """SELECT conv_id,
  string_agg('[' || coalesce(role, '') || '] ' || replace(coalesce(text, ''), chr(10), ' '), chr(10) ORDER BY turn)
    AS dialogue
FROM conversations GROUP BY conv_id""",
    "line_table": r"""WITH l AS (
  SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS line_no,
         '[' || coalesce(role, '') || '] ' || replace(coalesce(text, ''), chr(10), ' ') AS line
  FROM conversations)
SELECT conv_id, line_no,
       regexp_extract(line, '(?s)^\[([^\]]+)\] ?(.*)$', 1) AS speaker,
       CASE WHEN regexp_matches(line, '(?s)^\[([^\]]+)\] ?(.*)$')
            THEN regexp_extract(line, '(?s)^\[([^\]]+)\] ?(.*)$', 2) ELSE line END AS utterance
FROM l""",
    "dedup_keep_first": f"""WITH {CORPUS}
SELECT encounter_id, subset, split, transcript_version FROM corpus
QUALIFY row_number() OVER (PARTITION BY subset, split, transcript_version, dialogue ORDER BY doc_id) = 1""",
    "dedup_counted": f"""WITH {CORPUS}
SELECT encounter_id, subset, split, transcript_version,
       count(*) OVER (PARTITION BY subset, split, transcript_version, dialogue) AS n_copies
FROM corpus
QUALIFY row_number() OVER (PARTITION BY subset, split, transcript_version, dialogue ORDER BY doc_id) = 1""",
    "dedup_report": f"""WITH {CORPUS},
kept AS (SELECT subset, split FROM corpus
         QUALIFY row_number() OVER (PARTITION BY subset, split, transcript_version, dialogue ORDER BY doc_id) = 1),
i AS (SELECT subset, split, count(*) AS rows_in FROM corpus GROUP BY ALL),
o AS (SELECT subset, split, count(*) AS rows_out FROM kept GROUP BY ALL),
c AS (SELECT i.subset, i.split, i.rows_in, coalesce(o.rows_out, 0) AS rows_out FROM i LEFT JOIN o USING (subset, split))
SELECT 'cell' AS level, subset, split, CAST(rows_in AS BIGINT) AS rows_in, CAST(rows_out AS BIGINT) AS rows_out,
       CAST(rows_in - rows_out AS BIGINT) AS duplicates_removed FROM c
UNION ALL
SELECT 'total', NULL, NULL, CAST(sum(rows_in) AS BIGINT), CAST(sum(rows_out) AS BIGINT),
       CAST(sum(rows_in - rows_out) AS BIGINT) FROM c""",
    "sample_per_cell": f"""WITH {CORPUS}
SELECT encounter_id, subset, split,
       CAST(row_number() OVER (PARTITION BY subset, split ORDER BY doc_id) AS BIGINT) AS sample_rank
FROM corpus QUALIFY sample_rank <= 5""",
    "union_sources": f"""WITH {CORPUS},
u AS (
  SELECT encounter_id, subset, split, transcript_version, dialogue, 0 AS src_rank, doc_id FROM corpus
  UNION ALL
  SELECT encounter_id, subset, split, 'asrcorr', strip_accents(replace(dialogue, 'ß', '')), 1, doc_id FROM corpus)
SELECT encounter_id, subset, split, transcript_version, CAST(src_rank AS BIGINT) AS src_rank FROM u
QUALIFY row_number() OVER (PARTITION BY subset, split, transcript_version, dialogue ORDER BY src_rank, doc_id) = 1""",
    "route_cells": f"""WITH {CORPUS}
SELECT encounter_id, lower(trim(' ' || upper(subset) || chr(9), ' ' || chr(9))) AS subset, split FROM corpus
WHERE lower(subset) IN ('en', 'de', 'fr', 'es')""",
    "select_splits": f"""WITH {CORPUS}
SELECT encounter_id, subset, split, 'train' AS selection FROM corpus WHERE split IN ('train')
UNION ALL
SELECT encounter_id, subset, split, 'test1+test2+test3' FROM corpus WHERE split IN ('test1', 'test2', 'test3')""",
    "list_cells": f"""WITH {CORPUS} SELECT DISTINCT subset, split FROM corpus""",
    "notes_per_cell": f"""WITH {CORPUS} SELECT subset, split, count(*) AS n_rows FROM corpus GROUP BY ALL""",
    "rows_per_source": """SELECT source AS file, count(*) AS rows_loaded FROM documents GROUP BY source""",
    "versions_seen": f"""WITH {CORPUS}, {LABELLED}, {FLAGS},
r AS (SELECT DISTINCT transcript_version FROM corpus),
g AS (SELECT DISTINCT transcript_version FROM f)
SELECT coalesce(r.transcript_version, g.transcript_version) AS transcript_version,
       r.transcript_version IS NOT NULL AS in_rows, g.transcript_version IS NOT NULL AS in_findings
FROM r FULL JOIN g ON r.transcript_version = g.transcript_version""",
    "version_lookup": f"""WITH {CORPUS}
SELECT c.encounter_id, c.subset, v.tv AS transcript_version
FROM corpus c JOIN (VALUES ('en', 'asr'), ('de', 'humantrans'), ('fr', 'humantrans'), ('es', 'asrcorr')) v(subset, tv)
  ON v.subset = c.subset""",
    "manifest": f"""WITH {CORPUS},
cfg AS (SELECT * FROM (VALUES ('en', 0), ('de', 1), ('fr', 2), ('es', 3)) t(config, r)),
sp AS (SELECT * FROM (VALUES ('train'), ('valid'), ('test1'), ('test2'), ('test3')) t(split)),
cnt AS (SELECT subset, split, count(*) AS n FROM corpus GROUP BY ALL)
SELECT cfg.config, sp.split, cfg.config || '/' || sp.split || '.parquet' AS path, cfg.r = 0 AS is_default,
       CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_rows
FROM cfg CROSS JOIN sp LEFT JOIN cnt ON cnt.subset = cfg.config AND cnt.split = sp.split""",
    "parse_names": f"""WITH {CORPUS},
n AS (
  SELECT encounter_id,
         CASE n_chars % 7
           WHEN 0 THEN split || '.csv'
           WHEN 1 THEN split || '_' || subset || '_' || note || '_corr.CSV'
           WHEN 2 THEN split || '_' || subset || '_' || note || '.txt'
           WHEN 3 THEN '_' || subset || '_' || note || '.csv'
           ELSE ' ' || upper(split) || '_' || subset || '_' || note || '.csv' END AS file_name
  FROM corpus),
p AS (
  SELECT encounter_id, file_name,
         string_split(CASE WHEN lower(file_name) LIKE '%.csv' THEN substr(file_name, 1, length(file_name) - 4) END, '_')
           AS parts
  FROM n),
v AS (
  SELECT encounter_id, file_name, parts, lower(trim(parts[1])) AS a, lower(trim(parts[2])) AS b,
         lower(trim(array_to_string(parts[3:], '_'))) AS c
  FROM p)
SELECT encounter_id, file_name,
       CASE WHEN ok THEN a END AS p_split, CASE WHEN ok THEN b END AS p_subset, CASE WHEN ok THEN c END AS p_version
FROM (SELECT *, parts IS NOT NULL AND len(parts) >= 3 AND a <> '' AND b <> '' AND c <> '' AS ok FROM v)""",
    "prompt_render": f"""SELECT doc_id,
  {_q(PROMPT_HEAD)} || {_numbered_sql("coalesce(text, '')", ": ")} || {_q(PROMPT_TAIL)} AS prompt
FROM documents""",
    "judge_fanout": f"""WITH {CORPUS}, {LABELLED}, {FANOUT}
SELECT encounter_id, model, CAST(judge_rank AS BIGINT) AS judge_rank,
       CASE WHEN response IS NULL THEN 'failed' WHEN malformed THEN 'malformed' ELSE 'ok' END AS status, response
FROM fan""",
    "parse_responses": f"""WITH {CORPUS}, {LABELLED}
SELECT encounter_id, 'judge/quality' AS model, CAST(CASE WHEN quality IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_items,
       coalesce(quality = 0, false) AS has_actual, quality IS NOT NULL AS contract_ok FROM x
UNION ALL
SELECT encounter_id, 'judge/toxicity', CAST(CASE WHEN toxic IS NULL THEN 0 ELSE 1 END AS BIGINT),
       coalesce(toxic = 1, false), toxic IS NOT NULL FROM x
UNION ALL
SELECT encounter_id, 'judge/length',
       CAST(CASE WHEN doc_id % {td.ODD_EVERY} < {td.ODD_MALFORMED} THEN 0 WHEN NOT {_PLAIN} THEN 1
                 WHEN n_chars < {td.SHORT_TEXT_CHARS} THEN 2 ELSE 1 END AS BIGINT),
       coalesce(n_chars < {td.SHORT_TEXT_CHARS} AND {_PLAIN}, false), {_PLAIN} FROM x""",
    "flagged": f"""WITH {CORPUS}, {LABELLED}, {FLAGS}
SELECT subset, split, encounter_id, transcript_version,
       concat_ws(',', CASE WHEN fa THEN 'judge/quality' END, CASE WHEN fb THEN 'judge/toxicity' END,
                 CASE WHEN fc THEN 'judge/length' END) AS models_with_errors,
       CAST(k AS BIGINT) AS n_models_flagging,
       CAST(CAST(quality IS NOT NULL AS INT) + CAST(toxic IS NOT NULL AS INT)
            + CAST((doc_id % {td.ODD_EVERY} >= {td.ODD_MALFORMED}) AS INT) AS BIGINT) AS judges_in_map
FROM f""",
    "models_flagging": f"""WITH {CORPUS}, {LABELLED}, {FLAGS}
SELECT encounter_id, 'judge/quality' AS model FROM f WHERE fa
UNION ALL SELECT encounter_id, 'judge/toxicity' FROM f WHERE fb
UNION ALL SELECT encounter_id, 'judge/length' FROM f WHERE fc""",
    "consensus": f"""WITH {CORPUS}, {LABELLED}, {FLAGS}
SELECT subset, count(*) AS notes_with_errors,
       count(*) FILTER (WHERE k = 3) AS all_models_found_errors,
       count(*) FILTER (WHERE k * 2 > 3) AS majority_consensus_errors
FROM f GROUP BY subset""",
    "metrics_cube": f"""WITH {CORPUS}, {LABELLED}, {FLAGS},
cells AS MATERIALIZED (
  SELECT subset, split, transcript_version, count(*) AS nwe, count(*) FILTER (WHERE k = 3) AS unan, count(*) FILTER (WHERE k * 2 > 3) AS maj
  FROM f GROUP BY subset, split, transcript_version),
tot AS MATERIALIZED (SELECT subset, split, count(*) AS n FROM corpus GROUP BY subset, split),
r AS MATERIALIZED (
  SELECT subset, split, n AS total, 0 AS nwe, 0 AS unan, 0 AS maj FROM tot
  UNION ALL SELECT subset, split, 0, nwe, unan, maj FROM cells
  UNION ALL SELECT DISTINCT subset, unnest(['train', 'valid', 'test1', 'test2', 'test3']), 0, 0, 0, 0 FROM tot),
g AS MATERIALIZED (
  SELECT 'summary' AS grouping, NULL AS subset, NULL AS split, sum(total) AS total, sum(nwe) AS nwe, sum(unan) AS unan, sum(maj) AS maj FROM r
  UNION ALL SELECT 'by_subset', subset, NULL, sum(total), sum(nwe), sum(unan), sum(maj) FROM r GROUP BY subset
  UNION ALL SELECT 'by_split', NULL, split, sum(total), sum(nwe), sum(unan), sum(maj) FROM r GROUP BY split
  UNION ALL SELECT 'by_subset_and_split', subset, split, sum(total), sum(nwe), sum(unan), sum(maj) FROM r GROUP BY subset, split)
SELECT grouping, subset, split, CAST(NULL AS VARCHAR) AS transcript_version, CAST(total AS BIGINT) AS total_notes,
       CAST(nwe AS BIGINT) AS notes_with_errors,
       CASE WHEN grouping = 'summary' THEN NULL ELSE {_pct("nwe", "total")} END AS error_percentage,
       CASE WHEN grouping = 'summary' THEN NULL ELSE CAST(unan AS BIGINT) END AS all_models_found_errors,
       CAST(maj AS BIGINT) AS majority_consensus_errors
FROM g
UNION ALL SELECT 'by_transcript_version', NULL, NULL, transcript_version, NULL, CAST(sum(nwe) AS BIGINT), NULL, CAST(sum(unan) AS BIGINT),
       CAST(sum(maj) AS BIGINT) FROM cells GROUP BY transcript_version
UNION ALL SELECT 'by_subset_and_transcript_version', subset, NULL, transcript_version, NULL, CAST(sum(nwe) AS BIGINT), NULL, CAST(sum(unan) AS BIGINT),
       CAST(sum(maj) AS BIGINT) FROM cells GROUP BY subset, transcript_version""",
    "pending": f"""WITH {CORPUS}
SELECT subset, split, encounter_id, transcript_version FROM corpus c
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.doc_id)""",
    "progress_counts": f"""WITH {CORPUS},
p AS (SELECT c.subset, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.doc_id) AS done FROM corpus c)
SELECT subset, count(*) AS total, count(*) FILTER (WHERE done) AS processed,
       count(*) FILTER (WHERE NOT done) AS remaining
FROM p GROUP BY subset""",
    "processed_keys": f"""WITH {CORPUS}, {LABELLED}
SELECT subset, split, encounter_id, transcript_version FROM x WHERE quality IS NOT NULL AND toxic IS NOT NULL
  AND doc_id % {td.ODD_EVERY} >= {td.ODD_MALFORMED}""",
    "resolve_ranges": f"""WITH {CORPUS}, {LABELLED}, {FLAGS},
r AS (
  SELECT encounter_id, dialogue, 'judge/quality' AS model, 2 AS s, -1 AS e FROM f WHERE fa
  UNION ALL SELECT encounter_id, dialogue, 'judge/toxicity', 1, -1 FROM f WHERE fb
  UNION ALL SELECT encounter_id, dialogue, 'judge/length', 1, 1 FROM f WHERE fc),
l AS (
  SELECT encounter_id, model, s, e, len(string_split(dialogue, chr(10))) AS n_lines,
         unnest(string_split(dialogue, chr(10))) AS line,
         unnest(range(1, len(string_split(dialogue, chr(10))) + 1)) AS line_no
  FROM r)
SELECT encounter_id, model, CAST(line_no AS BIGINT) AS line_no, line FROM l
WHERE line_no >= s AND line_no <= CASE WHEN e = -1 THEN n_lines ELSE e END""",
    "range_lengths": f"""WITH {CORPUS}, {LABELLED}, {FLAGS},
r AS (
  SELECT encounter_id, dialogue, 'judge/quality' AS model, 2 AS s, -1 AS e FROM f WHERE fa
  UNION ALL SELECT encounter_id, dialogue, 'judge/toxicity', 1, -1 FROM f WHERE fb
  UNION ALL SELECT encounter_id, dialogue, 'judge/length', 1, 1 FROM f WHERE fc)
SELECT encounter_id, model, CAST(s AS BIGINT) AS line_start, CAST(e AS BIGINT) AS line_end,
       CAST(greatest(least(CASE WHEN e = -1 THEN n ELSE e END, n) - greatest(s, 1) + 1, 0) AS BIGINT) AS n_covered
FROM (SELECT *, len(string_split(dialogue, chr(10))) AS n FROM r)""",
}
ORACLE_SQL["resume_two_runs"] = ORACLE_SQL["judge_fanout"]
ORACLE_SQL["resume_metrics"] = ORACLE_SQL["metrics_cube"]
ORACLE_SQL["prompt_judge"] = f"""WITH p AS ({ORACLE_SQL["prompt_render"]})
SELECT doc_id, 'judge/prompt' AS model, 'ok' AS status,
       '{{"errors":[{{"lines":[1,' || length(prompt) || '],"reason":"' || md5(prompt) || '"}}]}}' AS response
FROM p"""
ORACLE_SQL["pending_null_key"] = f"""WITH {CORPUS}
SELECT subset, split, encounter_id, CASE WHEN doc_id % 3 <> 0 THEN transcript_version END AS transcript_version
FROM corpus c WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.doc_id)"""
ORACLE_SQL["import_progress"] = ORACLE_SQL["flagged"] + " WHERE doc_id IN (SELECT doc_id FROM labels)"


def _mapped_sql(expr: str) -> str:
    """The fold spelled out as replacements: NFKC of each injected character, then the map, then accents and controls."""
    for c in INJECTED:
        wide = "".join(CHAR_MAP.get(x, x) for x in unicodedata.normalize("NFKC", c))
        if wide != c:
            expr = f"replace({expr}, {_q(c)}, {_q(wide)})"
    for c in ("\x01", "\x0b", "\x1f"):
        expr = f"replace({expr}, chr({ord(c)}), '')"
    return f"strip_accents(replace({expr}, '\u00df', ''))"


ORACLE_SQL["normalize_mapped"] = f"SELECT doc_id, {_mapped_sql("coalesce(text, '') || " + " || ".join(f'chr({ord(c)})' for c in INJECTED))} AS text_ascii FROM documents"
ORACLE_SQL["read_cells"] = f"""WITH {CORPUS}
SELECT encounter_id, subset, split, transcript_version, sha256(dialogue) AS dialogue_sha256
FROM corpus WHERE subset IN ('en', 'fr') AND split IN ('train', 'test2')"""
ORACLE_SQL["counts_order"] = f"""WITH {CORPUS}, {LONG}
SELECT subset, split, tv AS transcript_version, n AS "count",
       row_number() OVER (ORDER BY subset, CASE tv WHEN 'asr' THEN 1 WHEN 'asrcorr' THEN 2 WHEN 'humantrans' THEN 3 ELSE 4 END, tv, split) AS place
FROM long"""

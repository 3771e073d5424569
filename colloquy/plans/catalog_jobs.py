"""Registered queries of whole jobs over the test tables: files written and read back, published versions, runs that follow one
another, each with a DuckDB oracle for what the job must leave behind."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import text as tx
from colloquy.operators import audit as au
from colloquy.operators import bitmaps as bm
from colloquy.operators import corpus as co
from colloquy.operators import counts as ct
from colloquy.operators import metrics as me
from colloquy.operators import open_fields as of
from colloquy.operators.coverage import clamped_ranges, coverage_segments, coverage_totals
from colloquy.operators.position import with_position, with_position_in_group
from colloquy.operators.resolve import covered_lines, flagged_ranges
from colloquy.plans.catalog import CORPUS, FLAGS, KEY, LABELLED, LONG, N_MODELS, _PLAIN, _findings, _progress, _wide
from colloquy.plans.catalog import ORACLE_SQL as CATALOG_SQL
from colloquy.plans import rolling_audit as ra
from colloquy.session import scratch_path
from colloquy.sinks.bucketed import store_bucketed, with_transcripts
from colloquy.sinks import publish as pb
from colloquy.sinks.csv_text import csv_line, write_csv_text
from colloquy.sinks.findings import write_metrics
from colloquy.sinks.layout import write_counts_csv, write_samples
from colloquy.sources import csv_files as cf
from colloquy.sources import testdata as td
from colloquy.sources.csv_records import csv_records, usable
from colloquy.streaming import stateful as sf_


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------
# CSV files
# ---------------------------------------------------------------------------
FILES_PER_SPLIT = 8
BAD_EVERY = 50  # documents; every so many are followed by a bad row of each kind


def challenge_files(spark: SparkSession, sf: str) -> str:
    """``documents`` as challenge files, with bad rows put in: short ones, long ones, text after a closing quote, and a
    quote that never closes at the end of the first file. Returns their folder."""
    c = td.corpus(spark, sf).withColumn("note", F.coalesce("note", F.lit("")))
    file_no = F.element_at(F.create_map(*[F.lit(x) for i, s in enumerate(td.SPLITS) for x in (s, i)]), F.col("split")) * FILES_PER_SPLIT + F.col("doc_id") % FILES_PER_SPLIT
    good = csv_line(F.array("subset", "encounter_id", "dialogue", "note"))
    bad = (
        F.when(F.col("doc_id") % BAD_EVERY == 0, F.concat(F.lit("short,"), F.col("encounter_id")))
        .when(F.col("doc_id") % BAD_EVERY == 1, csv_line(F.array(F.lit("long"), "encounter_id", F.lit("d"), "note", F.lit("more, and"), F.lit("more"))))
        .when(F.col("doc_id") % BAD_EVERY == 2, F.concat(F.lit("stray,"), F.col("encounter_id"), F.lit(',"a ""b"" c" d,'), csv_line(F.array("note"))))
    )
    header = F.lit("dataset,encounter_id,dialogue,note")
    rows = c.select(file_no.alias("file"), "doc_id", header.alias("header"), F.posexplode(F.array(good, bad)).alias("seq", "line")).where("line is not null")
    last = spark.range(1).select(F.lit(0).alias("file"), F.lit(2**62).alias("doc_id"), header.alias("header"), F.lit(0).alias("seq"), F.lit('open,E0,"never closed\nto the end,').alias("line"))
    root = _scratch(spark, "challenge")
    write_csv_text(rows.unionByName(last), root, "file", ["doc_id", "seq"])
    return root


def _file_no() -> F.Column:
    return F.regexp_extract("file_path", r"file_no=(\d+)", 1).cast("long").alias("file_no")


def q_csv_challenge(spark, sf):
    """SRC-1, SRC-2, SRC-5, SRC-6: challenge files with quoted line breaks read back: the good rows with their places, and the rejects."""
    records = csv_records(spark, challenge_files(spark, sf), cf.CHALLENGE_FIELDS, cf.CHALLENGE_REQUIRED)
    kept, bad = usable(records, "drop"), records.where("reason is not null")
    return kept.unionByName(bad).select(
        _file_no(),
        "record_no",
        "dataset",
        "encounter_id",
        F.sha2(tx.unify_newlines("dialogue"), 256).alias("dialogue_sha256"),
        "note",
        F.col("n_fields").cast("long").alias("n_fields"),
        "reason",
    )


VARIANT_FILES = 200


def variant_files(spark: SparkSession, sf: str, files: int = VARIANT_FILES) -> str:
    """``documents`` as ``files`` CSV files, no two with the same header: columns in another order and with other
    extra ones; the id column is ``id``, ``encounter_id``, both (the second one wrong) or missing."""
    c = td.corpus(spark, sf).select("doc_id", F.pmod("doc_id", F.lit(files)).cast("int").alias("file"), "encounter_id", "dialogue", F.coalesce("note", F.lit("")).alias("note"))
    values = {"id": F.when(F.col("file") % 4 != 1, F.col("encounter_id")), "encounter_id": F.when(F.col("file") % 4 == 0, F.lit("wrong")).otherwise(F.col("encounter_id")), "dialogue": F.col("dialogue"), "note": F.col("note")}
    columns = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in values.items()], F.struct(F.concat(F.lit("extra, "), F.col("file").cast("string")).alias("name"), F.lit("x\ny").alias("value")))
    ids = F.when(F.col("file") % 4 == 0, F.array(F.lit(""))).when(F.col("file") % 4 == 1, F.array(F.lit("id"))).when(F.col("file") % 4 == 2, F.array(F.lit("encounter_id"))).otherwise(F.array(F.lit("id"), F.lit("encounter_id")))
    columns = F.filter(columns, lambda x: ~F.array_contains(ids, x["name"]))
    shuffled = F.array_sort(F.transform(columns, lambda x: F.struct(F.md5(F.concat(x["name"], F.lit("/"), F.col("file").cast("string"))).alias("o"), x["name"].alias("name"), x["value"].alias("value"))))
    rows = c.select("file", "doc_id", csv_line(F.transform(shuffled, lambda x: x["name"])).alias("header"), csv_line(F.transform(shuffled, lambda x: x["value"])).alias("line"))
    root = _scratch(spark, "variants")
    write_csv_text(rows, root, "file", ["doc_id"])
    return root


def q_csv_variants(spark, sf):
    """SRC-3, SRC-4: files with 200 different headers in one scan."""
    records = csv_records(spark, variant_files(spark, sf), cf.VARIANT_FIELDS, cf.VARIANT_REQUIRED)
    return records.select(
        _file_no(), "record_no", F.coalesce("encounter_id", F.lit("")).alias("encounter_id"), F.sha2(tx.unify_newlines("dialogue"), 256).alias("dialogue_sha256"), "note", "reason"
    )


# ---------------------------------------------------------------------------
# Published versions
# ---------------------------------------------------------------------------
def q_publish_versions(spark, sf):
    """SNK-1, SNK-7, AGG-19: three versions of the corpus, the third refused by its audit; what readers then see, by cell,
    beside the manifest's counts, which the writing pass took."""
    c = td.corpus(spark, sf)
    root, columns = _scratch(spark, "published"), ["encounter_id", "transcript_version", "dialogue"]
    vocab = td.TESTDATA_VOCAB
    pb.publish(c.where("subset <> 'es'"), root, columns, vocab)
    pb.publish(c, root, columns, vocab, extra={"chars": F.sum(F.length("dialogue"))})
    try:
        pb.publish(c.withColumn("subset", F.when(F.col("doc_id") % 2 == 0, F.col("subset")).otherwise(F.lit("other"))), root, columns, vocab)
    except pb.PublishError:
        pass  # the published version stays
    read = pb.read_published(spark, root).groupBy("subset", "split").agg(F.count(F.lit(1)).alias("n_read"), F.sum(F.length("dialogue")).alias("n_chars"))
    manifest = pb.read_manifest(spark, root).select("path", "is_default", "n_rows", F.col("config").alias("subset"), "split")
    return manifest.join(read, ["subset", "split"], "left").select(
        "subset", "split", "path", "is_default", "n_rows", F.coalesce("n_read", F.lit(0)).cast("long").alias("n_read"), F.coalesce("n_chars", F.lit(0)).cast("long").alias("n_chars")
    )


# ---------------------------------------------------------------------------
# Positions in a global order
# ---------------------------------------------------------------------------
def q_document_positions(spark, sf):
    """SRT-1 for any order: the place of every document by (source descending, text, doc_id) among all."""
    d = td.table(spark, sf, "documents").select("doc_id", "source", "text")
    return with_position(d, ["-source", "text", "doc_id"]).select("doc_id", "place")


def q_text_line_numbers(spark, sf):
    """WIN-2 by a text order: the number of every document among those of its source, by text, then doc_id."""
    d = td.table(spark, sf, "documents").select("doc_id", "source", "text")
    return with_position_in_group(d, ["source"], ["text", "doc_id"]).select("doc_id", "source", "line_no")


def q_totals_order(spark, sf):
    """SRT-3: the place of every row of the report with totals: totals after (ALL) or before the versions as they sort, the grand total last."""
    long = ct.version_counts(td.corpus(spark, sf))
    rows = ct.overall_with_totals(long, ct.report_order(long, td.TESTDATA_VOCAB))
    return rows.select("subset", "transcript_version", "Count", (F.monotonically_increasing_id() + 1).alias("place"))


def q_split_column_order(spark, sf):
    """SRT-2: the place of every split among the pivot's columns, with its total."""
    long = ct.version_counts(td.corpus(spark, sf))
    wide = ct.pivot_by_split(long, ["subset"], ct.report_order(long, td.TESTDATA_VOCAB))
    splits = [c for c in wide.columns if c not in ("subset", "Total")]
    return wide.where("subset = 'ALL'").select(F.inline(F.array(*[F.struct(F.lit(c).alias("split"), F.lit(i + 1).alias("place"), F.col(c).alias("total")) for i, c in enumerate(splits)])))


# ---------------------------------------------------------------------------
# Lines flagged by one and by most judges
# ---------------------------------------------------------------------------
def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    return clamped_ranges(flagged_ranges(_findings(spark, sf), KEY), td.corpus(spark, sf), KEY)


def q_flagged_coverage(spark, sf):
    """FN-17: the runs of lines that the same number of judges flagged."""
    return coverage_segments(_ranges(spark, sf), KEY).select("encounter_id", "line_start", "line_end", "n_judges")


def q_flagged_coverage_totals(spark, sf):
    """FN-17, FN-12: per flagged transcript, lines flagged by some, most and all judges."""
    ranges = _ranges(spark, sf)
    totals = coverage_totals(coverage_segments(ranges, KEY), ranges, N_MODELS, KEY)
    return totals.select("encounter_id", "n_lines", "n_flagged", "n_majority", "n_unanimous")


# ---------------------------------------------------------------------------
# Runs that follow one another
# ---------------------------------------------------------------------------
def _three_runs(spark: SparkSession, sf: str) -> ra.RollingStore:
    """Two runs over different subsets, and a third that asks every third transcript again of a length judge that now sees no errors."""
    inputs = td.labelled_prompt_inputs(spark, sf)
    judges = td.testdata_judges()
    root = _scratch(spark, "rolling")
    ra.run_rolling_audit(spark, inputs.where("subset in ('en', 'de')"), judges, root, td.TESTDATA_AUDIT, run_id=1)
    ra.run_rolling_audit(spark, inputs, judges, root, td.TESTDATA_AUDIT, run_id=2, max_attempts=1)
    calm = [*judges[:2], au.ColumnJudge(judges[2].name, lambda: F.lit(td.RESP_CLEAN))]
    return ra.run_rolling_audit(spark, inputs.where("doc_id % 3 = 0"), calm, root, td.TESTDATA_AUDIT, run_id=3, again=True)


def q_rolling_metrics(spark, sf):
    """INC-2, AGG-9 to AGG-14: metrics after three runs, from what each of them changed."""
    return ra.rolling_metrics(spark, _three_runs(spark, sf), td.TESTDATA_VOCAB.splits)


def q_rolling_findings(spark, sf):
    """SNK-3, FIL-7: findings after three runs; the third withdraws some and changes others."""
    found = ra.rolling_findings(spark, _three_runs(spark, sf), td.TESTDATA_AUDIT)
    return found.select(*KEY, F.array_join("models_with_errors", ",").alias("models_with_errors"), F.size("models_with_errors").cast("long").alias("n_models_flagging"))


def _landed_twice(spark: SparkSession, sf: str, start) -> None:
    """Lets ``start(source)`` run over files of the first half of ``documents``, then, started anew, over the rest."""
    c = td.corpus(spark, sf).withColumn("row_pos", F.col("row_pos").cast("long"))
    source = _scratch(spark, "landing")
    half = c.agg(F.max("doc_id")).first()[0] // 2
    for part in ("doc_id <= {}", "doc_id > {}"):
        c.where(part.format(half)).write.mode("append").parquet(source)
        start(source, c.schema).awaitTermination()


def q_stream_keep_first(spark, sf):
    """WIN-1, INC-1 as a stream: copies are found across batches and a restart, by state."""
    out, checkpoint = _scratch(spark, "kept"), _scratch(spark, "kept-state")
    _landed_twice(spark, sf, lambda source, schema: sf_.start_keep_first_stream(spark, source, schema, out, checkpoint))
    return spark.read.parquet(out).select("encounter_id", "subset", "split", "transcript_version")


def q_stream_progress(spark, sf):
    """INC-3 as a stream: rows and characters per cell, counted on over a restart."""
    out, checkpoint = _scratch(spark, "progress"), _scratch(spark, "progress-state")
    _landed_twice(spark, sf, lambda source, schema: sf_.start_progress_stream(spark, source, schema, out, checkpoint))
    return sf_.read_progress(spark, out)


def q_resolve_bucketed(spark, sf):
    """JOIN-7 over a corpus stored in buckets: only the findings move."""
    table = f"corpus_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store_bucketed(td.corpus(spark, sf).select(*KEY, "dialogue"), table, _scratch(spark, "bucketed"), buckets, KEY)
    ranges = flagged_ranges(_findings(spark, sf), KEY)
    lines = covered_lines(with_transcripts(spark, ranges, table, ["dialogue"], KEY), KEY)
    return lines.select("encounter_id", "model", F.col("line_no").cast("long").alias("line_no"), "line")


# ---------------------------------------------------------------------------
# Fields that the contract does not know
# ---------------------------------------------------------------------------
def q_open_findings(spark, sf):
    """SRC-10, SNK-3: findings written, read, rewritten and read again, with all fields of their items and a field of their own."""
    found = of.open_findings(_wide(spark, sf), KEY)
    notes = td.corpus(spark, sf).select(*KEY, F.col("note").alias("own_field"))
    first, second = _scratch(spark, "findings"), _scratch(spark, "findings")
    of.write_open_findings(found.join(notes, KEY), first)
    of.write_open_findings(of.read_open_findings(spark, first, KEY), second)
    back = of.read_open_findings(spark, second, KEY)
    items = F.flatten(F.map_values("errors"))
    unknown = F.transform(items, lambda i: F.size(F.filter(F.map_keys(i.cast("map<string,variant>")), lambda k: ~k.isin(*of.KNOWN_ITEM_FIELDS))))
    return back.select(
        "encounter_id",
        F.array_join("models_with_errors", ",").alias("models_with_errors"),
        F.size(items).cast("long").alias("n_items"),
        F.aggregate(unknown, F.lit(0).cast("long"), lambda s, n: s + n).alias("n_unknown"),
        F.try_variant_get(F.element_at("extra", "own_field"), "$", "string").alias("own_field"),
    )


def q_field_report(spark, sf):
    """FN-7, FN-8 as a report: the fields of all judges' error items, their types and how often they come."""
    return of.field_report(au.verdicts_long(_wide(spark, sf), KEY))


# ---------------------------------------------------------------------------
# The processed set as bitmaps
# ---------------------------------------------------------------------------
def _progress_bits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Codes given in two deliveries of the corpus, and the processed set merged from three runs' bitmaps."""
    c = td.corpus(spark, sf).select(*KEY, "doc_id")
    codes = bm.key_codes(c, bm.key_codes(c.where("doc_id % 3 = 0"), None, KEY), KEY)
    path = _scratch(spark, "codes")
    codes.write.parquet(path)
    codes = spark.read.schema(codes.schema).parquet(path)
    done = _progress(spark, sf)
    parts = [bm.bitmaps(done.where(F.crc32("encounter_id") % 4 != n), codes, KEY) for n in (0, 1, 2)]
    return codes, bm.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def q_bitmap_pending(spark, sf):
    """JOIN-1 by bits: the transcripts that are not in the processed set."""
    return bm.without(*_progress_bits(spark, sf), KEY)


def q_bitmap_progress(spark, sf):
    """JOIN-2, INC-3 by bits: total, processed and remaining per subset, counted in the set."""
    return bm.set_counts(*_progress_bits(spark, sf))


# ---------------------------------------------------------------------------
# Reports as files
# ---------------------------------------------------------------------------
def q_samples_json(spark, sf):
    """SNK-2: the first five records of every cell, written as JSON and read back."""
    path = _scratch(spark, "samples")
    write_samples(td.corpus(spark, sf), path, ["encounter_id", "transcript_version", "dialogue"])
    rows = spark.read.schema("encounter_id string, transcript_version string, dialogue string, sample_rank long, subset string, split string").json(path)
    return rows.select("subset", "split", "sample_rank", "encounter_id", "transcript_version", F.sha2("dialogue", 256).alias("dialogue_sha256"))


def q_counts_csv(spark, sf):
    """SNK-6: the long counts as a CSV file, read back with the place of every row in it."""
    path = _scratch(spark, "counts")
    write_counts_csv(ct.version_counts(td.corpus(spark, sf)), path, td.TESTDATA_VOCAB)
    rows = csv_records(spark, path, {c: (c,) for c in ("subset", "split", "transcript_version", "count")})
    return rows.select("subset", "split", "transcript_version", F.col("count").cast("long").alias("count"), F.col("record_no").alias("place"))


_CELL = "struct<total_notes:bigint,notes_with_errors:bigint,error_percentage:double,all_models_found_errors:bigint,majority_consensus_errors:bigint>"
_SUMMARY = "struct<total_notes_with_errors:bigint,total_notes_processed:bigint,majority_consensus_errors:bigint>"
_DOCUMENT = (
    f"summary {_SUMMARY}, by_subset map<string,{_CELL}>, by_split map<string,{_CELL}>, by_subset_and_split map<string,map<string,{_CELL}>>, "
    f"by_transcript_version map<string,{_CELL}>, by_subset_and_transcript_version map<string,map<string,{_CELL}>>"
)


def q_metrics_json(spark, sf):
    """SNK-5: the nested metrics document, written, read and unfolded into rows again."""
    table, text = _scratch(spark, "metrics"), _scratch(spark, "metrics-json")
    totals = co.cell_counts(td.corpus(spark, sf))
    write_metrics(me.metrics(_findings(spark, sf), totals, N_MODELS, td.TESTDATA_VOCAB.splits), table, text)
    doc = spark.read.text(text).select(F.from_json("value", _DOCUMENT).alias("d")).select("d.*")
    none = F.lit(None).cast("string")
    measures = ("total_notes", "notes_with_errors", "error_percentage", "all_models_found_errors", "majority_consensus_errors")

    def rows(name: str, subset=none, split=none, version=none, cells: DataFrame | None = None) -> DataFrame:
        return cells.select(F.lit(name).alias("grouping"), subset.alias("subset"), split.alias("split"), version.alias("transcript_version"), *[F.col(f"cell.{m}").alias(m) for m in measures])

    flat = lambda name: doc.select(F.explode(name).alias("k", "cell"))
    nested = lambda name: doc.select(F.explode(name).alias("k", "inner")).select("k", F.explode("inner").alias("j", "cell"))
    null = lambda kind: F.lit(None).cast(kind)
    summary = doc.select(
        F.lit("summary").alias("grouping"),
        none.alias("subset"),
        none.alias("split"),
        none.alias("transcript_version"),
        F.col("summary.total_notes_processed").alias("total_notes"),
        F.col("summary.total_notes_with_errors").alias("notes_with_errors"),
        null("double").alias("error_percentage"),
        null("long").alias("all_models_found_errors"),
        F.col("summary.majority_consensus_errors").alias("majority_consensus_errors"),
    )
    k, j = F.col("k"), F.col("j")
    out = summary.unionByName(rows("by_subset", subset=k, cells=flat("by_subset"))).unionByName(rows("by_split", split=k, cells=flat("by_split")))
    out = out.unionByName(rows("by_subset_and_split", subset=k, split=j, cells=nested("by_subset_and_split")))
    out = out.unionByName(rows("by_transcript_version", version=k, cells=flat("by_transcript_version")))
    return out.unionByName(rows("by_subset_and_transcript_version", subset=k, version=j, cells=nested("by_subset_and_transcript_version")))


def _unified(expr: str) -> str:
    return f"replace(replace({expr}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


_COVERED = f"""{CORPUS}, {LABELLED}, {FLAGS},
n AS (SELECT *, len(string_split(dialogue, chr(10))) AS n_lines FROM f),
r AS (SELECT encounter_id, n_lines, 'q' AS m, 2 AS s, n_lines AS e FROM n WHERE fa
      UNION ALL SELECT encounter_id, n_lines, 't', 1, n_lines FROM n WHERE fb
      UNION ALL SELECT encounter_id, n_lines, 'l', 1, 1 FROM n WHERE fc),
l AS (SELECT DISTINCT encounter_id, n_lines, m, unnest(generate_series(s, e)) AS line FROM r),
c AS (SELECT encounter_id, n_lines, line, count(*) AS k FROM l GROUP BY ALL)"""

QUERIES = {
    "csv_challenge": q_csv_challenge,
    "csv_variants": q_csv_variants,
    "publish_versions": q_publish_versions,
    "document_positions": q_document_positions,
    "text_line_numbers": q_text_line_numbers,
    "totals_order": q_totals_order,
    "split_column_order": q_split_column_order,
    "flagged_coverage": q_flagged_coverage,
    "flagged_coverage_totals": q_flagged_coverage_totals,
    "rolling_metrics": q_rolling_metrics,
    "rolling_findings": q_rolling_findings,
    "stream_keep_first": q_stream_keep_first,
    "stream_progress": q_stream_progress,
    "resolve_bucketed": q_resolve_bucketed,
    "findings_unknown_fields": q_open_findings,
    "field_report": q_field_report,
    "bitmap_pending": q_bitmap_pending,
    "bitmap_progress": q_bitmap_progress,
    "samples_json": q_samples_json,
    "counts_csv": q_counts_csv,
    "metrics_json": q_metrics_json,
}

# How many items the length judge's answer has.
_LENGTH_ITEMS = f"CASE WHEN doc_id % {td.ODD_EVERY} < {td.ODD_MALFORMED} THEN 0 WHEN {_PLAIN} AND n_chars < {td.SHORT_TEXT_CHARS} THEN 2 ELSE 1 END"

# The third run's length judge flags nothing in every third transcript.
_CALMED = (_PLAIN, f"{_PLAIN} AND doc_id % 3 <> 0")

ORACLE_SQL = {
    "csv_challenge": f"""WITH {CORPUS},
c AS (SELECT *, (list_position(['train','valid','test1','test2','test3'], split) - 1) * {FILES_PER_SPLIT} + doc_id % {FILES_PER_SPLIT} AS file_no,
             doc_id % {BAD_EVERY} AS m, coalesce(note, '') AS nt FROM corpus),
r AS (
  SELECT file_no, doc_id, 0 AS seq, subset AS dataset, encounter_id, sha256({_unified("dialogue")}) AS dialogue_sha256, nt AS note, 4 AS n_fields, NULL AS reason FROM c
  UNION ALL SELECT file_no, doc_id, 1, 'short', encounter_id, NULL, NULL, 2, 'too few fields' FROM c WHERE m = 0
  UNION ALL SELECT file_no, doc_id, 1, 'long', encounter_id, sha256('d'), nt, 6, 'too many fields' FROM c WHERE m = 1
  UNION ALL SELECT file_no, doc_id, 1, 'stray', encounter_id, sha256('a "b" c d'), nt, 4, 'text after a quote' FROM c WHERE m = 2
  UNION ALL SELECT 0, {2**62}, 0, 'open', 'E0', sha256('never closed' || chr(10) || 'to the end,'), NULL, 3, 'open quote')
SELECT CAST(file_no AS BIGINT) AS file_no, row_number() OVER (PARTITION BY file_no ORDER BY doc_id, seq) AS record_no, dataset, encounter_id,
       dialogue_sha256, note, CAST(n_fields AS BIGINT) AS n_fields, reason FROM r""",
    "csv_variants": f"""WITH {CORPUS}
SELECT CAST(doc_id % {VARIANT_FILES} AS BIGINT) AS file_no, row_number() OVER (PARTITION BY doc_id % {VARIANT_FILES} ORDER BY doc_id) AS record_no,
       CASE WHEN doc_id % {VARIANT_FILES} % 4 = 3 THEN '' ELSE encounter_id END AS encounter_id, sha256({_unified("dialogue")}) AS dialogue_sha256,
       coalesce(note, '') AS note, CAST(NULL AS VARCHAR) AS reason FROM corpus""",
    "publish_versions": f"""WITH {CORPUS},
n AS (SELECT subset, split, count(*) AS n, sum(length(dialogue)) AS chars FROM corpus GROUP BY ALL)
SELECT s.subset, p.split, s.subset || '/' || p.split || '.parquet' AS path, s.subset = 'en' AS is_default, coalesce(n, 0)::BIGINT AS n_rows,
       coalesce(n, 0)::BIGINT AS n_read, coalesce(chars, 0)::BIGINT AS n_chars
FROM (SELECT unnest(['en', 'de', 'fr', 'es']) AS subset) s CROSS JOIN (SELECT unnest(['train', 'valid', 'test1', 'test2', 'test3']) AS split) p
LEFT JOIN n ON n.subset = s.subset AND n.split = p.split""",
    "document_positions": "SELECT doc_id, row_number() OVER (ORDER BY source DESC NULLS LAST, text NULLS FIRST, doc_id) AS place FROM documents",
    "text_line_numbers": "SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY text NULLS FIRST, doc_id) AS line_no FROM documents",
    "totals_order": f"""WITH t AS ({CATALOG_SQL["counts_rollup"]})
SELECT subset, transcript_version, "Count", row_number() OVER (ORDER BY subset = 'ALL', subset, transcript_version) AS place FROM t""",
    "split_column_order": f"""WITH {CORPUS}, {LONG}
SELECT s.split, s.place, coalesce(sum(n), 0)::BIGINT AS total
FROM (VALUES ('train', 1), ('valid', 2), ('test1', 3), ('test2', 4), ('test3', 5)) s(split, place) LEFT JOIN long ON long.split = s.split GROUP BY ALL""",
    "flagged_coverage": f"""WITH {_COVERED}, g AS (SELECT *, line - row_number() OVER (PARTITION BY encounter_id, k ORDER BY line) AS island FROM c)
SELECT encounter_id, min(line)::BIGINT AS line_start, max(line)::BIGINT AS line_end, k::BIGINT AS n_judges FROM g GROUP BY encounter_id, k, island""",
    "flagged_coverage_totals": f"""WITH {_COVERED}
SELECT encounter_id, n_lines::BIGINT AS n_lines, count(*) AS n_flagged, count(*) FILTER (k * 2 > {N_MODELS}) AS n_majority,
       count(*) FILTER (k = {N_MODELS}) AS n_unanimous FROM c GROUP BY encounter_id, n_lines""",
    "rolling_metrics": CATALOG_SQL["metrics_cube"].replace(*_CALMED),
    "rolling_findings": f"""SELECT subset, split, encounter_id, transcript_version, models_with_errors, n_models_flagging
FROM ({CATALOG_SQL["flagged"].replace(*_CALMED)})""",
    "stream_keep_first": CATALOG_SQL["dedup_keep_first"],
    "stream_progress": f"WITH {CORPUS} SELECT subset, split, count(*) AS n_rows, sum(length(dialogue))::BIGINT AS n_chars FROM corpus GROUP BY ALL",
    "resolve_bucketed": CATALOG_SQL["resolve_ranges"],
    "findings_unknown_fields": f"""WITH {CORPUS}, {LABELLED}, {FLAGS}
SELECT encounter_id, concat_ws(',', CASE WHEN fa THEN 'judge/quality' END, CASE WHEN fb THEN 'judge/toxicity' END, CASE WHEN fc THEN 'judge/length' END) AS models_with_errors,
       CAST((quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT + {_LENGTH_ITEMS} AS BIGINT) AS n_items,
       CAST((doc_id % {td.ODD_EVERY} = 3)::INT AS BIGINT) AS n_unknown, note AS own_field FROM f""",
    "field_report": f"""WITH {CORPUS}, {LABELLED},
i AS (SELECT doc_id, quality, toxic, {_LENGTH_ITEMS} AS k FROM x),
r AS (
  SELECT 'judge/quality' AS model, unnest(['lines', 'reason']) AS field, count(quality) AS n FROM i
  UNION ALL SELECT 'judge/toxicity', unnest(['lines', 'reason']), count(toxic) FROM i
  UNION ALL SELECT 'judge/length', 'lines', sum(k) FROM i
  UNION ALL SELECT 'judge/length', 'reason', sum(k) FILTER (doc_id % {td.ODD_EVERY} <> 4) FROM i
  UNION ALL SELECT 'judge/length', 'sure', count(*) FILTER (doc_id % {td.ODD_EVERY} = 3) FROM i)
SELECT model, field, CASE field WHEN 'lines' THEN 'ARRAY<BIGINT>' WHEN 'reason' THEN 'STRING' ELSE 'BOOLEAN' END AS kind, field <> 'sure' AS known, n::BIGINT AS n
FROM r WHERE n > 0""",
    "bitmap_pending": CATALOG_SQL["pending"],
    "bitmap_progress": CATALOG_SQL["progress_counts"],
    "samples_json": f"""WITH {CORPUS}
SELECT subset, split, row_number() OVER (PARTITION BY subset, split ORDER BY doc_id) AS sample_rank, encounter_id, transcript_version,
       sha256(dialogue) AS dialogue_sha256 FROM corpus QUALIFY sample_rank <= 5""",
    "counts_csv": CATALOG_SQL["counts_order"],
    "metrics_json": CATALOG_SQL["metrics_cube"],
}

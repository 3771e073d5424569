"""Corpus builds from CSV files: edge cases, routing, keep-first dedup, layout, named reads."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from colloquy.config import BuildOptions
from colloquy.functions.text import fold_to_ascii
from colloquy.plans.build import build_basic, build_extended, extended_rows
from colloquy.sources import csv_files as cf
from colloquy.sources.tables import read_corpus, read_corpus_record

SPLITS = ["train", "valid", "test1", "test2", "test3"]
HEADER = ["dataset", "encounter_id", "dialogue", "note"]


def write_csv(path, header, rows, newline=""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline=newline) as f:
        w = csv.writer(f, lineterminator="\n")
        if header:
            w.writerow(header)
        for r in rows:
            w.writerow(r)


def challenge_dir(root, rows_by_split, header=HEADER):
    for split in SPLITS:
        write_csv(os.path.join(root, f"{split}.csv"), header, rows_by_split.get(split, []))
    return root


# ---------------------------------------------------------------------------
# CSV fidelity
# ---------------------------------------------------------------------------
def test_csv_edge_cases(spark, scratch):
    data = os.path.join(scratch, "data")
    raw = (
        "dataset,encounter_id,dialogue,note,extra\n"
        '" ACI ",E1,"[doctor] said ""hi""\r\n[patient] ok\rbye",n1,x\n'
        "\n"
        "virtassist,E2,plain\\text,  spaced  \n"
        "VirtScribe,E3\n"
        "other,E4,dropped,n4\n"
    )
    os.makedirs(data)
    with open(os.path.join(data, "train.csv"), "w", encoding="utf-8", newline="") as f:
        f.write(raw)
    for split in SPLITS[1:]:
        write_csv(os.path.join(data, f"{split}.csv"), HEADER, [])
    res = build_basic(spark, data, os.path.join(scratch, "out"))
    got = {r.encounter_id: r for r in res.corpus.collect()}
    assert set(got) == {"E1", "E2", "E3"}  # unknown subset dropped, blank line skipped
    assert got["E1"].dialogue == '[doctor] said "hi"\n[patient] ok\nbye'
    assert got["E1"].subset == "aci" and got["E1"].split == "train"
    assert got["E2"].dialogue == "plain\\text" and got["E2"].note == "  spaced  "
    assert got["E3"].dialogue == "" and got["E3"].note == ""  # short row -> ''


def test_missing_split_file_raises(spark, scratch):
    data = challenge_dir(os.path.join(scratch, "d"), {})
    os.remove(os.path.join(data, "test2.csv"))
    with pytest.raises(FileNotFoundError, match="test2.csv"):
        cf.challenge_paths(spark, data)


def test_missing_required_columns_raises(spark, scratch):
    data = challenge_dir(os.path.join(scratch, "d"), {}, header=["dataset", "dialogue"])
    with pytest.raises(ValueError, match="columns encounter_id, note not in the header"):
        cf.read_challenge(spark, data)


def test_unknown_subset_fails_extended_build(spark, scratch):
    data = challenge_dir(os.path.join(scratch, "d"), {"train": [["mystery", "E1", "d", "n"]]})
    rows = cf.read_challenge(spark, data, extended=True)
    with pytest.raises(Exception, match="Unknown subset/dataset 'mystery'"):
        rows.collect()


def test_variant_files_with_different_headers(spark, scratch):
    data = challenge_dir(os.path.join(scratch, "d"), {})
    write_csv(os.path.join(data, "abl", "train_aci_asrcorr.csv"), ["id", "dialogue", "note"], [["A1", "d1", "n1"]])
    write_csv(
        os.path.join(data, "abl", "deep", "train_aci_Asr_Fix.CSV"),
        ["note", "dialogue", "encounter_id"],
        [["n2", "d2", "A2"]],
    )
    write_csv(os.path.join(data, "abl", "valid_virtscribe_asr.csv"), ["dialogue", "note"], [["d3", "n3"]])
    write_csv(os.path.join(data, "abl", "extra_aci_asr.csv"), ["id", "dialogue", "note"], [["X", "x", "x"]])
    write_csv(os.path.join(data, "abl", "train_other_asr.csv"), ["id", "dialogue", "note"], [["Y", "y", "y"]])
    write_csv(os.path.join(data, "abl", "bad.csv"), ["id", "dialogue", "note"], [["Z", "z", "z"]])
    files = cf.discover_variants(spark, data)
    assert sorted((f.split, f.subset, f.transcript_version) for f in files.collect()) == [
        ("train", "aci", "asr_fix"),
        ("train", "aci", "asrcorr"),
        ("valid", "virtscribe", "asr"),
    ]
    rows = {r.dialogue: r for r in cf.read_variants(spark, files).collect()}
    assert (rows["d1"].encounter_id, rows["d1"].note, rows["d1"].transcript_version) == ("A1", "n1", "asrcorr")
    assert (rows["d2"].encounter_id, rows["d2"].note, rows["d2"].transcript_version) == ("A2", "n2", "asr_fix")
    assert (rows["d3"].encounter_id, rows["d3"].split, rows["d3"].subset) == ("", "valid", "virtscribe")


# ---------------------------------------------------------------------------
# End-to-end extended build on files derived from the documents table
# ---------------------------------------------------------------------------
LANG_TO_DATASET = {"en": " ACI ", "de": "virtassist", "fr": "VirtScribe", "es": "aci"}


def documents_as_files(spark, data):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    by_split = {s: [] for s in SPLITS}
    for d in docs:
        by_split[SPLITS[d.doc_id % 5]].append([LANG_TO_DATASET[d.lang], f"D{d.doc_id}", d.text, d.source])
    challenge_dir(data, by_split)
    # Variant files: the aci rows again as 'asr' (duplicates of the challenge rows),
    # and ASCII-folded as 'asrcorr' with one row repeated inside the file.
    for split in SPLITS:
        aci = [r for r in by_split[split] if r[0].strip().lower() == "aci"]
        write_csv(os.path.join(data, "ablation", f"{split}_aci_asr.csv"), ["id", "dialogue", "note"],
                  [[r[1], r[2], r[3]] for r in aci])
        corr = [[r[1], fold_to_ascii(r[2]), r[3]] for r in aci]
        write_csv(os.path.join(data, "ablation", "corr", f"{split}_aci_asrcorr.csv"), ["dialogue", "note", "id"],
                  [[c[1], c[2], c[0]] for c in corr + corr[:1]])
    return docs, by_split


def brute_force(by_split):
    """The keep-first rule in plain Python over the same files, in the same order."""
    out = {}
    defaults = {"aci": "asr", "virtassist": "humantrans", "virtscribe": "humantrans"}
    for split in SPLITS:
        cells = {}
        for ds, enc, text, note in by_split[split]:
            subset = fold_to_ascii(ds).strip().lower()
            cells.setdefault(subset, []).append((enc, defaults[subset], fold_to_ascii(text), 0))
        aci = [r for r in by_split[split] if r[0].strip().lower() == "aci"]
        cells.setdefault("aci", [])
        cells["aci"] += [(r[1], "asr", fold_to_ascii(r[2]), 1) for r in aci]
        corr = [(r[1], "asrcorr", fold_to_ascii(r[2]), 1) for r in aci]
        cells["aci"] += corr + corr[:1]
        for subset, recs in cells.items():
            seen, kept = set(), []
            for enc, tv, text, rank in recs:
                if (text, tv) in seen:
                    continue
                seen.add((text, tv))
                kept.append((enc, tv, rank))
            out[(subset, split)] = kept
    return out


def test_extended_build_matches_brute_force(spark, scratch):
    data = os.path.join(scratch, "data")
    _, by_split = documents_as_files(spark, data)
    out = os.path.join(scratch, "out")
    res = build_extended(spark, data, out)
    want = brute_force(by_split)
    got = {}
    for r in res.corpus.select("subset", "split", "encounter_id", "transcript_version", "src_rank").collect():
        got.setdefault((r.subset, r.split), []).append((r.encounter_id, r.transcript_version, r.src_rank))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v}

    # Dedup report: rows in - rows out per cell.
    rep = {(r.subset, r.split): (r.rows_in, r.rows_out) for r in res.dedup_report.where("level = 'cell'").collect()}
    rows_in = {}
    for split in SPLITS:
        for r in by_split[split]:
            subset = fold_to_ascii(r[0]).strip().lower()
            rows_in[(subset, split)] = rows_in.get((subset, split), 0) + 1
            if subset == "aci":  # the asr copy and the asrcorr copy of every aci row
                rows_in[(subset, split)] += 2
        rows_in[("aci", split)] = rows_in.get(("aci", split), 0) + (1 if any(
            fold_to_ascii(r[0]).strip().lower() == "aci" for r in by_split[split]) else 0)
    for cell, kept in want.items():
        if kept:
            assert rep[cell] == (rows_in[cell], len(kept)), cell
    total = res.dedup_report.where("level = 'total'").first()
    assert total.rows_in - total.rows_out == total.duplicates_removed > 0

    # Manifest: every configured cell, first config is the default, counts joined in.
    man = res.manifest.collect()
    assert len(man) == 15 and [m.config for m in man if m.is_default] == ["virtassist"] * 5
    assert {(m.config, m.split): m.n_rows for m in man} == {
        (s, sp): len(want.get((s, sp), [])) for s in ("virtassist", "aci", "virtscribe") for sp in SPLITS
    }
    assert man[0].path == "virtassist/train.parquet"

    # Samples: at most five per cell, the first ones in source order.
    samples = spark.read.json(os.path.join(out, "samples"))
    per_cell = samples.groupBy("subset", "split").count().collect()
    assert per_cell and all(r["count"] <= 5 for r in per_cell)

    # Enumerated dialogue round-trips.
    row = res.corpus.select("dialogue", "enumerated_dialogue").first()
    lines = row.enumerated_dialogue.split("\n")
    assert "\n".join(line.split(" ", 1)[1] for line in lines) == row.dialogue


def test_named_reads_prune_partitions(spark, scratch):
    data = os.path.join(scratch, "data")
    documents_as_files(spark, data)
    res = build_extended(spark, data, os.path.join(scratch, "out"))
    df = read_corpus_record(spark, res.data_root, subset="aci", split="test1+test2+test3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(subset" in plan
    assert set(df.columns) == {"subset", "split", "encounter_id", "transcript_version", "dialogue",
                               "enumerated_dialogue", "note"}
    assert {r.split for r in df.select("split").distinct().collect()} <= {"test1", "test2", "test3"}
    assert df.count() == res.corpus.where("subset = 'aci' AND split IN ('test1','test2','test3')").count()
    whole = read_corpus(spark, res.data_root)
    assert whole.count() == res.corpus.count()


def test_extended_rows_keep_challenge_first(spark, scratch):
    data = os.path.join(scratch, "data")
    documents_as_files(spark, data)
    rows = extended_rows(spark, data, options=BuildOptions())
    first = rows.where("src_rank = 0").select(F.min("row_pos")).first()[0]
    assert first is not None
    assert rows.where("src_rank = 1 AND subset <> 'aci'").count() == 0


def test_header_with_bom_and_empty_file(spark, scratch):
    path = os.path.join(scratch, "bom.csv")
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        f.write("dialogue,note,id\nd,n,1\n")
    assert cf.header_of(spark, path) == ("dialogue", "note", "id")
    empty = os.path.join(scratch, "empty.csv")
    open(empty, "w").close()
    with pytest.raises(ValueError, match="no header row"):
        cf.header_of(spark, empty)


def test_available_cells_lists_published_partitions(spark, scratch):
    from colloquy.sinks.layout import write_corpus
    from colloquy.sources import testdata as td
    from colloquy.sources.tables import available_cells

    root = os.path.join(scratch, "pub")
    write_corpus(td.corpus(spark, "/root/testdata/sf0.001"), root, ["encounter_id", "dialogue"])
    got = {tuple(r) for r in available_cells(spark, root).collect()}
    want = {tuple(r) for r in td.corpus(spark, "/root/testdata/sf0.001").select("subset", "split").distinct().collect()}
    assert got == want


def test_basic_build_reads_a_file_with_a_byte_order_mark(spark, scratch):
    data = challenge_dir(os.path.join(scratch, "bom"), {})
    with open(os.path.join(data, "train.csv"), "w", encoding="utf-8-sig", newline="") as f:
        f.write("dataset,encounter_id,dialogue,note\naci,E1,[doctor] hi,n\n")
    res = build_basic(spark, data, os.path.join(scratch, "out"))
    rows = res.corpus.select("subset", "split", "encounter_id", "dialogue").collect()
    assert [tuple(r) for r in rows] == [("aci", "train", "E1", "[doctor] hi")]


def test_build_without_ascii_normalisation_keeps_the_text(spark, scratch):
    data = challenge_dir(os.path.join(scratch, "raw"), {"valid": [["VirtAssist", "E9", "café — ok", "nöte"]]})
    res = build_basic(spark, data, os.path.join(scratch, "out"), options=BuildOptions(ascii_normalize=False, on_unknown_subset="drop"))
    row = res.corpus.select("subset", "dialogue", "note").first()
    assert (row.subset, row.dialogue, row.note) == ("virtassist", "café — ok", "nöte")


def test_variant_names_with_spaces_and_percent_signs(spark, scratch):
    data = challenge_dir(os.path.join(scratch, "d"), {})
    for name, text in (("train _aci_asrcorr.csv", "d1"), ("train_aci_asr corr.csv", "d2"), ("valid_aci_100%25 a+b.csv", "d3")):
        write_csv(os.path.join(data, "odd names", name), ["id", "dialogue", "note"], [["A", text, "n"]])
    rows = cf.read_variants(spark, cf.discover_variants(spark, data)).collect()
    assert {r.dialogue: (r.split, r.subset, r.transcript_version) for r in rows} == {
        "d1": ("train", "aci", "asrcorr"),
        "d2": ("train", "aci", "asr corr"),
        "d3": ("valid", "aci", "100%25 a+b"),
    }


def test_a_hot_cell_is_written_in_few_files(spark, scratch):
    import glob

    from pyspark.sql import functions as F

    from colloquy.sinks.layout import write_corpus

    df = spark.range(0, 20000, 1, 64).select(F.lit("t").alias("note"), F.lit("aci").alias("subset"), F.when(F.col("id") % 100 == 0, "valid").otherwise("train").alias("split"))
    write_corpus(df, os.path.join(scratch, "out"), ["note"])
    for split in ("train", "valid"):
        assert 1 <= len(glob.glob(os.path.join(scratch, "out", "subset=aci", f"split={split}", "*.parquet"))) <= 8

"""All CSV files in one scan: fields by each file's own header, and the table of bad rows."""

import csv
import io
import os

import pytest

from colloquy.config import BuildOptions
from colloquy.plans import catalog_jobs as jobs
from colloquy.plans.build import build_basic
from colloquy.sources import csv_files as cf
from colloquy.sources.csv_records import csv_records, parse_record, rejects, usable

from conftest import SF_SMALL

FIELDS = {"encounter_id": ("id", "encounter_id"), "dialogue": ("dialogue",), "note": ("note",)}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


def test_rows_are_mapped_by_their_own_file(spark, scratch):
    paths = [
        _write(f"{scratch}/a b%20+.csv", 'note,id,dialogue\nn1,1,"two\nlines, ""quoted"""\n,,\n'),
        _write(f"{scratch}/b.csv", '﻿dialogue,"odd, name",encounter_id,note\r\nd,x,2,n2\r\n"",,"",""\r\n'),
        _write(f"{scratch}/c.csv", "dialogue,note\n\n\nonly,here\n"),
        _write(f"{scratch}/one.csv", 'dialogue\nplain\n"quoted, ""text"""\n'),
        _write(f"{scratch}/header_only.csv", "id,dialogue,note\n"),
        _write(f"{scratch}/empty.csv", ""),
    ]
    got = csv_records(spark, paths, FIELDS).orderBy("file_name", "record_no").collect()
    assert [(r.file_name, r.record_no, r.encounter_id, r.dialogue, r.note, r.reason) for r in got] == [
        ("a b%20+.csv", 1, "1", 'two\nlines, "quoted"', "n1", None),
        ("a b%20+.csv", 2, "", "", "", None),
        ("b.csv", 1, "2", "d", "n2", None),
        ("b.csv", 2, "", "", "", None),
        ("c.csv", 1, None, "only", "here", None),
        ("one.csv", 1, None, "plain", None, None),
        ("one.csv", 2, None, 'quoted, "text"', None, None),
    ]
    assert all(r.raw is None for r in got)


def test_bad_rows_are_kept_with_file_and_place(spark, scratch):
    path = _write(f"{scratch}/x.csv", 'id,dialogue,note\n1,a,b\n2,short\n3,a,b,more\n4,"a" b,c\n\n5,ok,"x\ny"\n6,"open\nto,the,end\n')
    other = _write(f"{scratch}/y.csv", "id,text\n7,t\n")
    records = csv_records(spark, [path, other], FIELDS, ["dialogue", "note"])
    bad = {(os.path.basename(r.file_path), r.record_no): (r.reason, r.n_fields, r.raw) for r in rejects(records).collect()}
    assert bad == {
        ("x.csv", 2): ("too few fields", 2, "2,short"),
        ("x.csv", 3): ("too many fields", 4, "3,a,b,more"),
        ("x.csv", 4): ("text after a quote", 3, '4,"a" b,c'),
        ("x.csv", 6): ("open quote", 2, bad[("x.csv", 6)][2]),
        ("y.csv", 1): ("no column dialogue, note", 2, "7,t"),
    }
    assert bad[("x.csv", 6)][2].rstrip("\n") == '6,"open\nto,the,end'
    assert sorted(r.encounter_id for r in usable(records, "drop").collect()) == ["1", "5"]
    lenient = {r.encounter_id: (r.dialogue, r.note) for r in usable(records).where("file_name = 'x.csv'").collect()}
    assert lenient["2"] == ("short", None) and lenient["3"] == ("a", "b") and lenient["4"] == ("a b", "c")
    with pytest.raises(Exception, match="x.csv, record 2: too few fields"):
        usable(records.where("file_name = 'x.csv'").coalesce(1), "error").collect()
    with pytest.raises(ValueError):
        usable(records, "ignore")


@pytest.mark.parametrize("raw", ["a,b", "", '"a,b",c', 'a"b,c', '"x""y"', '"a\r\nb",c', ",", '""', "a,\"b\nc\nd\",e", "'a',b"])
def test_records_are_cut_as_the_csv_module_does(raw):
    assert parse_record(raw)[0] == (next(csv.reader(io.StringIO(raw, newline="")), [""]) or [""])


def test_plan_does_not_grow_with_headers(spark):
    def nodes(n):
        records = csv_records(spark, jobs.variant_files(spark, SF_SMALL, n), FIELDS, ["dialogue", "note"])
        return len(records._jdf.queryExecution().optimizedPlan().toString().splitlines()), records.count()

    (few, rows), (many, same) = nodes(3), nodes(200)
    assert few == many and rows == same > 0


def test_builds_keep_drop_or_refuse_bad_rows(spark, scratch):
    data = f"{scratch}/data"
    for split in ("train", "valid", "test1", "test2", "test3"):
        _write(f"{data}/{split}.csv", "dataset,encounter_id,dialogue,note\n")
    _write(f"{data}/train.csv", "dataset,encounter_id,dialogue,note\naci,E1,d,n\naci,E2\naci,E3,d,n,x\n")
    ids = lambda how: {r.encounter_id for r in build_basic(spark, data, f"{scratch}/{how}", options=BuildOptions(on_unknown_subset="drop", on_bad_row=how)).corpus.collect()}
    assert ids("keep") == {"E1", "E2", "E3"}
    assert ids("drop") == {"E1"}
    with pytest.raises(Exception, match="too (few|many) fields"):
        ids("error")
    bad = cf.challenge_rejects(spark, data).collect()
    assert sorted((os.path.basename(r.file_path), r.record_no, r.reason) for r in bad) == [("train.csv", 2, "too few fields"), ("train.csv", 3, "too many fields")]


def test_variant_rejects(spark, scratch):
    data = f"{scratch}/v"
    _write(f"{data}/train_aci_asr.csv", "id,dialogue,note\n1,a,b\n2\n")
    _write(f"{data}/valid_aci_asr.csv", "id,dialogue\n3,a\n")
    bad = cf.variant_rejects(spark, cf.discover_variants(spark, data)).collect()
    assert sorted((os.path.basename(r.file_path), r.record_no, r.reason) for r in bad) == [("train_aci_asr.csv", 2, "too few fields"), ("valid_aci_asr.csv", 1, "no column note")]
    os.makedirs(f"{scratch}/none")
    assert cf.variant_rejects(spark, cf.discover_variants(spark, f"{scratch}/none")).count() == 0

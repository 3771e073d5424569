"""Write, audit, publish: a dataset of versions with a pointer to the current one (SNK-1, SNK-7, AGG-19).

Layout under ``root``:

* ``versions/<id>/data/``     - one Parquet dataset partitioned by (subset, split), complete before anyone reads it
* ``versions/<id>/manifest/`` - rows per configured cell, counted while the data was written
* ``current``                 - one line: the id of the version that readers get

A version is written under a new id, its counts are held against the given checks, and only then is the pointer
replaced, by a rename. A job that stops anywhere before leaves the published version as it was; what it wrote is an unpublished folder that
``expire`` removes. Readers that hold an older version keep reading its files until it expires.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_VOCAB, Vocabulary
from colloquy.functions.names import layout_path
from colloquy.sinks.layout import write_corpus
from colloquy.sources.csv_files import join_path

MANIFEST = "config string, split string, path string, is_default boolean, n_rows long"


@dataclass(frozen=True)
class Counts:
    """What the writing pass saw: all rows, those outside the configured cells, rows per cell and further measures."""

    rows: int
    unrouted: int
    cells: dict[tuple[str, str], int]
    extra: dict[str, object]


Check = Callable[[Counts], str | None]  # what is wrong, or None


class PublishError(RuntimeError):
    """The audit refused a version; the published one is unchanged."""


def observed(df: DataFrame, vocab: Vocabulary = DEFAULT_VOCAB, extra: dict[str, Column] | None = None) -> tuple[DataFrame, Callable[[], Counts]]:
    """``df`` with its counts taken as it passes by, and a function that gives them after the one action on it.

    The counters are one per configured cell: vocabulary-sized, summed by the tasks that write.
    """
    cells = [(s, p) for s in vocab.subsets for p in vocab.splits]
    inside = F.col("subset").isin(list(vocab.subsets)) & F.col("split").isin(list(vocab.splits))
    seen = Observation()
    named = {f"cell_{i}": F.count_if((F.col("subset") == s) & (F.col("split") == p)) for i, (s, p) in enumerate(cells)}
    named |= {"rows": F.count(F.lit(1)), "unrouted": F.count_if(~F.coalesce(inside, F.lit(False)))}
    named |= {f"extra_{k}": c for k, c in (extra or {}).items()}
    out = df.observe(seen, *[c.alias(k) for k, c in named.items()])

    def counts() -> Counts:
        got = seen.get
        return Counts(got["rows"], got["unrouted"], {c: got[f"cell_{i}"] for i, c in enumerate(cells)}, {k: got[f"extra_{k}"] for k in (extra or {})})

    return out, counts


def not_empty(counts: Counts) -> str | None:
    return None if counts.rows else "no rows"


def all_routed(counts: Counts) -> str | None:
    return f"{counts.unrouted} rows outside the configured cells" if counts.unrouted else None


def current_version(spark: SparkSession, root: str) -> str | None:
    fs, path = _fs(spark, join_path(root, "current"))
    if not fs.exists(path):
        return None
    reader = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(path)))
    try:
        return reader.readLine()
    finally:
        reader.close()


def publish(
    df: DataFrame,
    root: str,
    columns: Sequence[str],
    vocab: Vocabulary = DEFAULT_VOCAB,
    checks: Sequence[Check] = (not_empty, all_routed),
    extra: dict[str, Column] | None = None,
) -> tuple[str, Counts]:
    """Write ``df`` (with subset and split) as a new version, audit its counts and make it the current one; returns its id and counts.

    The data is read once: rows per cell, and the measures of ``extra``, are observed in the writing job.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    place = join_path(root, f"versions/{version}")
    rows, counts = observed(df, vocab, extra)
    write_corpus(rows, f"{place}/data", columns, mode="error")
    seen = counts()
    wrong = [w for w in (check(seen) for check in checks) if w]
    if wrong:
        raise PublishError(f"version {version}: " + "; ".join(wrong))
    cells = [(s, p, i == 0, seen.cells[s, p]) for i, s in enumerate(vocab.subsets) for p in vocab.splits]
    manifest = spark.createDataFrame(cells, "config string, split string, is_default boolean, n_rows long").withColumn("path", layout_path("config", "split"))
    manifest.select("config", "split", "path", "is_default", "n_rows").coalesce(1).write.parquet(f"{place}/manifest")
    _point(spark, root, version)
    return version, seen


def read_published(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The current version's rows (or another's), with subset and split."""
    data = join_path(root, f"versions/{_known(spark, root, version)}/data")
    return spark.read.option("basePath", data).parquet(data)


def read_manifest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """Rows per configured cell of the current version (or another), empty cells included."""
    return spark.read.schema(MANIFEST).parquet(join_path(root, f"versions/{_known(spark, root, version)}/manifest"))


def expire(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove all versions but the current one and the ``keep - 1`` latest others; returns the ids removed."""
    fs, path = _fs(spark, join_path(root, "versions"))
    if not fs.exists(path):
        return []
    current = current_version(spark, root)
    found = sorted(((-f.getModificationTime(), str(f.getPath().getName())) for f in fs.listStatus(path)), key=lambda x: (x[1] != current, x))
    gone = [name for _, name in found[max(keep, 1 if current else 0) :]]
    for name in gone:
        fs.delete(_path(spark, join_path(root, f"versions/{name}")), True)
    return gone


def _known(spark: SparkSession, root: str, version: str | None) -> str:
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return version


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _point(spark: SparkSession, root: str, version: str) -> None:
    """Replace the pointer: a new file takes its name in one rename, so a reader sees the old id or the new one."""
    jvm = spark.sparkContext._jvm
    new = _path(spark, join_path(root, f".current-{version}"))
    target = _path(spark, join_path(root, "current"))
    fs = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(new, True)
    out.write(bytearray(version.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fs.makeQualified(new), fs.makeQualified(target), options)

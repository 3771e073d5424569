"""Published versions: the pointer moves only after the audit, counts come from the writing pass."""

import os

import pytest
from pyspark.sql import functions as F

from colloquy.config import Vocabulary
from colloquy.sinks import publish as pb

VOCAB = Vocabulary(subsets=("aci", "vs"), splits=("train", "valid"))
COLUMNS = ["id", "text"]


def _rows(spark, n, subset="aci"):
    return spark.range(n).select("id", F.lit(subset).alias("subset"), F.when(F.col("id") % 3 == 0, "train").otherwise("valid").alias("split"), F.lit("t").alias("text"))


def test_readers_see_whole_versions_only(spark, scratch):
    root = f"{scratch}/d"
    with pytest.raises(FileNotFoundError):
        pb.read_published(spark, root)
    first, counts = pb.publish(_rows(spark, 9), root, COLUMNS, VOCAB, extra={"most": F.max("id")})
    assert counts == pb.Counts(9, 0, {("aci", "train"): 3, ("aci", "valid"): 6, ("vs", "train"): 0, ("vs", "valid"): 0}, {"most": 8})
    assert pb.current_version(spark, root) == first and pb.read_published(spark, root).count() == 9
    held = pb.read_published(spark, root)

    broken = _rows(spark, 30).withColumn("text", F.when(F.col("id") == 29, F.raise_error(F.lit("task lost"))).otherwise("t"))
    with pytest.raises(Exception, match="task lost"):  # stops in the write
        pb.publish(broken, root, COLUMNS, VOCAB)
    assert pb.current_version(spark, root) == first and pb.read_published(spark, root).count() == 9

    with pytest.raises(pb.PublishError, match="20 rows outside"):
        pb.publish(_rows(spark, 20, "odd"), root, COLUMNS, VOCAB)
    with pytest.raises(pb.PublishError, match="no rows"):
        pb.publish(_rows(spark, 0), root, COLUMNS, VOCAB)
    with pytest.raises(pb.PublishError, match="fewer"):
        pb.publish(_rows(spark, 5), root, COLUMNS, VOCAB, [lambda c: "fewer than before" if c.rows < 9 else None])
    assert pb.read_published(spark, root).count() == 9

    second, _ = pb.publish(_rows(spark, 12), root, COLUMNS, VOCAB)
    assert pb.read_published(spark, root).count() == 12
    assert held.count() == 9 and pb.read_published(spark, root, first).count() == 9  # an older reader goes on
    manifest = {(r.config, r.split): (r.n_rows, r.is_default, r.path) for r in pb.read_manifest(spark, root).collect()}
    assert manifest[("aci", "train")] == (4, True, "aci/train.parquet") and manifest[("vs", "valid")] == (0, False, "vs/valid.parquet")

    gone = pb.expire(spark, root)
    assert first in gone and second not in gone and len(gone) >= 2  # the refused and broken ones go too
    assert os.listdir(f"{root}/versions") == [second] and pb.read_published(spark, root).count() == 12


def test_manifest_needs_no_second_scan(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    rows = _rows(spark, 50).withColumn("text", F.udf(count, "string")("text"))
    _, counts = pb.publish(rows, f"{scratch}/e", COLUMNS, VOCAB)
    assert counts.rows == 50 and seen.value == 50
    assert sum(r.n_rows for r in pb.read_manifest(spark, f"{scratch}/e").collect()) == 50

"""The processed set as exact bitmaps over dense key codes (JOIN-1, JOIN-2, AGG-17, SNK-4).

Every transcript key has a code, counted from 0 inside its subset and never changed; keys that come later get the codes after the
last one. A set of transcripts is then one bit per key: rows of (subset, bucket, bits), 32,768 keys in 4 KB. Sets are merged by ``or``,
counted without looking at a key, and stored sets grow by a bit per key instead of by a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.config import DEFAULT_AUDIT
from colloquy.operators.position import with_position_in_group
from colloquy.operators.resolve import key_join


def key_codes(keys: DataFrame, known: DataFrame | None = None, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(key, code) of all distinct ``keys``: the codes of ``known`` as they are, new keys after them in key order."""
    key = list(key)
    rest = [k for k in key if k != "subset"]
    new = keys.select(*key).distinct()
    if known is not None:
        new = key_join(new, known.select(*key), key, "left_anti")
    numbered = with_position_in_group(new, ["subset"], rest, "code").withColumn("code", F.col("code") - 1)
    if known is None:
        return numbered
    last = known.groupBy("subset").agg((F.max("code") + 1).alias("_next"))
    later = key_join(numbered, last, ["subset"], "left").select(*key, (F.col("code") + F.coalesce("_next", F.lit(0))).alias("code"))
    return known.select(*key, "code").unionByName(later)


def bitmaps(done: DataFrame, codes: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """(subset, bucket, bits): the set of the keys in ``done``; combined map-side, a key named twice is one bit."""
    key = [k for k in key if k in done.columns]
    coded = key_join(codes, done.select(*key).distinct(), key, "left_semi")
    return coded.groupBy("subset", F.bitmap_bucket_number("code").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"))


def merged(sets: DataFrame) -> DataFrame:
    """The union of sets."""
    return sets.groupBy("subset", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def is_set(bits: Column, code: Column) -> Column:
    """Whether the bit of ``code`` is set; a null set holds nothing."""
    at = F.bitmap_bit_position(code)
    octet = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(octet / F.pow(F.lit(2), at % 8)) % 2 == 1, F.lit(False))


def without(codes: DataFrame, done: DataFrame, key: Sequence[str] = DEFAULT_AUDIT.key) -> DataFrame:
    """JOIN-1: the keys whose bit is not set in ``done``, looked up a bucket of 32,768 keys at a time."""
    named = codes.withColumn("bucket", F.bitmap_bucket_number("code"))
    return key_join(named, done, ["subset", "bucket"], "left").where(~is_set(F.col("bits"), F.col("code"))).select(*key)


def set_counts(codes: DataFrame, done: DataFrame) -> DataFrame:
    """JOIN-2 + INC-3: total, processed and remaining per subset: bits are counted, no keys are joined."""
    total = codes.groupBy("subset").agg(F.count(F.lit(1)).alias("total"))
    counted = done.groupBy("subset").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return key_join(total, counted, ["subset"], "left").select("subset", "total", n.alias("processed"), (F.col("total") - n).alias("remaining"))

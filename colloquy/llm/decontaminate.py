"""Benchmark decontamination: documents that hold a passage near to a benchmark item.

Item-sized windows of a document get a SimHash of their words. Fingerprints are split into blocks; by
the pigeonhole principle two fingerprints within the radius agree, up to ``radius // blocks`` bits, in some
block, so an equi-join on (item length, block, block value) against the items' blocks and their
neighbours finds every pair within the radius. The pairs found are verified by the exact weighted Jaccard
similarity of their word shingles (each shingle weighs its number of occurrences).

A window without any shingle of an item has similarity 0, so windows are laid only where a
document holds a shingle of some item: for each such place and item, every item-sized window that covers the
shingle. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import stored

BROADCAST_ROWS = 2_000_000  # distinct item shingles, one long each: 16 MB; beyond, the lookup is a shuffle join


@dataclass(frozen=True)
class Decontamination:
    shingle_words: int = 5
    threshold: float = 0.8
    blocks: int = 8
    radius: int = 15

    @property
    def near(self) -> int:
        """Bits that some block of two fingerprints within the radius differs in at most."""
        return self.radius // self.blocks


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and marks: case, spacing and punctuation don't hide a copy."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(r"([\p{L}\p{M}\p{N}]+)"), F.lit(1))


def shingle_hashes(word_hashes: Column, n: Column, k: int) -> Column:
    """Hashes of all k consecutive words; fewer words make one shingle."""
    last = F.greatest(n - k, F.lit(0))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(word_hashes, i + 1, F.lit(k))))).otherwise(F.array().cast("array<long>"))


def simhash(word_hashes: Column, n: Column) -> Column:
    """64 bits: bit b is set if more than half of the words have it set."""
    one = lambda b: F.aggregate(word_hashes, F.lit(0), lambda s, h: s + F.getbit(h, b).cast("int"))
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(2 * one(b) > n, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(b))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of smaller over sum of larger shingle counts."""
    count = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    both = F.aggregate(F.array_distinct(a), F.lit(0), lambda s, x: s + F.least(count(a, x), count(b, x)))
    return both / (F.size(a) + F.size(b) - both)


def _block_values(fp: Column, p: Decontamination) -> Column:
    width = 64 // p.blocks
    return F.array(*(F.shiftrightunsigned(fp, width * i).bitwiseAND(F.lit((1 << width) - 1).cast("long")).cast("int") for i in range(p.blocks)))


def _flips(p: Decontamination) -> list[int]:
    width = 64 // p.blocks
    return [sum(1 << b for b in bits) for r in range(p.near + 1) for bits in combinations(range(width), r)]


def contaminated(docs: DataFrame, items: DataFrame, p: Decontamination = Decontamination()) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): per document and item the best window at the threshold or above.

    start and n_words place the window in the document's words; ties go to the earliest. A document shorter
    than an item is one window. An item of fewer than ``shingle_words`` words is one shingle: it is found where it stands
    word for word. Documents or items without words, with null text or null id take no
    part; repeated rows give one result; empty tables give an empty result. Extra columns are ignored.
    """
    k = p.shingle_words
    length = F.size("words")
    i = items.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("words")).where("item_id is not null and size(words) > 0").distinct()
    i = i.select("item_id", length.alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    i = stored(i.select("item_id", "n", shingle_hashes(F.col("h"), F.col("n"), k).alias("shingles"), simhash(F.col("h"), F.col("n")).alias("fp")), "items")
    # the lengths, less than k, of items that are one shingle of their own length: k - 1 numbers at most
    short = sorted(r.n for r in i.where(F.col("n") < k).select("n").distinct().collect())
    vocabulary = i.select(F.explode("shingles").alias("hash")).distinct()
    if vocabulary.count() <= BROADCAST_ROWS:
        vocabulary = F.broadcast(vocabulary)

    d = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    h = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    hashed = d.select("doc_id", h.alias("h"))

    def runs(n: int) -> DataFrame:
        rows = hashed.select("doc_id", F.size("h").alias("len"), shingle_hashes(F.col("h"), F.size("h"), n).alias("s"))
        # outer: an inner explode would have the optimiser test the array's size below the projections, once per word
        return rows.select("doc_id", "len", F.posexplode_outer("s").alias("pos", "hash"))

    places = runs(k)
    for n in short:  # a document's shingles have k words: shorter items are looked for by runs of their own length
        places = places.unionByName(runs(n))
    places = places.join(vocabulary, "hash", "left_semi")
    holders = i.select("n", F.explode("shingles").alias("hash")).distinct()
    places = places.join(holders, "hash")
    # windows of n words (the whole document, if shorter) that cover the shingle at pos
    size = F.least("n", "len")
    low, high = F.greatest(F.col("pos") + F.least(F.lit(k), size) - size, F.lit(0)), F.least("pos", F.col("len") - size)
    windows = places.select("doc_id", "n", F.explode(F.sequence(low, F.greatest(low, high))).alias("start")).distinct()
    windows = windows.groupBy("doc_id").agg(F.collect_list(F.struct("n", "start")).alias("w"))  # at most a few times the document's words

    at = windows.join(d, "doc_id").select("doc_id", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"), "w")
    at = at.select("doc_id", "h", F.explode("w").alias("w")).select("doc_id", F.col("w.n").alias("n"), F.col("w.start").alias("start"), F.slice("h", F.col("w.start") + 1, F.col("w.n")).alias("h"))
    at = at.withColumn("len", F.size("h")).withColumn("fp", simhash(F.col("h"), F.col("len")))
    # a window shorter than its item (a short document) has a fingerprint of its own length and is found within the radius too
    probe = at.where("len > 0").select("*", F.posexplode(_block_values(F.col("fp"), p)).alias("block", "value"))
    index = i.select("item_id", "n", "shingles", F.col("fp").alias("item_fp"), F.posexplode(_block_values(F.col("fp"), p)).alias("block", "v"))
    index = index.select("*", F.explode(F.array(*(F.col("v").bitwiseXOR(F.lit(f)) for f in _flips(p)))).alias("value")).drop("v")
    near = probe.join(index, ["n", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= p.radius)
    near = near.dropDuplicates(["doc_id", "start", "n", "item_id", "fp"])
    near = near.withColumn("own", shingle_hashes(F.col("h"), F.col("len"), k))
    near = near.select("doc_id", "item_id", "start", "len", weighted_jaccard(F.col("own"), F.col("shingles")).alias("similarity"))
    best = near.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("similarity", "start", "len"), F.struct("similarity", -F.col("start"))).alias("b"))
    best = best.where(F.col("b.similarity") >= p.threshold)
    return best.select("doc_id", "item_id", F.col("b.similarity").alias("similarity"), F.col("b.start").cast("long").alias("start"), F.col("b.len").cast("long").alias("n_words"))

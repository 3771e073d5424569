"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Every document draws the key ``-ln(u) / w``: an exponential variable whose rate is its quality
weight, so taking documents in key order is a weighted sample. A source's target is met by
complete epochs first; the rest takes documents in key order while the prefix sum of their words
comes nearer to the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import WORD

BUCKETS = 4096  # slices of the key range within which a source is sorted and summed
CYCLE = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) from the document id alone: the first 52 bits of an MD5 digest."""
    hexed = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(hexed, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, budget: float = 1.5, most: float = 2.0, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, weigh ``cycle`` in turn and share ``budget`` times all
    words. A target stops at ``most`` times its source; what it leaves goes to the others by weight.
    That ends at one level per unit of weight, read off the sources in the order in which they fill up.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int")).cast("double")
    s = sizes.select("source", "source_size").withColumn("w", weight).withColumn("cap", most * F.col("source_size"))
    s = s.withColumn("ratio", F.col("cap") / F.col("w"))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    filled = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = (budget * F.sum("source_size").over(everything) - filled) / open_
    s = s.withColumn("level", level).withColumn("full", F.col("ratio") <= F.col("level"))
    shared = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(shared * F.col("w")).alias("target"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, seed: str = "mix", budget: float = 1.5, most: float = 2.0, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per row of ``docs``.

    ``weights`` (doc_id, weight) holds positive quality weights; documents without one weigh 1.
    taken is how many of its words the mix reads: size times the number of times it is read, at most
    ``ceil(most)`` times. Null texts have size 0; a null source is a source of its own; rows that repeat a
    doc_id draw the same key and are summed one after the other; an empty table gives an empty
    result. Extra columns are ignored. The keys depend on doc_id and ``seed`` alone, so reruns agree.

    A source is summed in slices of its key range: slice totals are combined before the shuffle, and a
    source with a third of all rows is spread over ``BUCKETS`` groups.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    if weights is not None:
        w = weights.where("doc_id is not null and weight > 0").groupBy("doc_id").agg(F.avg("weight").alias("weight"))
        d = d.join(w, "doc_id", "left")
    else:
        d = d.withColumn("weight", F.lit(1.0))
    d = d.withColumn("key", -F.log(uniform(F.col("doc_id"), seed)) / F.coalesce("weight", F.lit(1.0))).drop("weight")
    d = d.withColumn("slice", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    # a null source keeps its own group through the joins below
    d = d.withColumn("sk", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))

    slices = d.groupBy("sk", "source", "slice").agg(F.sum("size").alias("words"))
    targets = source_targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), budget, most, cycle)
    targets = targets.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("sk"), "source_size", "target")
    before = F.coalesce(F.sum("words").over(Window.partitionBy("sk").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = slices.select("sk", "slice", before.alias("before")).join(targets, "sk")

    d = d.join(slices, ["sk", "slice"])
    order = Window.partitionBy("sk", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    total = F.col("before") + F.sum("size").over(order)
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    d = d.withColumn("total", total).withColumn("epochs", epochs)
    once_more = (2 * F.col("total") - F.col("size") <= 2 * rest).cast("long")
    return d.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + F.when(F.col("epochs") < most, once_more).otherwise(0))).alias("taken"))


def label_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """Quality weights from labels: ``good`` for quality 1, ``bad`` for 0."""
    return labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("quality") >= 1, good).otherwise(bad).alias("weight"))


SQL = r"""
WITH w AS (SELECT doc_id, avg(CASE WHEN quality >= 1 THEN 2.0 ELSE 0.5 END::DOUBLE) AS weight FROM labels
           WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
          / coalesce(weight, 1.0) AS key
      FROM documents LEFT JOIN w USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
        2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, cap / w AS ratio,
        (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
          / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, source_size, CASE WHEN ratio <= level THEN cap
        ELSE max(CASE WHEN ratio > level THEN level END) OVER () * w END AS target FROM l),
p AS (SELECT d.*, t.source_size, t.target, coalesce(floor(t.target / nullif(t.source_size, 0)), 0)::BIGINT AS epochs,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS total
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
  (size * (epochs + CASE WHEN epochs < 2 AND 2 * total - size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""

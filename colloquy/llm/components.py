"""Groups of linked items: connected components, and linking the members of candidate buckets.

Both run as joins and aggregations over edge tables; nothing about items,
links or groups reaches the driver but a yes or no per step.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import stored

SMALL_BUCKET = 32  # members; up to here a bucket's pairs are rows, beyond they are compared block by block
BLOCK = 256  # members per block


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b); component is the smallest reachable id.

    Alternates the large-star and small-star steps until the edges are stars.
    Each step takes one minimum per node (combined before the shuffle) and one
    equi-join that AQE can split on a hot node. Null ends and self-loops are ignored;
    an empty edge table gives an empty result.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        e = stored(e, "edges")
        ends = e.select("a").union(e.select(F.col("b").alias("a")).distinct())
        if ends.groupBy("a").count().where("count > 1").isEmpty():  # every edge leads from a leaf to its root
            break
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s"))
        e = small.select("s.*").where("a <> b").distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(e.select("b", "b").distinct())


def spanning(pairs: list[tuple[int, int]], labels: list[int]) -> list[tuple[int, int]]:
    """The pairs (positions) that join different groups, given each position's first label."""
    root = {x: x for x in labels}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in pairs:
        a, b = find(labels[i]), find(labels[j])
        if a != b:
            root[a] = b
            out.append((i, j))
    return out


def link_blocks(many: DataFrame, payload: Callable, compare: Callable) -> DataFrame:
    """Links (a, b) between members (key, id, component, n) of large buckets of n members, at most one per member and pair of blocks.

    A bucket is cut into blocks by a hash of the id, and every pair of its blocks is one task's group. See
    ``link_buckets`` for ``payload`` and ``compare``.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    many = many.select("key", "id", "component", blocks.alias("blocks")).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    wanted = many.select("id").distinct()
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = many.select("key", "id", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(payload(wanted), "id")

    def run(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        key, i, j = group
        same = i == j
        left = pdf[pdf.own == i].reset_index(drop=True)
        right = left if same else pdf[pdf.own == j].reset_index(drop=True)
        found = compare(key, left, right, same) if len(left) and len(right) else []
        found = spanning([(p, len(left) + q) for p, q in found], [*left.component, *right.component])
        ids = np.concatenate([left.id.to_numpy(np.int64), right.id.to_numpy(np.int64)])
        return pd.DataFrame({"a": [max(ids[p], ids[q]) for p, q in found], "b": [min(ids[p], ids[q]) for p, q in found]}, dtype="int64")

    return many.groupBy("key", "i", "j").applyInPandas(run, "a long, b long")


def link_buckets(members: DataFrame, verify: Callable, payload: Callable, compare: Callable) -> DataFrame:
    """(id, component) of the items linked through shared buckets; an item without a link has no row.

    ``members`` (key, id, no row twice) names every item's bucket keys. ``verify`` takes pairs (a, b)
    and returns those that are links; ``payload`` gives (id, more columns) for a table of ids; ``compare(key, left, right, same)`` gets two blocks
    of one bucket as pandas frames (id, component, payload columns; ``same`` if they are one
    block) and returns the linked positions. Two members of a bucket are compared unless
    they are known to be in one component, so no component is split:

    1. every member with one leader only, the smallest leader of its buckets: linear,
       and it gathers groups of copies;
    2. the members of buckets that still span several components: as pairs in buckets up
       to ``SMALL_BUCKET``, else in blocks that a task holds whole. Blocks return at most
       one link per member, never all pairs.
    """
    shared = members.groupBy("key").count().where("count > 1").select("key")
    members = stored(members.join(shared, "key", "left_semi"), "members")
    leaders = members.groupBy("key").agg(F.min("id").alias("leader"))
    first = members.join(leaders, "key").where("id <> leader").groupBy(F.col("id").alias("a")).agg(F.min("leader").alias("b"))
    links = stored(verify(first), "links")
    comp = stored(components(links), "components")

    now = members.select("key", "id").join(comp, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    per = now.groupBy("key", "component").agg(F.count("*").alias("n"))
    top = per.groupBy("key").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main"), F.sum("n").alias("n"), F.count("*").alias("parts"))
    open_ = stored(now.join(top.where("parts > 1"), "key"), "open")
    few = open_.where(F.col("n") <= SMALL_BUCKET).select("key", "id", "component", "main")
    x, y = few.where("component <> main").drop("main"), few.select("key", F.col("id").alias("other"), F.col("component").alias("c"))
    pairs = x.join(y, "key").where("component <> c").select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct()
    more = verify(pairs.join(first, ["a", "b"], "left_anti"))

    dense = link_blocks(open_.where(F.col("n") > SMALL_BUCKET).select("key", "id", "component", "n"), payload, compare)
    more = stored(more.union(dense), "links")
    return comp if more.isEmpty() else components(links.union(more))

"""Conversation prefix trie: every distinct beginning of a conversation is a node, and all are aggregated by ROLLUP.

A conversation's turns lie in blocks of ``WIDTH`` positional columns. One ``GROUP BY ... ROLLUP (t1, ..., t8)``, with
``grouping_id`` telling how many columns a row stands for, aggregates the prefixes of all lengths together; the blocks of long conversations
are rows of the same statement, keyed by the node that the block before ends in. A node's identity is a digest of its path, taken per row, so no block waits for another.

What a subtree holds is additive over its members too. A conversation is the smallest member from some depth on; its turns from
there on are the ones that it adds to the trie, and it stands for a leaf if it ends in one. A second ROLLUP sums these over the members of every node.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import record_batches, stored

WIDTH = 8  # turns per block, and grouping columns of the ROLLUP
CHUNK = 1 << 16  # characters of member ids per row on the way to their hash
TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]


def _digest(x: Column) -> Column:
    """The first half of SHA-256."""
    return F.substring(F.unhex(F.sha2(x, 256)), 1, 16)


def _joined(start: Column, turns: Column) -> Column:
    return F.aggregate(turns, start, lambda s, t: F.concat(s, t["key"]))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (key, bytes): a digest of role and text, and the text's size."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("bytes")).alias("t")
    )
    turns = F.sort_array(F.collect_list("t"))  # a null turn sorts first
    return rows.groupBy("conv_id").agg(F.transform(turns, lambda t: F.struct(t["key"].alias("key"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(own: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % family, then c's own after its first h; h = crc32(c) % heads."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    first = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    rows = own.select("*", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), h.alias("h")).join(first, "base", "left")
    none = F.slice("turns", 1, 0)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), none), rest).alias("turns"))


def blocks(conversations: DataFrame) -> DataFrame:
    """(conv_id, total, end, block, prior, before, t1, ...): a row per conversation and block of turns.

    ``prior`` is the node that the block before ends in, ``before`` the bytes up to there, ``end`` the conversation's
    own last node and ``total`` its bytes. A conversation without turns has one row without turns.
    """
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size("turns") / WIDTH).cast("int") - 1, F.lit(0))), lambda i: F.slice("turns", i * WIDTH + 1, F.lit(WIDTH)))
    start = F.struct(
        F.expr("cast(array() as array<struct<prior:binary,before:bigint,turns:array<struct<key:binary,bytes:bigint>>>>)").alias("done"), F.expr("X''").alias("node"), F.lit(0).cast("long").alias("bytes")
    )

    def step(s: Column, piece: Column) -> Column:
        return F.struct(
            F.array_append(s["done"], F.struct(s["node"].alias("prior"), s["bytes"].alias("before"), piece.alias("turns"))).alias("done"),
            F.when(F.size(piece) > 0, _digest(_joined(s["node"], piece))).otherwise(s["node"]).alias("node"),
            F.aggregate(piece, s["bytes"], lambda n, t: n + t["bytes"]).alias("bytes"),
        )

    rows = conversations.select("conv_id", F.aggregate(pieces, start, step).alias("walk"))
    rows = rows.select("conv_id", F.col("walk.bytes").alias("total"), F.col("walk.node").alias("end"), F.posexplode("walk.done").alias("block", "b"))
    return rows.select("conv_id", "total", "end", "block", "b.prior", "b.before", *[F.get("b.turns", F.lit(i)).alias(t) for i, t in enumerate(TURNS)])


def rolled_up(rows: DataFrame, aggregates: str) -> DataFrame:
    """(node, parent, depth, upto, aggregates) of every prefix; ``upto`` are the bytes ahead of the node's own turn."""
    turns = ", ".join(TURNS)
    found = rows.sparkSession.sql(
        f"""SELECT block, prior, before, array({turns}) AS path, {WIDTH} - bit_count(grouping_id() & {2**WIDTH - 1}) AS length, {aggregates}
            FROM {{rows}} GROUP BY block, prior, before, ROLLUP ({turns})""",
        rows=rows,
    )
    found = found.withColumn("path", F.filter("path", lambda t: t.isNotNull()))
    # shorter conversations fill the columns with nulls, which make no prefix of that length; a block's start is the end of the one before
    found = found.where("size(path) = length and (length > 0 or block = 0)")
    above = F.slice("path", F.lit(1), F.greatest(F.col("length") - 1, F.lit(0)))
    return found.select(
        F.when(F.col("length") > 0, _digest(_joined(F.col("prior"), F.col("path")))).otherwise(F.col("prior")).alias("node"),
        F.when(F.col("length") > 1, _digest(_joined(F.col("prior"), above))).when(F.col("length") == 1, F.col("prior")).alias("parent"),
        (F.col("block") * WIDTH + F.col("length")).cast("long").alias("depth"),
        (F.col("before") + F.aggregate(above, F.lit(0).cast("long"), lambda n, t: n + t["bytes"])).alias("upto"),
        *[c for c in found.columns if c not in ("block", "prior", "before", "path", "length")],
    )


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the comma-joined conv_ids that end in a node, ascending.

    Rows are sorted over all tasks by (node, conv_id), so a node with very many ends spans several tasks, each of which joins its own part; the
    parts, few rows, are then hashed one after the other. No task holds more than one part at a time.
    """
    parts = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    hashes = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def join(batches):
        def rows():
            node, ids, size = None, [], 0
            for b in batches:
                for n, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if ids and (n != node or size >= CHUNK):
                        yield node, ids[0], ",".join(map(str, ids))
                        ids, size = [], 0
                    node = n
                    ids.append(c)
                    size += 20
            if ids:
                yield node, ids[0], ",".join(map(str, ids))

        yield from record_batches(rows(), parts)

    def digest(batches):
        def rows():
            node, h = None, None
            for b in batches:
                for n, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                    if h is not None and n == node:
                        h.update(b",")
                    else:
                        if h is not None:
                            yield node, h.hexdigest()
                        node, h = n, hashlib.sha256()
                    h.update(ids.encode())
            if h is not None:
                yield node, h.hexdigest()

        yield from record_batches(rows(), hashes)

    joined = ends.select(F.col("end").alias("node"), "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = joined.mapInArrow(join, "node binary, first long, ids string").repartition("node").sortWithinPartitions("node", "first")
    return joined.mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """A row per node of the trie of the rebuilt conversations, see ``rebuilt``: (conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256), all but the hash long.

    ``conversations`` has conv_id, turn, role and text. A node's conv_id is its smallest member; with its depth it names
    the node. ``saved_tokens`` counts UTF-8 bytes of texts that a cache shared along the subtree need not read again.
    Rows go by turn, null first; rows of equal turn by the digest of role and text, so that repeated
    rows are turns of their own in a fixed order. A null role or text is empty. Rows with a null conv_id belong to no conversation and are
    left out. An empty table has no node; extra columns are ignored. A conversation is one value of 24 bytes a
    turn; long texts never leave their row.
    """
    rows = stored(blocks(rebuilt(ordered_turns(conversations), family, heads)), "blocks")
    nodes = stored(rolled_up(rows, "min(conv_id) AS conv_id, count(*) AS n_convs, sum(total) AS held"), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")

    # the depth from which a conversation is the smallest member, told by the bytes ahead of it, and whether it ends in a leaf
    own = nodes.groupBy("conv_id").agg(F.min_by("upto", "depth").alias("ahead"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    totals = rows.where("block = 0").select("conv_id", "total")
    own = stored(own.join(totals, "conv_id").select("conv_id", "total", (F.col("total") - F.col("ahead")).alias("added"), "leaf"), "own")
    sums = rolled_up(rows.drop("total").join(own, "conv_id"), "sum(added) AS added_below, sum(leaf) AS n_leaves").select("node", "added_below", "n_leaves")

    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, "node").join(ends_hashes(rows.where("block = 0").select("end", "conv_id")).withColumnRenamed("end", "node"), "node", "left")
    out = out.join(above, "parent", "left").join(own.select("conv_id", "total", "added"), "conv_id")
    distinct = F.col("added_below") - F.col("added") + F.col("total") - F.col("upto")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("held") - F.col("n_convs") * F.col("upto") - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


#: Brute force: every prefix as a list of turns, subtrees by the prefixes of each node's path.
SQL = r"""
WITH t AS (SELECT conv_id, turn, {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS v FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(v ORDER BY turn NULLS FIRST, sha256(strlen(v.r)::VARCHAR || ':' || v.r || v.x)) AS s FROM t GROUP BY conv_id),
h AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda c: [256::BIGINT + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: CASE WHEN e >= 256 THEN xor(a, e - 256) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) % 9 AS h FROM own),
c AS (SELECT h.conv_id, list_concat(coalesce(b.s, [])[1:h.h], h.s[h.h + 1:]) AS s FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, unnest(generate_series(0, len(s))) AS d, s FROM c),
n AS (SELECT d, s[1:d] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '')) AS ends_sha256 FROM p GROUP BY ALL),
k AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.d > 0 THEN (n_convs - 1) * strlen(n.path[n.d].x) ELSE 0 END AS saved
    FROM n LEFT JOIN k ON k.d = n.d AND k.path = n.path),
u AS (SELECT path AS below, n_children, saved, unnest(generate_series(0, d)) AS d FROM m),
b AS (SELECT d, below[1:d] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM u GROUP BY ALL)
SELECT m.conv_id, m.d AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, b.n_leaves::BIGINT AS n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM m JOIN b ON b.d = m.d AND b.path = m.path LEFT JOIN n q ON q.d = m.d - 1 AND q.path = m.path[1:m.d - 1]
"""

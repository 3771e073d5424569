"""Suffix-array dedup of bytes: what a window of ``size`` bytes repeats from an earlier place is removed.

1. Every window belongs to an anchor (``anchors``), and equal windows have anchors of one hash. Stretches of windows whose
   anchor's hash stands once in the corpus are dropped.
2. Equal stretches of one hash are a class: all but the first place of each are repeats as a whole.
3. The first places of a hash's classes, a few texts of little more than ``size`` bytes, form a group. A group's suffix array (``suffixes``)
   brings equal windows together; the earliest of each run of equal ones stays. Groups of more than ``GROUP`` classes, such as a phrase that very
   many documents continue differently, are first split: windows that start in one half of the anchor's reach share more bytes, which
   are part of the halves' keys. After at most seven halvings a key is a whole window and its group one class.
4. Per document, the repeats' bytes are cut out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.anchors import SEED, stretches
from colloquy.llm.common import parts, record_batches, signed, stored
from colloquy.llm.suffixes import suffix_arrays

GROUP = 64  # classes whose suffix array is built at once
BATCH = 1 << 20  # bytes of groups that advance together
_BITS = 10  # of the distances packed with a place


def _packed(low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
    """One long, ordered by ``low``."""
    return (low << (2 * _BITS)) | ((high - low) << _BITS) | (place - low)


_LOW = f"shiftright(packed, {2 * _BITS})"
_HIGH = f"{_LOW} + (shiftright(packed, {_BITS}) & {(1 << _BITS) - 1})"


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each ends (a null is empty)."""
    a = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def _stretches(texts: DataFrame, size: int, whole: bool) -> DataFrame:
    """(hash) of every stretch of windows, or (hash, class, doc_id, copy, packed) if ``whole``."""

    def run(batches):
        for part in parts(batches):
            data, ends = _bytes_of(part.column(2))
            begins = np.concatenate([[0], ends[:-1]])
            for place, low, high, seed, stretch in stretches(data, ends, size):
                out = {"hash": signed(seed)}
                if whole:
                    row = np.searchsorted(ends, low, "right")
                    out["class"] = signed(stretch)
                    out["doc_id"], out["copy"] = part.column(0).to_numpy()[row], part.column(1).to_numpy()[row]
                    out["packed"] = _packed(low - begins[row], high - begins[row], place - begins[row])
                yield pa.RecordBatch.from_pydict(out)

    return texts.mapInArrow(run, "hash long, class long, doc_id long, copy long, packed long" if whole else "hash long")


def _cut(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(key, doc_id, copy, place, low, bytes): the bytes of the wanted stretches (hash, doc_id, copy, packed)."""
    lists = wanted.groupBy("doc_id", "copy").agg(F.collect_list("hash").alias("hashes"), F.collect_list("packed").alias("places"))
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int64()), ("place", pa.int64()), ("low", pa.int64()), ("bytes", pa.binary())])
    mask = (1 << _BITS) - 1

    def run(batches):
        def rows():
            for b in batches:
                for doc, copy, text, hashes, places in zip(*(b.column(i) for i in range(5)), strict=True):
                    text, doc, copy = text.as_py(), doc.as_py(), copy.as_py()
                    for key, p in zip(hashes.as_py(), places.as_py(), strict=True):
                        low = p >> (2 * _BITS)
                        yield key, doc, copy, low + (p & mask), low, text[low : low + (p >> _BITS & mask) + size]

        yield from record_batches(rows(), schema)

    return texts.join(lists, ["doc_id", "copy"]).select("doc_id", "copy", "text", "hashes", "places").mapInArrow(run, "key long, doc_id long, copy long, place long, low long, bytes binary")


def _solve(groups: list[list[tuple]], size: int):
    """(doc_id, copy, low, high) window starts that repeat an earlier one of their group; rows are (doc_id, copy, low, bytes)."""
    rows = [r for g in groups for r in g]
    lengths = np.array([len(r[3]) + 1 for r in rows], np.int64)
    begins = np.cumsum(lengths) - lengths
    counts = np.array([len(g) for g in groups], np.int64)
    firsts = np.cumsum(counts) - counts
    data = np.frombuffer(b"\0".join(r[3] for r in rows) + b"\0", np.uint8)
    text = data.astype(np.int16) + 2
    text[begins + lengths - 1] = 1  # between a group's texts; its last one ends the group
    text[(begins + lengths - 1)[firsts + counts - 1]] = 0
    order = suffix_arrays(text, begins[firsts])
    owner = np.repeat(np.arange(len(rows)), lengths)
    windows = np.arange(len(text)) + size < (begins + lengths)[owner]
    order = order[windows[order]]
    if len(order) < 2:
        return
    new = np.ones(len(order), bool)
    view = np.lib.stride_tricks.sliding_window_view(data, size)
    for i in range(1, len(order), 1 << 17):
        part = view[order[i - 1 : i + (1 << 17)]]
        new[i : i + (1 << 17)] = (part[1:] != part[:-1]).any(1)
    group = np.repeat(np.arange(len(groups)), counts)[owner[order]]
    new[1:] |= group[1:] != group[:-1]
    run = np.cumsum(new)
    row = owner[order]
    doc, copy, low = (np.array([r[i] for r in rows], np.int64)[row] for i in range(3))
    start = low + order - begins[row]
    by = np.lexsort((start, copy, doc, run))
    repeats = np.zeros(len(text) + 1, bool)
    repeats[order[by][~np.diff(run[by], prepend=0).astype(bool)]] = True
    edges = np.flatnonzero(np.diff(repeats.astype(np.int8), prepend=0))
    for a, z in zip(edges[::2], edges[1::2], strict=True):
        r = owner[a]
        yield rows[r][0], rows[r][1], int(rows[r][2] + a - begins[r]), int(rows[r][2] + z - 1 - begins[r])


_MARK = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_MARKS = "doc_id long, copy long, low long, high long"


def _repeats(stretches: DataFrame, size: int) -> DataFrame:
    """(doc_id, copy, low, high) of the repeated windows in groups (key) of at most ``GROUP`` stretches."""

    def run(batches):
        def rows():
            key, group, batch, n = None, [], [], 0
            for b in batches:
                for k, *row in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                    if k != key:
                        if len(group) > 1:
                            batch.append(group)
                            n += sum(len(r[3]) for r in group)
                        if n >= BATCH:
                            yield from _solve(batch, size)
                            batch, n = [], 0
                        key, group = k, []
                    group.append(tuple(row))
            if len(group) > 1:
                batch.append(group)
            if batch:
                yield from _solve(batch, size)

        yield from record_batches(rows(), _MARK)

    return stretches.select("key", "doc_id", "copy", "low", "bytes").repartition("key").sortWithinPartitions("key").mapInArrow(run, _MARKS)


def _halves(hot: DataFrame, size: int) -> DataFrame:
    """Stretches of large groups, cut to the windows that start in either half of the range ``first`` ... ``last`` before the anchor."""
    middle = F.floor((F.col("first") + F.col("last")) / 2).cast("int")
    halves = F.explode(F.array(F.struct(F.col("first").alias("f"), middle.alias("l")), F.struct((middle + 1).alias("f"), F.col("last").alias("l"))))
    rows = hot.select("*", halves.alias("half")).drop("first", "last")
    high = F.col("low") + F.octet_length("bytes") - size
    rows = rows.select("*", F.greatest("low", F.col("place") + F.col("half.f")).alias("from"), F.least(high, F.col("place") + F.col("half.l")).alias("to")).where("half.f <= half.l and `from` <= `to`")
    # bytes that all windows of the half hold: from the last start to the first end
    shared = F.col("bytes").substr((F.col("place") + F.col("half.l") - F.col("low") + 1).cast("int"), (F.col("half.f") - F.col("half.l") + size).cast("int"))
    return rows.select(
        F.xxhash64("key", "half.l", shared).alias("key"),
        "doc_id",
        "copy",
        "place",
        F.col("from").alias("low"),
        F.col("bytes").substr((F.col("from") - F.col("low") + 1).cast("int"), (F.col("to") - F.col("from") + size).cast("int")).alias("bytes"),
        F.col("half.f").alias("first"),
        F.col("half.l").alias("last"),
    )


def _same_first(a: Column, b: Column) -> Column:
    return (a["doc_id"] == b["doc_id"]) & (a["copy"] == b["copy"]) & (a["at"] == b["at"])


def repeated_windows(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, copy, low, high): starts of windows of (doc_id, copy, text) whose bytes also start at an earlier place."""
    # a table, not an aggregation that the join reads through: the join then can split a hash that very many stretches share
    often = stored(_stretches(texts, size, False).groupBy("hash").count().where("count > 1").select("hash"), "hashes")
    spans = stored(_stretches(texts, size, True).join(often, "hash", "left_semi"), "stretches")
    place = F.struct("doc_id", "copy", F.col("packed").alias("at"))
    classes = stored(spans.groupBy("hash", "class").agg(F.min(place).alias("earliest"), F.count("*").alias("n")), "classes")
    copies = spans.join(classes.where("n > 1").select("hash", "class", "earliest"), ["hash", "class"]).where(~_same_first(place, F.col("earliest")))
    marks = [copies.select("doc_id", "copy", F.expr(_LOW).alias("low"), F.expr(_HIGH).alias("high"))]

    several = classes.groupBy("hash").count().where("count > 1").select("hash")
    wanted = classes.join(several, "hash", "left_semi").select("hash", "earliest.doc_id", "earliest.copy", F.col("earliest.at").alias("packed"))
    todo = _cut(texts, wanted, size).withColumns({"first": F.lit(SEED - size), "last": F.lit(0)})
    todo = stored(todo, "todo")
    while True:
        large = stored(todo.groupBy("key").count().where(F.col("count") > GROUP).select("key"), "large")
        marks.append(_repeats(todo.join(large, "key", "left_anti"), size))
        if large.isEmpty():
            break
        halves = stored(_halves(todo.join(large, "key", "left_semi"), size), "halves")
        halves = halves.select("*", (F.col("place") - F.col("low")).alias("apart"), F.struct("doc_id", "copy", F.col("low").alias("at")).alias("own"))
        firsts = halves.groupBy("key", "apart", "bytes").agg(F.min("own").alias("earliest"), F.min("first").alias("first"), F.min("last").alias("last"), F.count("*").alias("n"))
        firsts = stored(firsts, "firsts")
        copies = halves.select("key", "apart", "bytes", "own").join(firsts.where("n > 1").select("key", "apart", "bytes", "earliest"), ["key", "apart", "bytes"]).where(~_same_first(F.col("own"), F.col("earliest")))
        marks.append(copies.select("own.doc_id", "own.copy", F.col("own.at").alias("low"), (F.col("own.at") + F.octet_length("bytes") - size).alias("high")))
        todo = firsts.select("key", "earliest.doc_id", "earliest.copy", (F.col("earliest.at") + F.col("apart")).alias("place"), F.col("earliest.at").alias("low"), "bytes", "first", "last")
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out


def remove_repeated_bytes(docs: DataFrame, size: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row of ``docs`` (doc_id, text): the text's UTF-8 bytes without every byte
    covered by a string of ``size`` bytes that also starts earlier: in a row of smaller doc_id, or earlier in the same text.

    Repeats are judged on the input. ``n_spans`` counts the maximal removed runs; ``kept`` (binary) is what is left, joined, and may end inside a
    character. A null text is empty. Equal rows are one document and come out alike; different texts
    of one doc_id are documents ordered by a hash of the text. A row without doc_id is
    returned whole and hides nothing in others. An empty table gives an empty result; extra columns are ignored. A text is
    one value; work on it goes by pieces of a million bytes.
    """
    if not SEED * 2 <= size <= SEED + (1 << _BITS) - 1:
        raise ValueError(f"size must be {SEED * 2} to {SEED + (1 << _BITS) - 1}")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    # documents are named by doc_id; only where ids repeat does a hash of the text belong to the name
    twice = not rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    rows = rows.select("doc_id", (F.xxhash64("text") if twice else F.lit(0).cast("long")).alias("copy"), "text")
    texts = rows.where(f"doc_id is not null and octet_length(text) >= {size}")
    texts = texts.dropDuplicates(["doc_id", "copy"]) if twice else texts
    lists = repeated_windows(texts, size).groupBy("doc_id", "copy").agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches):
        def kept():
            for b in batches:
                for doc, text, low, high in zip(*(b.column(i) for i in range(4)), strict=True):
                    text, doc = text.as_py(), doc.as_py()
                    if not low.is_valid:
                        yield doc, len(text), 0, 0, text
                        continue
                    low, high = low.values.to_numpy(), high.values.to_numpy() + size
                    by = np.argsort(low, kind="stable")
                    low, reach = low[by], np.maximum.accumulate(high[by])
                    new = np.ones(len(low), bool)
                    new[1:] = low[1:] > reach[:-1]
                    begin = low[new].tolist()
                    stop = reach[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)].tolist()
                    left = b"".join(text[i:j] for i, j in zip([0, *stop], [*begin, len(text)], strict=True))
                    yield doc, len(text), len(text) - len(left), len(begin), left

        yield from record_batches(kept(), schema, 512)

    joined = rows.join(lists, ["doc_id", "copy"], "left").select("doc_id", "text", "low", "high")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


#: Brute force over the hexadecimal bytes: every window's text, the earliest of equal ones, gaps and islands of the others.
SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT doc_id, b, substr(x, 2 * b + 1, 1198) AS y  -- pieces of 500 windows
      FROM (SELECT doc_id, x, unnest(generate_series(0, strlen(x) // 2 - 100, 500)) AS b FROM d WHERE strlen(x) >= 200)),
p AS (SELECT doc_id, b, y, unnest(generate_series(0, strlen(y) // 2 - 100)) AS j FROM c),
w AS (SELECT doc_id, b + j AS i, sha256(substr(y, 2 * j + 1, 200)) AS k FROM p),
m AS (SELECT k, min({'doc': doc_id, 'i': i}) AS earliest FROM w GROUP BY k HAVING count(*) > 1),
r AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS new
      FROM w JOIN m ON m.k = w.k WHERE (doc_id, i) <> (earliest.doc, earliest.i)),
n AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM r),
s AS (SELECT doc_id, min(i) AS low, max(i) + 100 AS high FROM n GROUP BY doc_id, span),
l AS (SELECT doc_id, list(low ORDER BY low) AS low, list(high ORDER BY low) AS high, sum(high - low) AS n_removed, count(*) AS n_spans FROM s GROUP BY doc_id)
SELECT d.doc_id, strlen(x) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE array_to_string(list_transform(generate_series(0, n_spans),
    lambda j: substr(x, CASE WHEN j = 0 THEN 1 ELSE 2 * high[j] + 1 END, 2 * (CASE WHEN j = n_spans THEN strlen(x) // 2 ELSE low[j + 1] END - CASE WHEN j = 0 THEN 0 ELSE high[j] END))), '') END)) AS kept_sha256
FROM d LEFT JOIN l ON l.doc_id = d.doc_id
"""

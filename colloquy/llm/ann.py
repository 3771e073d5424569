"""Approximate nearest neighbours by inner product over balanced posting lists.

Centroids come from size-penalised k-means on a bounded sample; a neighbour graph over them, held in memory, finds
the centroids near a vector. Every vector goes to the posting list of its nearest centroid and, near
a boundary, to those of other centroids almost as near (unless a chosen one is nearer to them). A query reads
the lists whose centroids are within a ratio of the nearest one's distance, and every vector read is
scored exactly; a list returns those alone that reach the score of the k-th nearest in the sample. A query whose lists
gave too few, or left out a vector of the sample that belongs among those they gave, reads further lists.

Equal vectors are one entry that carries its smallest ids, so a vector with very many copies
costs one comparison. Lists and the queries that read them are cut into blocks of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import Shared, stored


@dataclass(frozen=True)
class AnnIndex:
    """Parameters. ``sample`` bounds the vectors that centroids are fitted on; every vector is indexed."""

    sample: int = 16_384
    list_size: int = 256  # vectors per list aimed at
    most_lists: int = 4_096  # bounds what is broadcast; beyond, lists get longer and are read in blocks
    iterations: int = 8
    penalty: float = 0.3  # of the mean distance, for a cluster of twice the mean size
    neighbours: int = 16
    width: int = 32  # centroids that the graph search keeps
    copies: int = 4  # lists per vector at most
    boundary: float = 0.05  # a vector joins lists up to (1 + boundary) times its nearest centroid's distance
    reach: float = 0.22  # a query reads lists up to (1 + reach) times its nearest centroid's distance (or the usual one, if larger)
    least: int = 10  # and at least lists that hold this many times k vectors
    block: int = 2_048
    seed: int = 5


BLOCK = 1_024  # sample vectors whose distances to all centroids are held at once: 34 MB beside 4,096 of them


def _distances(x: np.ndarray, c: np.ndarray):
    """Squared distances to all centroids, a block of vectors at a time."""
    norm = (c * c).sum(1)[None, :]
    for i in range(0, len(x), BLOCK):
        part = x[i : i + BLOCK]
        yield np.maximum((part * part).sum(1)[:, None] - 2 * part @ c.T + norm, 0)


def fit_centroids(x: np.ndarray, k: int, p: AnnIndex) -> tuple[np.ndarray, float]:
    """k-means whose assignment adds a penalty for large clusters, so that lists come out balanced; and the median distance to them.

    The lifted vectors lie on a sphere, and so do the centroids: means inside it would draw nearly everything."""
    rng = np.random.default_rng(p.seed)
    norm = np.sqrt((x * x).sum(1).max())
    c = x[rng.permutation(len(x))[:k]].copy()
    size = np.full(k, len(x) / k)
    for _ in range(p.iterations):
        usual = sum(d.min(1).sum() for d in _distances(x, c)) / len(x)
        load = p.penalty * usual * np.maximum(size * k / len(x) - 1, 0)[None, :]
        own = np.concatenate([(d + load).argmin(1) for d in _distances(x, c)])
        size = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        empty = size == 0
        c[~empty] = total[~empty] / size[~empty, None]
        c[empty] = x[rng.integers(0, len(x), int(empty.sum()))]
        c *= norm / np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-12)
    return c, float(np.median(np.sqrt(np.concatenate([d.min(1) for d in _distances(x, c)]))))


class CentroidGraph:
    """Centroids with links to their nearest ones and a few random ones, searched best-first for many vectors at once."""

    def __init__(self, centroids: np.ndarray, usual: float, p: AnnIndex):
        self.c, self.width = centroids, min(p.width, len(centroids))
        k = len(centroids)
        rng = np.random.default_rng(p.seed)
        links = min(p.neighbours, k)
        near = np.empty((k, links), np.int32)
        norm = (centroids**2).sum(1)
        for i in range(0, k, 512):
            d = norm[None, :] - 2 * centroids[i : i + 512] @ centroids.T
            near[i : i + 512] = np.argpartition(d, links - 1, axis=1)[:, :links]
        self.links = np.concatenate([near, rng.integers(0, k, (k, 4), dtype=np.int32)], axis=1)
        self.entry = rng.permutation(k)[: self.width].astype(np.int32)
        self.norm = norm
        self.usual = usual

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) per row of x, nearest first, at most ``width``; missing ones are -1 and inf."""
        n, w = len(x), self.width
        sq = (x * x).sum(1)
        ids = np.tile(self.entry, (n, 1))
        dist = sq[:, None] + self.norm[self.entry][None, :] - 2 * x @ self.c[self.entry].T
        done = np.zeros((n, w), bool)
        rows = np.arange(n)
        for _ in range(2 * w):
            at = np.where(done, np.inf, dist).argmin(1)
            live = ~done[rows, at] & (ids[rows, at] >= 0)
            if not live.any():
                break
            r = rows[live]
            done[r, at[live]] = True
            new = self.links[ids[r, at[live]]]
            d = sq[r, None] + self.norm[new] - 2 * np.einsum("nkd,nd->nk", self.c[new], x[r])
            ids2, dist2 = np.concatenate([ids[r], new], 1), np.concatenate([dist[r], d], 1)
            done2 = np.concatenate([done[r], np.zeros_like(new, bool)], 1)
            # one entry per centroid, the visited one first
            order = np.lexsort((~done2, ids2))
            same = np.take_along_axis(ids2, order, 1)
            dup = np.zeros_like(same, bool)
            dup[:, 1:] = same[:, 1:] == same[:, :-1]
            np.put_along_axis(dist2, order, np.where(dup, np.inf, np.take_along_axis(dist2, order, 1)), 1)
            np.put_along_axis(ids2, order, np.where(dup, -1, same), 1)
            best = np.argsort(dist2, axis=1, kind="stable")[:, :w]
            ids[r], dist[r], done[r] = (np.take_along_axis(m, best, 1) for m in (ids2, dist2, done2))
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.sqrt(np.maximum(np.take_along_axis(dist, order, 1), 0))


def choose_lists(x: np.ndarray, graph: CentroidGraph, p: AnnIndex) -> list[list[int]]:
    """The lists that hold each vector: its nearest centroid's, and others within the boundary ratio that no chosen centroid is nearer to."""
    ids, dist = graph.search(x)
    out = []
    for row, d in zip(ids, dist, strict=True):
        chosen: list[int] = []
        for c, dc in zip(row, d, strict=True):
            if c < 0 or len(chosen) >= p.copies or (chosen and dc > (1 + p.boundary) * d[0]):
                break
            if all(((graph.c[c] - graph.c[o]) ** 2).sum() > dc * dc for o in chosen):
                chosen.append(int(c))
        out.append(chosen)
    return out


def probe_lists(x: np.ndarray, graph: CentroidGraph, p: AnnIndex, sizes: np.ndarray, k: int, times: int = 1) -> list[list[int]]:
    """The lists that each query reads: all within the reach ratio of the distance to its nearest centroid, nearest first.

    A query on top of a centroid takes the usual distance of a vector to its centroid instead. Where the
    graph search's result ends within reach, or its lists hold too few vectors, every centroid is looked at; so it is
    for ``times`` as many lists.
    """
    ids, dist = graph.search(x)
    out = []
    for v, row, d in zip(x, ids, dist, strict=True):
        limit = (1 + p.reach) * max(d[0], graph.usual)
        row, d = row[row >= 0], d[row >= 0]
        if (times > 1 or d[-1] <= limit or sizes[row].sum() < p.least * k) and len(d) < len(graph.c):
            d = np.sqrt(np.maximum(((graph.c - v) ** 2).sum(1), 0))
            row = np.argsort(d, kind="stable")
            d = d[row]
        enough = np.searchsorted(np.cumsum(sizes[row]), p.least * k) + 1
        out.append(row[: times * max(enough, int(np.searchsorted(d, limit, "right")))].tolist())
    return out


def _usable(embedding: Column) -> Column:
    v = embedding.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, p: AnnIndex = AnnIndex()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors found with the largest inner product for every query row.

    ``vectors`` has vec_id and embedding; ``is_query`` marks the query rows, each of which is compared with every row
    but those of its own id. Ranks go by score, then by vec_id. Rows whose id or vector is null, or
    whose vector is zero, holds a null or non-finite component or has another length than
    most, take no part. Repeated rows of an id and vector are one. An empty table gives an empty result; extra columns are
    ignored. The inner product of the original vectors is summed in double precision.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), is_query.alias("q"))
    v = v.where(F.col("vec_id").isNotNull() & _usable(F.col("v"))).withColumn("h", F.xxhash64("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    shapes = v.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("top"), F.min("vec_id")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim, n, top = (shapes[0].dim, shapes[0].n, shapes[0].top) if shapes else (1, 1, 1.0)
    v = v.where(F.size("v") == dim)

    # classes of equal vectors with the ids that can be among the k nearest of anything: k + 1, as a query leaves itself out
    ids = v.select("h", "v", "vec_id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    classes = ids.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("rep", F.element_at("ids", 1))
    classes = stored(classes, "vectors")
    queries = v.where(F.coalesce("q", F.lit(False))).select("vec_id", "h", "v").distinct()
    queries = stored(queries.join(classes.select("h", "v", "rep"), ["h", "v"]).select(F.col("vec_id").alias("query_id"), "rep"), "queries")
    asked = classes.join(queries.select("rep").distinct(), "rep", "left_semi")

    drawn = classes.orderBy(F.xxhash64("rep", F.lit(p.seed)), "rep").select("rep", "v").limit(p.sample).collect()
    sample = np.array([r.v for r in drawn], np.float64).reshape(len(drawn), dim)
    lift = lambda x: np.concatenate([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))[:, None]], 1)  # noqa: E731  largest product = smallest distance
    lists = max(1, min(p.most_lists, len(sample), round(n / p.list_size)))
    graph = CentroidGraph(*fit_centroids(lift(sample), lists, p), p) if len(sample) else None
    shared = Shared(vectors.sparkSession, graph)  # most_lists centroids at most

    seen = vectors.sparkSession.sparkContext.broadcast((np.array([r.rep for r in drawn], np.int64), sample))

    def floor(q: np.ndarray) -> np.ndarray:
        """A score that k + 1 vectors of the sample reach: what scores less is not among the k nearest."""
        _, x = seen.value
        if len(x) <= k:
            return np.full(len(q), -np.inf)
        return np.concatenate([np.partition(q[i : i + 64] @ x.T, -k - 1, axis=1)[:, -k - 1] for i in range(0, len(q), 64)]) - 1e-9

    def in_sample(batches):
        """The nearest of the sample: what the lists' hits are held against, never hits themselves."""
        rep, x = seen.value
        for pdf in batches:
            out = []
            for q in pdf.v:
                s = (x * np.asarray(q)).sum(1)
                near = np.argpartition(-s, k)[: k + 1] if len(s) > k + 1 else np.arange(len(s))
                out.append([{"rep": int(rep[i]), "score": float(s[i])} for i in near])
            yield pd.DataFrame({"query": pdf.rep.to_numpy(), "known": out})

    def spread(rows: DataFrame, choose, flat: bool) -> DataFrame:
        def run(batches):
            for pdf in batches:
                for i in range(0, len(pdf), 1024):
                    part = pdf.iloc[i : i + 1024]
                    x = np.array(part.v.tolist(), np.float64)
                    least = floor(x) if flat else 0.0
                    x = np.concatenate([x, np.zeros((len(x), 1))], 1) if flat else lift(x)
                    found = choose(x, shared.value, p)
                    yield pd.DataFrame({"list": found, "rep": part.rep.to_numpy(), "v": part.v.to_numpy(), "least": least}).explode("list").astype({"list": "int64"})

        return rows.select("rep", "v").mapInPandas(run, "list long, rep long, v array<double>, least double")

    posts = stored(spread(classes, choose_lists, False), "posts")
    sizes = np.zeros(lists, np.int64)
    for r in posts.groupBy("list").count().collect():  # most_lists rows at most
        sizes[r["list"]] = r["count"]
    count = lambda d, name: d.groupBy("list").agg(F.ceil(F.count("*") / p.block).cast("int").alias(name))
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    def score(entries: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(asks):
            return pd.DataFrame({"query": [], "rep": [], "score": []})
        entries = entries.sort_values("rep", kind="stable")
        x, rep = np.array(entries.v.tolist(), np.float64), entries.rep.to_numpy()
        out = []
        for ask, q, least in zip(asks.rep, asks.v, asks.least, strict=True):
            s = (x * np.asarray(q)).sum(1)
            near = np.flatnonzero(s >= least)
            best = near[np.argsort(-s[near], kind="stable")[: k + 1]]
            out.append(pd.DataFrame({"query": ask, "rep": rep[best], "score": s[best]}))
        return pd.concat(out)

    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")

    def read_lists(asked: DataFrame, times: int) -> DataFrame:
        """(query, rep, score): the k + 1 best entries of the lists that each query reads."""
        probes = stored(spread(asked, partial(probe_lists, sizes=sizes, k=k, times=times), True), "probes")
        blocks = count(posts, "pb").join(count(probes, "qb"), "list")  # a row per list
        left = posts.join(blocks, "list").select("list", own("pb").alias("i"), every("qb").alias("j"), "rep", "v")
        right = probes.join(blocks, "list").select("list", every("pb").alias("i"), own("qb").alias("j"), "rep", "v", "least")
        hits = left.groupBy("list", "i", "j").cogroup(right.groupBy("list", "i", "j")).applyInPandas(score, "query long, rep long, score double")
        hits = hits.groupBy("query", "rep").agg(F.max("score").alias("score"))
        return stored(hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"), "hits")

    known = stored(asked.select("rep", "v").mapInPandas(in_sample, "query long, known array<struct<rep:long,score:double>>"), "known")
    need = min(k + 1, len(sample))  # the sample is all there is, or holds as many
    hits, times = read_lists(asked, 1), 1
    while times < lists:
        found = hits.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("low"), F.collect_list("rep").alias("reps"))
        left_out = F.exists("known", lambda x: (x["score"] > F.col("low") + 1e-9) & ~F.array_contains("reps", x["rep"]))
        short = known.join(found, "query", "left").where((F.coalesce("n", F.lit(0)) < need) | left_out).select("query")
        short = stored(short, "short")
        if short.isEmpty():
            break
        times *= 4
        more = read_lists(asked.join(short.withColumnRenamed("query", "rep"), "rep", "left_semi"), times)
        hits = stored(hits.join(short, "query", "left_anti").union(more), "hits")
    hits = hits.join(classes.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1)
    hits = hits.groupBy(F.col("query").alias("rep")).agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
    out = queries.join(hits, "rep").withColumn("found", F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k))
    return out.select("query_id", F.posexplode("found").alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))

"""Nearest neighbours by cosine over balanced posting lists.

Centroids are fitted on a bounded sample so that lists get about equal shares. Every vector goes to
its nearest list, and one near a boundary to the next ones too. The centroids are searched through an
in-memory neighbour graph, for vectors to place as for queries; a query reads the lists whose centroid
is not much farther than the nearest one. Lists are packed in blocks of bounded size, so a list that
holds a large share of all vectors is many blocks. Vectors that are equal are one entry with as many
ids as a result can need.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.llm.common import by_batch
from millrace.storage import saved

#: Vectors of a list on average, lists at most, sampled vectors for a list and in all.
LIST_ROWS, MAX_LISTS, SAMPLE_PER_LIST, MAX_SAMPLE = 512, 65_536, 40, 131_072
#: Components of all sampled vectors at most (128 MB on the driver), and of a block of distances.
MAX_SAMPLE_VALUES, BLOCK_VALUES = 1 << 24, 1 << 23
#: Lists of a vector at most, and how much farther than the nearest centroid they may be.
REPLICAS, REPLICA_RATIO = 6, 1.08
#: Graph: nearest links, long links, entry points, nodes opened in a step.
LINKS, LONG_LINKS, ENTRIES, OPENED = 16, 4, 8, 4
#: Vectors and queries of a block, and how far a product of unit rows may be from the cosine of the original ones.
BLOCK, ROUNDING = 1024, 1e-9
#: Share of the sampled neighbours that the lists within the calibrated ratio must hold.
REACHED = 0.985
TRIALS = 200
#: Different vectors of a less common length from which it has an index of its own, and lengths that have one at most.
DIRECT, MOST_LENGTHS = 4096, 64


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision, safe for very large and very small components."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; powers of two are taken out first, which changes no digit and keeps sums in range."""
    even = lambda x: np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    a, b = even(a.astype(np.float64)), even(b.astype(np.float64))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def fitted(sample: np.ndarray, n_lists: int, seed: int = 7, turns: int = 8) -> np.ndarray:
    """Centroids of about equally filled lists: k-means whose distances rise with a list's share."""
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), n_lists, replace=False)]
    fill, size = np.ones(n_lists), max(1, BLOCK_VALUES // n_lists)
    for _ in range(turns):
        at = np.concatenate([(2 - 2 * sample[i : i + size] @ found.T + 0.05 * fill).argmin(axis=1) for i in range(0, len(sample), size)])
        counts = np.bincount(at, minlength=n_lists)
        sums = np.zeros_like(found)
        np.add.at(sums, at, sample)
        empty = (counts == 0) | (np.abs(sums).max(axis=1) < 1e-12)
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        found, fill = unit(sums), 0.5 * fill + 0.5 * counts * n_lists / len(sample)
    return found


class Graph:
    """Centroids with links to their nearest and to some far ones."""

    def __init__(self, centroids: np.ndarray, seed: int = 11):
        n = len(centroids)
        self.centroids = centroids
        size = max(1, BLOCK_VALUES // n)
        near = [np.argsort(-(centroids[i : i + size] @ centroids.T), axis=1, kind="stable")[:, 1 : LINKS + 1] for i in range(0, n, size)]
        rng = np.random.default_rng(seed)
        self.links = np.concatenate([np.concatenate(near), rng.integers(0, n, (n, LONG_LINKS))], axis=1)
        self.entries = np.unique(rng.integers(0, n, ENTRIES))

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest ``width`` centroids found and their distances, nearest first, for each query (unit rows)."""
        n, width = len(self.centroids), min(width, len(self.centroids))
        rows = np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), n + 1), bool)
        ids = np.tile(self.entries, (len(queries), 1))
        seen[rows, ids] = True
        far = self.distances(queries, ids)
        opened = np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(far, axis=1, kind="stable")[:, : width + OPENED]
            ids, far, opened = ids[rows, order], far[rows, order], opened[rows, order]
            waiting = np.where(opened | ~np.isfinite(far), np.inf, far)
            waiting[:, width:] = np.inf
            chosen = np.argsort(waiting, axis=1, kind="stable")[:, :OPENED]
            live = np.isfinite(waiting[rows, chosen])
            if not live.any():
                return ids[:, :width], far[:, :width]
            opened[rows, chosen] |= live
            new = np.where(live[:, :, None], self.links[np.minimum(ids[rows, chosen], n - 1)], n).reshape(len(queries), -1)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            new[seen[rows, new]] = n
            seen[rows, new] = True
            seen[:, n] = False
            ids = np.concatenate([ids, new], axis=1)
            far = np.concatenate([far, np.where(new < n, self.distances(queries, np.minimum(new, n - 1)), np.inf)], axis=1)
            opened = np.concatenate([opened, new >= n], axis=1)

    def distances(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * np.einsum("qd,qkd->qk", queries, self.centroids[ids])))

    def lists_of(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The lists of each vector: the nearest, and those not much farther."""
        out = []
        for i in range(0, len(vectors), 512):
            ids, far = self.search(vectors[i : i + 512], 2 * REPLICAS)
            out += [x[: REPLICAS][f[: REPLICAS] <= f[0] * REPLICA_RATIO] for x, f in zip(ids, far, strict=True)]
        return out


def calibrated(graph: Graph, sample: np.ndarray, k: int) -> tuple[float, int]:
    """Distance ratio and search width within which ``REACHED`` of sampled neighbours lie."""
    lists = graph.lists_of(sample)
    trial = sample[:: max(1, len(sample) // TRIALS)][:TRIALS]
    far = np.sqrt(np.maximum(0, 2 - 2 * trial @ graph.centroids.T))
    rank = far.argsort(axis=1).argsort(axis=1)
    nearest = np.argsort(-(trial @ sample.T), axis=1, kind="stable")[:, 1 : k + 1]
    ratios, ranks = [], []
    for q, found in enumerate(nearest):
        for v in found:
            best = lists[v][far[q, lists[v]].argmin()]
            ratios.append(far[q, best] / max(far[q].min(), 1e-9))
            ranks.append(rank[q, best])
    if not ratios:  # a single vector has no neighbours
        return 1.0, len(graph.centroids)
    return float(np.quantile(ratios, REACHED)), int(np.quantile(ranks, REACHED)) + 2


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector, digest, dim) of the vectors that take part, each (vec_id, vector) once; dim is their length."""
    own = df.selectExpr(f"cast(`{vec_id}` as bigint) as vec_id", f"cast(`{vector}` as array<double>) as vector")
    fine = "vec_id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(vector, x -> x <> 0)"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("vector")
        flat = column.flatten().to_numpy(zero_copy_only=False) + 0.0  # -0 as 0
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in np.split(flat, ends[:-1])] if len(ends) else []
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], ["vec_id", "vector", "digest"])

    found = own.where(fine).mapInArrow(by_batch(run), "vec_id bigint, vector array<double>, digest binary").dropDuplicates(["vec_id", "digest"])
    return found.withColumn("dim", F.size("vector"))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """One row per different vector: digest, dim, vector, and its smallest k + 1 ids."""
    order = W.Window.partitionBy("digest").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    return few.groupBy("digest").agg(F.first("dim").alias("dim"), F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def in_blocks(placed: DataFrame, rows: DataFrame, on: list[str], entry: list[str], name: str) -> DataFrame:
    """(list, block, ``name``): each list's rows packed into arrays of about ``BLOCK`` entries. ``placed`` has list and ``on``."""
    dealt = placed.join(F.broadcast(block_counts(placed)), "list").withColumn("block", F.pmod(F.xxhash64(*on), "n_blocks").cast("int"))
    return dealt.join(rows, on).groupBy("list", "block").agg(F.collect_list(F.struct(*entry)).alias(name))


def block_counts(placed: DataFrame) -> DataFrame:
    """(list, n_blocks) of at most ``MAX_LISTS`` lists, or as many as there are lengths."""
    return placed.groupBy("list").agg(F.expr(f"cast(ceil(count(*) / {BLOCK}) as int) as n_blocks"))


def compared(k: int):
    """The nearest ``k`` of a block of entries for each query of a block."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for wants, posts in zip(batch.column("wanted"), batch.column("posted"), strict=True):
            w, p = wants.values, posts.values
            q, v = matrix(w.field("vector")), matrix(p.field("vector"))
            asked_ids, ids = w.field("vec_id").to_pylist(), p.field("ids").to_pylist()
            nearby = unit(q) @ unit(v).T
            some = min(len(v), k + 1)  # one may be the query itself
            least = -np.partition(-nearby, some - 1, axis=1)[:, some - 1] - ROUNDING
            for i, a in enumerate(asked_ids):
                few = np.flatnonzero(nearby[i] >= least[i])  # ties at the end stay, so that the smaller ids can win
                scores = cosines(np.broadcast_to(q[i], (len(few), q.shape[1])), v[few])
                hits = [(-s, x) for s, at in zip(scores, few, strict=True) for x in ids[at] if x != a]
                out += [(a, x, -s) for s, x in sorted(hits)[:k]]
        a, x, s = zip(*out, strict=True) if out else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(x, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"])

    return run


def matched(placed: DataFrame, own: DataFrame, probed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of each query and block of a list that it reads, some more than once.

    Pairs of blocks meet by list and block, so a list that holds a large share of all vectors is many tasks;
    a block of queries goes to each of them.
    """
    posted = in_blocks(placed, own, ["digest"], ["ids", "vector"], "posted")
    wanted = in_blocks(probed, asked, ["vec_id", "digest"], ["vec_id", "vector"], "wanted").drop("block")
    wanted = wanted.join(F.broadcast(block_counts(placed)), "list").withColumn("block", F.explode(F.expr("sequence(0, n_blocks - 1)")))
    pairs = wanted.join(posted, ["list", "block"]).select("wanted", "posted")
    return pairs.mapInArrow(by_batch(compared(k)), "query_id bigint, vec_id bigint, score double")


def best_of(found: DataFrame) -> DataFrame:
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


def listed(batch: pa.RecordBatch, lists: list[np.ndarray], keep: list[str]) -> pa.RecordBatch:
    """A row for each row of ``batch`` and each of its lists."""
    at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    out = batch.select(keep).take(pa.array(at))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists) if lists else [], pa.int32()), *out.columns], ["list", *keep])


def indexed(own: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) found for queries ``asked`` among entries ``own``, all of one length."""
    spark = own.sparkSession
    n, length = own.count(), own.select("dim").first()[0]
    most = max(64, min(n, MAX_SAMPLE, MAX_SAMPLE_VALUES // length))
    n_lists = max(1, min(MAX_LISTS, n // LIST_ROWS, most // 2))
    n_sample = min(n, most, max(SAMPLE_PER_LIST * n_lists, 4096))
    sampled = own.orderBy(F.xxhash64("digest"), "digest").limit(n_sample).select("vector").toArrow()
    sample = unit(matrix(sampled.column("vector").combine_chunks()))
    graph = Graph(fitted(sample, n_lists))
    ratio, width = calibrated(graph, sample, k)
    shared = spark.sparkContext.broadcast(graph)  # at most MAX_LISTS centroids and links

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        return listed(batch, shared.value.lists_of(unit(matrix(batch.column("vector")))), ["digest"])

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, lists = unit(matrix(batch.column("vector"))), []
        for i in range(0, len(vectors), 256):
            ids, far = shared.value.search(vectors[i : i + 256], width)
            near = np.isfinite(far) & (far <= np.maximum(far[:, :1], 1e-9) * ratio)
            lists += [x[y] for x, y in zip(ids, near, strict=True)]
        return listed(batch, lists, ["vec_id", "digest"])

    def wider(upto: int):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            vectors, lists = unit(matrix(batch.column("vector"))), []
            size = max(1, BLOCK_VALUES // n_lists)
            for i in range(0, len(vectors), size):
                lists += list(np.argsort(-(vectors[i : i + size] @ shared.value.centroids.T), axis=1, kind="stable")[:, :upto])
            return listed(batch, lists, ["vec_id", "digest"])

        return run

    probes = "list int, vec_id bigint, digest binary"
    placed = saved(own.mapInArrow(by_batch(place), "list int, digest binary"), "ann-placed")
    probed = saved(asked.mapInArrow(by_batch(probe), probes), "ann-probed")
    best = saved(best_of(matched(placed, own, probed, asked, k)), "ann-found")
    read = width
    while read < n_lists:  # queries whose lists hold fewer than k others read more of them, the nearest first
        enough = best.groupBy(F.col("query_id").alias("vec_id")).count().where(F.col("count") >= k)
        short = saved(asked.join(enough, "vec_id", "left_anti"), "ann-short")
        if short.isEmpty():
            break
        read = min(n_lists, 4 * read + 16)
        probed = saved(short.mapInArrow(by_batch(wider(read)), probes), "ann-probed")
        best = saved(best_of(best.union(matched(placed, own, probed, short, k))), "ann-found")
    return best


def search(df: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per query its ``k`` nearest vectors found: query_id, rank from 1, vec_id, score (cosine).

    Ties go to the smaller vec_id; a query is never its own neighbour. Vectors that are null, zero or
    hold null or non-finite components take no part. Vectors of different lengths have no cosine: each
    length is searched by itself, with an index for the most common one and for those of more than
    ``DIRECT`` different vectors, the others block by block. Rows that repeat a vec_id and vector count
    once. With fewer than k others all are returned, so a single vector has no row; an empty table gives
    an empty result. A query whose lists hold fewer than k others reads further lists, the nearest first.
    """
    spark = df.sparkSession
    rows = saved(usable(df, vec_id, vector), "ann-rows")
    own = saved(entries(rows, k), "ann-entries")
    asked = rows.join(queries.select(F.col(vec_id).cast("bigint").alias("vec_id")).distinct(), "vec_id", "left_semi")
    asked = saved(asked, "ann-asked")
    shape = "query_id bigint, rank int, vec_id bigint, score double"
    lengths = own.groupBy("dim").count().orderBy(F.desc("count"), "dim")
    chosen = [r["dim"] for i, r in enumerate(lengths.limit(MOST_LENGTHS).collect()) if i == 0 or r["count"] > DIRECT]
    if not chosen:
        return spark.createDataFrame([], shape)
    found = [indexed(own.where(F.col("dim") == d), asked.where(F.col("dim") == d), k) for d in chosen]
    rest = ~F.col("dim").isin(chosen)
    others = asked.where(rest)
    if not others.isEmpty():
        found.append(best_of(matched(own.where(rest).select(F.col("dim").alias("list"), "digest"), own, others.select(F.col("dim").alias("list"), "vec_id", "digest"), asked, k)))
    best = reduce(DataFrame.union, found)
    order = W.Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best_of(best).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

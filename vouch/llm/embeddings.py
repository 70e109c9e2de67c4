"""Embedding near-duplicates by a robust-pruned flat graph, built on overlapping cluster shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.llm.components import connected_components
from vouch.sources.staging import settle


@dataclass(frozen=True)
class Graph:
    """Settings of index and search."""

    #: Links are pairs of at least this cosine.
    threshold: float = 0.9
    #: Vectors that the centroids are fitted on, the first in the order of a hash, and the centroids at most.
    sample: int = 16_384
    centroids: int = 1_024
    #: Vectors of a shard to aim at, and the most that one task takes from each of two blocks.
    shard: int = 1_500
    block: int = 3_000
    #: Nearest clusters whose shards a vector belongs to.
    overlap: int = 3
    #: Edges of a node, candidates they are chosen from, and the factor of the pruning rule.
    degree: int = 24
    candidates: int = 64
    alpha: float = 1.2
    #: Width of the greedy search before it expands over the range.
    beam: int = 24


DEFAULT = Graph()


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, vector): vectors in double precision; key and vector are null for those that link with nothing."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for v in batch.column(1).to_pandas():
                x = np.array([] if v is None else v, dtype=float)
                good = len(x) > 0 and bool(np.isfinite(x).all()) and bool(x.any())
                x = x + 0.0  # one zero
                keys.append(hashlib.sha256(x.tobytes()).digest()[:16] if good else None)
                found.append(x.tolist() if good else None)
            arrays = [batch.column(0), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "key", "vector"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(each, f"vec_id {kind}, key binary, vector array<double>")


def normed(rows) -> np.ndarray:
    x = np.array(list(rows), dtype=float)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; a cluster without points keeps its centroid."""
    rng = np.random.default_rng(0)
    centroids = points[np.sort(rng.choice(len(points), min(k, len(points)), replace=False))]
    for _ in range(rounds):
        nearest = (points @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return centroids


def place(classes: DataFrame, count: int, graph: Graph = DEFAULT) -> DataFrame:
    """The classes (rep, n, vector) with ``shards``, the numbers of their nearest clusters, sorted.

    The centroids are fitted on a bounded sample; every vector is placed. Vectors of different
    lengths have clusters of their own.
    """
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(graph.sample).select("vector").collect()
    by_length: dict[int, list] = {}
    for row in sample:
        by_length.setdefault(len(row.vector), []).append(row.vector)
    wanted = max(1, -(-count * graph.overlap // graph.shard))
    fitted, first = {}, 0
    for length, rows in sorted(by_length.items()):
        points = normed(rows)
        k = min(graph.centroids, max(1, round(wanted * len(rows) / len(sample))), max(1, len(rows) // 8))
        fitted[length] = (first, fit_centroids(points, k))
        first += k

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shards: list = [[-len(v)] for v in batch["vector"]]  # a length that the sample lacks: one shard
            for length, rows in batch.groupby(batch["vector"].map(len), sort=False).groups.items():
                if length in fitted:
                    start, centroids = fitted[length]
                    near = -(normed(batch.loc[rows, "vector"]) @ centroids.T)
                    top = np.argsort(near, axis=1, kind="stable")[:, : graph.overlap] + start
                    for at, own in zip(batch.index.get_indexer(rows), np.sort(top, axis=1).tolist(), strict=True):
                        shards[at] = own
            yield batch.assign(shards=shards)

    kind = classes.schema["rep"].dataType.simpleString()
    return classes.mapInPandas(nearest, f"rep {kind}, n bigint, vector array<double>, shards array<int>")


def robust_prune(x: np.ndarray, graph: Graph) -> list[np.ndarray]:
    """The out-edges of every node of a shard.

    Candidates are taken nearest first; one is kept unless a kept one is nearer to it by the
    factor alpha than the node itself is. Edges then run both ways.
    """
    m = len(x)
    width = min(graph.candidates, m - 1)
    edges: list[set[int]] = [set() for _ in range(m)]
    for a in range(0, m, 512):
        sims = x[a : a + 512] @ x.T
        own = np.arange(len(sims))
        sims[own, a + own] = -2
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        order = np.argsort(-np.take_along_axis(sims, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        far = 2 - 2 * np.take_along_axis(sims, near, 1)  # squared distances to the node
        alive = np.ones(near.shape, bool)
        for _ in range(min(graph.degree, width)):
            some = alive.any(axis=1)
            if not some.any():
                break
            at = alive.argmax(axis=1)
            kept = near[own, at]
            for q in np.flatnonzero(some).tolist():
                edges[a + q].add(int(kept[q]))
            between = 2 - 2 * np.einsum("qd,qkd->qk", x[kept], x[near])
            alive &= graph.alpha**2 * between > far
            alive[own, at] = False
    for node, out in enumerate([sorted(e) for e in edges]):
        for other in out:
            edges[other].add(node)
    return [np.array(sorted(e), np.int64) for e in edges]


def range_search(x: np.ndarray, edges: list[np.ndarray], graph: Graph, chunk: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (query, node) with a cosine near the threshold or above, for all nodes as queries.

    A query walks greedily from the medoid, with its own node as a second entry, keeping the
    best ``beam`` nodes; then it expands every node in range until no new one is found.
    """
    m = len(x)
    width = max((len(e) for e in edges), default=0)
    table = np.full((m, max(1, width)), -1, np.int64)
    for node, e in enumerate(edges):
        table[node, : len(e)] = e
    medoid = int((x @ x.mean(axis=0)).argmax())
    near = graph.threshold - 1e-4
    for a in range(0, m, chunk):
        queries = np.arange(a, min(a + chunk, m))
        n = len(queries)
        own = np.arange(n)
        seen = np.zeros((n, m), bool)
        expanded = np.zeros((n, m), bool)
        sims = np.full((n, m), -2.0, np.float32)
        for entry in (np.full(n, medoid), queries):
            seen[own, entry] = True
            sims[own, entry] = np.einsum("qd,qd->q", x[queries], x[entry])

        def expand(rows: np.ndarray, nodes: np.ndarray) -> None:
            expanded[rows, nodes] = True
            following = table[nodes]
            fresh = (following >= 0) & ~seen[rows[:, None], following]
            at, k = np.nonzero(fresh)
            r, f = rows[at], following[at, k]
            pairs = np.unique(r * m + f)
            r, f = pairs // m, pairs % m
            seen[r, f] = True
            for b in range(0, len(r), 1 << 16):
                part = slice(b, b + (1 << 16))
                sims[r[part], f[part]] = np.einsum("pd,pd->p", x[queries[r[part]]], x[f[part]])

        beam = min(graph.beam, m)
        active = own
        while len(active):
            best = np.argpartition(-sims[active], beam - 1, axis=1)[:, :beam]
            waiting = np.where(seen[active[:, None], best] & ~expanded[active[:, None], best], sims[active[:, None], best], -3)
            at = waiting.argmax(axis=1)
            go = waiting[np.arange(len(active)), at] > -3
            active, nodes = active[go], best[go, at[go]]
            if len(active):
                expand(active, nodes)
        while True:
            rows, nodes = np.nonzero((sims >= near) & ~expanded)
            if not len(rows):
                break
            for b in range(0, len(rows), 1 << 14):
                expand(rows[b : b + (1 << 14)], nodes[b : b + (1 << 14)])
        rows, nodes = np.nonzero(sims >= near)
        found = queries[rows] != nodes
        yield queries[rows[found]], nodes[found]


def _tasks(placed: DataFrame, graph: Graph) -> DataFrame:
    """A row per class and task (shard, lo, hi): blocks lo and hi of a shard that is larger than one block.

    A shard within the block size is one task. A larger one, as around a vector with very many
    near copies, is dealt into blocks by hash, and each pair of blocks is a task.
    """
    each = placed.withColumn("shard", F.explode("shards"))
    sizes = each.groupBy("shard").count()  # a row per cluster
    blocks = F.ceil(F.col("count") / graph.block).cast("int")
    sized = each.join(sizes.select("shard", blocks.alias("blocks")), "shard")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(other, F.col("own")).alias("lo"), F.greatest(other, F.col("own")).alias("hi")),
    )
    return sized.withColumn("own", own).withColumn("task", F.explode(pairs)).select("shard", "task.lo", "task.hi", "own", "rep", "n", "vector", "shards")


def search(placed: DataFrame, graph: Graph = DEFAULT) -> DataFrame:
    """(rep, links, root) of every class that links: rows linked with it, and the smallest class of its group in a task.

    Every task builds the graph of its shard; the edges of a node from all its shards are
    united; then each task searches with them. A pair that shares several shards counts in the
    first of them, so no pairs leave a task: only a number and a root per vector.
    """
    tasks = settle(_tasks(placed, graph))
    keys = ["shard", "lo", "hi"]
    kind = placed.schema["rep"].dataType.simpleString()

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) < 2:
            return pd.DataFrame({"rep": rows["rep"][:0], "edges": pd.Series([], dtype=object)})
        rows = rows.sort_values("rep", ignore_index=True)
        reps = rows["rep"].to_numpy()
        edges = robust_prune(normed(rows["vector"]).astype(np.float32), graph)
        return pd.DataFrame({"rep": reps, "edges": [reps[e].tolist() for e in edges]})

    built = tasks.groupBy(*keys).applyInPandas(build, f"rep {kind}, edges array<{kind}>")
    united = built.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))

    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", ignore_index=True)
        reps, weight = rows["rep"].to_numpy(), rows["n"].to_numpy()
        exact = normed(rows["vector"])
        at = {r: i for i, r in enumerate(reps.tolist())}
        own = [[] if e is None else e for e in rows["edges"]]
        edges = [np.array([at[r] for r in e if r in at], np.int64) for e in own]
        shards = np.full((len(rows), max(map(len, rows["shards"]))), np.iinfo(np.int32).max)
        for i, s in enumerate(rows["shards"]):
            shards[i, : len(s)] = s
        total, roots = np.zeros(len(rows), np.int64), np.arange(len(rows))
        linked = np.zeros(len(rows), bool)

        def root(i: int) -> int:
            while roots[i] != i:
                roots[i] = roots[roots[i]]
                i = roots[i]
            return i

        found = []
        for q, v in range_search(exact.astype(np.float32), edges, graph):
            close = np.einsum("pd,pd->p", exact[q], exact[v]) >= graph.threshold
            found.append(np.minimum(q, v)[close] * len(rows) + np.maximum(q, v)[close])
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
        a, b = pairs // len(rows), pairs % len(rows)
        linked[a] = linked[b] = True
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            i, j = root(i), root(j)
            roots[max(i, j)] = min(i, j)
        block = rows["own"].to_numpy()
        counted = np.ones(len(a), bool) if key[1] == key[2] else block[a] != block[b]
        for k in range(0, len(a), 1 << 16):
            p = slice(k, k + (1 << 16))
            common = (shards[a[p]][:, :, None] == shards[b[p]][:, None, :]) & (shards[a[p]] < np.iinfo(np.int32).max)[:, :, None]
            first = np.where(common.any(axis=2), shards[a[p]], np.iinfo(np.int32).max).min(axis=1)
            counted[p] &= first == key[0]
        np.add.at(total, a[counted], weight[b[counted]])
        np.add.at(total, b[counted], weight[a[counted]])
        top = reps[[root(i) for i in np.flatnonzero(linked).tolist()]] if linked.any() else reps[:0]
        return pd.DataFrame({"rep": reps[linked], "links": total[linked], "root": top})

    joined = tasks.join(united, "rep", "left")
    return joined.groupBy(*keys).applyInPandas(links, f"rep {kind}, links bigint, root {kind}")


def near_duplicates(vectors: DataFrame, graph: Graph = DEFAULT) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector, a row per row.

    Equal vectors form a class that is placed and searched once; its rows link with each other
    and with every row of a linked class. Null, empty and zero vectors and those with null or
    non-finite components link with nothing and are kept; so is one that stands alone. A null
    vec_id never stands for others: its component is the smallest vec_id it reaches, or null; a
    vector that only rows with a null vec_id have links among those rows alone.
    """
    found = settle(unit_vectors(vectors))
    classes = found.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    classes = settle(classes)
    named_classes = classes.where("rep is not null")
    count = named_classes.count()
    links = settle(search(settle(place(named_classes.select("rep", "n", "vector"), count, graph)), graph))
    per_class = links.groupBy("rep").agg(F.sum("links").alias("links"))
    named = connected_components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    keyed = classes.select("key", "rep", "n").join(per_class, "rep", "left").join(named, F.col("rep") == F.col("id"), "left")
    component = F.coalesce("component", "rep").alias("component_id")
    keyed = keyed.select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), component)
    result = found.select("vec_id", "key").join(keyed, "key", "left")
    own = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        own.alias("component_id"),
        F.col("vec_id").eqNullSafe(own).alias("kept"),
    )


def audit(vectors: DataFrame, result: DataFrame, graph: Graph = DEFAULT, every: int = 50, queries: int = 2_048) -> DataFrame:
    """(vec_id, expected, found): links by brute force and by the graph, for ids divisible by ``every``.

    The queries are compared in blocks with all vectors, so a task holds one block at a time.
    """
    good = settle(unit_vectors(vectors).where("key is not null"))
    asked = good.where(F.col("vec_id") % every == 0).select("vec_id", "vector").orderBy("vec_id")
    blocks, rows = [], asked.toLocalIterator()
    while block := [r for _, r in zip(range(queries), rows)]:
        ids, wanted = [r.vec_id for r in block], [r.vector for r in block]

        def compare(batches: Iterator[pd.DataFrame], ids=ids, wanted=wanted) -> Iterator[pd.DataFrame]:
            lengths, total = np.array([len(v) for v in wanted]), np.zeros(len(ids), np.int64)
            for batch in batches:
                for length, rows in batch["vector"].groupby(batch["vector"].map(len)):
                    at = np.flatnonzero(lengths == length)
                    for k in range(0, len(rows) * bool(len(at)), 4_096):
                        cosines = normed(rows.iloc[k : k + 4_096]) @ normed(wanted[i] for i in at.tolist()).T
                        total[at] += (cosines >= graph.threshold).sum(axis=0)
            yield pd.DataFrame({"vec_id": ids, "links": total})

        blocks.append(good.select("vector").mapInPandas(compare, "vec_id bigint, links bigint"))
    if not blocks:
        return result.where("false").select("vec_id", F.lit(0).alias("expected"), F.lit(0).alias("found"))
    every_block = blocks[0]
    for frame in blocks[1:]:
        every_block = every_block.unionAll(frame)
    expected = every_block.groupBy("vec_id").agg((F.sum("links") - 1).alias("expected"))
    return expected.join(result.select("vec_id", F.col("n_links").alias("found")), "vec_id")

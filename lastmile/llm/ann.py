"""Approximate nearest neighbours: one navigable small-world graph per shard, results merged.

Equal vectors are one node. Nodes are dealt into shards of bounded size by hash; each shard's
layered graph is kept as flat neighbour arrays beside its vectors, in one row of a table.
Blocks of queries walk every shard's graph in step, and the shards' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.operators.sizing import written

SHARD_ROWS = 8_192  # different vectors in a shard, about
QUERY_BLOCK = 512
DEGREE = 24  # neighbours above the ground layer; twice as many on it
BUILD_WIDTH = 64
SEARCH_WIDTH = 160
BATCH = 256  # vectors put into the graph together
SEED = 11
MOST_TASKS = 10_000


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), np.finfo(float).tiny)  # no over- or underflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def dots(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Nearness of each row's ids to its query; -inf where there is no id."""
    near = (vectors[np.maximum(ids, 0)] @ queries[:, :, None])[:, :, 0]
    near[ids < 0] = -np.inf
    return near


def best_of(ids: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k nearest different ids (-1: none), nearest first."""
    order = np.lexsort((-near, ids), axis=1)
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    again = np.zeros(ids.shape, bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    near = np.where(again | (ids < 0), -np.inf, near)
    order = np.argsort(-near, axis=1, kind="stable")[:, :k]
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    return np.where(np.isneginf(near), -1, ids), near


def walk(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int):
    """Best-first search of one layer for all queries in step: (ids, nearness), ``width`` per query.

    Each step expands every query's nearest unexpanded node until all of its ``width`` best
    are expanded.
    """
    rows = np.arange(len(queries))
    ids, near = best_of(start, dots(vectors, start, queries), width)
    if ids.shape[1] < width:
        pad = width - ids.shape[1]
        ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
        near = np.pad(near, ((0, 0), (0, pad)), constant_values=-np.inf)
    seen = np.zeros((len(queries), len(vectors)), bool)
    seen[rows[:, None], np.maximum(start, 0)] = True
    done = np.zeros(ids.shape, bool)
    live = rows
    while len(live):
        open_near = np.where(done[live] | (ids[live] < 0), -np.inf, near[live])
        at = open_near.argmax(1)
        more = ~np.isneginf(open_near[np.arange(len(live)), at])
        live, at = live[more], at[more]
        if not len(live):
            break
        done[live, at] = True
        next_ids = links[ids[live, at]]
        fresh = (next_ids >= 0) & ~seen[live[:, None], np.maximum(next_ids, 0)]
        seen[np.repeat(live, fresh.sum(1)), next_ids[fresh]] = True
        next_ids = np.where(fresh, next_ids, -1)
        all_near = np.concatenate((near[live], dots(vectors, next_ids, queries[live])), 1)
        all_ids = np.concatenate((ids[live], next_ids), 1)
        all_done = np.concatenate((done[live], np.zeros(next_ids.shape, bool)), 1)
        order = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        near[live] = np.take_along_axis(all_near, order, 1)
        ids[live] = np.take_along_axis(all_ids, order, 1)
        done[live] = np.take_along_axis(all_done, order, 1)
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def spread(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours that are nearer to the node than to any neighbour kept before; then the nearest others."""
    count, width = ids.shape
    own = vectors[np.maximum(ids, 0)]
    between = own @ own.transpose(0, 2, 1)
    kept = np.zeros(ids.shape, bool)
    for k in range(width):
        closer = (between[:, k, :] > near[:, k : k + 1]) & kept
        kept[:, k] = (ids[:, k] >= 0) & ~closer.any(1) & (kept.sum(1) < degree)
    order = np.argsort(np.where(ids < 0, 2, np.where(kept, 0, 1)), axis=1, kind="stable")[:, :degree]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, max(0, degree - out.shape[1]))), constant_values=-1)


def put_in(vectors: np.ndarray, links: np.ndarray, new: np.ndarray, ids: np.ndarray, near: np.ndarray) -> None:
    """Link new nodes to found ones, and those back; full nodes keep a spread selection."""
    degree = links.shape[1]
    links[new] = spread(vectors, ids, near, degree)
    source, target = np.repeat(new, degree), links[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    most = int(count.max()) if len(count) else 0
    back = np.full((len(nodes), most), -1, np.int64)
    back[np.repeat(np.arange(len(nodes)), count), np.arange(len(target)) - np.repeat(first, count)] = source
    for at in range(0, len(nodes), BATCH):
        part = nodes[at : at + BATCH]
        all_ids = np.concatenate((links[part], back[at : at + BATCH]), 1)
        near_all = dots(vectors, all_ids, vectors[part])
        kept, kept_near = best_of(all_ids, near_all, min(all_ids.shape[1], 2 * degree))
        links[part] = spread(vectors, kept, kept_near, degree)


def build(vectors: np.ndarray, degree: int = DEGREE, width: int = BUILD_WIDTH) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Layers of a graph over unit vectors: per layer its nodes and its flat neighbour array.

    Layer 0 has all nodes; each higher one a hashed part of the one below. Nodes are put in
    batches: each batch searches the graph so far and itself.
    """
    rnd = np.random.default_rng(SEED)
    level = np.minimum((rnd.exponential(1 / np.log(degree), len(vectors))).astype(int), 6)
    layers, arrays = [], []
    for layer in range(int(level.max()) + 1 if len(vectors) else 1):
        nodes = np.flatnonzero(level >= layer)
        own = vectors[nodes]
        links = np.full((len(nodes), 2 * degree if layer == 0 else degree), -1, np.int64)
        at, size = 0, 1
        while at < len(nodes):
            new = np.arange(at, min(at + size, len(nodes)))
            within = own[new] @ own[new].T
            np.fill_diagonal(within, -np.inf)
            ids, near = np.tile(new, (len(new), 1)), within
            if at:
                entry = np.unique(np.linspace(0, at - 1, min(at, 8)).astype(int))
                start = np.tile(entry, (len(new), 1))
                found, found_near = walk(own, links, own[new], start, min(width, at))
                ids, near = np.concatenate((found, ids), 1), np.concatenate((found_near, near), 1)
            ids, near = best_of(ids, near, min(width, ids.shape[1]))
            put_in(own, links, new, ids, near)
            at, size = at + size, min(BATCH, max(1, at))
        layers.append(nodes)
        arrays.append(links)
    return layers, arrays


def search(vectors: np.ndarray, layers, arrays, queries: np.ndarray, k: int, width: int = SEARCH_WIDTH):
    """(ids, nearness) of about the k nearest nodes of each query: down the layers, then wide on the ground."""
    start = np.zeros((len(queries), 1), np.int64)
    for layer in range(len(layers) - 1, 0, -1):
        own = vectors[layers[layer]]
        ids, _ = walk(own, arrays[layer], queries, start, min(8, len(own)))
        found = np.where(ids >= 0, layers[layer][np.maximum(ids, 0)], -1)
        below = layers[layer - 1]
        start = np.where(found >= 0, np.searchsorted(below, np.maximum(found, 0)), -1)
        start[:, 0] = np.maximum(start[:, 0], 0)
    ids, near = walk(vectors, arrays[0], queries, start, min(width, len(vectors)))
    return ids[:, :k], near[:, :k]


def usable(vector: str):
    """Whether a vector has no null or non-finite component and is not all zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & finite & F.exists(x, lambda v: v != 0)


def distinct_vectors(rows: DataFrame, id_column: str, vector: str, kept_ids: int) -> DataFrame:
    """(vector, ids): each different vector with its smallest ids, at most ``kept_ids``.

    More than one query needs of a group of copies: ties go to the smaller ids. The rank
    limit is applied before the shuffle, so a frequent vector is no large group.
    """
    first = Window.partitionBy("vector").orderBy("id")
    return (
        rows.where(usable(vector)).select(F.col(vector).cast("array<double>").alias("vector"), F.col(id_column).alias("id"))
        .distinct().withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= kept_ids)
        .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )


def packed_blocks(rows: DataFrame, group: str, columns: dict[str, str]) -> DataFrame:
    """One row per group: number, and its columns gathered in one order. Groups are of bounded size."""
    fields = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    gathered = rows.groupBy(group).agg(F.sort_array(F.collect_list(fields)).alias("_r"))
    return gathered.select(group, *[F.col(f"_r.{n}").alias(n) for n in columns])


def build_index(rows: DataFrame, id_column: str, vector: str, kept_ids: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, nodes, dim, vectors, layers, links): the written index, one row per shard.

    Vectors are grouped by their length too, since only equal lengths have an angle.
    """
    nodes = written(distinct_vectors(rows, id_column, vector, kept_ids))
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.withColumn(
        "shard", F.concat_ws("/", F.size("vector"), F.pmod(F.xxhash64("vector", F.lit(SEED)), F.lit(shards)))
    )
    dealt = dealt.repartition(min(shards, MOST_TASKS), "shard")
    gathered = packed_blocks(dealt, "shard", {"ids": "ids", "vector": "vector"})
    schema = "shard string, size int, ids array<array<bigint>>, vectors binary, layers array<binary>, links array<binary>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                vectors = batch.column(2)[i].values
                original = np.asarray(vectors.flatten(), float).reshape(len(vectors), -1)
                layers, arrays = build(unit(original).astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1), pa.array([len(original)], pa.int32()), batch.column(1).slice(i, 1),
                        pa.array([original.tobytes()], pa.binary()),
                        pa.array([[x.astype("<i4").tobytes() for x in layers]], pa.list_(pa.binary())),
                        pa.array([[x.astype("<i4").tobytes() for x in arrays]], pa.list_(pa.binary())),
                    ],
                    [c.split()[0] for c in schema.split(", ")],
                )

    return written(gathered.mapInArrow(run, schema))


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK, width: int = SEARCH_WIDTH,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found by cosine, in double precision.

    A query never finds rows of its own id. Vectors that are null, zero or hold null or
    non-finite components take no part; ties go to the smaller id; repeated rows count once.
    With fewer than k other rows all are returned; empty tables give no rows. Columns beside
    the id and the vector are ignored.
    """
    index = build_index(rows, id_column, vector, k + 1, shard_rows)
    asked = written(
        queries.where(usable(vector)).select(F.col(id_column).alias("query_id"), F.col(vector).cast("array<double>").alias("vector"))
        .where("query_id IS NOT NULL").distinct()
    )
    blocks = max(1, -(-asked.count() // query_block))
    in_block = packed_blocks(
        asked.withColumn("block", F.concat_ws("/", F.size("vector"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)))),
        "block", {"query_id": "query_id", "vector": "vector"},
    )
    # Every block meets every shard of its vector length: an equality join on their pair.
    length = lambda c: F.element_at(F.split(c, "/"), 1)
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    last = index.agg(F.max(F.element_at(F.split("shard", "/"), 2).cast("long"))).first()[0]
    shards = 1 if last is None else last + 1
    left = in_block.withColumn("_s", numbers(shards)).withColumn("shard", F.concat_ws("/", length("block"), F.col("_s"))).drop("_s")
    right = index.withColumn("_b", numbers(blocks)).withColumn("block", F.concat_ws("/", length("shard"), F.col("_b"))).drop("_b")
    # As many tasks as pairs, so that tasks are even and a batch holds few indexes.
    pairs = left.join(right, ["shard", "block"]).repartition(min(shards * blocks, MOST_TASKS), "shard", "block").select("query_id", "vector", "size", "ids", "vectors", "layers", "links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ask = np.asarray(batch.column(0)[i].values, np.int64)
                asked_vectors = np.asarray(batch.column(1)[i].values.flatten(), float).reshape(len(ask), -1)
                size = batch.column(2)[i].as_py()
                ids = batch.column(3)[i].as_py()
                original = np.frombuffer(batch.column(4)[i].as_buffer(), float).reshape(size, -1)
                layers = [np.frombuffer(x, "<i4").astype(np.int64) for x in batch.column(5)[i].as_py()]
                arrays = [
                    np.frombuffer(x, "<i4").astype(np.int64).reshape(len(nodes), -1)
                    for x, nodes in zip(batch.column(6)[i].as_py(), layers)
                ]
                near = unit(original).astype(np.float32), layers, arrays, unit(asked_vectors).astype(np.float32)
                found, _ = search(*near, k + 1, width)
                out = []
                for q in range(len(ask)):
                    node = found[q][found[q] >= 0]
                    a, b = asked_vectors[q], original[node]
                    score = b @ a / (np.linalg.norm(a) * np.linalg.norm(b, axis=1))
                    # Equal directions of unequal length and equal vectors are ties by id.
                    got = [(-s, j) for s, n in zip(score.tolist(), node.tolist()) for j in ids[n] if j != ask[q]]
                    out += [(int(ask[q]), j, -s) for s, j in sorted(got)[:k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                    ["query_id", "id", "score"],
                )

    found = pairs.mapInArrow(run, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_column), "score")
    )

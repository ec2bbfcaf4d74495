"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

1. Equal vectors are one node; a node keeps its smallest ids, as many as a result can need, taken
   per batch before the shuffle, so a vector that a third of the rows share stays small.
2. Nodes are dealt to shards of about ``SHARD`` by hash. In each shard, nodes are inserted in
   batches: a greedy beam search proposes neighbours, relaxed distance pruning (``ALPHA``) keeps
   diverse edges, and back edges are pruned when a node has more than ``DEGREE``.
3. Every query searches every shard's graph by beam search, in blocks of queries. Proposed nodes
   are scored by the cosine of the original vectors in double precision, and the shards' best are
   merged per query.

Defined cases: very large and very small components are scaled before they are squared; vectors that are null, empty, zero or hold null or non-finite components take no
part; vectors are compared within their dimension; rows that repeat an id and a vector are one
candidate; null ids are left out; ties go to the smaller id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import settle

SHARD = 4000
DEGREE, BEAM, ALPHA, BATCH = 28, 64, 1.2, 256
QUERY_BLOCK = 2000
EVERY = 50
NEAREST = 5
NONE = np.iinfo(np.int64).max
GRAPH = "dim int, shard int, n int, ids binary, vectors binary, edges binary, start int"


def beam_search(edges: np.ndarray, unit: np.ndarray, start: int, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (-1: none) and squared distances of the ``beam`` nearest found, nearest first, for many queries."""
    n, m = len(unit), len(queries)
    nodes = np.full((m, beam), -1, np.int64)
    far = np.full((m, beam), np.inf, np.float32)
    done = np.zeros((m, beam), bool)
    seen = np.zeros((m, n + 1), bool)  # the last column stands for absent edges
    seen[:, [start, n]] = True
    nodes[:, 0], far[:, 0] = start, 2 - 2 * (queries @ unit[start])
    line = np.arange(m)
    while True:
        open_ = np.where(done, np.inf, far)
        best = np.argmin(open_, axis=1)
        live = np.flatnonzero(open_[line, best] < np.inf)
        if not len(live):
            return nodes, far
        done[live, best[live]] = True
        next_ = edges[nodes[live, best[live]]]
        fresh = ~seen[live[:, None], next_]
        seen[live[:, None], next_] = True
        distance = 2 - 2 * np.matmul(unit[np.minimum(next_, n - 1)], queries[live][:, :, None])[:, :, 0]
        distance = np.where(fresh, distance, np.inf).astype(np.float32)
        every = np.concatenate((far[live], distance), axis=1)
        order = np.argsort(every, axis=1, kind="stable")[:, :beam]
        far[live] = np.take_along_axis(every, order, 1)
        nodes[live] = np.take_along_axis(np.concatenate((nodes[live], np.where(fresh, next_, -1)), axis=1), order, 1)
        done[live] = np.take_along_axis(np.concatenate((done[live], np.zeros(next_.shape, bool)), axis=1), order, 1)


def robust_prune(unit: np.ndarray, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Diverse neighbours of the nodes ``own`` from ``candidates`` (-1: none), padded with len(unit)."""
    n = len(unit)
    candidates = np.sort(np.where(candidates == own[:, None], -1, candidates), axis=1)
    twice = np.zeros(candidates.shape, bool)
    twice[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    held = unit[np.maximum(candidates, 0)]
    distance = 2 - 2 * np.matmul(held, unit[own][:, :, None])[:, :, 0]
    distance[(candidates < 0) | twice] = np.inf
    kept = np.full((len(own), DEGREE), n, np.int64)
    line = np.arange(len(own))
    left = distance.copy()
    for k in range(DEGREE):
        best = np.argmin(left, axis=1)
        ok = left[line, best] < np.inf
        if not ok.any():
            break
        kept[ok, k] = candidates[line, best][ok]
        between = 2 - 2 * np.matmul(held, held[line, best][:, :, None])[:, :, 0]
        left[ALPHA ** 2 * between <= distance] = np.inf
        left[line, best] = np.inf
    return kept


def build_graph(unit: np.ndarray, seed: int = 0) -> tuple[np.ndarray, int]:
    """Edges (padded with len(unit)) and the node where searches start."""
    n = len(unit)
    random = np.random.default_rng(seed)
    edges = np.full((n + 1, DEGREE), n, np.int64)
    start = int(np.argmax(unit @ unit.mean(axis=0)))
    order = random.permutation(n)
    at, size = 0, 1
    while at < n:
        some = order[at:at + size]
        at, size = at + len(some), min(BATCH, size * 2)
        found, _ = beam_search(edges, unit, start, unit[some])
        edges[some] = robust_prune(unit, some, np.concatenate((found, np.where(edges[some] == n, -1, edges[some])), axis=1))
        to, back = edges[some].ravel(), np.repeat(some, DEGREE)
        to, back = to[to < n], back[to < n]
        by = np.argsort(to, kind="stable")
        to, back = to[by], back[by]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        wide = np.full((len(targets), DEGREE + int(count.max(initial=0))), -1, np.int64)
        wide[:, :DEGREE] = np.where(edges[targets] == n, -1, edges[targets])
        wide[np.repeat(np.arange(len(targets)), count), DEGREE + np.arange(len(to)) - np.repeat(first, count)] = back
        for low in range(0, len(targets), 1024):
            edges[targets[low:low + 1024]] = robust_prune(unit, targets[low:low + 1024], wide[low:low + 1024])
    return edges, start


def _valid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and vector the NEAREST + 1 smallest ids: no result can hold more of one vector."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        rows, held = batch.column(1), {}
        for i in np.argsort(ids, kind="stable"):
            values = rows[int(i)].values.to_numpy(zero_copy_only=False) + 0.0  # no negative zeros
            some = held.setdefault(hashlib.blake2b(values.tobytes(), digest_size=16).digest(), (values, []))[1]
            if len(some) <= NEAREST and ids[i] not in some:
                some.append(ids[i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array([v for v, _ in held.values()], pa.list_(pa.float64())),
             pa.array([s for _, s in held.values()], pa.list_(pa.int64()))], names=["key", "v", "ids"])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("key")
    vectors = np.stack(pdf["v"].to_numpy())
    edges, start = build_graph(_unit(vectors))
    ids = np.full((len(pdf), NEAREST + 1), NONE, np.int64)
    for row, some in enumerate(pdf["ids"]):
        ids[row, :len(some)] = some
    return pd.DataFrame([{"dim": int(pdf["dim"].iloc[0]), "shard": int(pdf["shard"].iloc[0]), "n": len(pdf), "ids": ids.tobytes(),
                          "vectors": vectors.tobytes(), "edges": edges.astype(np.int32).tobytes(), "start": start}])


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Every vector times the power of two that brings its largest component between a half and one."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])


def cosines(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosine of each query with its own row of vectors (queries x candidates x dimension).

    Vectors are scaled by powers of two, which changes no digit, so that no square overflows or vanishes.
    """
    vectors, queries = _scaled(vectors), _scaled(queries)
    dot = np.matmul(vectors, queries[:, :, None])[:, :, 0]
    return dot / (np.linalg.norm(vectors, axis=2) * np.linalg.norm(queries, axis=1)[:, None])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64).reshape(row["n"], -1)
            vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["dim"])
            edges = np.frombuffer(row["edges"], np.int32).reshape(row["n"] + 1, -1).astype(np.int64)
            unit, q_ids = _unit(vectors), np.array(row["q_ids"], np.int64)
            queries = np.array(row["q"], np.float64).reshape(len(q_ids), row["dim"])
            q_unit = _unit(queries)
            for low in range(0, len(q_ids), BATCH):
                q = slice(low, low + BATCH)
                nodes, _ = beam_search(edges, unit, row["start"], q_unit[q])
                score = np.where(nodes >= 0, cosines(vectors[np.maximum(nodes, 0)], queries[q]), -np.inf)
                members = np.where(nodes[:, :, None] >= 0, ids[np.maximum(nodes, 0)], NONE)
                members = np.where(members == q_ids[q, None, None], NONE, members).reshape(len(nodes), -1)
                score = np.where(members == NONE, -np.inf, np.repeat(score, NEAREST + 1, axis=1))
                order = np.lexsort((members, -score), axis=1)[:, :NEAREST]
                members, score = np.take_along_axis(members, order, 1), np.take_along_axis(score, order, 1)
                ok = members != NONE
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids[q], ok.sum(axis=1))), pa.array(members[ok]), pa.array(score[ok])], names=["query_id", "vec_id", "score"])


def graphs(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """One row per shard: its nodes, vectors and edges, packed."""
    nodes = settle(_valid(rows, id_col, vector_col).mapInArrow(_nodes, "key binary, v array<double>, ids array<long>")
                   .groupBy("key").agg(F.first("v").alias("v"), F.flatten(F.collect_list("ids")).alias("ids"))
                   .select("key", "v", F.slice(F.array_sort(F.array_distinct("ids")), 1, NEAREST + 1).alias("ids"), F.size("v").alias("dim")))
    n_shards = max(1, -(-nodes.count() // shard))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(n_shards)).cast("int"))
    return settle(dealt.groupBy("dim", "shard").applyInPandas(_build, GRAPH))


def nearest(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: each query's nearest rows other than itself."""
    built = graphs(rows, id_col, vector_col, shard)
    asked = settle(_valid(queries, id_col, vector_col).distinct())
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks = (asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")).withColumn("dim", F.size("v"))
              .groupBy("dim", "block").agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("q"))
              .select("dim", "block", F.col("q.id").alias("q_ids"), F.flatten("q.v").alias("q")))
    work = (built.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).hint("merge")
            .join(blocks, ["dim", "block"]).repartition("dim", "shard", "block"))
    found = work.mapInArrow(_search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order))
    return best.filter(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")


def op8_neighbours(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(rows, rows.filter(F.col("vec_id") % EVERY == 0))

"""Hard-negative mining by the threshold algorithm over per-dimension sorted lists.

1. Rows become nodes: one per label and integer vector, with the smallest ids that a result can
   need, taken per batch before the shuffle, so a vector that a third of the rows share stays small.
2. Nodes are range-partitioned by label into shards of about ``SHARD``, each with one candidate list
   per dimension, sorted by component. A hot label is spread over many shards.
3. An anchor visits the shards that hold its label and finds its positives there; then, with the
   score window of each positive, all shards that hold another label. Inside a shard both use the
   threshold algorithm: lists are read in the direction of the sign of the anchor's component, rows
   seen for the first time are scored at random access by integer inner product, and reading stops
   once the threshold (the score of the components read last) is strictly below every window's kth
   score, or below its lower end while it is not full.
4. The shards' best are merged per anchor, and per anchor and positive.

Work is split by shard and part of the anchors: a task holds one shard and at most about ``PART``
anchors, so shards are copied once for every ``PART`` anchors and anchors once for every shard.

Scores are exact: they are sums in double precision while all partial sums stay below 2**53, and
sums of Python integers beyond; a score outside a long is held at the end of its range.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite component
take no part; rows that repeat an id, a label and an integer vector are one row; rows that repeat
an id with another content are rows of their own, never partners of their own id, and listed once
for each score; vectors meet only vectors of their dimension, and empty vectors score 0; ties go to the smaller id; a window
holds nothing when its positive's score is negative; an empty table gives an empty result; other
columns of the input, whatever their names, are left out. A component whose product with ``SCALE``
is beyond a double is held at the largest one. No texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach
from gaugeflow.session import settle

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
SHARD, PART = 16_384, 16_384
FIRST_DEPTH = 32
EXACT = 2.0 ** 53
LEAST, MOST = -(2 ** 63), 2 ** 63 - 1
KINDS = ("i2", "i4", "f8")  # how integer vectors are packed: the first that holds them
NODES = "label long, dim int, vector binary, ids array<long>"
SHARDS = "dim int, shard int, low long, high long, n int, labels binary, ids binary, n_ids binary, vectors binary, orders binary"
FOUND = "anchor_id long, anchor_key binary, positive_id long, positive_score long, id long, score long"


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), held inside the doubles."""
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -most, most) + 0.0


def pack(vector: np.ndarray) -> bytes:
    """Bytes of an integer vector; equal vectors give equal bytes."""
    top = np.abs(vector).max(initial=0.0)
    kind = KINDS[0] if top < 2 ** 15 else KINDS[1] if top < 2 ** 31 else KINDS[2]
    return kind.encode() + vector.astype(kind).tobytes()


def unpack(packed: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(p, p[:2].decode(), offset=2).astype(np.float64) for p in packed])


def scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Integer inner products as longs."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    if float(np.abs(rows).max()) * float(np.abs(anchor).sum()) < EXACT:
        return (rows @ anchor).astype(np.int64)
    whole_anchor = [int(x) for x in anchor]
    exact = [sum(int(x) * y for x, y in zip(row, whole_anchor)) for row in rows]
    return np.array([min(max(s, LEAST), MOST) for s in exact], np.int64)


def window(score: int) -> tuple[int, int]:
    """Whole scores s with LOW * score <= 100 * s <= HIGH * score."""
    return -(-LOW * score // 100), HIGH * score // 100


@dataclass
class Shard:
    """Nodes of one dimension and their sorted lists: ``orders[d]`` by falling component d."""
    labels: np.ndarray
    ids: np.ndarray  # ascending, padded
    n_ids: np.ndarray
    vectors: np.ndarray
    orders: np.ndarray

    def visits(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """Nodes seen for the first time at growing depths, and the threshold for all not yet seen."""
        n = len(self.labels)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) + len(down):  # nothing tells rows apart: one reading covers all
            yield np.arange(n), LEAST
            return
        seen = np.zeros(n, bool)
        done, depth = 0, FIRST_DEPTH
        while not seen.all():
            upto = min(done + depth, n)
            met = np.zeros(n, bool)
            met[self.orders[up, done:upto]] = True
            met[self.orders[down, n - upto:n - done]] = True
            fresh = np.flatnonzero(met & ~seen)
            seen |= met
            last = np.zeros(len(anchor))
            last[up] = self.vectors[self.orders[up, upto - 1], up]
            last[down] = self.vectors[self.orders[down, n - upto], down]
            yield fresh, int(scores(last[None, :], anchor)[0])
            done, depth = upto, upto

    def best(self, anchor: np.ndarray, anchor_id: int, takes: np.ndarray, spans: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each span of scores (both ends included), ids and scores of its first k rows among the nodes of ``takes``."""
        found = {}
        nodes, value = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for fresh, threshold in self.visits(anchor):
            fresh = fresh[takes[fresh]]
            nodes = np.concatenate((nodes, fresh))
            value = np.concatenate((value, scores(self.vectors[fresh], anchor)))
            order = np.argsort(value, kind="stable")[::-1]
            nodes, value = nodes[order], value[order]
            found = {s: self._first(value, nodes, *s, k, anchor_id) for s in spans}
            if all(threshold < (v[-1] if len(v) == k else low) for (low, high), (_, v) in found.items() if low <= high):
                break
        return [found[s] for s in spans]

    def _first(self, value: np.ndarray, nodes: np.ndarray, low: int, high: int, k: int, anchor_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the first k rows whose scores (``value`` falls) lie in the span."""
        n, rising = len(value), value[::-1]
        begin, end = n - int(np.searchsorted(rising, high, "right")), n - int(np.searchsorted(rising, low, "left"))
        upto = begin
        while True:
            upto = min(end, max(begin + 2 * k, 2 * upto - begin))
            if upto > begin:  # all ties of the last one, so that the smaller id is among them
                upto = n - int(np.searchsorted(rising, value[upto - 1], "left"))
            some = nodes[begin:upto]
            ids = self.ids[some]
            ok = (np.arange(ids.shape[1]) < self.n_ids[some][:, None]) & (ids != anchor_id)
            ids, v = ids[ok], np.repeat(value[begin:upto], ok.sum(axis=1))
            order = np.lexsort((ids, ~v))  # ~v falls as v grows, without overflow
            ids, v = ids[order], v[order]
            once = np.ones(len(ids), bool)
            once[1:] = (ids[1:] != ids[:-1]) | (v[1:] != v[:-1])
            if once.sum() >= k or upto >= end:
                return ids[once][:k], v[once][:k]


def _valid(rows: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    v = F.col("v")
    return (rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull())
            .filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))


def _packed(batch: pa.RecordBatch) -> list[bytes]:
    column = batch.column(2)
    ends = column.offsets.to_numpy()
    numbers = whole(column.values.to_numpy(zero_copy_only=False)) if len(column.values) else np.zeros(0)
    return [pack(numbers[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, label and vector the smallest ids: no result needs more of one node."""
    most = max(POSITIVES + 1, NEGATIVES)
    for batch in batches:
        held: dict[tuple[int, bytes], set[int]] = {}
        for i, label, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _packed(batch)):
            held.setdefault((label, vector), set()).add(i)
        dims = [(len(v) - 2) // np.dtype(v[:2].decode()).itemsize for _, v in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array([l for l, _ in held], pa.int64()), pa.array(dims, pa.int32()), pa.array([v for _, v in held], pa.binary()),
             pa.array([sorted(s)[:most] for s in held.values()], pa.list_(pa.int64()))], names=["label", "dim", "vector", "ids"])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _packed(batch)
        dims = [(len(v) - 2) // np.dtype(v[:2].decode()).itemsize for v in vectors]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())],
                                         names=["anchor_id", "label", "dim", "vector"])


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row: the nodes of a shard with their sorted lists."""
    pdf = pdf.sort_values(["label", "vector"])
    vectors = unpack(list(pdf["vector"]))
    orders = np.argsort(-vectors.T, axis=1, kind="stable")
    n_ids = np.array([len(s) for s in pdf["ids"]], np.int32)
    ids = np.zeros((len(pdf), n_ids.max()), np.int64)
    for row, some in enumerate(pdf["ids"]):
        ids[row, :len(some)] = some
    labels = pdf["label"].to_numpy(np.int64)
    return pd.DataFrame([{"dim": vectors.shape[1], "shard": int(pdf["shard"].iloc[0]), "low": labels.min(), "high": labels.max(), "n": len(pdf),
                          "labels": labels.tobytes(), "ids": ids.tobytes(), "n_ids": n_ids.tobytes(), "vectors": pack(vectors.ravel()),
                          "orders": orders.astype(np.int32).tobytes()}])


def _opened(row) -> Shard:
    n = int(row["n"])
    return Shard(np.frombuffer(row["labels"], np.int64), np.frombuffer(row["ids"], np.int64).reshape(n, -1), np.frombuffer(row["n_ids"], np.int32),
                 unpack([row["vectors"]]).reshape(n, -1), np.frombuffer(row["orders"], np.int32).reshape(-1, n))


def shards(rows: DataFrame, id_col: str, label: Column, vector_col: str, shard: int = SHARD) -> DataFrame:
    """One row per shard: labels, ids, vectors and sorted lists, packed."""
    most = max(POSITIVES + 1, NEGATIVES)
    nodes = settle(_valid(rows, id_col, label, vector_col).mapInArrow(_nodes, NODES)
                   .groupBy("label", "dim", "vector").agg(F.flatten(F.collect_list("ids")).alias("ids"))
                   .select("label", "dim", "vector", F.slice(F.array_sort(F.array_distinct("ids")), 1, most).alias("ids")))
    n_ranges = max(1, -(-nodes.count() // shard))
    # the ranges are numbered in a table of their own, since a range partitioning can't be repeated exactly
    ranged = settle(nodes.repartitionByRange(n_ranges, "dim", "label", "vector").withColumn("range", F.spark_partition_id()))
    # neighbouring ranges that are small together make one shard, however many ranges there came to be
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    numbers = settle(ranged.groupBy("range").agg(F.count(F.lit(1)).alias("rows")).select(
        "range", F.floor(F.coalesce(F.sum("rows").over(upto), F.lit(0)) / shard).cast("int").alias("shard")))
    dealt = attach(ranged, numbers, ["range"])
    return settle(dealt.groupBy("dim", "shard").applyInPandas(_build, SHARDS))


def _search(own_label: bool, k: int):
    """Function of a shard and a part of the anchors."""
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            shard = _opened(left.iloc[0])
            same: dict[int, np.ndarray] = {}
            for a in right.itertuples(index=False):
                if a.label not in same:
                    same[a.label] = shard.labels == a.label
                takes = same[a.label] if own_label else ~same[a.label]
                anchor = unpack([a.vector])[0]
                spans = [(LEAST, MOST)] if own_label else [window(int(s)) for s in a.positive_scores]
                owners = [(None, None)] if own_label else list(zip(a.positive_ids, a.positive_scores))
                once = list(dict.fromkeys(spans))
                found = dict(zip(once, shard.best(anchor, a.anchor_id, takes, once, k)))
                for span, (positive, value) in zip(spans, owners):
                    out += [(a.anchor_id, a.anchor_key, positive, value, i, s) for i, s in zip(*(x.tolist() for x in found[span]))]
        frame = pd.DataFrame(out, columns=["anchor_id", "anchor_key", "positive_id", "positive_score", "id", "score"])
        return frame.astype({"anchor_id": "int64", "positive_id": "Int64", "positive_score": "Int64", "id": "int64", "score": "int64"})

    return run


def _visit(built: DataFrame, spans: DataFrame, anchors: DataFrame, n_parts: int, own_label: bool, k: int) -> DataFrame:
    """Every anchor in every shard that can hold rows for it."""
    inside = F.col("label").between(F.col("low"), F.col("high"))
    alone = (F.col("low") == F.col("high")) & (F.col("low") == F.col("label"))
    n_shards = spans.agg(F.max("shard")).first()[0]
    shard_no = F.explode(F.sequence(F.lit(0), F.lit(n_shards or 0)))
    work = attach(anchors.withColumn("shard", shard_no), spans, ["dim", "shard"]).filter(inside if own_label else ~alone).drop("low", "high")
    copies = built.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    # the given count keeps small tables from being gathered in one task
    n_tasks = max(int(built.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * (n_shards or 0) * n_parts)
    keys = ["dim", "shard", "part"]
    return (copies.repartition(n_tasks, *keys).groupBy(*keys).cogroup(work.repartition(n_tasks, *keys).groupBy(*keys))
            .applyInPandas(_search(own_label, k), FOUND))


def mine(rows: DataFrame, anchors: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         shard: int = SHARD, part: int = PART) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows ``anchors``.

    ``label`` is written over the columns of both tables.
    """
    built = shards(rows, id_col, label, vector_col, shard)
    spans = settle(built.select("dim", "shard", "low", "high"))
    key = F.unhex(F.sha2(F.concat_ws(":", "anchor_id", "label", F.hex("vector")).cast("binary"), 256)).alias("anchor_key")
    asked = settle(_valid(anchors, id_col, label, vector_col).mapInArrow(_anchors, "anchor_id long, label long, dim int, vector binary")
                   .distinct().select("*", key))
    n_parts = max(1, -(-asked.count() // part))
    dealt = asked.withColumn("part", F.pmod(F.xxhash64("anchor_key"), F.lit(n_parts)).cast("int"))

    first = Window.partitionBy("anchor_key").orderBy(F.desc("score"), "id")
    near = _visit(built, spans, dealt, n_parts, True, POSITIVES).distinct().withColumn("rank", F.row_number().over(first))
    chosen = near.filter(F.col("rank") <= POSITIVES).groupBy("anchor_key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    windows = settle(dealt.join(chosen.select("anchor_key", F.col("p.id").alias("positive_ids"), F.col("p.score").alias("positive_scores")), "anchor_key"))

    order = Window.partitionBy("anchor_key", "positive_id").orderBy(F.desc("score"), "id")
    far = _visit(built, spans, windows, n_parts, False, NEGATIVES).distinct().withColumn("rank", F.row_number().over(order))
    return far.filter(F.col("rank") <= NEGATIVES).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                                                         "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, rows.filter(F.col("vec_id") % 100 == 0), label)


ORACLE = """
with r as (select vec_id id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) v
  from embeddings where label is not null and embedding is not null and vec_id is not null
    and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: not isfinite(x))) = 0),
s as (select a.id a, b.id b, a.l = b.l same, cast(list_inner_product(a.v, b.v) as bigint) s
  from r a join r b on a.id <> b.id and len(a.v) = len(b.v) where a.id % 100 = 0),
p as (select a, b, s from s where same qualify row_number() over (partition by a order by s desc, b) <= 5),
n as (select p.a, p.b, n.b n, p.s ps, n.s ns, row_number() over (partition by p.a, p.b order by n.s desc, n.b) k
  from p join s n on n.a = p.a and not n.same and 100 * n.s between 30 * p.s and 90 * p.s)
select a anchor_id, b positive_id, cast(k as int) rank, n negative_id, ps positive_score, ns negative_score from n where k <= 10
"""

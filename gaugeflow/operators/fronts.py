"""Non-dominated points of large groups: mergeable skylines and front numbers. All objectives are maximised."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions.skew import attach, running_max
from gaugeflow.session import settle

BLOCK = 4096  # points of a group that one task compares with as many others
CHUNK = 256


def beaten(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether some row of ``others`` dominates each row of ``points``."""
    out = np.zeros(len(points), bool)
    for low in range(0, len(points), CHUNK):
        some = points[low:low + CHUNK, None]
        no_worse, larger = (others[None] >= some).all(axis=2), (others[None] > some).any(axis=2)
        out[low:low + CHUNK] = (no_worse & larger).any(axis=1)
    return out


def _values(table: pa.Table | pa.RecordBatch, objectives: list[str]) -> np.ndarray:
    return np.stack([np.asarray(pc.cast(table.column(o), pa.float64())) for o in objectives], axis=1)


def _staircase(points: DataFrame, keys: list[str], objectives: list[str]) -> DataFrame:
    """Two objectives: by falling first one, a point stays if its second one is larger than all before."""
    first, second = objectives
    steps = settle(points.groupBy(*keys, first).agg(F.max(second).alias(second)))
    swept = running_max(steps, keys, [F.desc(first)], second, "_before")
    return swept.filter(F.col("_before").isNull() | (F.col(second) > F.col("_before"))).drop("_before")


def _numbered(points: DataFrame, keys: list[str], objectives: list[str], block: int) -> DataFrame:
    """Points with the number of blocks of their group and their own block."""
    sizes = settle(points.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks")))
    return attach(points, sizes, keys).withColumn("_block", F.pmod(F.xxhash64(*objectives), F.col("_blocks")).cast("int"))


def own_skyline(values: np.ndarray) -> np.ndarray:
    """Numbers of the rows that no other row dominates.

    Rows are visited in chunks by falling sum, which can only place a dominating row first, so each
    chunk is compared with the rows kept so far and with itself.
    """
    order = np.argsort(-values.sum(axis=1), kind="stable")
    kept = order[:0]
    for low in range(0, len(order), CHUNK):
        some = order[low:low + CHUNK]
        some = some[~beaten(values[some], values[kept])]
        kept = np.concatenate((kept, some[~beaten(values[some], values[some])]))
    return np.sort(kept)


def _merged(points: DataFrame, keys: list[str], objectives: list[str], block: int) -> DataFrame:
    """Any number of objectives, in a fixed number of passes.

    1. Every batch of rows keeps the skyline of each group in it, before anything is shuffled.
    2. The rest is dealt to blocks, and each block keeps its own skyline. That is all where the
       groups are single blocks.
    3. What is left is dealt again; every block is compared with every block of its group, one pair
       a task. A skyline of f points takes f / ``block`` copies of it, and no task more than two blocks.
    """
    schema = points.schema
    names = schema.names

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _values(batch, objectives)
            groups = batch.select(keys).to_pandas().groupby(keys, dropna=False, sort=False).indices.values() if keys else [np.arange(len(values))]
            kept = [rows if len(rows) == 1 else rows[own_skyline(values[rows])] for rows in groups]
            yield batch.take(pa.array(np.sort(np.concatenate(kept)))) if kept else batch

    def own(table: pa.Table) -> pa.Table:
        return table.select(names).take(pa.array(own_skyline(_values(table, objectives))))

    rest = settle(points.mapInArrow(first, schema).distinct())
    largest = rest.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= block:
        return rest.groupBy(*keys).applyInArrow(own, schema)
    left = settle(_numbered(rest, keys, objectives, block).groupBy(*keys, "_block").applyInArrow(own, schema))

    def lost(mine: pa.Table, other: pa.Table) -> pa.Table:
        if not mine.num_rows or not other.num_rows:
            return mine.select(names).slice(0, 0)
        return mine.select(names).filter(pa.array(beaten(_values(mine, objectives), _values(other, objectives))))

    dealt = settle(_numbered(left, keys, objectives, block))
    numbers = F.sequence(F.lit(0), F.col("_blocks") - 1)
    mine = dealt.withColumn("_with", F.explode(numbers)).drop("_blocks")
    other = dealt.withColumnRenamed("_block", "_with").withColumn("_block", F.explode(numbers)).drop("_blocks")
    pair = [*keys, "_block", "_with"]
    gone = mine.groupBy(*pair).cogroup(other.groupBy(*pair)).applyInArrow(lost, schema)
    return left.join(gone, names, "left_anti")


def skyline(points: DataFrame, keys: list[str], objectives: list[str], block: int = BLOCK) -> DataFrame:
    """The distinct non-dominated rows of ``points`` (keys, objectives), which must be without NULL."""
    if len(objectives) == 1:
        return points.groupBy(*keys).agg(F.max(objectives[0]).alias(objectives[0]))
    if len(objectives) == 2:
        return _staircase(points, keys, objectives)
    return _merged(points, keys, objectives, block)


class _Fronts:
    """Fronts of one group while its points come by falling objectives.

    A point is dominated by a front if some member reaches it in every objective but the first, in
    which all earlier points reach it. So a front keeps only the tail of members that others of it
    don't reach. A point that one front dominates is dominated by all before it, so the first front
    that doesn't is found by binary search.
    """

    def __init__(self, n_objectives: int):
        self.single = n_objectives == 2
        self.tails: list = []

    def place(self, rest: np.ndarray) -> int:
        if self.single:  # one number a front, falling from front to front, so negated it rises
            at = bisect_right(self.tails, -rest[0])
            self.tails[at:at + 1] = [-rest[0]]
            return at
        low, high = 0, len(self.tails)
        while low < high:
            mid = (low + high) // 2
            if (self.tails[mid] >= rest).all(axis=1).any():
                low = mid + 1
            else:
                high = mid
        if low == len(self.tails):
            self.tails.append(rest[None].copy())
        else:
            tail = self.tails[low]
            self.tails[low] = np.concatenate((tail[~(rest >= tail).all(axis=1)], rest[None]))
        return low


def front_numbers(runs: DataFrame, keys: list[str], objectives: list[str]) -> DataFrame:
    """``runs`` with ``front``: 0 for rows that no row of their group dominates, 1 for those left without these, and so on.

    A NULL objective is worse than any number. Distinct points of a group are sorted by falling
    objectives and pass through one task as a stream, which carries the tails of the fronts and no
    points; the sort spills, so a group of any size fits. Groups are spread over tasks.
    """
    worst = F.lit(float("-inf"))
    names = [f"_v{i}" for i in range(len(objectives))]
    rated = runs.withColumns({n: F.coalesce(F.col(o).cast("double"), worst) for n, o in zip(names, objectives)})
    points = rated.select(*keys, *names).distinct()
    schema = T.StructType([*points.schema.fields, T.StructField("front", T.IntegerType())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, fronts, step = object(), None, -1
        for batch in batches:
            values = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
            owners = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * len(values)
            out = np.zeros(len(values), np.int32)
            for i, (owner, v) in enumerate(zip(owners, values)):
                if owner != group:
                    group, fronts = owner, _Fronts(len(names))
                    step = -1
                step += 1
                out[i] = fronts.place(v[1:]) if len(names) > 1 else step  # one objective: a front for each value
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "front"])

    order = [F.asc(k) for k in keys] + [F.desc(n) for n in names]
    dealt = points.repartition(*keys) if keys else points.coalesce(1)
    fronts = dealt.sortWithinPartitions(*order).mapInArrow(stream, schema)
    return rated.join(fronts, [*keys, *names]).select(*runs.columns, "front")

"""Helpers shared by the operators: ids, Arrow batches, word hashes and components.

A null id counts as the smallest id. A null text counts as empty. Rows that repeat an id belong to
one document, and each of them gets its own row in a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.session import settle

LEAST_ID = -(2 ** 63)
BATCH_BYTES = 1_000_000  # bytes of text that a task turns into arrays at once; one text is never split
STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
STEP_BACK = np.uint64(pow(int(STEP), -1, 2 ** 64))
SPACES = b" \t\n\r\x0b\x0c"  # \x20 and \x09-\x0D


def key_of(column: str) -> Column:
    """An id as a non-null long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LEAST_ID))


def id_of(key: str) -> Column:
    return F.when(F.col(key) != LEAST_ID, F.col(key))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and ``_text`` alone: other columns of the input, whatever their names, stay out."""
    return docs.select(key_of(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def slices(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of batches with about ``BATCH_BYTES`` of text: rows, bytes of the texts, their offsets."""
    for batch in batches:
        column = pc.fill_null(batch.column(text), "").cast(pa.large_string())
        n = len(column)
        if not n:
            continue
        ends = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
        held = column.buffers()[2]
        data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
        first = 0
        while first < n:
            last = int(np.searchsorted(ends, ends[first] + BATCH_BYTES, side="right")) - 1
            last = min(max(last, first + 1), n)
            yield batch.slice(first, last - first), data[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
            first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Bijection that spreads every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of STEP and of its inverse for exponents below n."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (STEP, STEP_BACK):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers[size] = both[0], both[1]
    return _powers[size]


def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += 32
    return mix(codes + np.uint64(1))


BYTE_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of several texts, and where each text's words begin (n + 1 numbers).

    Words are maximal runs of bytes other than ASCII white space; ``lower`` folds A-Z only.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    starts_text = np.zeros(n + 1, bool)
    starts_text[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | starts_text[1:-1]
    end[:-1] &= ~inside[1:] | starts_text[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[lower][data] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of the word sequences from ``starts`` to ``ends`` (exclusive)."""
    up, down = powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    salted = mix(hashes ^ np.uint64(seed)) if seed else hashes
    np.cumsum(salted * up[:len(hashes)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def contracted(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step on links (u, v) with u > v; both are written tables.

    Every node then points to a smaller one of its own component, so rows with one ``v`` are connected.
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = settle(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .filter("u <> v").distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    return settle(large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def downward(edges: DataFrame) -> DataFrame:
    """Edges (a, b) as links (u, v) from the larger node to the smaller."""
    return edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")


def _unfinished(links: DataFrame) -> bool:
    """Whether some node points to two nodes, or to one that points on."""
    ends = (links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).select(F.col("u").alias("node"), "n", F.lit(0).alias("root"))
            .unionByName(links.groupBy("v").agg(F.lit(0).cast("long").alias("n"), F.lit(1).alias("root")).withColumnRenamed("v", "node")))
    return not ends.groupBy("node").agg(F.sum("n").alias("n"), F.sum("root").alias("root")).filter("n + root > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Node and smallest node of its connected component, for the nodes of ``edges`` (a, b).

    ``edges`` is read several times, so it should come from written tables.
    Alternates large-star and small-star steps, whose rounds grow with the logarithm of the
    component, until every link leads to a root. Each round is a written table, so a lost executor
    repeats one round only.
    """
    links = contracted(downward(edges))
    while _unfinished(links):
        links = contracted(links)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

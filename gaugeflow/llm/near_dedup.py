"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. Each document gets ``HASHES`` minima over its distinct 5-word shingles. Their low ``BITS`` bits
   are packed into six longs; triples of whole minima make ``BANDS`` band keys. A pair at the
   threshold shares no band with probability (1 - 0.75**3)**30, about 1e-7.
2. Documents with equal shingle sets form one class, and its smallest doc_id stands for it.
3. Members of a band bucket are paired with the bucket's smallest and largest member, never with
   each other. Pairs whose collision-corrected estimate from bit counts is at least ``ESTIMATE``
   (six standard deviations below the threshold) are confirmed on their full sets.
4. Buckets that still hold documents of several components are searched again: the documents
   outside the bucket's main component are compared with its members of other components. Estimate
   and full sets are compared inside joins, so only members and links leave them.
5. Components come from star contraction.

Defined cases: a null or empty text has no shingles and is linked with nothing; fewer than five
words make one shingle; a null doc_id is the smallest id; rows that repeat a doc_id are one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import (components, contracted, downward, hash_words, id_and_text, id_of, key_of, mix, run_hashes,
                                  signed, slices)
from gaugeflow.session import settle

SHINGLE = 5
PERCENT = 75
BANDS, ROWS, BITS = 30, 3, 4
HASHES = BANDS * ROWS
LONGS = -(-HASHES * BITS // 64)
ESTIMATE = 0.46
FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
MASKS = mix(np.arange(1001, HASHES + 1001, dtype=np.uint64))
SKETCH = "_id long, n long, s1 long, s2 long, sig array<long>, bands array<long>"


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of several texts (with repeats) and where each text's begin."""
    words, first = hash_words(data, offsets, lower=True)
    lengths = np.diff(first)
    n = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
    bounds = np.concatenate(([0], np.cumsum(n)))
    text = np.repeat(np.arange(len(n)), n)
    starts = np.arange(bounds[-1]) - bounds[:-1][text] + first[:-1][text]
    ends = np.minimum(starts + SHINGLE, first[1:][text])
    return run_hashes(words, starts, ends), bounds


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return (np.concatenate(sets) if sets else hashes), np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in slices(batches):
        hashes, bounds = _distinct(*_shingles(data, offsets))
        n = np.diff(bounds)
        full = np.flatnonzero(n)
        starts = bounds[:-1][full]
        minima = np.zeros((HASHES, len(full)), np.uint64)
        sums = np.zeros((2, len(n)), np.uint64)
        if len(full):
            for k in range(HASHES):
                minima[k] = np.minimum.reduceat((hashes ^ MASKS[k]) * FACTORS[k], starts)
            sums[0, full] = np.add.reduceat(mix(hashes), starts)
            sums[1, full] = np.add.reduceat(mix(hashes ^ MASKS[0]), starts)
        low = mix(minima) & np.uint64((1 << BITS) - 1)
        packed = np.zeros((len(n), LONGS), np.uint64)
        per_long = 64 // BITS
        for k in range(HASHES):
            packed[full, k // per_long] |= low[k] << np.uint64(k % per_long * BITS)
        keys = np.zeros((len(full), BANDS), np.uint64)
        for band in range(BANDS):
            key = np.full(len(full), band + 1, np.uint64)
            for row in range(ROWS):
                key = mix(key ^ minima[band * ROWS + row])
            keys[:, band] = key
        sizes = np.concatenate(([0], np.cumsum(np.where(n > 0, BANDS, 0)))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n), signed(sums[0]), signed(sums[1]),
             pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * LONGS), signed(packed.ravel())),
             pa.ListArray.from_arrays(pa.array(sizes), signed(keys.ravel()))],
            names=["_id", "n", "s1", "s2", "sig", "bands"])


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in slices(batches):
        hashes, bounds = _distinct(*_shingles(data, offsets))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), signed(hashes))],
            names=["_id", "shingles"])


def estimate(a: str, b: str) -> Column:
    """Similarity from two arrays of packed signatures."""
    return _similarity(*[[F.get(c, F.lit(i)) for i in range(LONGS)] for c in (a, b)])


def _similarity(a: list[Column], b: list[Column]) -> Column:
    """Matching groups of bits, corrected for chance matches.

    Joins keep the longs as columns of their own: the condition names each long several times, and
    reading it from an array each time makes the generated code large.
    """
    ones = F.lit(int("1" * (64 // BITS), 1 << BITS))
    unequal = []
    for x, y in zip(a, b):
        z = x.bitwiseXOR(y)
        for shift in (1, 2):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        unequal.append(F.bit_count(z.bitwiseAND(ones)))
    match = 1 - reduce(lambda x, y: x + y, unequal) / F.lit(float(HASHES))
    chance = 2.0 ** -BITS
    return (match - chance) / (1 - chance)


def _alike(a: str, b: str) -> Column:
    """Sizes that allow the threshold, then an estimate that does; ``a`` and ``b`` end the columns' names."""
    n_a, n_b = F.col(f"n{a}"), F.col(f"n{b}")
    signatures = [[F.col(f"sig{i}{end}") for i in range(LONGS)] for end in (a, b)]
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT) & (_similarity(*signatures) >= ESTIMATE)


def _ending(df: DataFrame, end: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}{end}") for c in df.columns])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those similar enough on their full sets."""
    both = (pairs.join(sets.select(F.col("_id").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("_id").alias("b"), F.col("shingles").alias("sb")), "b"))
    return both.filter(_linked("sa", "sb")).select("a", "b")


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    return (texts.join(wanted.hint("merge"), "_id", "left_semi").select("_id", "_text").distinct()
            .mapInArrow(full_sets, "_id long, shingles array<long>"))


def _linked(a: str, b: str) -> Column:
    # 100 * shared >= PERCENT * (|a| + |b| - shared)
    return F.size(F.array_intersect(a, b)).cast("long") * (100 + PERCENT) >= (F.size(a) + F.size(b)) * PERCENT


def _estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    signatures = reps.drop("bands")
    return (pairs.join(_ending(signatures, "_a"), F.col("a") == F.col("_id_a"))
            .join(_ending(signatures, "_b"), F.col("b") == F.col("_id_b"))
            .filter(_alike("_a", "_b")).select("a", "b"))


def _across(members: DataFrame, labels: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of a bucket with different labels; members with one label are connected.

    A pair is looked at in the first band it shares only. Two semi joins keep the members that have
    any partner by the estimate, once each; full sets are attached to these alone and compared
    inside the last join, so what leaves a join are members or links, never pairs.
    """
    placed = settle(members.join(labels, members["_id"] == labels["node"], "left")
                    .select("bucket", "band", "_id", F.coalesce("root", "_id").alias("comp")))
    sizes = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = (sizes.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("most"), F.count(F.lit(1)).alias("k"))
            .filter("k > 1").select("bucket", F.col("most.comp").alias("main")))
    held = settle(placed.join(main, "bucket").join(reps, "_id"))
    minor = held.filter("comp <> main")
    minor = _ending(minor, "_m")
    near = ((F.col("bucket_m") == F.col("bucket")) & (F.col("comp_m") != F.col("comp"))
            & ((F.col("comp") == F.col("main")) | (F.col("_id_m") < F.col("_id"))) & _alike("_m", ""))
    # a band's keys are seeded with its number, so equal keys are of one band
    before = [F.slice(bands, F.lit(1), F.col("band")) for bands in ("bands_m", "bands")]
    shared_first = ~F.arrays_overlap(*before)
    some_minor = settle(minor.join(held.hint("merge"), near, "left_semi"))
    some_held = settle(held.join(minor.hint("merge"), near, "left_semi"))
    left = some_minor.join(sets.select(F.col("_id").alias("_id_m"), F.col("shingles").alias("shingles_m")), "_id_m")
    right = some_held.join(sets, "_id")
    return (left.join(right.hint("merge"), near & shared_first & _linked("shingles_m", "shingles"))
            .select(F.least("_id_m", "_id").alias("a"), F.greatest("_id_m", "_id").alias("b")).distinct())


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, n_shingles, component_id (smallest id of its component), kept."""
    texts = id_and_text(docs, id_col, text_col)
    sketch = settle(texts.mapInArrow(sketches, SKETCH))
    # equal sets have equal signatures and bands, so any row's will do
    reps = settle(sketch.filter("n > 0").groupBy("s1", "s2", "n")
                  .agg(F.min("_id").alias("_id"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
                  .select("_id", "n", "s1", "s2", *[F.get("sig", F.lit(i)).alias(f"sig{i}") for i in range(LONGS)], "bands"))
    placed = settle(sketch.select("_id", "n", "s1", "s2")
                    .join(reps.select("s1", "s2", "n", F.col("_id").alias("rep")), ["s1", "s2", "n"], "left")
                    .select("_id", "n", F.coalesce("rep", "_id").alias("rep")))
    reps = reps.drop("s1", "s2")
    in_bands = reps.select("_id", F.posexplode("bands").alias("band", "bucket"))
    buckets = in_bands.groupBy("bucket").agg(F.min("_id").alias("low"), F.max("_id").alias("high")).filter("low < high")
    members = settle(in_bands.join(buckets, "bucket"))
    paired = (members.select("_id", F.explode(F.array("low", "high")).alias("head")).filter("_id <> head")
              .select(F.least("_id", "head").alias("a"), F.greatest("_id", "head").alias("b")).distinct())
    first = settle(_estimated(paired, reps))
    sets = settle(_sets(texts, members.select("_id").distinct()))
    links = settle(_confirmed(first, sets))
    # ids that stand for several sets (rows that repeat a doc_id) are joined through their copies
    through = placed.filter("_id <> rep").select(F.col("rep").alias("a"), F.col("_id").alias("b")).distinct()
    # one step joins most of a group, and nodes with one label are connected: enough to skip their pairs
    labels = contracted(downward(links)).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    across = settle(_across(members.select("bucket", "band", "_id"), labels, reps, sets))
    comps = components(links.unionByName(across).unionByName(through))
    out = (placed.join(comps, placed["_id"] == comps["node"], "left")
           .select("_id", "n", F.coalesce("root", "_id").alias("comp")))
    return out.select(id_of("_id").alias(id_col), F.col("n").alias("n_shingles"),
                      id_of("comp").alias("component_id"), (F.col("_id") == F.col("comp")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document stands for its component."""
    gone = classes(docs, id_col, text_col).filter("NOT kept").select(key_of(id_col).alias("_gone")).distinct()
    return docs.join(gone, key_of(id_col) == F.col("_gone"), "left_anti")


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))

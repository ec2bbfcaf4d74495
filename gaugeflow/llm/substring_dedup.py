"""Removal of word runs that occur earlier, found by difference-cover anchors.

Two positions of any two texts have a shift below ``PERIOD`` that brings both to cover positions.
So if two windows of ``WINDOW`` words are equal, both hold the same run of ``ANCHOR`` words at some
cover position, and hashing runs at cover positions alone finds every repeated window.

1. Runs at cover positions are hashed and counted; a hash seen twice is a shared anchor.
2. The shared anchors go into a Bloom filter of bounded size. It only chooses which windows are
   looked at: beyond the bound more windows are looked at, and results stay the same.
3. Anchors are extended to the windows around them. For each window's 128-bit hash the smallest
   document that holds it is kept: counting and minimum are combined before the shuffle, so large
   groups of copies do not gather anywhere.
4. Each document gets the windows it holds first. All its other shared windows are removed, and so
   are later occurrences inside the document.

Defined cases: null text has no words; a null doc_id counts as smaller than all others; rows that
repeat a doc_id are the same document, so their windows do not start earlier than each other's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import hash_words, id_and_text, id_of, mix, run_hashes, signed, slices
from gaugeflow.session import settle

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)  # every residue modulo PERIOD is a difference of two of these
ANCHOR = WINDOW - PERIOD + 1
BITS_PER_KEY = 24
MAX_BITS = 1 << 28  # 32 MB
PROBES = 3
SECOND = 0x5851F42D4C957F2D


def _anchors(first: np.ndarray, n_words: int) -> np.ndarray:
    """Cover positions from which a whole anchor fits, in texts that hold a window."""
    at = np.arange(n_words)
    lengths = np.diff(first)
    text = np.repeat(np.arange(len(lengths)), lengths)
    within = at - first[:-1][text]
    on = np.isin(within % PERIOD, COVER) & (within + ANCHOR <= lengths[text]) & (lengths[text] >= WINDOW)
    return at[on]


def _probe_bits(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix(keys ^ np.uint64((i + 1) * SECOND & (2 ** 64 - 1))) & np.uint64(bits - 1) for i in range(PROBES)]


def _hit(keys: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for bit in _probe_bits(keys, len(bloom) * 8):
        found &= (bloom[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return found


def count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, data, offsets in slices(batches):
        words, first = hash_words(data, offsets)
        at = _anchors(first, len(words))
        keys, n = np.unique(run_hashes(words, at, at + ANCHOR), return_counts=True)
        yield pa.RecordBatch.from_arrays([signed(keys), pa.array(n.astype(np.int64))], names=["h", "n"])


def shared_windows(words: np.ndarray, first: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold a shared anchor."""
    at = _anchors(first, len(words))
    if not len(at):
        return at
    at = at[_hit(run_hashes(words, at, at + ANCHOR), bloom)]
    text = np.searchsorted(first, at, side="right") - 1
    low = np.maximum(at - (PERIOD - 1), first[text])
    high = np.minimum(at, first[text + 1] - WINDOW)
    ok = low <= high
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, low[ok], 1)
    np.add.at(steps, high[ok] + 1, -1)
    return np.flatnonzero(np.cumsum(steps[:-1]) > 0)


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """Hashes of the anchors that occur more than once; ``docs`` has _id and _text."""
    return (docs.select("_id", "_text").mapInArrow(count_anchors, "h long, n long")
            .groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h"))


def bloom_filter(keys: DataFrame) -> np.ndarray:
    """Filter over the column ``h`` of a settled table, built in slices by the executors."""
    n = keys.count()
    bits = min(MAX_BITS, 1 << max(20, (BITS_PER_KEY * n).bit_length()))
    parts = max(1, n // 500_000)
    parts = 1 << min(10, parts.bit_length())
    span = bits // parts

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            where = np.unique(np.concatenate(_probe_bits(held, bits)))
            cut = np.searchsorted(where, np.arange(parts + 1, dtype=np.uint64) * np.uint64(span))
            rows = [(i, (where[cut[i]:cut[i + 1]] - np.uint64(i * span)).astype(np.uint32).tobytes())
                    for i in range(parts) if cut[i + 1] > cut[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                names=["part", "bits"])

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(span, np.uint8)
        for some in pdf["bits"]:
            held[np.frombuffer(some, np.uint32)] = 1
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])],
                             "bits": [np.packbits(held, bitorder="little").tobytes()]})

    whole = np.zeros(bits // 8, np.uint8)
    for row in (keys.mapInArrow(place, "part int, bits binary").groupBy("part")
                .applyInPandas(build, "part int, bits binary").toLocalIterator()):  # MAX_BITS in all
        whole[row["part"] * span // 8:(row["part"] + 1) * span // 8] = np.frombuffer(row["bits"], np.uint8)
    return whole


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, n_words, n_removed, kept (the kept words joined by one space), kept_sha256."""
    texts = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    bloom = spark.sparkContext.broadcast(bloom_filter(settle(repeated_anchors(texts))))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            words, first = hash_words(data, offsets)
            at = shared_windows(words, first, bloom.value)
            ids = batch.column(0).to_numpy(zero_copy_only=False)[np.searchsorted(first, at, side="right") - 1]
            one = run_hashes(words, at, at + WINDOW)
            order = np.lexsort((ids, one))
            keep = order[np.concatenate(([True], one[order][1:] != one[order][:-1]))] if len(at) else order
            two = run_hashes(words, at[keep], at[keep] + WINDOW, SECOND)
            yield pa.RecordBatch.from_arrays([signed(one[keep]), signed(two), pa.array(ids[keep])],
                                             names=["w", "w2", "_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            words, first = hash_words(data, offsets)
            at = shared_windows(words, first, bloom.value)
            one = run_hashes(words, at, at + WINDOW).view(np.int64)
            text = np.searchsorted(first, at, side="right") - 1
            bound = np.searchsorted(text, np.arange(batch.num_rows + 1))
            own = batch.column(2)
            steps = np.zeros(len(words) + 1, np.int64)
            for i in np.unique(text):
                here = one[bound[i]:bound[i + 1]]
                held = own[int(i)].values
                earlier = np.ones(len(here), bool)
                if held is not None and len(held):
                    _, first_at = np.unique(here, return_index=True)
                    lead = np.zeros(len(here), bool)
                    lead[first_at] = True
                    earlier = ~(lead & np.isin(here, held.to_numpy(zero_copy_only=False)))
                starts = at[bound[i]:bound[i + 1]][earlier]
                np.add.at(steps, starts, 1)
                np.add.at(steps, starts + WINDOW, -1)
            gone = np.cumsum(steps[:-1]) > 0
            n_gone = np.concatenate(([0], np.cumsum(gone)))
            removed = n_gone[first[1:]] - n_gone[first[:-1]]
            raw, kept = data.tobytes(), []
            for i in range(batch.num_rows):
                some = raw[offsets[i]:offsets[i + 1]].split()
                if removed[i]:
                    some = compress(some, ~gone[first[i]:first[i + 1]])
                kept.append(b" ".join(some))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(first)), pa.array(removed),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["_id", "n_words", "n_removed", "kept_sha256", "kept"])

    firsts = (texts.mapInArrow(candidates, "w long, w2 long, _id long")
              .groupBy("w", "w2").agg(F.min("_id").alias("_id"))
              .groupBy("_id").agg(F.collect_list("w").alias("_own")))
    out = (texts.join(firsts, "_id", "left").select("_id", "_text", "_own")
           .mapInArrow(cut, "_id long, n_words long, n_removed long, kept_sha256 string, kept string"))
    return out.select(id_of("_id").alias(id_col), "n_words", "n_removed", "kept_sha256", "kept")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")

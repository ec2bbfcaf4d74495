"""Removal of repeated runs of lines by a distributed suffix array over line ids.

1. Every line of every document gets a rank: how many lines of the corpus sort before it (by a
   128-bit hash). A rank that one line alone holds is final.
2. Prefix doubling: suffixes that share a rank for their first ``k`` lines are ranked again by the
   rank ``k`` lines further on, for k = 1, 2, 4, ... Only suffixes in shared classes take part, and
   the rounds end when no class splits. The ranks are then the suffix array.
3. Neighbouring classes of the array follow each other's end, so an equality join pairs them. Their
   longest common prefix is found from the longest doubling step down.
4. Classes whose common prefixes reach ``min_lines`` form an interval: one repeated run. Its
   occurrence in the smallest document stays, the lines of later occurrences go.

Classes are counted before they are shuffled and ordered by range slices, so a line that makes up a
third of the corpus is one row where order matters.

Defined cases: a null or empty text has no lines; a null doc_id is the smallest id; equal rows that
repeat a doc_id are one document; a text without repeated runs is returned as it was.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import running_total
from gaugeflow.llm.common import id_and_text, id_of, key_of
from gaugeflow.session import settle

MIN_LINES = 2
SLICE_ROWS = 500_000  # classes ordered in one task
AT = ["_id", "_part"]  # a document: its id and the hash of its text


def _ranked(classes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``start``: the rows of the group's classes that sort before this one."""
    upto = running_total(classes, keys, [F.asc(c) for c in order], "_upto", "n", SLICE_ROWS)
    return upto.withColumn("start", F.col("_upto") - F.col("n")).drop("_upto")


def line_ranks(docs: DataFrame) -> DataFrame:
    """One row per line: document, position, lines from here to the end, rank, size of the class."""
    lines = F.split("_text", "\n", -1)
    rows = settle(
        docs.filter("_text <> ''").select(*AT, "_text").dropDuplicates(AT)
        .select(*AT, F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(x, F.lit(1)).alias("g")))
                .alias("_lines"))
        .select(*AT, F.size("_lines").alias("_n"), F.posexplode("_lines").alias("pos", "_line"))
        .select(*AT, "pos", (F.col("_n") - F.col("pos")).alias("left"), "_line.h", "_line.g"))
    classes = _ranked(settle(rows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"))), [], ["h", "g"])
    return rows.join(classes, ["h", "g"]).select(*AT, "pos", "left", F.col("start").alias("rank"), "n")


def _again(shared: DataFrame, known: DataFrame, step: int) -> tuple[DataFrame, int, int]:
    """Ranks of the suffixes in ``shared`` after twice as many lines; classes, and those of one suffix."""
    ahead = known.select(*AT, (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
    pairs = settle(shared.select(*AT, "pos", "left", "rank").join(ahead, [*AT, "pos"], "left")
                   .withColumn("next", F.coalesce("next", F.lit(-1))))  # no line there: sorts first
    classes = settle(_ranked(settle(pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"))), ["rank"], ["next"]))
    n, single = classes.agg(F.count(F.lit(1)), F.count_if(F.col("n") == 1)).first()
    return (pairs.join(classes, ["rank", "next"])
            .select(*AT, "pos", "left", (F.col("rank") + F.col("start")).alias("rank"), "n")), n, single


def suffix_array(lines: DataFrame, min_lines: int) -> tuple[list[DataFrame], DataFrame]:
    """Shared ranks for each power of two, and the final rank of every suffix that repeats for min_lines."""
    ranked = settle(lines)
    shared, final = ranked.filter("n > 1"), [ranked.filter("n = 1")]
    levels, step, since = [shared], 1, None
    n_classes = shared.select("rank").distinct().count()
    while True:
        if 2 * step > min_lines and since is None:
            since = len(final)  # what is shared now repeats for step lines, and its later parts for more
        known = shared.select(*AT, "pos", "rank")
        for some in final:
            known = known.unionByName(some.select(*AT, "pos", "rank"))
        again, n, single = _again(shared, known, step)
        if n == n_classes and since is not None:
            break  # no class was split, so none will be
        ranked = settle(again)
        step, n_classes = step * 2, n - single
        final.append(ranked.filter("n = 1"))
        shared = ranked.filter("n > 1")
        levels.append(shared)
    for some in final[since:]:
        shared = shared.unionByName(some)
    return levels, shared


def common_prefixes(levels: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    """Classes of equal suffixes in array order, each with its common prefix with the class before."""
    first = F.min(F.struct(*AT, "pos", "left")).alias("at")
    classes = settle(suffixes.groupBy("rank", "n").agg(first).select("rank", "n", "at.*"))
    before = classes.select((F.col("rank") + F.col("n")).alias("rank"),
                            *[F.col(c).alias(f"{c}_b") for c in (*AT, "pos", "left")])
    pairs = settle(classes.join(before, "rank").withColumn("lcp", F.lit(0)))
    for level in range(len(levels) - 1, -1, -1):
        shared = levels[level].select(*AT, "pos", "rank")
        a = shared.select(F.col("_id").alias("ia"), F.col("_part").alias("pa"), F.col("pos").alias("xa"), F.col("rank").alias("ra"))
        b = shared.select(F.col("_id").alias("ib"), F.col("_part").alias("pb"), F.col("pos").alias("xb"), F.col("rank").alias("rb"))
        found = (pairs
                 .join(a, (F.col("_id") == F.col("ia")) & (F.col("_part") == F.col("pa")) & (F.col("pos") + F.col("lcp") == F.col("xa")), "left")
                 .join(b, (F.col("_id_b") == F.col("ib")) & (F.col("_part_b") == F.col("pb")) & (F.col("pos_b") + F.col("lcp") == F.col("xb")), "left"))
        longer = F.when(F.col("ra") == F.col("rb"), F.col("lcp") + (1 << level)).otherwise(F.col("lcp"))
        pairs = settle(found.withColumn("lcp", longer).select(*pairs.columns))
    lengths = pairs.select("rank", F.least("lcp", "left", "left_b").alias("lcp"))
    return classes.join(lengths, "rank", "left").withColumn("lcp", F.coalesce("lcp", F.lit(0)))


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """Starts of runs of ``min_lines`` lines whose text starts earlier elsewhere. ``docs``: _id, _part, _text."""
    levels, suffixes = suffix_array(line_ranks(docs), min_lines)
    suffixes = settle(suffixes.filter(F.col("left") >= min_lines))
    classes = settle(common_prefixes(levels, suffixes).withColumn("head", F.when(F.col("lcp") < min_lines, 1).otherwise(0).cast("long")))
    runs = settle(running_total(classes, [], [F.asc("rank")], "run", "head", SLICE_ROWS))
    first = runs.groupBy("run").agg(F.min(F.struct("_id", "pos")).alias("first"))
    placed = runs.join(first, "run").select("rank", "first")
    here = F.struct("_id", "pos")
    return (suffixes.join(placed, "rank").filter(here > F.col("first"))
            .select(*AT, "pos").distinct())


def _without(text: str, starts: np.ndarray, min_lines: int) -> tuple[str, int, int]:
    """The text without its repeated runs, the lines removed, and the lines of the longest run."""
    lines = text.split("\n")
    steps = np.zeros(len(lines) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + min_lines, -1)
    gone = np.cumsum(steps[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return "\n".join(x for x, out in zip(lines, gone) if not out), int(gone.sum()), int((edges[1::2] - edges[::2]).max())


def _cut(min_lines: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"n_lines": [], "n_removed": [], "longest": [], "kept": [], "kept_sha256": []}
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2)):
                n_lines, removed, longest = text.count("\n") + 1 if text else 0, 0, 0
                if starts.is_valid:
                    text, removed, longest = _without(text, starts.values.to_numpy(zero_copy_only=False), min_lines)
                for name, value in zip(rows, (n_lines, removed, longest, text, hashlib.sha256(text.encode()).hexdigest())):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(rows[c], pa.int64()) for c in ("n_lines", "n_removed", "longest")],
                 pa.array(rows["kept"], pa.string()), pa.array(rows["kept_sha256"], pa.string())],
                names=["_key", *rows])
    return cut


def _part() -> Column:
    return F.xxhash64("_text")


def remove_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_lines: int = MIN_LINES) -> DataFrame:
    """Per row: its id, n_lines, n_removed, longest (lines of its longest removed run), kept, kept_sha256."""
    texts = id_and_text(docs, id_col, text_col).withColumn("_part", _part())
    starts = later_copies(texts, min_lines).groupBy(*AT).agg(F.collect_list("pos").alias("_starts"))
    out = (texts.join(starts, AT, "left").select("_id", "_text", "_starts")
           .mapInArrow(_cut(min_lines), "_key long, n_lines long, n_removed long, longest long, kept string, kept_sha256 string"))
    return out.select(id_of("_key").alias(id_col), "n_lines", "n_removed", "longest", "kept", "kept_sha256")


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with shortened texts; every row stays, and texts without later copies are unchanged."""
    at = docs.columns.index(text_col)
    columns = [f"c{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*columns)
    named = (named.withColumn("_id", key_of(columns[docs.columns.index(id_col)]))
             .withColumn("_text", F.coalesce(F.col(columns[at]), F.lit(""))).withColumn("_part", _part()))
    starts = later_copies(named.select("_id", "_text", "_part"), min_lines).groupBy(*AT).agg(F.collect_list("pos").alias("_starts"))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [batch.column(i) for i in range(len(columns))]
            found = batch.column(len(columns))
            texts = [_without(text, starts.values.to_numpy(zero_copy_only=False), min_lines)[0] if starts.is_valid else text
                     for text, starts in zip(arrays[at].to_pylist(), found)]
            arrays[at] = pa.array(texts, arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    return named.join(starts, AT, "left").select(*columns, "_starts").mapInArrow(replace, docs.toDF(*columns).schema).toDF(*docs.columns)


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_runs(docs).drop("kept")

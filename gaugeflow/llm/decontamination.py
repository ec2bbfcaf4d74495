"""Benchmark decontamination by winnowing, in DataFrame operations only.

A benchmark window is ``WINDOW`` consecutive words of an item, or the whole of a shorter item. Texts
are fingerprinted by winnowing: of every ``WINDOW - GRAM + 1`` consecutive GRAM-word hashes the
smallest is kept, so two texts that share a window share a fingerprint. Items shorter than a window
are fingerprinted by the hash of all their words, and texts then also by their runs of these lengths.

1. Fingerprints of the training texts are joined to those of the benchmark; texts without a common
   fingerprint are done.
2. The hits are extended: windows of the remaining texts are compared with benchmark windows by
   two 64-bit hashes over word hashes, and the words they cover are counted.

The benchmark side is broadcast only after its rows were counted against ``BROADCAST_ROWS``; past
that the joins shuffle.

Defined cases: words are lower-cased in A-Z; null texts have no words; rows that repeat a doc_id
are judged by their own text; a null item_id is named by the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import id_and_text, id_of, key_of
from gaugeflow.session import settle

WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 200_000  # of three numbers each
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
AT = ["_id", "_part"]


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.translate(F.col(text), UPPER, LOWER), NOT_WORD), "")


def _positions(size: int) -> Column:
    """0-based starts of the runs of ``size`` words; none in a shorter text."""
    return F.when(F.col("_n") >= size, F.sequence(F.lit(0), F.col("_n") - size)).otherwise(F.array().cast("array<int>"))


def _hashed(texts: DataFrame, keep: list[str]) -> DataFrame:
    words = texts.select(*keep, words_of("_text").alias("_words"))
    return words.select(*keep, F.size("_words").alias("_n"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))


def _run(start: Column, size: int, *salt: Column) -> Column:
    return F.xxhash64(*[F.get(F.col("_hashes"), start + F.lit(k)) for k in range(size)], *salt)


def fingerprints(hashed: DataFrame, keep: list[str], short: list[int]) -> DataFrame:
    """Adds ``prints``: winnowed hashes, and the hashes of all runs of the lengths in ``short``."""
    grams = hashed.select(*keep, "_n", "_hashes", F.transform(_positions(GRAM), lambda i: _run(i, GRAM)).alias("_grams"))
    least = F.transform(_positions(WINDOW), lambda i: F.least(*[F.get("_grams", i + j) for j in range(WINDOW - GRAM + 1)]))
    parts = [least, *[F.transform(_positions(s), lambda i: _run(i, s, F.lit(s))) for s in short]]
    return grams.select(*keep, "_n", F.array_distinct(F.concat(*parts)).alias("prints"))


def windows(hashed: DataFrame, keep: list[str], sizes: list[int]) -> DataFrame:
    """One row per run of a length in ``sizes``: position, size and two hashes."""
    parts = [F.transform(_positions(s), lambda i: F.struct(
        i.alias("pos"), F.lit(s).alias("size"), _run(i, s).alias("h"), _run(i, s, F.lit(s)).alias("g"))) for s in sizes]
    return hashed.select(*keep, F.explode(F.concat(*parts)).alias("_w")).select(*keep, "_w.*")


def _sized(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id") -> DataFrame:
    """Per row: its id, n_words, n_hit, n_items, items_sha256, contaminated."""
    texts = id_and_text(docs, id_col, text_col).withColumn("_part", F.xxhash64("_text"))
    items = settle(_hashed(benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("_item"),
                                            F.coalesce(F.col(text_col), F.lit("")).alias("_text")), ["_item"]).filter("_n > 0"))
    short = sorted(r[0] for r in items.filter(F.col("_n") < WINDOW).select("_n").distinct().collect())  # lengths below WINDOW
    sizes = [WINDOW, *short]

    def own_length(table: DataFrame, size: Column) -> DataFrame:  # an item is cut at one length only
        return table.filter(size == F.least(F.col("_n"), F.lit(WINDOW)))

    whole, parts = items.filter(F.col("_n") >= WINDOW), items.filter(F.col("_n") < WINDOW)
    prints = fingerprints(whole, ["_item"], [])
    for s in short:
        prints = prints.unionByName(fingerprints(parts.filter(F.col("_n") == s), ["_item"], [s]))
    prints = settle(prints.select(F.explode("prints").alias("print")).distinct())
    spans = settle(own_length(windows(items, ["_item", "_n"], sizes), F.col("size")).select("size", "h", "g", "_item").distinct())

    sketch = settle(fingerprints(_hashed(texts, AT), AT, short))
    met = settle(sketch.select(*AT, F.explode("prints").alias("print")).join(_sized(prints), "print", "left_semi")
                 .select(*AT).distinct())
    near = _hashed(texts.join(met.hint("merge"), AT, "left_semi"), AT)
    hits = windows(near, AT, sizes).join(_sized(spans), ["size", "h", "g"])
    found = hits.groupBy(*AT).agg(F.collect_set(F.struct("pos", "size")).alias("_spans"), F.collect_set("_item").alias("_items"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def cover(state: Column, span: Column) -> Column:
        end = span["pos"] + span["size"]
        new = F.greatest(F.lit(0), end - F.greatest(state["end"], span["pos"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + new).alias("n"))

    hit = F.aggregate(F.array_sort("_spans"), start, cover)["n"]
    judged = found.select(*AT, hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
                          F.array_join(F.array_sort("_items"), ",").alias("_names"))
    out = sketch.select(*AT, F.col("_n").cast("long").alias("n_words")).join(judged, AT, "left")
    none = F.lit(0).cast("long")
    return out.select(id_of("_id").alias(id_col), "n_words", F.coalesce("n_hit", none).alias("n_hit"),
                      F.coalesce("n_items", none).alias("n_items"),
                      F.sha2(F.coalesce("_names", F.lit("")).cast("binary"), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", none) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document holds no benchmark window."""
    gone = (contamination(docs, benchmark, id_col, text_col).filter("contaminated")
            .select(key_of(id_col).alias("_gone")).distinct())
    return docs.join(gone, key_of(id_col) == F.col("_gone"), "left_anti")


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
ORACLE = f"""
with items as (select cast(item_id as varchar) item, {_WORDS} ws from benchmark),
spans as (select distinct item, ws[p + 1:p + least(10, len(ws))] win
          from (select item, ws, unnest(range(0, len(ws) - least(10, len(ws)) + 1)) p from items where len(ws) > 0)),
docs as (select row_number() over () as row, doc_id, {_WORDS} ws from documents),
sizes as (select distinct len(win) s from spans),
runs as (select row, s, p, ws[p + 1:p + s] win from (select row, ws, s, unnest(range(0, len(ws) - s + 1)) p from docs, sizes where len(ws) >= s)),
hits as (select row, p, s, item from runs join spans using (win)),
n_hits as (select row, count(distinct w) n from (select row, unnest(range(p, p + s)) w from hits) group by row),
found as (select row, count(distinct item) n, string_agg(distinct item, ',' order by item) names from hits group by row)
select doc_id, len(ws) n_words, coalesce(h.n, 0) n_hit, coalesce(f.n, 0) n_items, sha256(coalesce(names, '')) items_sha256,
       coalesce(h.n, 0) > 0 contaminated
from docs left join n_hits h using (row) left join found f using (row)
"""

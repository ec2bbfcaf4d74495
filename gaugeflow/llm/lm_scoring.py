"""Cross-entropy difference of documents under matched target and background bigram models.

Both models share the vocabulary, the bigram list and the smoothing; only their counts differ. The
background is the whole table and the target the documents given as examples. Words and bigrams are
counted over all documents, and every one that was counted is in the models, at every size.

    P1(w)   = (c(w) + ADDED) / (N + ADDED * (V + 1))
    P(w|h)  = KEPT * c(h, w) / c(h) + back(h) * P1(w)     (listed bigrams; else the second term)
    back(h) = 1 - KEPT * sum of c(h, w) / c(h) over listed bigrams

A document scores the mean over its words of -log2 P under either model, and their difference:
the lower, the closer to the target. Words are lower-cased in A-Z and split at ASCII white space.

No task holds the models. Documents are written in slices of about ``SLICE_BYTES``. A slice asks once
for each of its distinct words and bigrams and sends its own counts along, as sorted 64-bit hashes
in buckets of the hash; a bucket adds up its hashes over all slices and answers each slice in the
order of its question. So a word that makes up a third of the corpus is one entry of each slice, and
the answers are joined with their slice to score it. Hashes travel as the gaps between them. Two words
or bigrams whose hashes are equal would count as one.

Defined cases: a null or empty text has no words and NULL scores; without target documents the
target counts are zero and its model is uniform; rows that repeat a doc_id are counted and scored
each; target ids that repeat count once. A very long text is a slice of its own and is scored whole.
A table without rows gives none. Order and ties do not matter, and columns other than the id and the
text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach
from gaugeflow.llm.common import STEP, hash_words, id_and_text, id_of, key_of, mix, signed, slices
from gaugeflow.session import settle

SLICE_BYTES = 12_000_000  # text that a task scores at once; one text is never split
BUCKET_BYTES = 16_000_000  # text of the corpus for each bucket of hashes
BUCKETS = 256  # at least
START = np.uint64(0x2545F4914F6CDD1D)  # stands before the first word of a text
COUNTS = ["b", "t", "end_b", "end_t"]  # in background and target; as the last word of a text
ADDED = 0.5
KEPT = 0.7


def _numbered(slice_bytes: int):
    """Adds the slice of a row and its place there; a slice lies in one partition."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place, held = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            numbers, places = [], []
            for size in pc.binary_length(batch.column(1)).to_pylist():
                if held and held + size > slice_bytes:
                    at, place, held = at + 1, 0, 0
                numbers.append(at)
                places.append(place)
                place, held = place + 1, held + size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64()), pa.array(places, pa.int64())],
                                             names=["_id", "_text", "_target", "slice", "place"])
    return number


def _words(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's begin."""
    parts = [hash_words(data, offsets, lower=True) for _, data, offsets in slices(iter(batches))]
    starts = np.cumsum([0] + [len(words) for words, _ in parts])
    first = [f[:-1] + n for (_, f), n in zip(parts, starts)]
    return np.concatenate([words for words, _ in parts]), np.concatenate([*first, starts[-1:]])


def _bigrams(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[first[:-1][np.diff(first) > 0]] = START
    return mix(mix(before + STEP) ^ words)


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _widths(largest: np.ndarray) -> np.ndarray:
    """Bytes that hold each number."""
    return 1 + sum((largest >= np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, 8))


def _gaps(keys: np.ndarray, starts: np.ndarray, lowest: np.ndarray) -> pa.Array:
    """Sorted keys between starts as gaps, the first from the lowest key of its bucket, in as many bytes as the widest needs."""
    gaps = np.diff(keys, prepend=keys[:1])
    gaps[starts] = keys[starts] - lowest
    widths, sizes = _widths(np.maximum.reduceat(gaps, starts)), np.diff(np.append(starts, len(keys)))
    held = gaps.view(np.uint8).reshape(-1, 8)[np.arange(8) < np.repeat(widths, sizes)[:, None]]
    return _binaries(held, np.concatenate(([0], np.cumsum(widths * sizes))))


def _ungapped(binaries: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Keys above the lowest of their bucket."""
    widths = np.array([len(x) for x in binaries]) // sizes
    gaps = np.zeros((sizes.sum(), 8), np.uint8)
    gaps[np.arange(8) < np.repeat(widths, sizes)[:, None]] = np.frombuffer(b"".join(binaries), np.uint8)
    gaps = gaps.view(np.uint64).ravel()
    sums, starts = np.cumsum(gaps), np.cumsum(sizes) - sizes
    return sums - np.repeat(sums[starts] - gaps[starts], sizes)  # modulo 2^64


def _packed(counts: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Counts between bounds as binaries: a byte each, and behind them those of 255 and more."""
    small, large = np.minimum(counts, 255).astype(np.uint8), counts.astype(np.int64)
    if not len(counts) or small.max() < 255:
        return _binaries(small, bounds)
    at = zip(bounds[:-1].tolist(), bounds[1:].tolist())
    return pa.array([small[a:b].tobytes() + large[a:b][small[a:b] == 255].tobytes() for a, b in at], pa.binary())


def _unpacked(binaries: list[bytes], sizes: np.ndarray) -> np.ndarray:
    sizes = sizes.tolist()
    counts = np.frombuffer(b"".join(x[:n] for x, n in zip(binaries, sizes)), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(b"".join(x[n:] for x, n in zip(binaries, sizes)), np.int64)
    return counts


QUESTION = "kind int, bucket long, slice long, first long, size long, keys binary, b binary, t binary, end_b binary, end_t binary"
ANSWER = ("kind int, bucket long, slice long, first long, size long, b binary, t binary, end_b binary, end_t binary, "
          "n_keys long, n_b long, n_t long, n_end_b long, n_end_t long")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _asked(kind: int, number: int, place: int, keys: np.ndarray, counts: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """A slice's question to each bucket: its sorted keys there and their counts in the slice."""
    of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    asked, starts = np.unique(of, return_index=True)
    bounds = np.concatenate((starts, [len(keys)]))
    lowest = ((asked << np.uint64(32)) + np.uint64(buckets - 1)) // np.uint64(buckets) << np.uint64(32)
    n = len(asked)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), signed(asked), pa.array(np.full(n, number, np.int64)), pa.array(np.full(n, place, np.int64)),
         pa.array(np.diff(bounds)), _gaps(keys, starts, lowest), *[_packed(c, bounds) for c in counts],
         *[pa.nulls(n, pa.binary())] * (4 - len(counts))], names=_names(QUESTION))


def _asking(kind: int, buckets: int):
    def questions(number: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, first = _words(held)
        if not len(words):
            return
        n, place = np.diff(first), held[0].column("place")[0].as_py()
        target = np.repeat(np.concatenate([b.column("_target").to_numpy(zero_copy_only=False) for b in held]).astype(bool), n)
        last = first[1:][n > 0] - 1
        if kind:
            words = _bigrams(words, first)
        keys, at = np.unique(words, return_inverse=True)
        places = [at, at[target]] if kind else [at, at[target], at[last], at[last[target[last]]]]
        yield _asked(kind, number, place, keys, [np.bincount(x, minlength=len(keys)) for x in places], buckets)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []
        for batch in batches:
            numbers = batch.column("slice").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if held and numbers[a] != number:
                    yield from questions(number, held)
                    held = []
                number = int(numbers[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from questions(number, held)
    return ask


def _answered(asked: pa.Table) -> pa.Table:
    """A bucket's answers, the counts of all slices, and one row of its totals without a slice."""
    sizes = asked.column("size").to_numpy()
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    keys, at = np.unique(_ungapped(asked.column("keys").to_pylist(), sizes), return_inverse=True)
    n, found, totals = len(sizes), [], []
    for name in COUNTS:
        if asked.column(name).null_count:  # bigrams don't end texts
            found.append(pa.nulls(n, pa.binary()))
            totals.append(0)
            continue
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, _unpacked(asked.column(name).to_pylist(), sizes))
        found.append(_packed(total[at], bounds))
        totals.append(int(total.sum()))
    same = ["kind", "bucket", "slice", "first", "size"]
    answers = pa.Table.from_arrays([*[asked.column(c).combine_chunks() for c in same], *found, *[pa.nulls(n, pa.int64())] * 5], names=_names(ANSWER))
    summary = pa.Table.from_arrays(
        [asked.column("kind").combine_chunks()[:1], asked.column("bucket").combine_chunks()[:1], *[pa.nulls(1, pa.int64())] * 3,
         *[pa.nulls(1, pa.binary())] * 4, *[pa.array([x], pa.int64()) for x in (len(keys), *totals)]], names=_names(ANSWER))
    return pa.concat_tables([answers, summary])


def _losses(words: np.ndarray, first: np.ndarray, answers: dict[int, list[np.ndarray]], n_words: int,
            totals: tuple[int, int], texts: tuple[int, int]) -> list[np.ndarray]:
    """Mean loss per word of each text in background and target from the counts of its words and bigrams."""
    n = np.diff(first)
    at = np.unique(words, return_inverse=True)[1]
    pair = np.unique(_bigrams(words, first), return_inverse=True)[1]
    some = n > 0
    out = []
    for i in (0, 1):
        count, end = answers[0][i], answers[0][i + 2]
        before = np.empty_like(at)
        before[1:] = at[:-1]
        before[first[:-1][some]] = len(count)
        uses = np.concatenate((count, [texts[i]])).astype(np.float64)
        followed = np.concatenate((count - end, [texts[i]])) / np.maximum(uses, 1)
        single = (count + ADDED) / (totals[i] + ADDED * (n_words + 1))
        p = KEPT * answers[1][i][pair] / np.maximum(uses, 1)[before] + (1 - KEPT * followed)[before] * single[at]
        total = np.full(len(n), np.nan)
        if some.any():
            total[some] = np.add.reduceat(-np.log2(p), first[:-1][some]) / n[some]
        out.append(total)
    return out


SCORES = "_id long, n_words long, ce_target double, ce_background double, ce_diff double"


def _scores_of(ids: pa.Array, n: np.ndarray, b: np.ndarray, t: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, pa.array(n), *[pa.array(x, from_pandas=True) for x in (t, b, t - b)]], names=_names(SCORES))


def _scoring(n_words: int, totals: tuple[int, int], texts: tuple[int, int]):
    def scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """One slice: its rows in order, cut where a question began."""
        docs = docs.sort_by("place")
        answers = answers.sort_by([("first", "ascending"), ("kind", "ascending"), ("bucket", "ascending")])
        place, begun = docs.column("place").to_numpy(), answers.column("first").to_numpy()
        kind, sizes = answers.column("kind").to_numpy(), answers.column("size").to_numpy()
        cuts = [0, *np.searchsorted(place, np.unique(begun)).tolist(), len(place)]
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            rows = docs.slice(a, b - a).combine_chunks()
            words, first = _words(rows.select(["_id", "_text"]).to_batches())
            found = {}
            for k in (0, 1):
                mine = np.flatnonzero((begun == place[a]) & (kind == k))
                found[k] = [_unpacked(answers.column(c).take(mine).to_pylist(), sizes[mine]) for c in COUNTS[:4 - 2 * k]]
            b, t = _losses(words, first, found, n_words, totals, texts)
            out.append(_scores_of(rows.column("_id").combine_chunks(), np.diff(first), b, t))
        return pa.Table.from_batches(out)
    return scored


def _score_all(texts: DataFrame, wanted: DataFrame, slice_bytes: int, buckets: int) -> DataFrame:
    flagged = attach(texts, settle(wanted.withColumn("_target", F.lit(True))), ["_id"], "left").select(
        "_id", "_text", F.col("_target").isNotNull().alias("_target"))
    docs = settle(flagged.mapInArrow(_numbered(slice_bytes), "_id long, _text string, _target boolean, slice long, place long"))
    size = docs.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    buckets = max(buckets, size // BUCKET_BYTES)
    words, pairs = (docs.mapInArrow(_asking(kind, buckets), QUESTION).groupBy("kind", "bucket").applyInArrow(_answered, ANSWER)
                    for kind in (0, 1))
    words = settle(words)
    n_words, *sums = words.filter("slice is null").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in _names(ANSWER)[-5:]]).first()
    answers = words.unionByName(pairs).filter("slice is not null").select("kind", "bucket", "slice", "first", "size", *COUNTS)
    return docs.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        _scoring(n_words, (sums[0], sums[1]), (sums[2], sums[3])), SCORES)


def score(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          slice_bytes: int = SLICE_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """Per row: its id, n_words, ce_target, ce_background, ce_diff. ``target_ids`` has the id column."""
    texts = id_and_text(docs, id_col, text_col)
    wanted = target_ids.filter(F.col(id_col).isNotNull()).select(key_of(id_col).alias("_id")).distinct()
    return _score_all(texts, wanted, slice_bytes, buckets).select(id_of("_id").alias(id_col), "n_words", "ce_target", "ce_background", "ce_diff")


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Target: the documents labelled of good quality."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    scored = score(docs, good)
    return scored.select("doc_id", "n_words", *[F.round(c, 6).alias(c) for c in ("ce_target", "ce_background", "ce_diff")])


ORACLE = f"""
with words as (
  select row, doc_id, unnest(ws) w, generate_subscripts(ws, 1) p
  from (select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') ws from documents)),
flagged as (select words.*, doc_id in (select doc_id from labels where quality = 1) is_target from words),
totals as (select count(*) nb, count(*) filter (is_target) nt,
           count(*) filter (p = 1) hb, count(*) filter (p = 1 and is_target) ht from flagged),
counts as (select w, count(*) cb, count(*) filter (is_target) ct from flagged group by w),
size as (select count(*) v from counts),
pairs as (select *, coalesce(lag(w) over (partition by row order by p), ' ') h from flagged),
listed as (select h, w, count(*) cb, count(*) filter (is_target) ct from pairs group by 1, 2),
single as (select w, (cb + {ADDED}) / (nb + {ADDED} * (v + 1)) pb, (ct + {ADDED}) / (nt + {ADDED} * (v + 1)) pt from counts, totals, size),
before as (select w h, cb, ct from counts union all select ' ', hb, ht from totals),
shares as (select l.h, l.w, {KEPT} * coalesce(l.cb / nullif(b.cb, 0), 0) sb, {KEPT} * coalesce(l.ct / nullif(b.ct, 0), 0) st
           from listed l join before b using (h)),
back as (select h, 1 - sum(sb) kb, 1 - sum(st) kt from shares group by h),
losses as (select row, doc_id,
             -log2(coalesce(kb, 1) * pb + coalesce(sb, 0)) lb, -log2(coalesce(kt, 1) * pt + coalesce(st, 0)) lt
           from pairs join single using (w) left join back using (h) left join shares using (h, w)),
scores as (select row, count(*) n, avg(lt) t, avg(lb) b from losses group by row)
select d.doc_id, coalesce(n, 0) n_words, round(t, 6) ce_target, round(b, 6) ce_background, round(t - b, 6) ce_diff
from (select row_number() over () as row, doc_id from documents) d left join scores using (row)
"""

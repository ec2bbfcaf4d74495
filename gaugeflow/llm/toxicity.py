"""Toxicity by a weighted finite-state grammar over clauses.

A word becomes a symbol: insult (with a weight), threat, target, negation, reported speech or other.
Insults are learned from labelled documents: whole words and word beginnings whose document
frequency differs between toxic and clean documents, counted only where a clause could match.
Transducers follow a clause forwards (negation for three words, target for four, reported speech,
company of other words) and backwards (target, reported speech, company). Each direction is composed
into one table of states; the pair of states around an insult or threat picks its channel:
aimed (a target near it), predicated (no target, but at least ``COMPANY`` other words in the clause),
negated, reported, or threat (at a target). A word that stands alone matches nothing, so it scores
like the empty text. Channel sums enter a logistic model whose weights are ordered, whatever the
labels say: aimed above predicated above negated and reported, and all above zero. Channels that the
labelled rows never show (threats, say) keep their ``PRIOR``.

The fit reads at most ``SAMPLE`` labelled rows, those with the smallest hash of doc_id; equal texts
count once in the lexicon. Scoring reads every whole text and nothing but the text.

Defined cases: a null or empty text scores like a text without matches; a very long text is read
clause by clause, clauses without insult or threat only once; null labels are not used; without
labels every score is 0.5; an empty table gives an empty result; rows that repeat a doc_id are
scored each; a label that repeats a doc_id counts as often as it matches, up to ``SAMPLE`` rows in
all, ties by features; columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import id_and_text, id_of, key_of

SAMPLE = 20_000
LEAST_EVIDENCE = 30.0  # likelihood ratio of an entry's document counts
LEAST_WEIGHT = 4.0  # logarithm of the odds ratio
BEGINNINGS = (4, 5, 6)
COMPANY = 2  # other words that make a clause of an insult without a target
REJECT = 0.7
CACHE = 300_000  # words whose symbol a task remembers

# fixed words of the grammar
TARGETS = frozenset("you your yourself u he she they him her them du dich dir ihr euch sie er tu toi te vous il elle "
                    "ils elles usted ustedes tú él ella ellos ellas".split())
NEGATIONS = frozenset("not no never neither nor without nicht nie kein keine keinen niemals pas jamais ni sans nunca "
                      "jamás sin tampoco".split())
REPORTS = frozenset("said says saying wrote called quoted claims reported sagte schrieb meinte nannte dit écrit "
                    "appelé déclaré dijo escribió llamó".split())
THREATS = frozenset("kill hurt destroy shoot stab strangle murder töten umbringen verletzen tuer frapper détruire "
                    "matar golpear destruir".split())

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CHANNELS = ("predicated", "aimed", "negated", "reported", "threat")
PREDICATED, AIMED, NEGATED, REPORTED, THREATENED = range(5)
# steps from one channel's weight to the next: negated, reported, from these to predicated, from that to aimed, threat
STEPS = np.array([[1, 1, 1, 0, 0], [1, 1, 1, 1, 0], [1, 0, 0, 0, 0], [0, 1, 0, 0, 0], [0, 0, 0, 0, 1]], float)
PRIOR = np.array([0.1, 0.1, 0.6, 0.4, 1.0])
LEAST_STEP = 0.05
NEGATION_SPAN, TARGET_SPAN = 3, 4
WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[^.!?;:|\n]+")


class Transducer(NamedTuple):
    """Next state by state and symbol; whether its mark is on in a state."""

    follow: list[list[int]]
    on: list[bool]


def countdown(symbol: int, span: int) -> Transducer:
    """On for ``span`` words after the symbol."""
    follow = [[span if s == symbol else max(left - 1, 0) for s in range(6)] for left in range(span + 1)]
    return Transducer(follow, [left > 0 for left in range(span + 1)])


def latch(symbol: int) -> Transducer:
    """On from the symbol to the end of the clause."""
    return Transducer([[int(on or s == symbol) for s in range(6)] for on in (0, 1)], [False, True])


def company() -> Transducer:
    """Words so far, up to ``COMPANY``."""
    return Transducer([[min(k + 1, COMPANY)] * 6 for k in range(COMPANY + 1)], [k > 0 for k in range(COMPANY + 1)])


def product_of(parts: list[Transducer]) -> tuple[list[tuple[int, ...]], list[list[int]]]:
    """States of the composition and its next state by state and symbol."""
    states = list(product(*(range(len(p.on)) for p in parts)))
    number = {s: i for i, s in enumerate(states)}
    return states, [[number[tuple(p.follow[k][s] for p, k in zip(parts, state))] for s in range(6)] for state in states]


def composed() -> tuple[list[list[int]], list[list[int]], list]:
    """Next states forwards and backwards, and the channel of state, symbol and state (-1: none)."""
    negation, target, report, words = countdown(NEGATION, NEGATION_SPAN), countdown(TARGET, TARGET_SPAN), latch(REPORT), company()
    before, ahead = product_of([negation, target, report, words])
    after, behind = product_of([target, report, words])
    channel = [[[-1] * len(after) for _ in range(6)] for _ in before]
    for i, (n, t, r, k) in enumerate(before):
        for j, (t2, r2, k2) in enumerate(after):
            aimed = target.on[t] or target.on[t2]
            marked = REPORTED if report.on[r] or report.on[r2] else NEGATED if negation.on[n] else None
            if aimed or k + k2 >= COMPANY:
                channel[i][INSULT][j] = marked if marked is not None else AIMED if aimed else PREDICATED
            if aimed:
                channel[i][THREAT][j] = marked if marked is not None else THREATENED
    return ahead, behind, channel


AHEAD, BEHIND, CHANNEL = composed()


def matched(symbols: list[int]) -> list[int]:
    """Channel of each symbol of one clause."""
    after = [0] * len(symbols)
    for i in range(len(symbols) - 1, 0, -1):
        after[i - 1] = BEHIND[after[i]][symbols[i]]
    out, state = [], 0
    for s, end in zip(symbols, after):
        out.append(CHANNEL[state][s][end])
        state = AHEAD[state][s]
    return out


def entries_of(word: str) -> list[str]:
    return [f"={word}", *[word[:k] for k in BEGINNINGS if len(word) >= k]]


def matchable(words: list[str]) -> list[str]:
    """Words of a clause that would match as insults: there is enough company or a target."""
    return words if len(words) > COMPANY or any(w in TARGETS for w in words) else []


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


class Grammar:
    """Lexicon and logistic weights; matches texts."""

    def __init__(self, lexicon: dict[str, float], weights: np.ndarray | None = None):
        self.lexicon, self.weights = lexicon, weights
        self.seen: dict[str, tuple[int, float]] = {}

    def __getstate__(self):
        return {"lexicon": self.lexicon, "weights": self.weights, "seen": {}}

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.seen.get(word)
        if found is None:
            weight = max((self.lexicon.get(e, 0.0) for e in entries_of(word)), default=0.0)
            found = ((INSULT, weight) if weight else (THREAT, LEAST_WEIGHT) if word in THREATS
                     else (TARGET, 0.0) if word in TARGETS else (NEGATION, 0.0) if word in NEGATIONS
                     else (REPORT, 0.0) if word in REPORTS else (OTHER, 0.0))
            if len(self.seen) >= CACHE:
                self.seen.clear()
            self.seen[word] = found
        return found

    def channels(self, text: str) -> list[float]:
        """Sum of the weights of the matches in each channel."""
        out = [0.0] * len(CHANNELS)
        text = text.lower()
        symbol = self.symbol
        if not any(symbol(w)[1] for w in set(WORD.findall(text))):
            return out
        for clause in CLAUSE.finditer(text):
            found = [symbol(w) for w in WORD.findall(clause[0])]
            if any(weight for _, weight in found):
                for (_, weight), to in zip(found, matched([s for s, _ in found])):
                    if to >= 0:
                        out[to] += weight
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(design(features) @ self.weights, -30, 30)))


def design(features: np.ndarray) -> np.ndarray:
    features = np.asarray(features, float).reshape(-1, len(CHANNELS))
    return np.column_stack([np.ones(len(features)), np.log1p(features)])


def ordered_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Penalised maximum likelihood of intercept and channel weights, by projected Newton steps.

    The weights are sums of steps of at least ``LEAST_STEP``, drawn to ``PRIOR`` by the ridge.
    """
    x = np.column_stack([x[:, 0], x[:, 1:] @ STEPS])
    low = np.r_[-np.inf, np.full(len(PRIOR), LEAST_STEP)]
    middle, penalty = np.r_[0.0, PRIOR], np.r_[1e-6, np.full(len(PRIOR), ridge)]
    v = middle.copy()

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((np.logaddexp(0, z) - y * z).sum() + (penalty * (v - middle) ** 2).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        slope = x.T @ (p - y) + penalty * (v - middle)
        free = ~((v <= low) & (slope > 0))
        bend = ((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty))[np.ix_(free, free)]
        step, size, before = np.zeros(len(v)), 1.0, loss(v)
        step[free] = np.linalg.solve(bend, slope[free])
        while size > 1e-6 and loss(np.maximum(v - size * step, low)) > before:
            size /= 2
        new = np.maximum(v - size * step, low)
        if np.abs(new - v).max() < 1e-9 or size <= 1e-6:
            break
        v = new
    return np.r_[v[0], STEPS @ v[1:]]


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    for text in batch.column(1):
        yield text.as_py() or ""


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = (Counter(), Counter())
        for text, toxic in zip(_texts(batch), batch.column(2).to_pylist()):
            words = {w for clause in CLAUSE.findall(text.lower()) for w in matchable(WORD.findall(clause))}
            held[toxic].update({e for w in words for e in entries_of(w)})
        names = list(held[0].keys() | held[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([c[e] for e in names], pa.int64()) for c in held]], names=["entry", "c", "t"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    """Learns from labelled rows (id, toxic) that are not held out."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    sample = (usable.select(key_of(id_col).alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
              .orderBy(F.xxhash64("_id"), "_id", "_toxic").limit(SAMPLE))
    rows = sample.collect()  # at most SAMPLE pairs of numbers
    known = docs.sparkSession.createDataFrame(rows, "_id long, _toxic int")
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(known), "_id").select("_id", "_text", "_toxic")
    toxic, clean = (sum(r["_toxic"] == v for r in rows) for v in (1, 0))
    if not toxic or not clean:  # nothing to learn from
        return Grammar({}, np.zeros(1 + len(CHANNELS)))
    distinct = texts.dropDuplicates(["_text"])  # copies of one text are one piece of evidence
    counts = distinct.mapInArrow(_entry_counts, "entry string, c long, t long").groupBy("entry").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    share = toxic / (toxic + clean)
    seen = F.col("t") + F.col("c")

    def part(n: Column, expected: float) -> Column:
        return F.when(n > 0, n * F.ln(n / (seen * expected))).otherwise(0.0)

    weight = F.ln((F.col("t") + 0.5) / (toxic + 1)) - F.ln((F.col("c") + 0.5) / (clean + 1))
    evidence = 2 * (part(F.col("t"), share) + part(F.col("c"), 1 - share))
    kept = (counts.withColumn("weight", weight).withColumn("evidence", evidence)
            .filter((F.col("weight") >= LEAST_WEIGHT) & (F.col("evidence") >= LEAST_EVIDENCE))
            .select("entry", "weight").collect())  # entries of at most SAMPLE texts that many of them share
    grammar = Grammar({r["entry"]: r["weight"] for r in kept})
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([shared.value.channels(t) for t in _texts(batch)]).reshape(-1, len(CHANNELS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in found.T], batch.column(2)], names=["id", *CHANNELS, "toxic"])

    rated = texts.mapInArrow(features, "id long, " + ", ".join(f"{c} double" for c in CHANNELS) + ", toxic int")
    table = rated.orderBy(F.xxhash64("id"), *rated.columns).limit(SAMPLE).toArrow()  # numbers only
    x = np.column_stack([table.column(c).to_numpy() for c in CHANNELS])
    y = table.column("toxic").to_numpy().astype(float)
    grammar.weights = ordered_logistic(design(x), y)
    return grammar


def _scored(grammar, batch: pa.RecordBatch) -> np.ndarray:
    return grammar.score(np.array([grammar.channels(t) for t in _texts(batch)]).reshape(-1, len(CHANNELS)))


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scored(shared.value, batch))], names=["_id", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "_id long, score double").select(id_of("_id").alias(id_col), "score")


def drop_toxic(docs: DataFrame, grammar: Grammar, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that score below ``reject``, whole and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    columns = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = _scored(shared.value, batch.select([at, at])) < reject
            yield batch.filter(pa.array(keep))

    return docs.toDF(*columns).mapInArrow(run, docs.toDF(*columns).schema).toDF(*docs.columns)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    grammar = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, grammar).select("doc_id", held_out().alias("held_out"), "score",
                                       (F.col("score") >= REJECT).cast("int").alias("predicted"))

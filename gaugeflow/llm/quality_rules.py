"""Quality rules as a learned decision list, in DataFrame operations only.

1. Every document gets plain statistics (words, symbols, repeated lines and word windows, capitals,
   marks and so on) from its own row; shares of them are the features of the rules.
2. Sequential covering on labelled statistics: a rule grows by the threshold condition with the
   largest information gain over the rows it still covers, until it covers no good row of the
   growing part. Its last conditions are pruned while that helps on the pruning part. A rule that is
   precise enough there joins the list, the rows it covers leave, and the next rule is grown. One
   that is not precise enough is grown again without the feature it began with.
3. The list becomes one ordered conditional expression: the first rule that holds rejects a
   document, and a document that no rule reaches is kept.

Each growing step is one aggregation of (feature, bin) counts; only these counts, and the bin
limits, come to the driver. Learning reads at most ``SAMPLE`` labelled rows, chosen by digest from
all that are not held out (crc32 of the id modulo 3 is 1). Everything else covers all rows.

Defined cases: a null text is empty and has no words; texts below ``LEAST_WORDS`` words fail the
base rule; shares of a text without words are 0; rows that repeat an id are judged by their own
text, and in learning each counts; labels other than 0 and 1 are left out; without labels, or with
labels of one kind, the list is empty and only the base rule rejects; ties in gain go to the earlier
feature, then to "at least", then to the lower limit; an empty table gives an empty result; other
columns of the input, whatever their names, are left out. A very long text costs sorting its word
windows inside its row, whose arrays hold about 100 bytes a word.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import id_and_text, id_of
from gaugeflow.session import settle

LEAST_WORDS, MOST_REPEATED = 50, 50  # base rule: words, per cent of words in repeated windows
RUN = 3
SPACE = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
SAMPLE = 20_000  # labelled rows read at most
BINS = 64
MOST_CONDITIONS, MOST_RULES = 4, 12  # size of a rule and of the list
PRECISION = 0.9  # share of bad rows among those a rule covers, on the pruning part
PRUNING = 3  # one labelled row of so many prunes
#: Features by name, over the statistics.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "repeated_line_share": "n_dup_lines / n_lines",
    "repeated_word_share": "n_repeat_words / n_words",
    "distinct_word_share": "n_distinct_words / n_words",
    "capital_share": "n_capitals / word_chars",
    "digit_share": "n_digits / word_chars",
    "marks_per_word": "n_marks / n_words",
    "exclamations_per_word": "n_exclamations / n_words",
    "words_per_line": "n_words / n_lines",
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _left(text: Column, others: str) -> Column:
    """Code points of ``text`` that the pattern ``others`` doesn't take."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _covered(starts: Column) -> Column:
    """Words in the union of the windows that begin at ``starts`` (sorted)."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, at: Column) -> Column:
        new = F.least(F.lit(RUN), at + RUN - state["end"])
        return F.struct((at + RUN).alias("end"), (state["n"] + new).alias("n"))

    return F.aggregate(starts, none, add)["n"]


def _repeated_words(words: Column) -> Column:
    """Words inside windows of ``RUN`` words that occur twice or more in the text."""
    def places(runs: Column) -> Column:
        ordered = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def pairs(s: Column) -> Column:
            some = F.size(s) - 1
            return F.zip_with(F.slice(s, F.lit(1), some), F.slice(s, F.lit(2), some),
                              lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))

        twice = F.filter(_let(ordered, pairs), lambda p: p.isNotNull())
        return _covered(F.sort_array(F.array_distinct(F.flatten(twice))))

    def count(hashes: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(hashes) - RUN),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(RUN)]))
        return _let(runs, lambda r: F.when(F.size(F.array_distinct(r)) < F.size(r), places(r)).otherwise(F.lit(0).cast("long")))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > RUN, _let(hashes, count)).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and the counts of every row."""
    text, lines, words = F.col("_text"), F.col("_lines"), F.col("_words")
    size = lambda c: F.size(c).cast("long")
    split = id_and_text(docs, id_col, text_col).select(
        "_id", "_text", F.array_remove(F.split(text, SPACE), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    return split.select(
        "_id", size(words).alias("n_words"), _left(text, SPACE).alias("word_chars"), _left(text, NOT_SYMBOL).alias("n_symbols"),
        (size(lines) - size(F.array_distinct(lines))).alias("n_dup_lines"), _repeated_words(words).alias("n_repeat_words"),
        size(lines).alias("n_lines"), size(F.array_distinct(words)).alias("n_distinct_words"), _left(text, r"\P{Lu}+").alias("n_capitals"),
        _left(text, r"\P{Nd}+").alias("n_digits"), _left(text, r"\P{P}+").alias("n_marks"), _left(text, "[^!]+").alias("n_exclamations"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def features() -> list[Column]:
    """The features as doubles; a share of nothing is 0."""
    def of(rule: str) -> Column:
        top, _, bottom = rule.partition(" / ")
        value = F.col(top).cast("double")
        return F.when(F.col(bottom) > 0, value / F.col(bottom)).otherwise(F.lit(0.0)) if bottom else value

    return [of(rule).alias(name) for name, rule in FEATURES.items()]


@dataclass(frozen=True)
class Condition:
    """``feature >= limit``, or ``feature < limit``."""
    feature: str
    at_least: bool
    limit: float

    def expression(self) -> Column:
        value = F.col(self.feature)
        return value >= F.lit(self.limit) if self.at_least else value < F.lit(self.limit)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.limit:.6g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    return reduce(lambda x, y: x & y, [c.expression() for c in rule], F.lit(True))


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1); 0 if none does."""
    if not rules:
        return F.lit(0)
    cases = F.when(holds(rules[0]), F.lit(1))
    for i, rule in enumerate(rules[1:], 2):
        cases = cases.when(holds(rule), F.lit(i))
    return cases.otherwise(F.lit(0))


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Features, ``bad`` and ``prunes`` of labelled rows that pass the base rule; a written table of ``sample`` rows at most.

    Ids are chosen by digest before texts are read, so that the join meets a bounded set of them;
    the rows are bounded again after it, as an id may repeat.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("_label_id"), F.col(label_col).alias("_label")).filter(
        F.col("_label").isin(0, 1) & F.col("_label_id").isNotNull() & ~held_out("_label_id")).distinct()
    chosen = settle(marks.orderBy(F.xxhash64("_label_id", F.lit(1)), "_label_id", "_label").limit(sample))
    texts = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_body"))
    met = texts.join(F.broadcast(chosen.select(F.col("_label_id").alias("_doc")).distinct()), "_doc", "left_semi")
    found = statistics(met, "_doc", "_body").join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))
    names = list(FEATURES)
    rows = found.filter(~base_failed()).select("_id", (F.col("_label") == 0).alias("bad"), *features())
    order = [F.xxhash64("_id", F.lit(1)), F.col("_id"), F.col("bad"), *names]
    prunes = F.pmod(F.xxhash64("_id", F.lit(2)), F.lit(PRUNING)) == 0
    return settle(rows.orderBy(*order).limit(sample).withColumn("prunes", prunes).drop("_id"))


def limits(rows: DataFrame, bins: int = BINS) -> dict[str, list[float]]:
    """Thresholds of each feature: its distinct quantiles over the labelled rows, without the least value."""
    names = list(FEATURES)
    grid = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(n, grid, 100_000).alias(n) for n in names], *[F.min(n).alias(f"_{n}") for n in names]).first()
    return {n: sorted({x for x in found[n] or [] if x > found[f"_{n}"]}) for n in names}


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """Information gained about the bad rows that a condition keeps."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def best_condition(counts: dict[tuple[str, int], tuple[int, int]], bounds: dict[str, list[float]]) -> tuple[float, Condition | None]:
    """Gain and condition from counts (bad, good) by feature and bin; a bin's number is how many limits a value reaches."""
    best: tuple[float, Condition | None] = (0.0, None)
    for name, cuts in bounds.items():
        bins = [counts.get((name, i), (0, 0)) for i in range(len(cuts) + 1)]
        bad0, good0 = sum(b for b, _ in bins), sum(g for _, g in bins)
        below, below_at = (0, 0), []
        for b, g in bins[:-1]:
            below = (below[0] + b, below[1] + g)
            below_at.append(below)
        for at_least in (True, False):
            for limit, (b, g) in zip(cuts, below_at):
                gain = _gain(bad0 - b, good0 - g, bad0, good0) if at_least else _gain(b, g, bad0, good0)
                if gain > best[0] + 1e-9:
                    best = (gain, Condition(name, at_least, limit))
    return best


def _bins(bounds: dict[str, list[float]]) -> Column:
    """One struct (feature, bin) for each feature of a row."""
    def number(name: str, cuts: list[float]) -> Column:
        if not cuts:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: F.col(name) >= c))

    return F.array(*[F.struct(F.lit(n).alias("feature"), number(n, c).alias("bin")) for n, c in bounds.items()])


def _counts(rows: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
    """At most features x (BINS) rows."""
    found = (rows.select(F.explode("_bins").alias("b"), "bad").groupBy("b.feature", "b.bin")
             .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect())
    return {(r.feature, r.bin): (r.bad, r.good) for r in found}


def grow(rows: DataFrame, bounds: dict[str, list[float]]) -> Rule:
    """Adds the best condition until no good row is covered or none helps."""
    rule: Rule = ()
    while len(rule) < MOST_CONDITIONS:
        _, condition = best_condition(_counts(rows.filter(holds(rule))), bounds)
        if condition is None:
            break
        rule += (condition,)
    return rule


def tightest(rule: Rule) -> Rule:
    """The rule without conditions that a later one on the same side of its feature implies."""
    last = {(c.feature, c.at_least): c for c in rule}
    return tuple(c for c in rule if last[c.feature, c.at_least] is c)


def prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of ``rule`` with the best (bad - good) / (bad + good), the shortest of equals, and what it covers."""
    if not rule:
        return rule, 0, 0
    parts = [rule[:k] for k in range(1, len(rule) + 1)]
    found = rows.agg(*[F.count_if(holds(p) & c).alias(f"{n}{i}") for i, p in enumerate(parts)
                       for n, c in (("bad", F.col("bad")), ("good", ~F.col("bad")))]).first()
    covered = [(found[f"bad{i}"], found[f"good{i}"]) for i in range(len(parts))]
    worth = [(b - g) / (b + g) if b + g else -1.0 for b, g in covered]
    i = max(range(len(parts)), key=lambda i: (worth[i], -i))
    return parts[i], *covered[i]


def learn(rows: DataFrame) -> list[Rule]:
    """The decision list of labelled rows, as ``labelled`` gives them."""
    bounds = limits(rows)
    binned = settle(rows.withColumn("_bins", _bins(bounds)))
    growing, pruning, rules, tried = binned.filter(~F.col("prunes")), binned.filter("prunes"), [], set()
    while len(rules) < MOST_RULES:
        grown = grow(growing, {n: c for n, c in bounds.items() if n not in tried})
        if not grown:
            break
        rule, bad, good = prune(pruning, grown)
        if not bad or bad < PRECISION * (bad + good):
            tried.add(grown[0].feature)
            continue
        rules.append(tightest(rule))
        growing, pruning, tried = growing.filter(~holds(rule)), pruning.filter(~holds(rule)), set()
    return rules


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, the statistics, base_failed, rule (0: none holds), kept."""
    counts = statistics(docs, id_col, text_col)
    known = counts.withColumns({c: v for c, v in zip(FEATURES, features())})
    ruled = known.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return ruled.select(id_of("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    return learn(labelled(docs, labels, id_col, text_col))


def op11_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, fit(docs, labels))

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import quality_rules as op

SF = "/root/testdata/sf0.1"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = SPACE.findall(text)
    lines = [l for l in text.split("\n") if SPACE.search(l)]
    runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(runs)
    hit = {i + k for i, r in enumerate(runs) if n[r] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed)


def judged(df, rules):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in op.judge(df, rules).collect()), key=str)


def test_base_of_hard_texts(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t\x0b\x0c\r ", "a", "a b c a b c", "a a a a", "a a a", "a b\na b\n\n\n \n a b\na b", "é😀 # * $ % & | < > é😀 x\x85y\x1cz",
             "<P>\r\n<P>\r\n", "x " * 200_000, "w" * 300_000, "\n" * 1000]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randrange(90))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["a b", "a  b", "c", "", " "]) for _ in range(rng.randrange(9))) for _ in range(30)]
    rows = list(enumerate(texts)) + [(None, "a b a b a b"), (3, "other text"), (3, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _id", "'k' as n_words", "2 as bad", "0 as words", "9 as rule")
    got = judged(df, [])
    assert got == sorted(((i, *base(t)) for i, t in rows), key=str)
    assert op.judge(df.limit(0), []).collect() == []


def test_query_over_whole_table(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = op.fit(docs, labels)
    rows = op.op11_quality_rules(spark, sf).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.rule == 0) and r.rule <= len(rules)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rules = op.fit(docs, labels)
    out = op.judge(docs, rules).join(labels, "doc_id").filter(op.held_out("doc_id") & ~F.col("base_failed"))
    n = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    caught, lost = n.get((0, False), 0), n.get((1, False), 0)
    assert caught >= 0.95 * (caught + n.get((0, True), 0)) and lost <= 0.005 * (lost + n[(1, True)])


class Plain:
    """The learner over Python rows: dicts of features with bad and prunes."""

    def __init__(self, rows, bounds):
        self.rows, self.bounds = rows, bounds

    @staticmethod
    def holds(rule, row):
        return all((row[c.feature] >= c.limit) == c.at_least for c in rule)

    def grow(self, rows, names):
        rule = ()
        while len(rule) < op.MOST_CONDITIONS:
            some = [r for r in rows if self.holds(rule, r)]
            bad0 = sum(r["bad"] for r in some)
            best = (0.0, None)
            for name in names:
                for at_least in (True, False):
                    for limit in self.bounds[name]:
                        c = op.Condition(name, at_least, limit)
                        kept = [r["bad"] for r in some if (r[name] >= limit) == at_least]
                        bad = sum(kept)
                        gain = bad * (math.log2(bad / len(kept)) - math.log2(bad0 / len(some))) if bad else 0.0
                        if gain > best[0] + 1e-9:
                            best = (gain, c)
            if best[1] is None:
                break
            rule += (best[1],)
        return rule

    def learn(self):
        growing, pruning = ([r for r in self.rows if r["prunes"] == p] for p in (False, True))
        rules, tried = [], set()
        while len(rules) < op.MOST_RULES:
            rule = self.grow(growing, [n for n in self.bounds if n not in tried])
            if not rule:
                break
            parts = []
            for k in range(1, len(rule) + 1):
                met = [r["bad"] for r in pruning if self.holds(rule[:k], r)]
                parts.append(((2 * sum(met) - len(met)) / len(met) if met else -1.0, -k, sum(met), len(met)))
            worth, k, bad, n = max(parts)
            if not bad or bad < op.PRECISION * n:
                tried.add(rule[0].feature)
                continue
            rule = rule[:-k]
            rules.append(op.tightest(rule))
            growing, pruning = ([r for r in some if not self.holds(rule, r)] for some in (growing, pruning))
            tried = set()
        return rules


@pytest.mark.parametrize("seed", [1, 2])
def test_learner_against_plain_version(spark, seed):
    rng = random.Random(seed)
    names = list(op.FEATURES)
    rows = []
    for i in range(500):
        row = {n: float(rng.randrange(12)) for n in names}
        junk = (row["words"] >= 8 and row["digit_share"] < 5) or row["capital_share"] >= 11
        rows.append({"bad": junk != (rng.random() < 0.03), "prunes": rng.random() < 0.33, **row})
    schema = "bad boolean, prunes boolean, " + ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    bounds = op.limits(df)
    assert bounds["words"] == [float(k) for k in range(1, 12)]
    got = op.learn(df)
    assert got == Plain(rows, bounds).learn() and len(got) >= 2


def test_labelled_rows(spark):
    long = "one two three four five six seven eight nine ten " + " ".join(f"w{i}" for i in range(60))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = [(i, long) for i in range(40)] + [(ids[0], long + " again"), (ids[1], None), (None, long)]
    labels = [(i, i % 2) for i in range(40)] + [(ids[2], None), (None, 0), (ids[3], 5), (ids[4], ids[4] % 2), (999, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("quality", F.lit(3)).withColumn("_label", F.lit(1))
    l = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("x"))
    rows = op.labelled(d, l)
    assert rows.count() == len(ids) + 1  # one document twice, one of its copies without words; held-out ids left out
    assert op.labelled(d, l, sample=7).count() <= 7
    assert op.learn(op.labelled(d.limit(0), l)) == op.learn(op.labelled(d, l.limit(0))) == []
    assert op.learn(op.labelled(d, l.filter("quality = 1"))) == []


def test_list_is_ordered(spark):
    rules = [(op.Condition("words", True, 10.0),), (op.Condition("words", True, 5.0), op.Condition("digit_share", False, 0.5))]
    df = spark.createDataFrame([(12.0, 0.9), (6.0, 0.1), (6.0, 0.5), (1.0, 0.0)], "words double, digit_share double")
    assert [r.v for r in df.select(op.verdict(rules).alias("v")).collect()] == [1, 2, 0, 0]
    assert op.tightest((op.Condition("a", True, 1.0), op.Condition("b", True, 2.0), op.Condition("a", True, 3.0))) == (
        op.Condition("b", True, 2.0), op.Condition("a", True, 3.0))

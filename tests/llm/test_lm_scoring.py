import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import Row

import compare
from gaugeflow.llm import lm_scoring as op
from gaugeflow.llm.queries import ORACLES, QUERIES


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    name = "op1_lm_scoring"
    assert compare.run_pair(spark, compare.connect(sf), QUERIES[name], ORACLES[name], sf) is None


def test_nulls_empty_and_no_target(spark):
    rows = [(1, None), (2, " \n"), (None, "a b"), (3, "A b"), (3, "A b"), (4, "z " * 20000)]
    df = frame(spark, rows).selectExpr("*", "3 as _id", "'x' as key", "1 as n")
    got = {(r.doc_id, r.n_words, r.ce_diff is None) for r in op.score(df, df.limit(0).select("doc_id")).collect()}
    assert got == {(1, 0, True), (2, 0, True), (None, 2, False), (3, 2, False), (4, 20000, False)}
    assert op.score(frame(spark, []), df.select("doc_id")).collect() == []


def test_probabilities_sum_to_one():
    texts, target = ["a b a c a b", "b c b"], {0}
    words = [t.split() for t in texts]
    known = sorted({w for ws in words for w in ws})

    def losses(text, i):
        w = text.split()
        hashes, first = op.hash_words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), lower=True)
        pairs = op._bigrams(hashes, first)
        some = [ws for n, ws in enumerate(words) if i == 0 or n in target]
        two = Counter(p for ws in some for p in zip(["", *ws], ws))

        def ordered(keys, counts):
            return np.array([c for _, c in sorted(dict(zip(keys.tolist(), counts)).items())])

        one = ordered(hashes, [sum(ws.count(x) for ws in some) for x in w])
        end = ordered(hashes, [sum(ws[-1] == x for ws in some) for x in w])
        joint = ordered(pairs, [two[p] for p in zip(["", *w], w)])
        total = sum(map(len, some))
        answers = {0: [one, one, end, end], 1: [joint, joint]}
        return op._losses(hashes, first, answers, len(known), (total, total), (len(some), len(some)))[i][0] * len(w)

    for i in (0, 1):
        starts = [2 ** -losses(w, i) for w in (*known, "unseen")]
        assert sum(starts) == pytest.approx(1)
        for h, start in zip(known, starts):
            assert sum(2 ** -losses(f"{h} {w}", i) / start for w in (*known, "unseen")) == pytest.approx(1)


def test_gaps_hold_every_key():
    r = np.random.default_rng(5)
    for n, buckets in ((1, 1), (1000, 7), (1_000_000, 256), (300, 4096)):
        keys = np.unique(np.concatenate((r.integers(0, 2 ** 64, n, np.uint64), np.array([0, 1, 2 ** 64 - 1], np.uint64))))
        asked = op._asked(0, 1, 0, keys, [np.ones(len(keys), np.int64)] * 4, buckets)
        sizes = asked.column("size").to_numpy()
        above = op._ungapped(asked.column("keys").to_pylist(), sizes)
        lowest = np.array([-(-(b << 32) // buckets) << 32 for b in asked.column("bucket").to_pylist()], np.uint64)
        assert (above + np.repeat(lowest, sizes) == keys).all()
        assert n < 1_000_000 or asked.column("keys").nbytes < 6.2 * len(keys)


def plain_scores(rows, wanted):
    """Plain version: every word and bigram counts."""
    texts = [(i, (t or "").lower().split()) for i, t in rows]
    models = []
    for some in ([w for _, w in texts], [w for i, w in texts if i in wanted]):
        one = Counter(x for w in some for x in w)
        two = Counter(p for w in some for p in zip(["\n", *w], w))
        one["\n"] = sum(bool(w) for w in some)
        follow = Counter()
        for (h, _), n in two.items():
            follow[h] += n
        models.append((one, two, follow, sum(map(len, some))))
    size = len({x for _, w in texts for x in w})
    out = []
    for i, w in texts:
        loss = []
        for one, two, follow, total in models:
            some = 0
            for h, x in zip(["\n", *w], w):
                single = (one[x] + op.ADDED) / (total + op.ADDED * (size + 1))
                some -= math.log2(op.KEPT * two[h, x] / max(one[h], 1) + (1 - op.KEPT * follow[h] / max(one[h], 1)) * single)
            loss.append(some / len(w) if w else None)
        out.append((i, len(w), loss[1], loss[0]))
    return out


def agree(got, expected):
    got = sorted((r.doc_id, r.n_words, r.ce_target, r.ce_background) for r in got)
    assert len(got) == len(expected) and all(a == pytest.approx(b) for a, b in zip(got, sorted(expected)))


def test_rare_words_of_a_large_table_count(spark):
    rows = [(1, "z " * 1_200_000), (2, "once seen words"), (3, "twice seen"), (4, "z once z")]
    df = frame(spark, rows)
    agree(op.score(df, df.filter("doc_id in (2, 4)").select("doc_id")).collect(), plain_scores(rows, {2, 4}))


def test_slices_and_buckets_do_not_change_scores(spark):
    r = random.Random(3)
    rows = [(i % 150, " ".join(f"w{int(r.expovariate(.05))}" for _ in range(r.randint(0, 60)))) for i in range(200)]
    df = frame(spark, rows)
    good = df.filter("doc_id < 40").select("doc_id")
    for size, buckets in ((1, 1), (500, 7), (10_000, 300)):
        agree(op.score(df, good, slice_bytes=size, buckets=buckets).collect(), plain_scores(rows, set(range(40))))


def test_a_slice_read_by_two_tasks(spark):
    rows = [(i, f"a b{i % 3} c{i % 7} a") for i in range(20)]
    table = frame(spark, rows).selectExpr("doc_id _id", "text _text", "doc_id < 5 _target", "0L slice", "doc_id place").toArrow()
    asked = [b for k in (0, 1) for part in (table.slice(0, 9), table.slice(9)) for b in op._asking(k, 4)(iter(part.to_batches()))]
    asked = pa.Table.from_batches(asked)
    answers = pa.concat_tables([op._answered(asked.filter((pc.field("kind") == k) & (pc.field("bucket") == b))) for k in (0, 1)
                                for b in set(asked.filter(pc.field("kind") == k).column("bucket").to_pylist())])
    got = op._scoring(11, (80, 20), (20, 5))(table, answers.filter(pc.field("slice") == 0)).to_pylist()
    agree([Row(doc_id=x["_id"], **x) for x in got], plain_scores(rows, set(range(5))))

import random

import numpy as np

import brute
from gaugeflow.llm import near_dedup as op


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def family(seed, n=90):
    """Chains and groups of mutated copies around the threshold."""
    r = random.Random(seed)
    rows, i = [], 0
    for _ in range(8):
        base = [f"t{r.randint(0, 400)}" for _ in range(r.randint(3, 150))]
        for _ in range(n // 8):
            w = list(base)
            for _ in range(r.randint(0, 6)):
                w[r.randrange(len(w))] = f"z{r.randint(0, 9)}"
            rows.append((i, " ".join(w)))
            i += 1
            if r.random() < .2:
                base = w
    ids = list(range(len(rows)))
    r.shuffle(ids)
    return [(j, t) for j, (_, t) in zip(ids, rows)]


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = family(seed)
        assert found(op.classes(frame(spark, rows).repartition(4))) == brute.near_classes(rows)


def test_nulls_empty_short_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE  two"), (5, "one three"), (6, " \n"), (7, "a b c d e"),
            (8, "A B C D E"), (9, "x" * 9000 + " y" * 9000), (10, "x" * 9000 + " y" * 9000)]
    df = frame(spark, rows).selectExpr("*", "1 as _id", "2 as n", "3 as rep", "'q' as kept")
    assert found(op.classes(df)) == brute.near_classes(rows)
    left = op.drop_near_duplicates(df)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 5, 6, 7, 9] and left.columns == df.columns


def test_null_and_repeated_ids(spark):
    rows = [(None, "p q r s t u"), (5, "p q r s t u"), (5, "p q r s t u"), (6, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op.classes(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (5, 2, None, False), (5, 2, None, False), (6, 0, 6, True)], key=str)


def test_empty_table(spark):
    assert op.classes(frame(spark, [])).collect() == []


def test_estimate_follows_similarity(spark):
    r = np.random.default_rng(0)
    base = [f"s{x}" for x in r.integers(0, 9999, 400)]
    for share in (0, 20, 60):
        other = list(base)
        for p in r.choice(400, share, replace=False):
            other[p] = "new"
        rows = [(0, " ".join(base)), (1, " ".join(other))]
        sets = [{tuple(t.split()[s:s + 5]) for s in range(396)} for _, t in rows]
        true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        sk = {x._id: x for x in op.id_and_text(frame(spark, rows)).mapInArrow(op.sketches, op.SKETCH).collect()}
        pair = spark.createDataFrame([(sk[0].sig, sk[1].sig)], "a array<long>, b array<long>")
        assert abs(pair.select(op.estimate("a", "b")).first()[0] - true) < .2


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in op.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_every_text_of_a_repeated_id_is_linked(spark):
    a, b = [" ".join(f"{s}{i}" for i in range(60)) for s in "ab"]
    rows = [(1, a), (5, a), (5, b), (7, b + " more")]
    got = {(r.doc_id, r.component_id) for r in op.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (5, 1), (7, 1)}

import hashlib
import random

import brute
import compare
from gaugeflow.llm import decontamination as op


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def expected(docs, items):
    return sorted(((i, n, hit, len(names.split(",")) if hit else 0, hashlib.sha256(names.encode()).hexdigest(), hit > 0)
                   for i, n, hit, names in brute.contaminated(docs, items)), key=str)


def test_matches_brute_force(spark):
    r = random.Random(4)
    vocabulary = [f"v{i}" for i in range(60)] + ["Ünï", "ça"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(k))) for i, k in enumerate([1, 3, 7, 9, 10, 11, 25, 40, 40])]
    items += [(20, None), (21, " . "), (22, items[6][1])]
    docs = []
    for i in range(60):
        w = []
        for _ in range(r.randint(0, 4)):
            source = items[r.randrange(9)][1].split()
            a = r.randrange(len(source))
            w += source[a:a + r.randint(1, 30)] if r.random() < .7 else [r.choice(vocabulary).upper() for _ in range(12)]
        docs.append((i, r.choice([" ", ", ", "\x00-"]).join(w)))
    docs += [(100, None), (101, ""), (101, docs[5][1]), (102, "w " * 9000 + items[7][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as _id", "2 as _n", "'z' as print")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as size")
    got = op.contamination(d, b)
    assert found(got) == expected(docs, items)
    kept = op.drop_contaminated(d, b)
    dirty = {r[0] for r in found(got) if r[5]}
    assert kept.schema == d.schema and {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - dirty
    assert found(op.contamination(d.limit(0), b)) == [] and not any(r[5] for r in found(op.contamination(d, b.limit(0))))


def test_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare.run_pair(spark, compare.connect(sf), op.op4_decontamination, op.ORACLE, sf) is None


def test_shuffled_joins_agree(spark, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_ROWS", 0)
    d = spark.createDataFrame([(1, " ".join(map(str, range(30)))), (None, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(map(str, range(5, 20)))), (8, "a")], "item_id long, text string")
    assert {(r.doc_id, r.n_hit, r.n_items) for r in op.contamination(d, b).collect()} == {(1, 15, 1), (None, 1, 1)}

import hashlib
import random

import brute
from gaugeflow.llm import substring_dedup as op


def texts(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    passages = [[r.choice(vocabulary) for _ in range(k)] for k in (19, 20, 21, 32, 45, 80)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(r.randint(0, 5)):
            w += r.choice(passages)[r.randint(0, 3):] if r.random() < .5 else [r.choice(vocabulary) for _ in range(r.randint(0, 40))]
        rows.append((i, r.choice([" ", "\n", "\t "]).join(w)))
    return rows


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept, r.kept_sha256) for r in df.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def expected(rows):
    return sorted(((*r, hashlib.sha256(r[3].encode()).hexdigest()) for r in brute.removed_words(rows)),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = texts(seed)
        assert found(op.remove_repeats(frame(spark, rows).repartition(5))) == expected(rows)


def test_nulls_empty_repeats_and_clashing_names(spark):
    long = " ".join(f"x{i % 30}" for i in range(5000))
    rows = [(1, None), (2, ""), (None, " ".join(map(str, range(40)))), (3, " ".join(map(str, range(10, 60)))),
            (4, " \t\n"), (5, long), (6, "é ß " * 25), (7, "é ß " * 25)]
    df = frame(spark, rows).selectExpr("*", "1 as _id", "'x' as _text", "2 as w", "3 as n_words")
    assert found(op.remove_repeats(df)) == expected(rows)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, " ".join(map(str, range(30))))] * 2
    assert [r[2] for r in found(op.remove_repeats(frame(spark, rows)))] == [0, 0]


def test_empty_table(spark):
    assert found(op.remove_repeats(frame(spark, []))) == []


def test_cover_holds_every_difference():
    held = {(a - b) % op.PERIOD for a in op.COVER for b in op.COVER}
    assert held == set(range(op.PERIOD))


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(op, "MAX_BITS", 1 << 10)
    rows = texts(3)
    assert found(op.remove_repeats(frame(spark, rows))) == expected(rows)

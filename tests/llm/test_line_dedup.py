import hashlib
import random

import brute
from gaugeflow.llm import line_dedup as op


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def key(r):
    return (r[0] is not None, r[0] or 0, r[3])


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in df.collect()), key=key)


def sample(seed, n=40):
    r = random.Random(seed)
    runs = [[f"l{r.randint(0, 25)}" for _ in range(r.randint(1, 12))] for _ in range(6)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(r.randint(0, 4)):
            lines += r.choice(runs)[r.randint(0, 2):] if r.random() < .6 else [f"l{r.randint(0, 60)}" for _ in range(r.randint(1, 6))]
        rows.append((i, "\n".join(lines)))
    return rows + [(n, rows[3][1]), (n + 1, "\n".join([rows[3][1]] * 3))]


def test_matches_brute_force(spark):
    rows = sample(1)
    for k in (2, 3):
        assert found(op.remove_repeated_runs(frame(spark, rows), min_lines=k)) == sorted(brute.removed_lines(rows, k), key=key)


def test_common_prefixes(spark):
    rows = sample(2, 15)
    docs = {i: (t.split("\n") if t else []) for i, t in rows}
    texts = op.id_and_text(frame(spark, rows)).withColumn("_part", op._part())
    levels, suffixes = op.suffix_array(op.line_ranks(texts), 2)
    for r in op.common_prefixes(levels, suffixes).collect():
        here = docs[r._id][r.pos:]
        longest = 0
        for other in suffixes.filter(f"rank < {r['rank']}").collect():
            there = docs[other._id][other.pos:]
            k = 0
            while k < min(len(here), len(there)) and here[k] == there[k]:
                k += 1
            longest = max(longest, k)
        assert r.lcp == longest or (r.lcp == 0 and longest < 2)


def test_nulls_empty_repeats_clashing_names_and_documents(spark):
    long = "\n".join(f"x{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (None, "a\nb\nc"), (3, "z\na\nb\nc\n"), (4, long), (5, long + "\nend"), (6, "q\nr"), (6, "q\nr"),
            (7, "\n\n\n")]
    df = frame(spark, rows).selectExpr("*", "7 as _id", "'p' as _part", "9 as rank", "10 as pos")
    expected = sorted(brute.removed_lines(rows), key=key)
    assert found(op.remove_repeated_runs(df)) == expected
    cut = op.cut_documents(df)
    assert cut.schema == df.schema
    assert sorted((r.doc_id or -1, r.text or "") for r in cut.collect()) == sorted((r[0] or -1, r[3]) for r in expected)
    assert {r.doc_id for r in cut.filter("text is null").collect()} == {1}
    sha = {r.doc_id: r.kept_sha256 for r in op.remove_repeated_runs(df).collect()}
    assert sha[5] == hashlib.sha256(b"end").hexdigest()


def test_empty_table(spark):
    assert op.remove_repeated_runs(frame(spark, [])).collect() == []
    assert op.cut_documents(frame(spark, [])).collect() == []

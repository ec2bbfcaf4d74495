import numpy as np

from gaugeflow.llm import neighbours as op

SF = "/root/testdata/sf0.1"


def brute(ids, vectors, queries):
    out = {}
    norms = np.linalg.norm(vectors, axis=1)
    for q in queries:
        score = vectors @ vectors[q] / (norms * norms[q])
        order = [i for i in np.lexsort((ids, -np.round(score, 12))) if i != q][:5]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def test_recall_and_scores_on_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    table = table[[v is not None and len(v) > 0 and np.isfinite(v).all() and np.any(v) for v in table["embedding"]]]
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    truth = brute(ids, vectors, np.flatnonzero(ids % 50 == 0))
    got = {}
    for r in op.op8_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(truth) and all(len(v) == 5 for v in got.values())
    hits = [sum(s >= truth[q][-1][1] - 1e-9 for _, s in got[q]) for q in truth]
    assert np.mean(hits) / 5 >= .95


def test_copies_ties_and_odd_vectors(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(300, 8))
    rows = [(i, [float(x) for x in base[i]]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [rows[9], (None, rows[3][1])]
    rows += [(2000, None), (2050, []), (2100, [0.0] * 8), (2150, [float("nan")] * 8), (2200, [1.0, None] * 4), (2250, [float("inf")] * 8),
             (2300, [1.0, 2.0]), (2350, [-1.0, 2.0]), (2400, [-0.0] + [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "'q' as v", "2 as shard", "3 as rank")
    asked = df.filter("vec_id % 50 = 0 or vec_id = 7 or vec_id = 1003")
    got = {}
    for x in op.nearest(df, asked, shard=100).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert got[7] == [1000, 1001, 1002, 1003, 1004] and got[1003] == [7, 1000, 1001, 1002, 1004]
    assert got[2300] == [2350] and got[2350] == [2300]
    assert not {2000, 2050, 2100, 2150, 2200, 2250, None} & set(got)
    some = [x for x in rows if x[0] is not None and x[1] and len(x[1]) == 8 and x[0] not in (2100, 2150, 2200, 2250)]
    some = list({x[0]: x for x in some}.values())
    ids, vectors = np.array([x[0] for x in some]), np.array([x[1] for x in some])
    truth = brute(ids, vectors, [i for i, x in enumerate(ids) if x % 50 == 0])
    assert np.mean([len({i for i, _ in truth[q]} & set(got[q])) for q in truth]) >= 4.5
    assert op.nearest(df.limit(0), df).collect() == [] and op.nearest(df, df.limit(0)).collect() == []


def test_very_large_and_small_components(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(120, 6))
    scale = r.choice([1e-200, 1.0, 1e200], size=120)
    rows = [(i, [float(x) for x in base[i] * scale[i]]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in op.nearest(df, df.filter("vec_id % 10 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    truth = brute(np.arange(120), base, range(0, 120, 10))
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    for q, found in got.items():  # every score is that of the vectors before they were scaled
        np.testing.assert_allclose([s for _, s in found], [unit[q] @ unit[i] for i, _ in found], rtol=1e-12)
    assert np.mean([len({i for i, _ in truth[q]} & {i for i, _ in got[q]}) for q in truth]) >= 4.5

"""Rankings, archives, stop rules; the ranked run history has known results."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.skew import running_max
from gaugeflow.operators import history as h
from gaugeflow.sources import tables

# Parameter ranges, a short run history and its known ranking.
RANGES = """ParameterName,MinValue,MaxValue,DefaultValue
UpperZoneTimeConstant,0.01,40,10
LowerZoneTimeConstant,40,10000,100
GwPercValue,0.01,2,0.8
LZThreshold,0,30,10
b_Xinanjiang,0.01,5,0.5
PowerPrefFlow,0.5,8,4
SnowMeltCoef,2.5,6.5,4
CalChanMan1,0.5,2,1
CalChanMan2,0.5,5,1
LakeMultiplier,0.5,2,1
adjust_Normal_Flood,0.01,0.99,0.8
ReservoirRnormqMult,0.25,2,1
QSplitMult,0,20,2
GwLoss,0,0.5,0
"""
NAMES = [line.split(",")[0] for line in RANGES.splitlines()[1:]]
RUN = ("20.007000500000004,5020.5019999999995,1.0051005,15.0015,2.5052505,4.250425,4.50045,1.250125,2.750275,"
       "1.250125,0.50005,1.1251125,10.001,0.250025,0.9999384017071802,0.9999999990062322,1.000024121449783,"
       "1.0000566789673309,0.9168100000000396")
RUN_IDS = [("006292064019", 0, 1), ("002858939496", 0, 2), ("003869096750", 1, 1), ("003794659864", 1, 2)]
BEST = [20.007, 5020.5, 1.0051, 15.0015, 2.50525, 4.25042, 4.50045, 1.25012, 2.75027, 1.25012, 0.50005, 1.12511,
        10.001, 0.250025]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("cal")
    (base / "param_ranges.csv").write_text(RANGES)
    station = base / "380"
    station.mkdir()
    ranges = [line.split(",") for line in RANGES.splitlines()[1:]]
    head = "randId," + ",".join(NAMES) + (",Kling Gupta Efficiency,Correlation,Signal ratio (s/o) (Bias),"
                                        "Noise ratio (s/o) (Spread),sae,generation,runNumber,\n")
    pseudo = "".join(f"{name}," + ",".join(r[i] for r in ranges) + ",\n"
                     for name, i in (("MinValue", 1), ("DefaultValue", 3), ("MaxValue", 2)))
    runs = "".join(f"{rid},{RUN},{gen},{run}\n" for rid, gen, run in RUN_IDS)
    (station / "paramsHistory.csv").write_text(head + pseudo + "\n" + runs)
    return base


@pytest.fixture(scope="module")
def runs(spark, folder):
    return tables.read_history(spark, str(folder / "380" / "paramsHistory.csv"), NAMES)


def test_param_ranges_keep_file_order(spark, folder):
    got = tables.read_param_ranges(spark, str(folder / "param_ranges.csv")).orderBy("idx").collect()
    assert [r.name for r in got] == NAMES
    assert (got[1].min, got[1].max, got[1].default) == (40, 10000, 100)


def test_history_reader_drops_pseudo_runs(runs):
    got = runs.orderBy("gen", "run").collect()
    assert [(r.rand_id, r.gen, r.run) for r in got] == RUN_IDS
    assert {r.obsid for r in got} == {380} and len(got[0].params) == 14
    assert got[0].kge == 0.9999384017071802


def test_history_search_under_two_roots(spark, folder):
    merged = tables.read_history(spark, [str(folder), str(folder / "380")], NAMES, recursive=True)
    assert merged.filter("obsid = 380").count() >= 4


def test_ranked_history_known_result(runs):
    ranked = h.rank_runs(runs, ["obsid"])
    got = tables.ranked_export(ranked, NAMES).orderBy("paretoRank").collect()
    assert [(r.randId, r.corrRank, r.saeRank, r.KGERank, r.paretoRank) for r in got] == [
        ("006292064019", "0.55", "0.55", "0.55", "0.166375"), ("002858939496", "1", "1", "1", "1")]
    assert [got[0][n] for n in NAMES] == [f"{x:g}" for x in BEST]
    assert (got[0]["Kling Gupta Efficiency"], got[0]["sae"], got[0]["Correlation"]) == ("0.999938", "0.91681", "1")


def test_best_parameters_known_result(runs):
    best = h.best_parameters(h.rank_runs(runs, ["obsid"]), ["obsid"], NAMES)
    assert best.first().effover == best.first().R == 0.9999384017071802
    got = tables.best_export(best).first()
    assert [got[f"param_{i:02d}_{n}"] for i, n in enumerate(NAMES)] == [f"{x:g}" for x in BEST]


def test_front_history_known_result(runs):
    got = h.front_history(runs).orderBy("gen").collect()
    top = 0.9999384017071802
    assert [tuple(r)[1:] for r in got] == [(0, top, top, 0.0, top), (1, top, top, 0.0, top)]


def test_statistics_of_an_archive(spark):
    archive = spark.createDataFrame([(1, 0.1), (1, 0.2)], "obsid long, kge double")
    got = h.archive_statistics(archive, ["obsid"], "kge").first()
    assert (got.effmin_R, got.effmax_R) == (0.1, 0.2)
    assert got.effstd_R == pytest.approx(0.05) and got.effavg_R == pytest.approx(0.15)


def test_stop_rules(spark):
    fronts = spark.createDataFrame([(1, 0, 0.991), (1, 1, 0.991), (2, 0, 0.5), (2, 1, 0.9), (2, 2, 0.95)],
                                   "obsid long, gen int, effmax_R double")
    flags = {(r.obsid, r.gen): (r.stalled, r.reached_max_gen)
             for r in h.termination(fronts, 1, 2, 1, 0.003).collect()}
    assert flags[(1, 1)] == (True, False) and flags[(1, 0)] == (False, False)
    assert flags[(2, 1)] == (False, False) and flags[(2, 2)] == (False, True)
    early = h.termination(fronts, 1, 2, 3, 0.003).filter("stalled")
    assert early.isEmpty()  # too few generations to look back


def test_target_check(spark):
    fronts = spark.createDataFrame([(1, 0, 1.0), (1, 1, 0.9995), (2, 0, 0.98)], "obsid long, gen int, effmax_R double")
    got = {r.obsid: r.reached for r in h.reaches_target(fronts, 0.99, 1.0, 0.001).collect()}
    assert got == {1: True, 2: False}


@pytest.mark.parametrize("n, kept", [(4, 2), (15, 2), (25, 2), (35, 4), (45, 4), (46, 5)])
def test_best_share_rounds_half_to_even(spark, n, kept):
    runs = spark.range(n).select(F.lit(1).alias("obsid"), F.lit(0).alias("gen"), F.col("id").alias("run"),
                                 (F.col("id") * 0.01).alias("kge"))
    got = h.best_runs(runs, ["obsid"]).collect()
    assert sorted(r.run for r in got) == list(range(n - kept, n))


def test_ties_follow_run_order(spark):
    runs = spark.createDataFrame([(1, 0, r, 0.5, 0.5, 1.0) for r in range(30)],
                                 "obsid long, gen int, run int, kge double, corr double, sae double")
    for parts in (1, 8):
        ranked = h.rank_runs(runs.repartition(parts), ["obsid"]).orderBy("paretoRank").collect()
        assert [r.run for r in ranked] == [0, 1, 2]


def points(seed, n, m, groups=3):
    rng = random.Random(seed)
    return [(i % groups, 0, i, *[float(rng.randrange(12)) for _ in range(m)]) for i in range(n)]


def beats(a, b):
    return all(x >= y for x, y in zip(a, b)) and a != b


@pytest.mark.parametrize("m, block", [(1, 64), (2, 2), (3, 3), (3, 64), (5, 4)])
def test_pareto_set_against_brute_force(spark, m, block):
    data = points(m * 7 + block, 150, m)
    names = [f"f{i}" for i in range(m)]
    table = spark.createDataFrame(data, "obsid long, gen int, run long, " + ", ".join(f"{x} double" for x in names))
    got = {r.run for r in h.pareto_set(table, ["obsid"], names, block).collect()}
    want = {a[2] for a in data if not any(b[0] == a[0] and beats(b[3:], a[3:]) for b in data)}
    assert got == want


def test_pareto_set_leaves_out_undefined_points(spark):
    table = spark.createDataFrame([(1, 0, 1, None, 9.0), (1, 0, 2, 1.0, 1.0)], "obsid long, gen int, run long, a double, b double")
    assert [r.run for r in h.pareto_set(table, ["obsid"], ["a", "b"]).collect()] == [2]
    assert h.pareto_set(table.filter("run = 1"), ["obsid"], ["a", "b"]).isEmpty()


def brute_fronts(data):
    left, fronts, level = list(data), {}, 0
    while left:
        front = [a for a in left if not any(b[0] == a[0] and beats(b[3:], a[3:]) for b in left)]
        fronts.update({a[2]: level for a in front})
        left = [a for a in left if a not in front]
        level += 1
    return fronts


def test_fronts_and_survivors_against_brute_force(spark):
    data = points(5, 120, 3)
    names = ["f0", "f1", "f2"]
    table = spark.createDataFrame(data, "obsid long, gen int, run long, f0 double, f1 double, f2 double")
    want = brute_fronts(data)
    assert {r.run: r.front for r in h.front_numbers(table, ["obsid"], names).collect()} == want
    kept = {r.run for r in h.select_survivors(table, ["obsid"], names, 15, "run").collect()}
    for obsid in range(3):
        mine = [a[2] for a in data if a[0] == obsid]
        chosen = [r for r in mine if r in kept]
        assert len(chosen) == 15
        worst = max(want[r] for r in chosen)
        assert all(r in kept for r in mine if want[r] < worst)


@pytest.mark.parametrize("m", [1, 2, 4])
def test_fronts_of_other_dimensions(spark, m):
    data = points(m + 20, 150, m)
    names = [f"f{i}" for i in range(m)]
    table = spark.createDataFrame(data, "obsid long, gen int, run long, " + ", ".join(f"{x} double" for x in names))
    assert {r.run: r.front for r in h.front_numbers(table, ["obsid"], names).collect()} == brute_fronts(data)


def test_missing_objectives_are_the_worst(spark):
    table = spark.createDataFrame([(1, 1, 5.0, None), (1, 2, 5.0, -9.0), (1, 3, None, None), (1, 4, 6.0, -10.0)],
                                  "obsid long, run long, a double, b double")
    assert {r.run: r.front for r in h.front_numbers(table, ["obsid"], ["a", "b"]).collect()} == {1: 1, 2: 0, 3: 2, 4: 0}


@pytest.mark.parametrize("m", [2, 3])
def test_one_large_group(spark, m):
    """A million rows in one group: the first front is the Pareto set, and chains have no gaps."""
    n = 1_000_000 if m == 2 else 100_000
    names = [f"f{i}" for i in range(m)]
    table = spark.range(n).select(F.lit(1).alias("obsid"), F.col("id").alias("run"),
                                  *[F.rand(i).alias(x) for i, x in enumerate(names)])
    table.write.mode("overwrite").parquet(path := f"{settle_folder(spark)}/large-{m}")
    table = spark.read.parquet(path)
    ranked = h.front_numbers(table, ["obsid"], names)
    ranked.write.mode("overwrite").parquet(out := f"{settle_folder(spark)}/fronts-{m}")
    ranked = spark.read.parquet(out)
    assert ranked.count() == n
    numbers = [r.front for r in ranked.select("front").distinct().collect()]
    assert sorted(numbers) == list(range(len(numbers)))
    best = h.pareto_set(table, ["obsid"], names, 64)
    assert ({r.run for r in best.collect()} == {r.run for r in ranked.filter("front = 0").collect()})


def settle_folder(spark):
    from gaugeflow.session import checkpoint_dir
    return checkpoint_dir(spark)


def test_written_tables_do_not_grow_with_the_front(spark, monkeypatch):
    written, settle = [0], h.settle

    def counted(df):
        written[0] += 1
        return settle(df)

    for module in (h, h.fronts):
        monkeypatch.setattr(module, "settle", counted)
    used = []
    for n in (1500, 6000):  # all on one sphere: every point is in the set
        u, v = F.rand(1) * 1.5, F.rand(2) * 1.5
        ball = spark.range(n).select(F.lit(1).alias("obsid"), F.col("id").alias("run"), (F.cos(u) * F.cos(v)).alias("a"),
                                     (F.sin(u) * F.cos(v)).alias("b"), F.sin(v).alias("c"))
        written[0] = 0
        assert h.pareto_set(settle(ball), ["obsid"], ["a", "b", "c"], 500).count() == n
        used.append(written[0])
    assert used[0] == used[1] < 10


@pytest.mark.parametrize("group_rows", [10**6, 10])
def test_running_max_in_slices(spark, group_rows):
    rng = random.Random(8)
    data = [(i % 2, i, float(rng.randrange(100))) for i in range(200)]
    got = running_max(spark.createDataFrame(data, "k long, i long, v double"), ["k"], [F.desc("i")], "v", "before", group_rows)
    want = {i: max((w for l, j, w in data if l == k and j > i), default=None) for k, i, _ in data}
    assert {r.i: r.before for r in got.collect()} == want


def test_crowding_matches_numpy(spark):
    rng = np.random.default_rng(2)
    values = rng.random((20, 2))
    table = spark.createDataFrame([(1, i, 0, float(a), float(b)) for i, (a, b) in enumerate(values)],
                                  "obsid long, run long, front int, f0 double, f1 double")
    want = np.zeros(20)
    for k in range(2):
        order = np.argsort(values[:, k])
        want[order[[0, -1]]] = np.inf
        span = (values[order[-1], k] - values[order[0], k]) * 2
        want[order[1:-1]] += (values[order[2:], k] - values[order[:-2], k]) / span
    got = {r.run: r.distance for r in h.crowding(table, ["obsid"], ["f0", "f1"], "run").collect()}
    assert [got[i] for i in range(20)] == pytest.approx(list(want))


def test_single_objective_survivors(spark):
    table = spark.createDataFrame([(1, i, float(i % 7)) for i in range(20)], "obsid long, run long, kge double")
    kept = h.select_survivors(table, ["obsid"], ["kge"], 4, "run")
    assert sorted((r.kge for r in kept.collect()), reverse=True) == [6.0, 6.0, 5.0, 5.0]


def test_restart_drops_the_incomplete_tail(spark):
    data = [(1, g, r) for g, n in ((0, 4), (1, 2), (2, 1), (3, 2)) for r in range(n)]
    data += [(2, 0, r) for r in range(3)] + [(3, g, r) for g, n in ((0, 4), (2, 2)) for r in range(n)]
    got = h.complete_generations(spark.createDataFrame(data, "obsid long, gen int, run int"), 4, 2)
    assert {(r.obsid, r.gen) for r in got.collect()} == {(1, 0), (1, 1), (3, 0)}

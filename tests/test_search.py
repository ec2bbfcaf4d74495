"""Parameter search: convergence, reproducibility, restart."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.operators import search
from gaugeflow.sources import tables

N_PARAMS = 14
RANGES = search.Ranges([f"p{i}" for i in range(N_PARAMS)], [0.0] * N_PARAMS, [1.0] * N_PARAMS, [0.5] * N_PARAMS)


def single(targets):
    """1 - root mean square distance to a target vector."""
    goal = F.array(*[F.lit(float(t)) for t in targets])

    def model(individuals: DataFrame) -> DataFrame:
        gaps = F.zip_with("x", goal, lambda x, t: (x - t) * (x - t))
        total = F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b)
        return individuals.select("obsid", "run", (1 - F.sqrt(total / F.size("x"))).alias("kge"))
    return model


def each_gene(value, n):
    """One objective per gene: 1 - distance to the value."""
    def model(individuals: DataFrame) -> DataFrame:
        return individuals.select("obsid", "run", *[
            (1 - F.abs(F.element_at("x", i + 1) - value)).alias(f"f{i}") for i in range(n)])
    return model


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([(380,), (892,)], "obsid long")


def test_single_objective_converges(spark, stations, tmp_path):
    settings = search.SearchSettings(pop=144, mu=18, lam=36, min_gen=6, max_gen=16, seed=42)
    targets = [(i + 1) / N_PARAMS for i in range(N_PARAMS)]
    state = search.run_search(stations, RANGES, single(targets), settings,
                              search.HistoryTable(spark, str(tmp_path / "h")))
    best = {r.obsid: r.kge for r in state.best.groupBy("obsid").agg(F.max("kge").alias("kge")).collect()}
    assert set(best) == {380, 892} and min(best.values()) > 0.9
    tops = state.fronts.orderBy("obsid", "gen").collect()
    for a, b in zip(tops, tops[1:]):
        assert a.obsid != b.obsid or b.effmax_R >= a.effmax_R


@pytest.mark.parametrize("value", [0.2, 0.8])
def test_many_objectives_converge(spark, stations, tmp_path, value):
    names = [f"f{i}" for i in range(5)]
    settings = search.SearchSettings(pop=144, mu=18, lam=36, min_gen=3, max_gen=4, seed=1, objectives=names)
    ranges = search.Ranges(names, [0.0] * 5, [1.0] * 5, [0.5] * 5)
    state = search.run_search(stations, ranges, each_gene(value, 5), settings,
                              search.HistoryTable(spark, str(tmp_path / "h")))
    top = state.best.groupBy("obsid").agg(F.max("f0").alias("f0"))
    assert all(r.f0 > 0.99 for r in top.collect())


SMALL = search.SearchSettings(pop=6, mu=3, lam=4, min_gen=9, max_gen=3, seed=5)


def snapshot(state):
    return sorted((r.obsid, r.gen, r.run, r.kge, tuple(r.x)) for r in state.population.collect())


def test_result_does_not_depend_on_partitions(spark, tmp_path):
    results = []
    for parts in (1, 8):
        stations = spark.range(3).select(F.col("id").alias("obsid")).repartition(parts)
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            table = search.HistoryTable(spark, str(tmp_path / f"p{parts}"))
            results.append(snapshot(search.run_search(stations, RANGES, single([0.3] * N_PARAMS), SMALL, table)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] and len(results[0]) == 9


def test_restart_continues_where_it_stopped(spark, stations, tmp_path):
    model = single([0.3] * N_PARAMS)
    whole = search.run_search(stations, RANGES, model, SMALL, search.HistoryTable(spark, str(tmp_path / "a")))
    table = search.HistoryTable(spark, str(tmp_path / "b"))
    first = search.SearchSettings(pop=6, mu=3, lam=4, min_gen=9, max_gen=1, seed=5)
    search.run_search(stations, RANGES, model, first, table)
    # a crashed generation left only a part of its runs behind
    torn = table.read().filter("gen = 1 AND run = 1").withColumn("gen", F.lit(2))
    table.write(2, torn)
    resumed = search.run_search(stations, RANGES, model, SMALL, table)
    assert snapshot(resumed) == snapshot(whole)


def test_finished_search_is_only_replayed(spark, stations, tmp_path):
    model, table = single([0.3] * N_PARAMS), search.HistoryTable(spark, str(tmp_path / "h"))
    done = search.run_search(stations, RANGES, model, SMALL, table)

    def never(individuals):
        raise AssertionError("a finished search evaluates nothing")

    again = search.run_search(stations, RANGES, never, SMALL, table)
    assert snapshot(again) == snapshot(done)
    counts = {r["gen"]: r["count"] for r in table.read().groupBy("gen").count().collect()}
    assert counts == {0: 12, 1: 8, 2: 8, 3: 8}


def test_stalled_station_stops_alone(spark, stations, tmp_path):
    """One station cannot improve; the other one goes on."""
    def model(individuals):
        score = F.when(F.col("obsid") == 380, F.lit(0.5)).otherwise(F.element_at("x", 1) / 2 + F.col("gen"))
        return individuals.select("obsid", "run", score.alias("kge"))

    settings = search.SearchSettings(pop=4, mu=2, lam=3, min_gen=1, max_gen=4, gen_offset=1, seed=2)
    state = search.run_search(stations, RANGES, model, settings, search.HistoryTable(spark, str(tmp_path / "h")))
    last = {r.obsid: r.gen for r in state.fronts.groupBy("obsid").agg(F.max("gen").alias("gen")).collect()}
    assert last == {380: 1, 892: 4}


def test_children_stay_in_bounds_and_vary(spark, stations):
    people = search.initial_population(stations, N_PARAMS, 20, 3)
    settings = search.SearchSettings(pop=20, mu=20, lam=200, min_gen=1, max_gen=1, seed=3)
    born = search.vary(people, 1, settings, N_PARAMS)
    low, high, n = born.select(F.explode("x").alias("g"), "run").agg(F.min("g"), F.max("g"), F.count("g")).first()
    assert 0 <= low and high <= 1 and n == 2 * 200 * N_PARAMS
    assert born.distinct().count() == 400


def test_single_parent_population(spark, stations):
    one = search.initial_population(stations, 3, 1, 3)
    settings = search.SearchSettings(pop=1, mu=1, lam=5, min_gen=1, max_gen=1)
    assert search.vary(one, 1, settings, 3).filter("size(x) = 3").count() == 10


def test_uniform_numbers_look_uniform(spark):
    from gaugeflow.functions.random import normal, uniform
    table = spark.range(20000).select(uniform(1, "a", F.col("id")).alias("u"), normal(1, "b", F.col("id")).alias("z"))
    r = table.agg(F.avg("u").alias("m"), F.stddev("u").alias("s"), F.avg("z").alias("zm"),
                  F.stddev("z").alias("zs"), F.min("u").alias("lo"), F.max("u").alias("hi")).first()
    assert abs(r.m - 0.5) < 0.01 and abs(r.s - 12 ** -0.5) < 0.01 and 0 <= r.lo and r.hi < 1
    assert abs(r.zm) < 0.03 and abs(r.zs - 1) < 0.03


def test_scaling_round_trip(spark):
    ranges = search.Ranges(["a", "b"], [2.0, -1.0], [4.0, 9.0], [3.0, 0.0])
    row = spark.range(1).select(F.array(F.lit(0.25), F.lit(0.5)).alias("x")).select(
        ranges.unscale(F.col("x")).alias("p"), ranges.scale(ranges.unscale(F.col("x"))).alias("x"),
        ranges.perturbed(F.col("x"), 0.1).alias("t")).first()
    assert row.p == [2.5, 4.0] and row.x == [0.25, 0.5] and row.t == pytest.approx([2.75, 4.4])


def test_individuals_without_pairs_stay(spark):
    people = spark.createDataFrame([(1, 0, 1, [.5]), (1, 0, 2, [.6]), (2, 0, 1, [.5])], "obsid long, gen int, run int, x array<double>")
    obs = spark.createDataFrame([(1, 1, 1.0), (1, 2, 3.0)], "obsid long, ts int, o double")

    def simulate(individuals: DataFrame) -> DataFrame:
        return individuals.filter("obsid = 1").select(
            "obsid", "run", F.explode(F.array(F.lit(1), F.lit(2))).alias("ts")).select(
            "*", F.when(F.col("run") == 1, F.col("ts") * 1.0).alias("s"))

    ranges = search.Ranges(["p"], [0.0], [1.0], [0.5])
    got = {(r.obsid, r.run): (r.kge, r.sae) for r in search.evaluate(people, ranges, search.series_model(simulate, obs)).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1)}
    assert got[1, 2] == got[2, 1] == (-100.0, None) and got[1, 1][0] > -100 and got[1, 1][1] == 1.0


@pytest.mark.parametrize("cells", [10**6, 7])
def test_stateful_simulator_equals_a_loop(spark, cells):
    """State is carried in the order of time, whatever the blocks; blocks may be empty."""
    def step(state, value, params):
        state = state * params[:, 0] + value
        return state, state * params[:, 1]

    times = [datetime(2000, 1, 1) + timedelta(days=i) for i in range(9)]
    forcing = [(s, t, None if i == 4 else float(s * 10 + i)) for s in (1, 2) for i, t in enumerate(times)]
    people = [(s, r, [0.1 * r, 2.0 + s]) for s in (1, 2, 3) for r in range(1, 6)]
    simulate = search.stateful_simulator(step, spark.createDataFrame(forcing[::-1], "obsid long, ts timestamp, forcing double"), cells)
    got = {(r.obsid, r.run, r.ts): r.s for r in simulate(spark.createDataFrame(people, "obsid long, run int, params array<double>")).collect()}
    want = {}
    for s, r, (keep, gain) in people:
        state = 0.0
        for owner, t, f in forcing:
            if owner == s:
                state = state * keep + (f or 0.0)
                want[s, r, t] = pytest.approx(state * gain)
    assert got == want and len(got) == 2 * 5 * 9


@pytest.mark.parametrize("cells", [10**6, 7])
def test_observations_travel_with_the_forcing(spark, cells):
    """Same scores as a join of the simulated steps with the observations, without moving them again."""
    times = [datetime(2000, 1, 1) + timedelta(days=i) for i in range(9)]
    rows = [(s, t, float(s * 10 + i * i), None if i == 4 else float(s * 8 + i * (9 - i))) for s in (1, 2) for i, t in enumerate(times)]
    pairs = spark.createDataFrame(rows[::-1], "obsid long, ts timestamp, forcing double, o double")
    people = spark.createDataFrame([(s, r, [0.1 * r, 2.0 + s]) for s in (1, 2, 3) for r in range(1, 6)], "obsid long, run int, params array<double>")

    def step(state, value, params):
        state = state * params[:, 0] + value
        return state, state * params[:, 1]

    alone = search.stateful_simulator(step, pairs.drop("o"), cells)
    want = search.series_model(alone, pairs.select("obsid", "ts", "o"))(people)
    got = search.series_model(search.stateful_simulator(step, pairs, cells))(people)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 10
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan[:plan.index("FlatMapCoGroups")]


def test_a_generation_without_commit_is_not_read(spark, tmp_path):
    table = search.HistoryTable(spark, str(tmp_path / "runs"))
    assert not table.exists()
    runs = spark.createDataFrame([(1, r, 0.5) for r in range(4)], "obsid long, run int, kge double")
    table.write(0, runs)
    table.write(1, runs.limit(2))
    table.write(1, runs)  # repeated: replaced
    tables.write_table(runs.withColumn("gen", F.lit(2)), table.path, ["gen"])  # broke off before its commit
    half = f"{table.path}/gen=1"
    assert table.exists() and {(r.gen, r["count"]) for r in table.read().groupBy("gen").count().collect()} == {(0, 4), (1, 4)}
    runs.limit(1).write.mode("append").parquet(half)  # rows beside the committed ones
    assert {r.gen for r in table.read().select("gen").distinct().collect()} == {0}

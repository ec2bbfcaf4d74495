"""Evolutionary parameter search for all stations at once: one generation is one job.

An individual is ``(obsid, gen, run, x ARRAY<DOUBLE>)`` with genes in [0, 1]. A model is a
DataFrame function ``model(individuals) -> (obsid, run, <objectives>)`` with the unscaled
parameters in ``params``; see ``series_model`` for one that simulates series.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.random import normal, uniform
from gaugeflow.functions.skew import attach
from gaugeflow.operators import history as runs_of
from gaugeflow.operators.metrics import KGE_FLOOR
from gaugeflow.operators.metrics import objectives as fit_objectives
from gaugeflow.session import settle
from gaugeflow.sources.tables import append_runs, read_runs

Model = Callable[[DataFrame], DataFrame]

# Fixed values of the variation operators.
BLEND_ALPHA = 0.15
MUTATION_SIGMA = 0.3
GENE_PROBABILITY = 0.3
CROSSOVER_RATE = 0.6
MUTATION_RATE = 0.4

CELLS = 1_000_000  # simulated values that one task holds


@dataclass(frozen=True)
class SearchSettings:
    pop: int
    mu: int
    lam: int
    min_gen: int
    max_gen: int
    gen_offset: int = 3
    effmax_tol: float = 0.003
    crossover: float = CROSSOVER_RATE
    mutation: float = MUTATION_RATE
    seed: int = 1
    objectives: list[str] = field(default_factory=lambda: ["kge"])


@dataclass(frozen=True)
class Ranges:
    """Parameter ranges in file order."""
    names: list[str]
    low: list[float]
    high: list[float]
    default: list[float]

    @classmethod
    def from_table(cls, table: DataFrame) -> "Ranges":
        """One row per model parameter, so the table is a handful of rows."""
        rows = table.orderBy("idx").collect()
        return cls([r["name"] for r in rows], [float(r["min"]) for r in rows],
                   [float(r["max"]) for r in rows], [float(r["default"]) for r in rows])

    def _widths(self) -> Column:
        return F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b - a).alias("w"))
                         for a, b in zip(self.low, self.high)])

    def unscale(self, x: Column) -> Column:
        return F.zip_with(x, self._widths(), lambda v, r: r["a"] + v * r["w"])

    def perturbed(self, x: Column, tolerance: float) -> Column:
        """Unscaled genes moved by a relative tolerance: the truth of a synthetic test."""
        return F.transform(self.unscale(x), lambda p: p * F.lit(1 + tolerance))

    def scale(self, params: Column) -> Column:
        return F.zip_with(params, self._widths(), lambda v, r: F.try_divide(v - r["a"], r["w"]))


def genes(n: int, make: Callable[[Column], Column]) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), make)


def clamp(x: Column) -> Column:
    return F.transform(x, lambda v: F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)))


def initial_population(stations: DataFrame, n_params: int, pop: int, seed: int) -> DataFrame:
    """``pop`` individuals per station, every gene uniform in [0, 1)."""
    return (stations.select("obsid", F.explode(F.sequence(F.lit(1), F.lit(pop))).alias("run"))
            .select("obsid", F.lit(0).alias("gen"), "run",
                    genes(n_params, lambda i: uniform(seed, "init", F.col("obsid"), F.col("run"), i))
                    .alias("x")))


def vary(parents: DataFrame, gen: int, settings: SearchSettings, n_params: int) -> DataFrame:
    """``lam`` children per station by blend crossover, Gaussian mutation or copying.

    The population of a station is bounded by the settings, so it travels as one array.
    """
    seed, lam = settings.seed, settings.lam
    pool = parents.groupBy("obsid").agg(
        F.array_sort(F.collect_list(F.struct("gen", "run", "x"))).alias("pool"))
    child = (pool.select("obsid", "pool", F.size("pool").alias("size"),
                         F.explode(F.sequence(F.lit(1), F.lit(lam))).alias("run")))
    ids = (F.col("obsid"), F.lit(gen), F.col("run"))
    size = F.col("size")
    first = F.floor(uniform(seed, "p1", *ids) * size).cast("int")
    # the second parent is another one unless the population has a single member
    other = F.floor(uniform(seed, "p2", *ids) * F.greatest(size - 1, F.lit(1))).cast("int")
    second = F.when(size == 1, F.lit(0)).otherwise(other + (other >= first).cast("int"))
    picked = child.select(
        "obsid", "run", uniform(seed, "how", *ids).alias("how"),
        F.element_at("pool", first + 1)["x"].alias("x1"),
        F.element_at("pool", second + 1)["x"].alias("x2"))

    def blended(i: Column) -> Column:
        g = F.lit(1 + 2 * BLEND_ALPHA) * uniform(seed, "mate", *ids, i) - F.lit(BLEND_ALPHA)
        return (1 - g) * F.element_at("x1", i + 1) + g * F.element_at("x2", i + 1)

    def mutated(i: Column) -> Column:
        gene = F.element_at("x1", i + 1)
        moved = gene + F.lit(MUTATION_SIGMA) * normal(seed, "noise", *ids, i)
        return F.when(uniform(seed, "hit", *ids, i) < GENE_PROBABILITY, moved).otherwise(gene)

    how = F.col("how")
    x = (F.when(how < settings.crossover, genes(n_params, blended))
         .when(how < settings.crossover + settings.mutation, genes(n_params, mutated))
         .otherwise(F.col("x1")))
    return picked.select("obsid", F.lit(gen).alias("gen"), "run", clamp(x).alias("x"))


def evaluate(individuals: DataFrame, ranges: Ranges, model: Model) -> DataFrame:
    """Objectives of every individual from one call of the model; without any they are NULL, and kge the floor."""
    ready = settle(individuals.withColumn("params", ranges.unscale(F.col("x"))))
    scored = ready.join(model(ready), ["obsid", "run"], "left")
    return scored.withColumn("kge", F.coalesce("kge", F.lit(KGE_FLOOR))) if "kge" in scored.columns else scored


def series_model(simulate: Callable[[DataFrame], DataFrame], obs: DataFrame | None = None) -> Model:
    """Model from a simulator ``simulate(individuals) -> (obsid, run, ts, s)`` and observations.

    A simulator that pairs its steps before it expands them returns ``o`` itself and needs no ``obs``.
    """
    def model(individuals: DataFrame) -> DataFrame:
        pairs = simulate(individuals)
        if "o" not in pairs.columns:
            pairs = pairs.join(obs.select("obsid", "ts", "o"), ["obsid", "ts"])
        return fit_objectives(pairs, ["obsid", "run"])
    return model


def stateful_simulator(step: Callable, forcing: DataFrame, cells: int = CELLS) -> Callable[[DataFrame], DataFrame]:
    """Simulator of a rule that carries state from step to step.

    ``step(state, value, params) -> (state, simulated)`` works on arrays over individuals (params:
    one row each; the first state is 0) and sees the ``forcing`` (obsid, ts, forcing) of a station
    in the order of time. Steps can't be split, so individuals are: those of a station are dealt to
    as many blocks as keep ``cells`` simulated values a block, and its forcing is copied for each.
    A NULL forcing counts as 0; a station without forcing simulates nothing. Observations ``o`` in
    ``forcing`` come out with every simulated step, so that ``series_model`` needs no join with them.
    """
    carried = ["o"] if "o" in forcing.columns else []
    made = pa.schema([("obsid", pa.int64()), ("run", pa.int32()), ("ts", pa.timestamp("us", "UTC")), ("s", pa.float64()),
                      *[(c, pa.float64()) for c in carried]])

    def run(individuals: pa.Table, values: pa.Table) -> pa.Table:
        if not individuals.num_rows or not values.num_rows:  # a block that no individual was dealt to
            return made.empty_table()
        steps = values.sort_by("ts")
        runs = individuals.column("run").to_numpy()
        params = np.array(individuals.column("params").to_pylist(), np.float64).reshape(len(runs), -1)
        put_in = steps.column("forcing").fill_null(0.0).to_numpy()
        state, out = np.zeros(len(runs)), np.empty((len(put_in), len(runs)))
        for t, value in enumerate(put_in):
            state, out[t] = step(state, value, params)
        each = pa.array(np.repeat(np.arange(len(put_in)), len(runs)))
        stamps, *beside = (pc.take(steps.column(c).combine_chunks(), each) for c in ("ts", *carried))
        owner = np.full(out.size, individuals.column("obsid")[0].as_py())
        return pa.Table.from_arrays([pa.array(owner), pa.array(np.tile(runs, len(put_in)), pa.int32()), stamps, pa.array(out.ravel()), *beside], schema=made)

    def simulate(individuals: DataFrame) -> DataFrame:
        steps = forcing.select(F.col("obsid").cast("long").alias("obsid"), "ts", F.col("forcing").cast("double").alias("forcing"),
                               *[F.col(c).cast("double").alias(c) for c in carried])
        lengths = steps.groupBy("obsid").agg(F.count(F.lit(1)).alias("_steps"))
        sizes = individuals.groupBy(F.col("obsid").cast("long").alias("obsid")).agg(F.count(F.lit(1)).alias("_runs"))
        blocks = settle(lengths.join(sizes, "obsid").select(
            "obsid", F.ceil(F.col("_runs") * F.col("_steps") / cells).cast("int").alias("_blocks")))
        people = individuals.select(F.col("obsid").cast("long").alias("obsid"), F.col("run").cast("int").alias("run"), "params")
        dealt = attach(people, blocks, ["obsid"]).withColumn("_block", F.pmod(F.xxhash64("run"), F.col("_blocks")).cast("int")).drop("_blocks")
        copies = attach(steps, blocks, ["obsid"]).withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
        keys = ["obsid", "_block"]
        return dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(
            run, ", ".join(["obsid long, run int, ts timestamp, s double", *[f"{c} double" for c in carried]]))

    return simulate


def survivors(population: DataFrame, settings: SearchSettings) -> DataFrame:
    """Best ``mu`` per station of parents and children."""
    tagged = population.withColumn("_id", F.col("gen").cast("long") * F.lit(1 << 32) + F.col("run"))
    return runs_of.select_survivors(tagged, ["obsid"], settings.objectives, settings.mu, "_id").drop("_id")


def archive(evaluated: DataFrame, settings: SearchSettings) -> DataFrame:
    """Non-dominated individuals per station."""
    if len(settings.objectives) > 1:
        return runs_of.pareto_set(evaluated, ["obsid"], settings.objectives)
    name = settings.objectives[0]
    best = evaluated.groupBy("obsid").agg(F.max(name).alias("_best"))
    return attach(evaluated, settle(best), ["obsid"]).filter(F.col(name) == F.col("_best")).drop("_best")


class HistoryTable:
    """Run history on shared storage: a partition per generation, replaced when it is repeated.

    A generation counts once its rows are committed, so one whose write broke off is never read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, gen: int, runs: DataFrame) -> None:
        append_runs(runs.withColumn("gen", F.lit(gen)), self.path, [gen])

    def read(self) -> DataFrame:
        return read_runs(self.spark, self.path)

    def generation(self, gen: int) -> DataFrame:
        """A generation that this search has just committed."""
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/gen={gen}")

    def exists(self) -> bool:
        try:
            return not self.read().isEmpty()
        except AnalysisException:
            return False


@dataclass
class SearchState:
    gen: int
    population: DataFrame
    best: DataFrame
    fronts: DataFrame


def _front_row(best: DataFrame, gen: int, settings: SearchSettings) -> DataFrame:
    stats = runs_of.archive_statistics(best, ["obsid"], settings.objectives[0])
    return stats.withColumn("gen", F.lit(gen))


def _advance(state: SearchState | None, gen: int, runs: DataFrame, settings: SearchSettings) -> SearchState:
    """Fold one evaluated generation into population, archive and front history."""
    if state is None:
        best = settle(archive(runs, settings))
        return SearchState(0, runs, best, settle(_front_row(best, gen, settings)))
    best = settle(archive(state.best.unionByName(runs), settings))
    population = settle(survivors(state.population.unionByName(runs), settings))
    searched = best.join(runs.select("obsid").distinct(), "obsid", "left_semi")
    fronts = settle(state.fronts.unionByName(_front_row(searched, gen, settings)))
    return SearchState(gen, population, best, fronts)


def _active(state: SearchState, settings: SearchSettings) -> DataFrame:
    """Stations that neither stalled nor reached the last generation."""
    flags = runs_of.termination(state.fronts, settings.min_gen, settings.max_gen,
                                settings.gen_offset, settings.effmax_tol)
    return (flags.groupBy("obsid").agg(F.max(F.col("stalled") | F.col("reached_max_gen")).alias("_stop"))
            .filter("NOT _stop").select("obsid"))


def restore(history: HistoryTable, settings: SearchSettings) -> SearchState | None:
    """Replay the complete generations of an earlier search; the incomplete tail is run again.

    A generation is written as one job, so the last complete one is the same for every station
    that is still active.
    """
    kept = settle(runs_of.complete_generations(history.read(), settings.pop, settings.lam))
    last = kept.agg(F.max("gen")).first()[0]
    state = None
    for gen in range(-1 if last is None else last + 1):
        state = _advance(state, gen, kept.filter(F.col("gen") == gen), settings)
    return state


def run_search(stations: DataFrame, ranges: Ranges, model: Model, settings: SearchSettings,
               history: HistoryTable) -> SearchState:
    """Generations until every station stalled or reached ``max_gen``.

    The driver only keeps the generation number and one flag; each generation is written to the
    history and read back from there.
    """
    n_params = len(ranges.names)

    def step(gen: int, individuals: DataFrame) -> DataFrame:
        history.write(gen, evaluate(individuals, ranges, model))
        return history.generation(gen)

    state = restore(history, settings) if history.exists() else None
    if state is None:
        first = initial_population(stations, n_params, settings.pop, settings.seed)
        state = _advance(None, 0, step(0, first), settings)
    while state.gen < settings.max_gen:
        active = settle(_active(state, settings))
        if active.isEmpty():
            break
        gen = state.gen + 1
        parents = state.population.join(active, "obsid", "left_semi")
        state = _advance(state, gen, step(gen, vary(parents, gen, settings, n_params)), settings)
    return state

"""Run histories: ranking, best parameters, Pareto archives, generation statistics.

A history row is ``(obsid, gen, run, <objectives>, ...)``; (gen, run) breaks every tie.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach, attach_stats, running_total
from gaugeflow.operators import fronts
from gaugeflow.session import settle

# Fixed values of the ranking.
BEST_SHARE = 0.1
RANK_FLOOR, RANK_CEILING = 0.1, 1.0
PSEUDO_RUNS = ["MinValue", "DefaultValue", "MaxValue"]


def tie_break(keys: list[str]) -> list[Column]:
    return [F.asc(k) for k in ("gen", "run") if k not in keys]


def best_runs(history: DataFrame, keys: list[str], share: float = BEST_SHARE,
              minimum: int = 2) -> DataFrame:
    """The best share of the runs by kge, at least ``minimum``; halves round to even."""
    sizes = settle(history.groupBy(*keys).agg(F.count(F.lit(1)).alias("_runs")))
    largest = sizes.agg(F.max("_runs")).first()[0] or 0
    ranked = running_total(history, keys, [F.desc("kge"), *tie_break(keys)], "_rank", largest=largest)
    keep = F.greatest(F.lit(minimum), F.bround(F.col("_runs") * F.lit(share))).cast("long")
    return (attach(ranked, sizes.withColumn("_keep", keep).drop("_runs"), keys)
            .filter(F.col("_rank") <= F.col("_keep")).drop("_rank", "_keep"))


def rank_runs(history: DataFrame, keys: list[str], share: float = BEST_SHARE, minimum: int = 2,
              floor: float = RANK_FLOOR, ceiling: float = RANK_CEILING) -> DataFrame:
    """Rank scores of the best runs and their product; ``floor=0`` gives the plain i/n scores."""
    best = settle(best_runs(history, keys, share, minimum))
    sizes = settle(best.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    orders = {"corrRank": F.desc("corr"), "saeRank": F.asc("sae"), "KGERank": F.desc("kge")}
    ranked = best
    for name, order in orders.items():
        ranked = running_total(ranked, keys, [order, *tie_break(keys)], name, largest=largest)
    scored = attach(ranked, sizes, keys)
    for name in orders:
        scored = scored.withColumn(
            name, F.lit(floor) + F.col(name) * F.lit(ceiling - floor) / F.col("_n"))
    return scored.withColumn(
        "paretoRank", F.col("corrRank") * F.col("saeRank") * F.col("KGERank")).drop("_n")


def best_run(ranked: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The run with the smallest product of ranks per group."""
    first = F.min_by(F.struct(*columns), F.struct("paretoRank", "gen", "run")).alias("_best")
    return ranked.groupBy(*keys).agg(first).select(*keys, "_best.*")


def best_parameters(ranked: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Best parameter set per station: effover and R (both the kge) and param_NN_name columns."""
    best = best_run(ranked, keys, ["kge", "params"])
    return best.select(
        *keys, F.col("kge").alias("effover"), F.col("kge").alias("R"),
        *[F.element_at("params", i + 1).alias(f"param_{i:02d}_{name}") for i, name in enumerate(names)])


def pareto_set(runs: DataFrame, keys: list[str], objectives: list[str], block: int = fronts.BLOCK) -> DataFrame:
    """Rows that no row of their group dominates; rows with a NULL objective are left out.

    Points are reduced first (see ``fronts``): one objective by its maximum, two by a sweep, more by
    skylines of batches and blocks, which are then compared pairwise. The number of passes and
    written tables does not depend on the size of the set.
    """
    known = reduce(lambda x, y: x & y, [F.col(o).isNotNull() for o in objectives])
    points = runs.filter(known).select(*keys, *objectives)
    return runs.join(fronts.skyline(points, keys, objectives, block), [*keys, *objectives], "left_semi")


def front_numbers(runs: DataFrame, keys: list[str], objectives: list[str]) -> DataFrame:
    """0-based non-dominated front per run; a NULL objective is worse than any number."""
    return fronts.front_numbers(runs, keys, objectives)


def crowding(ranked: DataFrame, keys: list[str], objectives: list[str], run_id: str) -> DataFrame:
    """Crowding distance inside each front; the ends of an objective are infinitely far apart."""
    long = ranked.unpivot([*keys, "front", run_id], objectives, "objective", "value")
    group = Window.partitionBy(*keys, "front", "objective")
    order = group.orderBy("value", run_id)
    gap = F.lead("value").over(order) - F.lag("value").over(order)
    width = F.max("value").over(group) - F.min("value").over(group)
    share = F.when(gap.isNull(), F.lit(float("inf"))).when(width == 0, F.lit(0.0)).otherwise(
        gap / F.when(width != 0, width * F.lit(float(len(objectives)))))
    distance = (long.withColumn("_d", share).groupBy(*keys, run_id)
                .agg(F.sum("_d").alias("distance")))
    return ranked.join(distance, [*keys, run_id])


def select_survivors(runs: DataFrame, keys: list[str], objectives: list[str], mu: int,
                     run_id: str) -> DataFrame:
    """Best ``mu`` of a bounded group: by front, then by crowding distance.

    One objective needs no fronts: the largest values win.
    """
    if len(objectives) == 1:
        order = [F.desc(objectives[0]), F.asc(run_id)]
        picked = runs
    else:
        picked = crowding(front_numbers(runs, keys, objectives), keys, objectives, run_id)
        order = [F.asc("front"), F.desc("distance"), F.asc(run_id)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return picked.withColumn("_rank", rank).filter(F.col("_rank") <= mu).drop(
        "_rank", "front", "distance")


def archive_statistics(archive: DataFrame, keys: list[str], objective: str) -> DataFrame:
    """Maximum, minimum, population deviation and mean of an objective over an archive."""
    return archive.groupBy(*keys).agg(
        F.max(objective).alias("effmax_R"), F.min(objective).alias("effmin_R"),
        F.stddev_pop(objective).alias("effstd_R"), F.avg(objective).alias("effavg_R"))


def front_history(history: DataFrame) -> DataFrame:
    """Statistics of the archive after every generation for a search driven by kge.

    The archive of one objective holds only points of the best value so far, so its maximum,
    minimum and mean agree and its deviation is zero. Generations are reduced first; the running
    maximum then sees one row per station and generation.
    """
    best = history.groupBy("obsid", "gen").agg(F.max("kge").alias("_best"))
    so_far = Window.partitionBy("obsid").orderBy("gen").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    top = F.max("_best").over(so_far)
    return best.select("obsid", "gen", top.alias("effmax_R"), top.alias("effmin_R"),
                       F.lit(0.0).alias("effstd_R"), top.alias("effavg_R"))


def termination(fronts: DataFrame, min_gen: int, max_gen: int, offset: int, tolerance: float) -> DataFrame:
    """Stop flags per station and generation; a missing earlier generation is no stall."""
    earlier = F.lag("effmax_R", offset).over(Window.partitionBy("obsid").orderBy("gen"))
    gain = F.col("effmax_R") - earlier
    stalled = (F.col("gen") >= min_gen) & F.coalesce(gain < F.lit(tolerance), F.lit(False))
    return fronts.withColumn("stalled", stalled).withColumn(
        "reached_max_gen", F.col("gen") >= max_gen)


def reaches_target(fronts: DataFrame, lower: float, target: float, tolerance: float) -> DataFrame:
    """Last effmax per station, and whether it is above ``lower`` and close enough to ``target``."""
    last = fronts.groupBy("obsid").agg(F.max_by("effmax_R", "gen").alias("effmax_R"))
    value = F.col("effmax_R")
    return last.withColumn("reached", (F.abs(value - target) < tolerance) & (value > lower))


def complete_generations(history: DataFrame, pop: int, lam: int) -> DataFrame:
    """History up to the first generation whose run count is not the expected one."""
    counts = history.groupBy("obsid", "gen").agg(F.count(F.lit(1)).alias("_runs"))
    expected = F.when(F.col("gen") == 0, F.lit(pop)).otherwise(F.lit(lam))
    order = Window.partitionBy("obsid").orderBy("gen")
    broken = (F.col("_runs") != expected) | (F.col("gen") != F.row_number().over(order) - 1)
    flagged = counts.withColumn("_broken", broken)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = flagged.withColumn("_bad", F.max("_broken").over(so_far)).filter("NOT _bad")
    return attach_stats(history, whole.select("obsid", "gen"), ["obsid", "gen"])


def merge_scenarios(histories: dict[str, DataFrame]) -> DataFrame:
    """Union of run histories with the name of their scenario."""
    tagged = [h.withColumn("scenario", F.lit(name)) for name, h in histories.items()]
    return reduce(DataFrame.unionByName, tagged)


def choose_scenario(merged: DataFrame, listed: DataFrame, inside: str, outside: str) -> DataFrame:
    """One scenario for the listed stations, the other one for the rest."""
    marks = listed.select("obsid").distinct().withColumn("_listed", F.lit(True))
    wanted = F.when(F.col("_listed"), F.lit(inside)).otherwise(F.lit(outside))
    return (attach(merged, marks, ["obsid"], "left").filter(F.col("scenario") == wanted)
            .drop("_listed"))

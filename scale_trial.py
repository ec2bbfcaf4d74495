"""Trial on generated series and grids that are larger than the test tables.

    python scale_trial.py [name ...]

Prints seconds and rows per second for each trial. One station holds a third of the rows.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import functions as F

from gaugeflow.functions.skew import running_total, values_at_ranks
from gaugeflow.operators import history, metrics, network, search
from gaugeflow.session import build_session, settle

ROWS = 60_000_000
CELLS = 4_000_000
STATIONS = 1_000


def skewed_pairs(spark, rows: int):
    """Every third row belongs to station 0."""
    i = F.col("id")
    noise = (F.xxhash64("id") % 1000) / 1000.0
    return spark.range(rows).select(
        F.when(i % 3 == 0, F.lit(0)).otherwise(i % STATIONS).alias("obsid"), i.alias("step"),
        (F.abs(noise) * 50 + 1).alias("o"), (F.abs(noise) * 45 + 2 + (i % 7)).alias("s"))


def fit(spark):
    """Sixteen scores per station in one pass."""
    names = [m for m in metrics.METRICS if m != "kge_skill"]
    metrics.goodness_of_fit(skewed_pairs(spark, ROWS), ["obsid"], names).collect()
    return ROWS


def low_flow(spark):
    """Exact percentile thresholds; the hot station is past the window bound."""
    metrics.low_flow_threshold(skewed_pairs(spark, ROWS), ["obsid"], 0.3).collect()
    return ROWS


def exact_quantiles(spark):
    """Three order statistics of a value that is distinct in every row."""
    pairs = skewed_pairs(spark, ROWS // 4).withColumn("v", F.xxhash64("step"))
    n = F.col("n")
    values_at_ranks(pairs, ["obsid"], "v", {"a": n * 0.25, "b": n * 0.5, "c": n - 1}, interpolate=False).collect()
    return ROWS // 4


def row_numbers(spark):
    """Row numbers of a group that is past the window bound."""
    pairs = skewed_pairs(spark, ROWS // 4).select("obsid", "step")
    running_total(pairs, ["obsid"], [F.asc("step")], "n").agg(F.max("n")).collect()
    return ROWS // 4


def best_runs(spark):
    """Ranking of the best tenth of a history where one station holds a third of the runs."""
    runs = skewed_pairs(spark, ROWS // 6).select(
        "obsid", F.lit(0).alias("gen"), F.col("step").alias("run"), (F.col("o") / 60).alias("kge"),
        (F.col("s") / 60).alias("corr"), "s", F.col("o").alias("sae"))
    history.rank_runs(settle(runs), ["obsid"]).agg(F.max("paretoRank")).collect()
    return ROWS // 6


def archive(spark):
    """Pareto set of three objectives with one hot station."""
    runs = skewed_pairs(spark, ROWS // 6).select("obsid", F.col("step").alias("run"), *[
        (F.pmod(F.xxhash64("step", F.lit(k)), F.lit(100_000)) / 1e5).alias(f"f{k}") for k in range(3)])
    history.pareto_set(runs, ["obsid"], ["f0", "f1", "f2"]).agg(F.count("run")).collect()
    return ROWS // 6


def topology(spark):
    """Regions and station tree; a third of the cells drain into one confluence."""
    i = F.col("id")
    target = i - 1 - F.pmod(F.xxhash64("id"), F.lit(40))
    kept = target - (target % 3 == 0).cast("long")  # the other cells form one long river system
    ldd = settle(spark.range(CELLS).select(
        i.alias("cell"), F.when(i == 0, None).when((i % 3 == 0) | (kept < 1), F.lit(0))
        .otherwise(kept).alias("down")))
    gauges = ldd.filter("cell % 997 = 5").select("cell", F.col("cell").alias("obsid"))
    regions = settle(network.interstation_regions(ldd, gauges, hot_rows=100_000))
    parents = settle(network.station_parents(ldd, gauges, regions))
    print("  deepest station", network.station_tree(parents, regions).agg(F.max("depth")).first()[0])
    return CELLS


def generation(spark):
    """One search generation of 100 stations, 72 individuals and 2,000 steps."""
    n, pop, steps = 100, 72, 2_000
    base = settle(spark.range(n * steps).select(
        (F.col("id") % n).alias("obsid"), F.timestamp_seconds(F.floor(F.col("id") / n) * 86400).alias("ts"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0 + 1).alias("o")))
    ranges = search.Ranges(["gain", "offset"], [0.5, -5.0], [2.0, 5.0], [1.0, 0.0])

    def simulate(people):
        runs = people.select("obsid", "run", F.element_at("params", 1).alias("g"), F.element_at("params", 2).alias("k"))
        return base.join(runs, "obsid").select("obsid", "run", "ts", (F.col("g") * F.col("o") + F.col("k")).alias("s"))

    people = search.initial_population(spark.range(n).select(F.col("id").alias("obsid")), 2, pop, 1)
    search.evaluate(people, ranges, search.series_model(simulate, base)).agg(F.max("kge")).collect()
    return n * pop * steps


TRIALS = {f.__name__: f for f in (
    fit, low_flow, exact_quantiles, row_numbers, best_runs, archive, topology, generation)}


def main() -> None:
    spark = build_session(8, 32)
    for name in sys.argv[1:] or TRIALS:
        started = time.time()
        rows = TRIALS[name](spark)
        seconds = time.time() - started
        print(f"{name:16s} {seconds:7.1f} s {rows / seconds / 1e6:8.2f} million rows/s", flush=True)


if __name__ == "__main__":
    main()

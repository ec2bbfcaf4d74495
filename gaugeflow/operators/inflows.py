"""Upstream series that enter a station's catchment, in link order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach
from gaugeflow.operators.alignment import end_violations
from gaugeflow.operators.network import link_slots


def gather_inflows(links: DataFrame, sim: DataFrame) -> DataFrame:
    """(obsid, inlet_no, upstream_id, step, q): the simulated series of every linked station."""
    series = sim.withColumnRenamed("obsid", "upstream_id")
    return attach(series, links, ["upstream_id"]).select(
        "obsid", "inlet_no", "upstream_id", *[c for c in series.columns if c != "upstream_id"])


def missing_upstream(links: DataFrame, sim: DataFrame) -> DataFrame:
    """Links whose upstream station has no simulated series."""
    present = sim.select(F.col("obsid").alias("upstream_id")).distinct()
    return links.join(present, "upstream_id", "left_anti")


def incomplete_inflows(links: DataFrame, sim: DataFrame, end: datetime) -> DataFrame:
    """Links whose upstream series does not stop at the end of the forcing; ``last_ts`` is NULL for an absent one.

    Only the series of linked stations are read. Empty when every inflow covers the run.
    """
    used = links.select(F.col("upstream_id").alias("obsid")).distinct()
    ends = end_violations(sim.join(used, "obsid", "left_semi"), used.withColumn("end", F.lit(end)))
    return links.join(ends.select(F.col("obsid").alias("upstream_id"), "last_ts"), "upstream_id")


def inflow_flags(stations: DataFrame, links: DataFrame) -> DataFrame:
    """Number of inflows per station and the flag '1' / '0'."""
    counts = links.groupBy("obsid").agg(F.count(F.lit(1)).alias("n_inflows"))
    n = F.coalesce("n_inflows", F.lit(0)).cast("long")
    return stations.select("obsid").join(counts, "obsid", "left").select(
        "obsid", n.alias("n_inflows"), F.when(n > 0, "1").otherwise("0").alias("inflow_flag"))


def inflows_wide(inflows: DataFrame, order: str = "step", slots: int | None = None) -> DataFrame:
    """A row per station and step with one column per inlet."""
    slots = slots or link_slots(inflows)
    wide = inflows.groupBy("obsid", order).pivot("inlet_no", list(range(1, slots + 1)))
    table = wide.agg(F.first("q"))
    return table.select("obsid", order, *[F.col(str(i)).alias(f"q_{i}") for i in range(1, slots + 1)])

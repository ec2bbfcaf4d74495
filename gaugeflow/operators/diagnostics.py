"""One table per station with everything the diagnostic figures show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach

# Names of the state variables, in figure order.
STATE_VARIABLES = [
    "rainUps", "snowUps", "snowMeltUps", "frostUps", "actEvapo", "theta1total", "theta2total",
    "theta3total", "dTopToSubUps", "qUzUps", "qLzUps", "percUZLZUps", "dSubToUzUps",
    "prefFlowUps", "infUps", "surfaceRunoffUps", "lossUps", "lzUps",
]


def states_wide(states: DataFrame, variables: list[str] | None = None) -> DataFrame:
    """A column per state variable for each station and timestamp."""
    return states.groupBy("obsid", "ts").pivot("variable", variables or STATE_VARIABLES).agg(
        F.first("value"))


def diagnostic_table(sim: DataFrame, obs: DataFrame, states: DataFrame, records: DataFrame,
                     scores: DataFrame, variables: list[str] | None = None) -> DataFrame:
    """Long-run simulation with observations, states, best scores and the period of each step.

    Every station of the simulation stays; without scores they are NULL, without a split date the
    period is ``other``.
    """
    per_station = records.select("obsid", "Split_date").join(
        scores.select("obsid", "kge", "corr", "bias", "spread"), "obsid", "full")
    joined = (
        sim.select("obsid", "ts", "s")
        .join(obs.select("obsid", "ts", "o"), ["obsid", "ts"], "left")
        .join(states_wide(states, variables), ["obsid", "ts"], "left")
    )
    period = F.when(F.col("ts") >= F.col("Split_date"), F.lit("calibration")).otherwise(F.lit("other"))
    return attach(joined, per_station, ["obsid"], "left").withColumn("period", period).drop("Split_date")

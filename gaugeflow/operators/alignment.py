"""Resampling and pairing of simulated and observed series.

Series are long tables ``(obsid, ts, <values>)``; observed ``o``, simulated ``s``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach_stats, running_total
from gaugeflow.functions.values import add_minutes, check_step, right_edge_day

PERIOD_UNITS = {"D": "day", "M": "month", "Y": "year"}


def dense_calendar(bounds: DataFrame, start: str, end: str, minutes: int,
                   keys: tuple[str, ...] = ("obsid",)) -> DataFrame:
    """Every timestamp from start to end per station."""
    check_step(minutes)
    step = F.make_dt_interval(mins=F.lit(minutes))
    return bounds.select(*keys, F.explode(F.sequence(F.col(start), F.col(end), step)).alias("ts"))


def fill_calendar(series: DataFrame, bounds: DataFrame, start: str, end: str, minutes: int,
                  keys: tuple[str, ...] = ("obsid",)) -> DataFrame:
    """The series on its dense calendar, NULL where a step is absent."""
    return dense_calendar(bounds, start, end, minutes, keys).join(series, [*keys, "ts"], "left")


def daily_mean(series: DataFrame, values: list[str], keys: tuple[str, ...] = ("obsid",)) -> DataFrame:
    """Mean over the bins (00:00, 24:00], labelled at the midnight that closes them."""
    day = right_edge_day(F.col("ts"))
    return series.groupBy(*keys, day.alias("ts")).agg(*[F.avg(v).alias(v) for v in values])


def resample_pairs(sim: DataFrame, obs: DataFrame, stations: DataFrame, minutes: int,
                   keys: tuple[str, ...] = ("obsid",)) -> tuple[DataFrame, DataFrame]:
    """Bring both series to the calibration step.

    A 360-minute run of a ``_24h`` station is averaged to days on both sides; a 1440-minute run
    averages only the observations.
    """
    check_step(minutes)
    if minutes == 1440:
        return sim, daily_mean(obs, ["o"])
    daily = stations.select("obsid", F.contains("CAL_TYPE", F.lit("_24h")).alias("_daily"))
    label = F.when(F.col("_daily"), right_edge_day(F.col("ts"))).otherwise(F.col("ts"))

    def to_step(series: DataFrame, value: str, by: list[str]) -> DataFrame:
        return (attach_stats(series, daily, ["obsid"])
                .groupBy(*by, label.alias("ts")).agg(F.avg(value).alias(value)))

    return to_step(sim, "s", list(keys)), to_step(obs, "o", ["obsid"])


def slice_window(series: DataFrame, windows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows inside the station's window, both ends included."""
    bounds = windows.select("obsid", F.col(start).alias("_from"), F.col(end).alias("_to"))
    return (attach_stats(series, bounds, ["obsid"])
            .filter(F.col("ts").between(F.col("_from"), F.col("_to"))).drop("_from", "_to"))


def align(sim: DataFrame, obs: DataFrame) -> DataFrame:
    """Pairs on (station, timestamp); the join key is spread by time, so no station is hot."""
    return sim.join(obs, ["obsid", "ts"], "inner")


def alignment_violations(sim: DataFrame, obs: DataFrame) -> DataFrame:
    """Timestamps that break the pairing rules, with the reason; empty when the series fit."""
    both = (sim.withColumn("_sim", F.lit(True))
            .join(obs.withColumn("_obs", F.lit(True)), ["obsid", "ts"], "full_outer"))
    reason = (
        F.when(F.col("_sim").isNull(), F.lit("no simulated step"))
        .when(F.col("_obs").isNull(), F.lit("no observed step"))
        .when(F.col("s").isNull(), F.lit("simulated value missing"))
    )
    return both.select("obsid", "ts", reason.alias("reason")).filter(F.col("reason").isNotNull())


def series_bounds_violations(series: DataFrame, stations: DataFrame,
                             start: str = "Obs_start", end: str = "Obs_end") -> DataFrame:
    """Stations whose first or last timestamp differs from their record."""
    ends = series.groupBy("obsid").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return (
        stations.select("obsid", F.col(start).alias("expected_first"), F.col(end).alias("expected_last"))
        .join(ends, "obsid", "left")
        .filter(~(F.col("first_ts").eqNullSafe(F.col("expected_first"))
                  & F.col("last_ts").eqNullSafe(F.col("expected_last"))))
    )


def period_max(series: DataFrame, value: str, period: str = "D",
               keys: tuple[str, ...] = ("obsid",)) -> DataFrame:
    """Largest value per day (right-closed), calendar month or calendar year."""
    if period not in PERIOD_UNITS:
        raise ValueError(f"period {period!r} is not one of {sorted(PERIOD_UNITS)}")
    label = (right_edge_day(F.col("ts")) if period == "D"
             else F.date_trunc(PERIOD_UNITS[period], F.col("ts")))
    return series.groupBy(*keys, label.alias("period")).agg(F.max(value).alias("peak"))


def number_steps(series: DataFrame, keys: tuple[str, ...] = ("obsid",)) -> DataFrame:
    """1-based step number by time."""
    return running_total(series, list(keys), [F.col("ts")], "step")


def stamp_steps(series: DataFrame, starts: DataFrame, minutes: int) -> DataFrame:
    """Timestamps for step numbers: the station's start plus (step - 1) steps."""
    check_step(minutes)
    begin = starts.select("obsid", F.col("start").alias("_start"))
    stamped = attach_stats(series, begin, ["obsid"])
    return stamped.withColumn(
        "ts", add_minutes(F.col("_start"), (F.col("step") - 1) * F.lit(minutes))).drop("_start")


def end_violations(stamped: DataFrame, ends: DataFrame, keys: tuple[str, ...] = ("obsid",)) -> DataFrame:
    """Series whose last timestamp is not the expected end; absent series have a NULL last_ts."""
    last = stamped.groupBy(*keys).agg(F.max("ts").alias("last_ts"))
    return (ends.select(*keys, F.col("end").alias("expected_last")).join(last, list(keys), "left")
            .filter(~F.col("last_ts").eqNullSafe(F.col("expected_last"))))

"""Choice of stations, record lengths and calibration periods."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach, attach_stats, values_at_ranks
from gaugeflow.functions.values import add_days, step_hours

DAYS_PER_YEAR = 365.25  # fixed value


@dataclass(frozen=True)
class Forcing:
    """Period covered by the meteorological forcing."""
    start: datetime
    end: datetime


def calibration_stations(stations: DataFrame, minimum_type: int) -> DataFrame:
    """Stations whose calibration class is a number of at least ``minimum_type``."""
    return stations.filter(F.col("EC_calib").try_cast("int") >= F.lit(minimum_type))


def observation_windows(stations: DataFrame, forcing: Forcing) -> DataFrame:
    """First usable timestamp (forcing start plus spin-up) and last one per station."""
    return stations.withColumns({
        "window_start": add_days(F.lit(forcing.start), F.col("Spinup_days")),
        "window_end": F.lit(forcing.end),
    })


def in_window(obs: DataFrame, windowed: DataFrame) -> DataFrame:
    """Observations inside the window of their station (station columns are not added)."""
    bounds = windowed.select("obsid", "window_start", "window_end")
    return (attach(obs, bounds, ["obsid"])
            .filter(F.col("ts").between(F.col("window_start"), F.col("window_end")))
            .drop("window_start", "window_end"))


def record_lengths(stations: DataFrame, obs: DataFrame, forcing: Forcing) -> DataFrame:
    """Valid steps, days and years per station inside its window."""
    windowed = observation_windows(stations, forcing)
    counts = in_window(obs, windowed).groupBy("obsid").agg(F.count("q").alias("n_data"))
    per_day = F.lit(24.0) / step_hours(F.col("CAL_TYPE"))
    return (
        windowed.join(counts, "obsid", "left")
        .withColumn("n_data", F.coalesce("n_data", F.lit(0)).cast("long"))
        .withColumn("period_days", F.col("n_data") / per_day)
        .withColumn("period_years", F.col("period_days") / F.lit(DAYS_PER_YEAR))
    )


def screen_stations(stations: DataFrame, obs: DataFrame, forcing: Forcing,
                    minimum_type: int) -> DataFrame:
    """Stations of interest with ``is_valid``: the record reaches the required days."""
    return record_lengths(calibration_stations(stations, minimum_type), obs, forcing).withColumn(
        "is_valid", F.col("period_days") >= F.col("Min_calib_days").cast("double"))


def require_records(lengths: DataFrame) -> DataFrame:
    """Strict form for extraction: a short record fails the job."""
    short = F.col("period_days") < F.col("Min_calib_days").cast("double")
    text = F.concat(F.lit("station "), F.col("obsid").cast("string"), F.lit(" only contains "),
                    F.col("period_days").cast("string"), F.lit(" days of data"))
    return lengths.withColumn("period_days", F.when(short, F.raise_error(text).cast("double"))
                              .otherwise(F.col("period_days")))


def require_any_valid(screened: DataFrame) -> DataFrame:
    if screened.filter("is_valid").isEmpty():
        raise ValueError("not a single station has enough data for calibration")
    return screened


def known_stations(requested: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Station rows of the requested ids, and the ids that do not exist."""
    return (stations.join(requested, "obsid", "left_semi"),
            requested.join(stations, "obsid", "left_anti"))


def work_list(stations: DataFrame, listed: DataFrame) -> DataFrame:
    """Listed stations with a known area, smallest first."""
    return (stations.join(listed, "obsid", "left_semi").filter(F.col("area").isNotNull())
            .orderBy("area", "obsid"))


def valid_bounds(obs: DataFrame) -> DataFrame:
    """First and last valid observation and the number of valid values."""
    has = F.col("q").isNotNull()
    return (obs.groupBy("obsid")
            .agg(F.min(F.when(has, F.col("ts"))).alias("Obs_start"),
                 F.max(F.when(has, F.col("ts"))).alias("Obs_end"),
                 F.count("q").alias("N_data"))
            .filter("N_data > 0"))


def trim_to_valid(obs: DataFrame) -> DataFrame:
    """Each record from its first to its last valid value; gaps inside are kept."""
    bounds = valid_bounds(obs).drop("N_data")
    return (attach_stats(obs, bounds, ["obsid"])
            .filter(F.col("ts").between(F.col("Obs_start"), F.col("Obs_end")))
            .drop("Obs_start", "Obs_end"))


def _valid_groups(stations: DataFrame, obs: DataFrame) -> DataFrame:
    counts = obs.groupBy("obsid").agg(F.count("q").alias("n")).filter("n > 0")
    hours = step_hours(F.col("CAL_TYPE"))
    return (counts.join(stations.select("obsid", hours.alias("hours")), "obsid")
            .withColumn("years", F.col("n") * F.col("hours") / F.lit(24.0 * DAYS_PER_YEAR)))


def split_dates(stations: DataFrame, obs: DataFrame, short_years: float = 8,
                long_years: float = 16) -> DataFrame:
    """Start of the calibration period.

    Short records are used whole, medium ones for their last ``short_years``, long ones for
    their second half (counted in valid steps).
    """
    groups = _valid_groups(stations, obs)
    steps = F.floor(F.lit(short_years * DAYS_PER_YEAR * 24) / F.col("hours"))
    n, years = F.col("n"), F.col("years")
    rank = (F.when(years <= short_years, F.lit(0)).when(years < long_years, n - steps)
            .otherwise(F.floor(n / 2)))
    return values_at_ranks(obs.filter("q IS NOT NULL"), ["obsid"], "ts", {"Split_date": rank},
                           groups, interpolate=False)


def documented_periods(stations: DataFrame, obs: DataFrame, minimum_years: float) -> DataFrame:
    """The documented alternative: drop short records, halve those of at least twice the minimum,
    otherwise calibrate on the last ``minimum_years``. The earlier part validates."""
    groups = _valid_groups(stations, obs).filter(F.col("years") >= F.lit(minimum_years))
    steps = F.floor(F.lit(minimum_years * DAYS_PER_YEAR * 24) / F.col("hours"))
    n = F.col("n")
    first = F.when(F.col("years") >= 2 * minimum_years, F.floor(n / 2)).otherwise(n - steps)
    kept = obs.filter("q IS NOT NULL").join(groups.select("obsid"), "obsid", "left_semi")
    return values_at_ranks(
        kept, ["obsid"], "ts",
        {"Val_Start": F.when(first > 0, F.lit(0)), "Val_End": F.when(first > 0, first - 1),
         "Cal_Start": first, "Cal_End": n - 1}, groups, interpolate=False)


def station_records(stations: DataFrame, obs: DataFrame, forcing: Forcing,
                    strict: bool = True) -> DataFrame:
    """Station rows enriched with observation bounds, split date and number of values."""
    lengths = record_lengths(stations, obs, forcing)
    if strict:
        lengths = require_records(lengths)
    sliced = in_window(obs, observation_windows(stations, forcing))
    return (lengths.drop("n_data").join(valid_bounds(sliced), "obsid")
            .join(split_dates(stations, sliced), "obsid"))


def run_windows(records: DataFrame, fast_debug: bool = False) -> DataFrame:
    """Observation and calibration window of a run; the debug window is 120 days long."""
    begin = F.col("Split_date")
    if fast_debug:
        end, cal_start = add_days(begin, F.lit(120)), begin
    else:
        end, cal_start = F.col("Obs_end"), add_days(begin, -F.col("Spinup_days").cast("int"))
    return records.select("obsid", begin.alias("obs_start"), end.alias("obs_end"),
                          cal_start.alias("cal_start"), end.alias("cal_end"))


def run_plan(records: DataFrame, stations: DataFrame, prerun_end: datetime,
             fast_debug: bool = False) -> DataFrame:
    """Run windows plus the pre-run start each station asks for."""
    return (run_windows(records, fast_debug)
            .join(stations.select("obsid", "prerun_start"), "obsid")
            .withColumn("prerun_end", F.lit(prerun_end)))


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose output does not exist yet."""
    return work.join(done, keys, "left_anti")

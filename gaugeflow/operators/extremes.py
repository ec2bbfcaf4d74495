"""Ranked peaks, Gumbel fit and return-level thresholds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
PLOTTING = {"Weibull": 0.0, "Hazen": 0.5, "Gringorten": 0.44}
RETURN_YEARS = {"rl1.5": 1.5, "rl2": 2.0, "rl5": 5.0, "rl20": 20.0}
PERIODS_PER_YEAR = {"D": 365.25, "M": 12.0, "Y": 1.0}
EULER = 0.5772
TOP_PEAKS = 30


def exceedance(rank: Column, n: Column, fitter: str = "Gringorten") -> Column:
    """Non-exceedance probability of the rank-th largest of n peaks."""
    if fitter == "cdf":
        return (n - rank) / n
    if fitter not in PLOTTING:
        raise ValueError(f"unknown plotting position {fitter!r}, use cdf or {sorted(PLOTTING)}")
    b = PLOTTING[fitter]
    return 1 - (rank - F.lit(b)) / (n + F.lit(1 - 2 * b))


def return_period(p: Column) -> Column:
    return F.when(p < 1, 1 / F.when(p < 1, 1 - p))


def reduced_variate(period: Column) -> Column:
    """-ln(ln(T / (T - 1))); NULL unless T > 1."""
    safe = F.when(period > 1, period)
    return -F.ln(F.ln(safe / (safe - 1)))


def gumbel_quantile(period: Column, a: Column, u: Column) -> Column:
    return a * reduced_variate(period) + u


def periods(unit: str) -> dict[str, float]:
    """Return periods counted in resampling steps."""
    if unit not in PERIODS_PER_YEAR:
        raise ValueError(f"unknown period unit {unit!r}, use one of {sorted(PERIODS_PER_YEAR)}")
    return {name: years * PERIODS_PER_YEAR[unit] for name, years in RETURN_YEARS.items()}


def gumbel_moments(peaks: DataFrame, keys: list[str]) -> DataFrame:
    """Scale and location from mean and sample deviation of all peaks."""
    a = F.lit(math.sqrt(6) / math.pi) * F.stddev_samp("peak")
    return peaks.groupBy(*keys).agg(a.alias("a"), (F.avg("peak") - F.lit(EULER) * a).alias("u"))


def ranked_peaks(peaks: DataFrame, keys: list[str], fitter: str = "Gringorten",
                 top: int = TOP_PEAKS) -> DataFrame:
    """The largest peaks with rank, probability and return period.

    The rank filter cuts each map task to ``top`` rows per station before the shuffle; the number
    of peaks is a separate aggregate.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("peak"), F.asc("period"))
    best = peaks.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    sizes = peaks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    p = exceedance(F.col("rank"), F.col("n"), fitter)
    return (best.join(sizes, keys).withColumn("p", p)
            .withColumn("T", return_period(F.col("p"))).filter("T IS NOT NULL"))


def gumbel_fit(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """Least squares of peak on the reduced variate (the Gumbel line is linear in a and u)."""
    z = reduced_variate(F.col("T"))
    y = F.when(z.isNotNull(), F.col("peak"))
    table = ranked.groupBy(*keys).agg(
        F.regr_slope(y, z).alias("a"), F.regr_intercept(y, z).alias("u"),
        F.regr_count(y, z).alias("m"), F.regr_avgx(y, z).alias("_mean_z"),
        F.regr_sxx(y, z).alias("_szz"), F.regr_sxy(y, z).alias("_szy"),
        F.regr_syy(y, z).alias("_syy"))
    szz = F.col("_szz")
    residual = F.col("_syy") - F.try_divide(F.col("_szy") * F.col("_szy"), szz)
    s2 = F.when(F.col("m") > 2, F.greatest(residual, F.lit(0.0)) / F.when(F.col("m") > 2, F.col("m") - 2))
    spread = F.col("_mean_z") * F.col("_mean_z")
    return table.select(
        *keys, "a", "u", "m", F.sqrt(F.try_divide(s2, szz)).alias("se_a"),
        F.sqrt(s2 * (1 / F.col("m") + F.try_divide(spread, szz))).alias("se_u"))


def thresholds(peaks: DataFrame, keys: list[str], unit: str = "D",
               fitter: str = "Gringorten", top: int = TOP_PEAKS) -> DataFrame:
    """One row per station with the return levels rl1.5, rl2, rl5 and rl20."""
    fit = gumbel_fit(ranked_peaks(peaks, keys, fitter, top), keys)
    return fit.select(*keys, *[
        gumbel_quantile(F.lit(steps), F.col("a"), F.col("u")).alias(name)
        for name, steps in periods(unit).items()])


def thresholds_long(wide: DataFrame, keys: list[str]) -> DataFrame:
    """(station, return period in years, level)."""
    levels = F.array(*[F.struct(F.lit(years).alias("return_period"), F.col(f"`{name}`").alias("level"))
                       for name, years in RETURN_YEARS.items()])
    return wide.select(*keys, F.inline(levels))

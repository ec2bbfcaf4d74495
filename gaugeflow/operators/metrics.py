"""Goodness of fit of simulated (``s``) against observed (``o``) values.

All scores of a group come from one aggregation over shared moments. Groups with fewer than two
valid pairs have NULL scores. Objective tuples keep every key of the pairs, with the worst kge and
NULL for the rest where fewer than two pairs are valid.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach_stats, values_at_ranks
from gaugeflow.functions.values import log_or_null, ratio

KGE_FLOOR = -100.0  # fixed value: worst efficiency reported
NSE_GUARD = 1e-20  # fixed value: keeps the denominator above zero
NO_SKILL_KGE = 1 - 2 ** 0.5  # efficiency of the mean of the observations


def valid_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("s").isNotNull() & F.col("o").isNotNull())


def blanked_pairs(pairs: DataFrame) -> DataFrame:
    """All rows; an invalid pair has neither value."""
    valid = F.col("s").isNotNull() & F.col("o").isNotNull()
    return pairs.withColumns({c: F.when(valid, F.col(c)) for c in ("s", "o")})


def moment_columns(s: Column, o: Column, prefix: str = "") -> list[Column]:
    return [
        F.count(F.when(s.isNotNull() & o.isNotNull(), F.lit(1))).alias(f"{prefix}n"),
        F.avg(s).alias(f"{prefix}mean_s"), F.avg(o).alias(f"{prefix}mean_o"),
        F.stddev_pop(s).alias(f"{prefix}sd_s"), F.stddev_pop(o).alias(f"{prefix}sd_o"),
        F.covar_pop(s, o).alias(f"{prefix}cov"),
        F.sum((s - o) * (s - o)).alias(f"{prefix}sse"),
        F.sum(F.abs(s - o)).alias(f"{prefix}sae"),
    ]


class Moments:
    """Score formulas over the moment columns with a prefix."""

    def __init__(self, prefix: str = ""):
        self.prefix = prefix

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.prefix}{name}")

    @property
    def correlation(self) -> Column:
        return ratio(self["cov"], self["sd_s"] * self["sd_o"])

    @property
    def bias_ratio(self) -> Column:
        return ratio(self["mean_s"], self["mean_o"])

    @property
    def spread_ratio(self) -> Column:
        return ratio(ratio(self["sd_s"], self["mean_s"]), ratio(self["sd_o"], self["mean_o"]))

    @property
    def spread_of_o(self) -> Column:
        return self["n"] * self["sd_o"] * self["sd_o"]

    @property
    def kge(self) -> Column:
        return efficiency(self.correlation, self.bias_ratio, self.spread_ratio)


def efficiency(corr: Column, bias: Column, spread: Column) -> Column:
    """Modified Kling-Gupta efficiency of its three components."""
    return 1 - F.sqrt(F.pow(corr - 1, F.lit(2)) + F.pow(bias - 1, F.lit(2))
                      + F.pow(spread - 1, F.lit(2)))


def floored(kge: Column) -> Column:
    return F.greatest(F.coalesce(kge, F.lit(KGE_FLOOR)), F.lit(KGE_FLOOR))


M = Moments()
L = Moments("log_")

METRICS: dict[str, Callable[[], Column]] = {
    "rsr": lambda: ratio(F.sqrt(M["sse"]), F.sqrt(M.spread_of_o)),
    "br": lambda: 1 - F.abs(M.bias_ratio - 1),
    "pc_bias": lambda: 100 * ratio(M["mean_s"] - M["mean_o"], M["mean_o"]),
    "pc_bias2": lambda: 100 * ratio(M["mean_s"] - M["mean_o"], M["mean_o"]),
    "apb": lambda: 100 * ratio(M["sae"], M["n"] * M["mean_o"]),
    "apb2": lambda: 100 * ratio(F.abs(M["mean_s"] - M["mean_o"]), M["mean_o"]),
    "rmse": lambda: F.sqrt(M["sse"] / M["n"]),
    "sae": lambda: M["sae"],
    "mae": lambda: M["sae"] / M["n"],
    "mae_skill": lambda: 1 - M["sae"] / M["n"],
    "bias": lambda: M["mean_s"] - M["mean_o"],
    "nse": lambda: 1 - M["sse"] / (M.spread_of_o + F.lit(NSE_GUARD)),
    "nse_log": lambda: 1 - ratio(F.when(F.col("log_n") == M["n"], L["sse"]), L.spread_of_o),
    "corr": lambda: M.correlation,
    "kge": lambda: M.kge,
    "vr": lambda: 1 - F.abs(M.spread_ratio - 1),
    "bias_ratio": lambda: M.bias_ratio,
    "spread": lambda: M.spread_ratio,
    "kge_skill": lambda: (M.kge - F.lit(NO_SKILL_KGE)) / F.lit(1 - NO_SKILL_KGE),
}
LOG_METRICS = {"nse_log"}


def _log_moments() -> list[Column]:
    # a pair counts in the log moments only when both logs exist, so log_n == n means all do
    both = (F.col("s") > 0) & (F.col("o") > 0)
    return moment_columns(F.when(both, log_or_null(F.col("s"))),
                          F.when(both, log_or_null(F.col("o"))), "log_")


def _moments(pairs: DataFrame, keys: list[str], logs: bool) -> DataFrame:
    columns = moment_columns(F.col("s"), F.col("o"))
    if logs:
        columns += _log_moments()
    return blanked_pairs(pairs).groupBy(*keys).agg(*columns)


def _tuples(table: DataFrame, keys: list[str], kge: Column, **parts: Column) -> DataFrame:
    """Objective tuples of every group; undefined below two valid pairs."""
    enough = M["n"] > 1
    return table.select(*keys, F.when(enough, kge).otherwise(F.lit(KGE_FLOOR)).alias("kge"),
                        *[F.when(enough, c).alias(k) for k, c in parts.items()])


def goodness_of_fit(pairs: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """The named scores per group, in one pass. Add keys (station, run) as needed."""
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    table = _moments(pairs, keys, bool(LOG_METRICS & set(metrics)))
    enough = M["n"] > 1
    return table.select(*keys, M["n"], *[F.when(enough, METRICS[m]()).alias(m) for m in metrics])


def index_of_agreement(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Two passes: the mean of the observations enters the second one per row."""
    valid = valid_pairs(pairs)
    means = valid.groupBy(*keys).agg(F.avg("o").alias("_mean_o"))
    s, o, m = F.col("s"), F.col("o"), F.col("_mean_o")
    spread = F.abs(s - m) + F.abs(o - m)
    return (
        attach_stats(valid, means, keys).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum((o - s) * (o - s)).alias("_sse"),
             F.sum(spread * spread).alias("_potential"))
        .select(*keys, F.when(F.col("n") > 1, 1 - ratio(F.col("_sse"), F.col("_potential")))
                .alias("index_agreement"))
    )


def low_flow_threshold(pairs: DataFrame, keys: list[str], percentile: float) -> DataFrame:
    """Observed flow at an empirical non-exceedance i/n, linear between neighbours.

    Built-in percentiles divide by n-1 instead, so the rank is given explicitly.
    """
    rank = F.least(F.lit(percentile) * F.col("n"), F.col("n") - F.lit(1.0))
    return values_at_ranks(valid_pairs(pairs), keys, "o", {"threshold": rank})


def objectives(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Objective tuple (kge, corr, bias, spread, sae); an undefined kge is the floor."""
    return _tuples(_moments(pairs, keys, False), keys, floored(M.kge),
                   corr=M.correlation, bias=M.bias_ratio, spread=M.spread_ratio, sae=M["sae"])


def statistics(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Objective tuple plus the Nash-Sutcliffe efficiency."""
    return _tuples(_moments(pairs, keys, False), keys, floored(M.kge),
                   corr=M.correlation, bias=M.bias_ratio, spread=M.spread_ratio, sae=M["sae"],
                   nse=METRICS["nse"]())


def objectives_low_flow(pairs: DataFrame, keys: list[str], percentile: float,
                        peaks_only: bool = False) -> DataFrame:
    """Objective tuple with bias from low flow (or peaks only) and spread from the peaks."""
    if not 0 < percentile <= 1:
        raise ValueError("the percentile lies in (0, 1]")
    flagged = attach_stats(blanked_pairs(pairs), low_flow_threshold(pairs, keys, percentile), keys, "left")
    s, o = F.col("s"), F.col("o")
    peak = o > F.col("threshold")
    low = peak if peaks_only else ~peak
    table = flagged.groupBy(*keys).agg(
        *moment_columns(s, o),
        *moment_columns(F.when(peak, s), F.when(peak, o), "peak_"),
        *moment_columns(F.when(low, s), F.when(low, o), "low_"))
    bias, spread = Moments("low_").bias_ratio, Moments("peak_").spread_ratio
    return _tuples(table, keys, floored(efficiency(M.correlation, bias, spread)),
                   corr=M.correlation, bias=bias, spread=spread, sae=M["sae"])


def objectives_log_weighted(pairs: DataFrame, keys: list[str], weight: float) -> DataFrame:
    """Objective tuple blended with the tuple of the logs; the sixth power drops the sign.

    Components that need a log are NULL when a value of the group is not positive.
    """
    if not 0 < weight <= 1:
        raise ValueError("the weight lies in (0, 1]")

    def blend(plain: Column, logged: Column) -> Column:
        logged = F.when(F.col("log_n") == M["n"], logged)
        return F.pow(F.pow((1 - weight) * plain, F.lit(6.0))
                     + F.pow(weight * logged, F.lit(6.0)), F.lit(1.0 / 6.0))

    return _tuples(_moments(pairs, keys, True), keys, blend(floored(M.kge), L.kge),
                   corr=blend(M.correlation, L.correlation), bias=blend(M.bias_ratio, L.bias_ratio),
                   spread=blend(M.spread_ratio, L.spread_ratio), sae=M["sae"])


def mae_skill(pairs: DataFrame, keys: list[str], percentile: float = 0.0,
              peaks_only: bool = False) -> DataFrame:
    """1 - mean absolute error; only flows above the percentile count when peaks_only is set."""
    kept = valid_pairs(pairs)
    if percentile > 0 and peaks_only:
        kept = attach_stats(kept, low_flow_threshold(pairs, keys, percentile), keys).filter(
            F.col("o") > F.col("threshold"))
    skill = 1 - F.avg(F.abs(F.col("s") - F.col("o")))
    return kept.groupBy(*keys).agg(F.when(F.count(F.lit(1)) > 1, skill).alias("mae_skill"))


def split_monthly(pairs: DataFrame) -> DataFrame:
    """Valid pairs with their calendar month: the twelve samples as one long table."""
    return valid_pairs(pairs).withColumn("month", F.month("ts"))


def monthly_boxes(pairs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Box-plot numbers of a series per calendar month."""
    monthly = split_monthly(pairs)
    by = [*keys, "month"]
    n = F.col("n")
    quartiles = values_at_ranks(
        monthly, by, value,
        {"q1": 0.25 * (n - 1), "median": 0.5 * (n - 1), "q3": 0.75 * (n - 1)})
    ends = monthly.groupBy(*by).agg(
        F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.avg(value).alias("mean"))
    return ends.join(quartiles, by)


def long_run_scores(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Efficiencies over the whole forcing period; negative observations are missing."""
    cleaned = pairs.withColumn("o", F.when(F.col("o") >= 0, F.col("o")))
    return goodness_of_fit(cleaned, keys, ["kge", "nse", "kge_skill"])

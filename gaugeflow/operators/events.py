"""Threshold exceedances: contingency tables and the scores built on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach_stats
from gaugeflow.functions.values import log_or_null, ratio
from gaugeflow.operators.metrics import valid_pairs


def contingency(pairs: DataFrame, levels: DataFrame, labels: list[str],
                keys: list[str] | None = None) -> DataFrame:
    """Counts n, a (hit), b (false alarm), c (miss), d (correct reject) per station and threshold.

    ``levels`` is wide, a column per threshold, so every pair is read once and never multiplied.
    """
    keys = keys or ["obsid"]
    rows = attach_stats(valid_pairs(pairs), levels.select("obsid", *[F.col(f"`{x}`") for x in labels]),
                        ["obsid"])
    counts = []
    for i, label in enumerate(labels):
        level = F.col(f"`{label}`")
        sim, obs = F.col("s") >= level, F.col("o") >= level
        for cell, hit in {"a": sim & obs, "b": sim & ~obs, "c": ~sim & obs, "d": ~sim & ~obs}.items():
            counts.append(F.count_if(hit).cast("double").alias(f"_{cell}{i}"))
        counts.append(F.count(level).cast("double").alias(f"_n{i}"))
    tables = F.array(*[
        F.struct(F.lit(label).alias("threshold"),
                 *[F.col(f"_{cell}{i}").alias(cell) for cell in "nabcd"])
        for i, label in enumerate(labels)])
    return rows.groupBy(*keys).agg(*counts).select(*keys, F.inline(tables))


def _cells() -> tuple[Column, ...]:
    return tuple(F.col(x) for x in "nabcd")


def _pc() -> Column:
    n, a, _, _, d = _cells()
    return ratio(a + d, n)


def _threat() -> Column:
    _, a, b, c, _ = _cells()
    return ratio(a, a + b + c)


def _odds() -> Column:
    _, a, b, c, d = _cells()
    return ratio(a * d, b * c)


def _event_bias() -> Column:
    _, a, b, c, _ = _cells()
    return ratio(a + b, a + c)


def _skill(top_scale: int, bottom: Callable[..., Column]) -> Column:
    _, a, b, c, d = _cells()
    return ratio(F.lit(top_scale) * (a * d - b * c), bottom(a, b, c, d))


def _chance_corrected() -> Column:
    n, a, b, c, _ = _cells()
    by_chance = ratio((a + b) * (a + c), n)
    return ratio(a - by_chance, a - by_chance + b + c)


def _extreme(symmetric: bool) -> Column:
    n, a, b, c, _ = _cells()
    base = log_or_null(ratio(a + c, n))
    top = log_or_null(ratio(a + b, n)) + base if symmetric else 2 * base
    return ratio(top, log_or_null(ratio(a, n))) - 1


def _share(top: str, *bottom: str) -> Column:
    total = F.col(bottom[0])
    for name in bottom[1:]:
        total = total + F.col(name)
    return ratio(F.col(top), total)


SCORES: dict[str, Callable[[], Column]] = {
    "PC": _pc,
    "TS": _threat,
    "OR": _odds,
    "B": _event_bias,
    "FAR": lambda: _share("b", "a", "b"),
    "FARCR": lambda: _share("d", "c", "d"),
    "HR": lambda: _share("a", "a", "c"),
    "F": lambda: _share("b", "b", "d"),
    "PCR": lambda: _share("d", "b", "d"),
    "HSS": lambda: _skill(2, lambda a, b, c, d: (a + c) * (c + d) + (a + b) * (b + d)),
    "PSS": lambda: _skill(1, lambda a, b, c, d: (a + c) * (b + d)),
    "CSS": lambda: _skill(1, lambda a, b, c, d: (a + b) * (c + d)),
    "GSS": _chance_corrected,
    "EDS": lambda: _extreme(symmetric=False),
    "SEDS": lambda: _extreme(symmetric=True),
    "Q": lambda: _skill(1, lambda a, b, c, d: a * d + b * c),
    "BR": lambda: ratio(F.col("a") + F.col("c"), F.col("n")),
    "CR": lambda: ratio(F.col("a") + F.col("b"), F.col("n")),
}

# Other names of the same scores, and the named groups of scores.
ALIASES = {
    "CSI": "TS", "POD": "HR", "HKD": "PSS", "KPI": "PSS", "TSS": "PSS",
    "ROS": "GSS", "ETS": "GSS", "ORSS": "Q",
}
SUMMARIES = {
    "BRHF": ["BR", "HR", "F"],
    "CRF": ["FAR", "FARCR", "CR"],
    "BHF": ["B", "HR", "F"],
    "BOP": ["B", "OR", "PSS"],
    "BROP": ["BR", "OR", "PSS"],
    "HBBR": ["HR", "B", "BR"],
    "ES": ["PSS", "HSS"],
    "AES": ["GSS", "SEDS", "Q"],
}


def score(name: str) -> Column:
    """Score by name or alias, over the columns n, a, b, c, d."""
    return SCORES[ALIASES.get(name, name)]()


def event_scores(table: DataFrame, keys: list[str], names: list[str] | None = None) -> DataFrame:
    names = names or [*SCORES, *ALIASES]
    return table.select(*keys, *[score(x).alias(x) for x in names])


def summary(table: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One of the named groups of scores."""
    return event_scores(table, keys, SUMMARIES[name])


def diagram_points(table: DataFrame, keys: list[str]) -> DataFrame:
    """Coordinates of the performance diagram."""
    return table.select(*keys, (1 - score("FAR")).alias("success_ratio"), score("HR").alias("hit_rate"),
                        score("B").alias("bias"), score("TS").alias("threat_score"))

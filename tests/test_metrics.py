"""Scores against numpy and the undefined cases."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import events, metrics

T0 = datetime(2001, 1, 1)
SCHEMA = "obsid long, ts timestamp, s double, o double"


def frame(spark, series):
    return spark.createDataFrame(
        [(k, T0 + timedelta(days=i), s, o) for k, (ss, oo) in series.items()
         for i, (s, o) in enumerate(zip(ss, oo))], SCHEMA)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(5)
    o = rng.gamma(2.0, 10.0, 400)
    return o * rng.uniform(0.6, 1.5, 400) + 1, o


def test_kge_and_components(spark, sample):
    s, o = sample
    got = metrics.objectives(frame(spark, {1: (s.tolist(), o.tolist())}), ["obsid"]).first()
    r = np.corrcoef(o, s)[0, 1]
    bias = s.mean() / o.mean()
    spread = (s.std() / s.mean()) / (o.std() / o.mean())
    kge = 1 - math.sqrt((r - 1) ** 2 + (bias - 1) ** 2 + (spread - 1) ** 2)
    assert tuple(got)[1:] == pytest.approx((kge, r, bias, spread, np.abs(s - o).sum()))


def test_low_flow_threshold_interpolates_i_over_n(spark, sample):
    s, o = sample
    for p in (0.1, 0.333, 1.0):
        want = np.interp(p, np.arange(len(o)) / len(o), np.sort(o))
        got = metrics.low_flow_threshold(frame(spark, {1: (s.tolist(), o.tolist())}), ["obsid"], p).first()
        assert got.threshold == pytest.approx(want)


def test_low_flow_objectives(spark, sample):
    s, o = sample
    thr = np.interp(0.3, np.arange(len(o)) / len(o), np.sort(o))
    got = metrics.objectives_low_flow(frame(spark, {1: (s.tolist(), o.tolist())}), ["obsid"], 0.3).first()
    peak = o > thr
    assert got.bias == pytest.approx(s[~peak].mean() / o[~peak].mean())
    assert got.spread == pytest.approx(
        (s[peak].std() / s[peak].mean()) / (o[peak].std() / o[peak].mean()))
    assert got.sae == pytest.approx(np.abs(s - o).sum())


def test_undefined_scores(spark):
    pairs = frame(spark, {
        1: ([1.0, 2.0, 3.0], [5.0, 5.0, 5.0]),       # constant observations
        2: ([1.0, 2.0, 3.0], [0.0, 0.0, 0.0]),       # no flow at all
        3: ([1.0, None, 3.0], [None, 2.0, 3.0]),     # a single valid pair
        4: ([2.0, 0.0, 1.0], [1.0, 2.0, 3.0]),       # a zero has no log
    })
    names = ["rsr", "corr", "kge", "nse_log", "pc_bias", "vr"]
    got = {r.obsid: r for r in metrics.goodness_of_fit(pairs, ["obsid"], names).collect()}
    assert got[1].corr is None and got[1].kge is None and got[1].rsr is None
    assert got[2].pc_bias is None and got[2].vr is None
    assert got[3].n == 1 and all(got[3][m] is None for m in names)
    assert got[4].nse_log is None and got[4].kge is not None
    floor = {r.obsid: r.kge for r in metrics.objectives(pairs, ["obsid"]).collect()}
    assert floor[1] == -100.0 and floor[2] == -100.0 and floor[3] == -100.0


def test_very_bad_kge_is_floored(spark):
    pairs = frame(spark, {1: ([1e6, 3e6, 2e6], [1.0, 2.0, 3.0])})
    assert metrics.objectives(pairs, ["obsid"]).first().kge == -100.0


def test_log_weight_drops_the_sign(spark, sample):
    s, o = sample
    got = metrics.objectives_log_weighted(frame(spark, {1: (s.tolist(), o.tolist())}), ["obsid"], 0.4).first()
    r, rl = np.corrcoef(o, s)[0, 1], np.corrcoef(np.log(o), np.log(s))[0, 1]
    assert got["corr"] == pytest.approx(((0.6 * r) ** 6 + (0.4 * rl) ** 6) ** (1 / 6))


def test_unknown_metric_and_bad_parameters(spark):
    pairs = frame(spark, {1: ([1.0], [1.0])})
    with pytest.raises(ValueError):
        metrics.goodness_of_fit(pairs, ["obsid"], ["nope"])
    with pytest.raises(ValueError):
        metrics.objectives_low_flow(pairs, ["obsid"], 0)
    with pytest.raises(ValueError):
        metrics.objectives_log_weighted(pairs, ["obsid"], 1.5)


def test_contingency_drops_missing_pairs(spark):
    pairs = frame(spark, {1: ([5.0, 5.0, 1.0, 1.0, None], [5.0, 1.0, 5.0, 1.0, 9.0])})
    levels = spark.createDataFrame([(1, 5.0)], "obsid long, t double")
    got = events.contingency(pairs, levels, ["t"]).first()
    assert tuple(got) == (1, "t", 4.0, 1.0, 1.0, 1.0, 1.0)


def test_scores_of_empty_cells_are_null(spark):
    table = spark.createDataFrame([(1, 4.0, 0.0, 0.0, 0.0, 4.0), (2, 4.0, 4.0, 0.0, 0.0, 0.0)],
                                  "obsid long, n double, a double, b double, c double, d double")
    got = {r.obsid: r.asDict() for r in events.event_scores(table, ["obsid"]).collect()}
    assert got[1]["PC"] == 1 and got[1]["CR"] == 0 and got[1]["EDS"] is None and got[1]["TS"] is None
    assert got[2]["F"] is None and got[2]["EDS"] is None and got[2]["HR"] == 1
    assert got[2]["CSI"] == got[2]["TS"] and got[2]["ORSS"] is None


def test_every_summary_is_available(spark):
    table = spark.createDataFrame([(1, 10.0, 4.0, 2.0, 1.0, 3.0)],
                                  "obsid long, n double, a double, b double, c double, d double")
    for name, scores in events.SUMMARIES.items():
        got = events.summary(table, ["obsid"], name).first()
        assert list(got.asDict())[1:] == scores and all(v is not None for v in got)
    for alias, name in events.ALIASES.items():
        row = table.select(events.score(alias).alias("a"), events.score(name).alias("b")).first()
        assert row.a == row.b


def test_monthly_split_keeps_valid_pairs(spark):
    pairs = frame(spark, {1: ([1.0, None, 3.0], [1.0, 2.0, 3.0])})
    assert metrics.split_monthly(pairs).filter(F.col("month") == 1).count() == 2


def test_every_key_is_kept(spark):
    pairs = frame(spark, {
        1: ([1.0, None, 3.0], [None, 2.0, 3.0]),     # a single valid pair
        2: ([1.0, None], [None, 2.0]),               # none
        3: ([1.0, 2.0, 4.0, None], [1.0, 3.0, 4.0, 5.0]),
    })
    for score in (lambda p: metrics.objectives(p, ["obsid"]), lambda p: metrics.statistics(p, ["obsid"]),
                  lambda p: metrics.objectives_low_flow(p, ["obsid"], 0.5),
                  lambda p: metrics.objectives_low_flow(p, ["obsid"], 0.5, True),
                  lambda p: metrics.objectives_log_weighted(p, ["obsid"], 0.4)):
        got = {r.obsid: tuple(r)[1:] for r in score(pairs).collect()}
        assert set(got) == {1, 2, 3}
        assert all(got[k][0] == -100.0 and set(got[k][1:]) == {None} for k in (1, 2))
        assert got[3] == tuple(score(pairs.filter("obsid = 3")).first())[1:]

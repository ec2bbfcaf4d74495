"""Resampling, calendars, selection rules and extremes."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeflow.functions.values import check_step, parse_stamp, step_hours
from gaugeflow.operators import alignment, extremes, selection

T0 = datetime(2016, 12, 31, 6)


def test_daily_mean_equals_right_closed_bins(spark):
    index = pd.date_range(T0, periods=41, freq="6h")
    values = np.arange(41.0)
    values[[3, 9, 10]] = np.nan
    want = pd.Series(values, index).resample("24h", label="right", closed="right").mean()
    data = [(1, t.to_pydatetime(), None if np.isnan(x) else float(x)) for t, x in zip(index, values)]
    got = alignment.daily_mean(spark.createDataFrame(data, "obsid long, ts timestamp, o double"), ["o"])
    assert {r.ts: r.o for r in got.collect()} == {k.to_pydatetime(): v for k, v in want.items()}


@pytest.mark.parametrize("unit, rule", [("D", "D"), ("M", "ME"), ("Y", "YE")])
def test_period_max_groups(spark, unit, rule):
    index = pd.date_range(T0, periods=1800, freq="6h")
    values = np.random.default_rng(1).random(1800)
    want = pd.Series(values, index).resample(rule, label="right", closed="right").max()
    data = [(1, t.to_pydatetime(), float(x)) for t, x in zip(index, values)]
    got = alignment.period_max(spark.createDataFrame(data, "obsid long, ts timestamp, s double"), "s", unit)
    assert [r.peak for r in got.orderBy("period").collect()] == want.tolist()


def test_steps_and_units_are_checked(spark):
    with pytest.raises(ValueError):
        check_step(720)
    with pytest.raises(ValueError):
        alignment.period_max(spark.range(1), "s", "W")
    with pytest.raises(ValueError):
        extremes.periods("W")
    with pytest.raises(ValueError):
        extremes.exceedance(F.lit(1), F.lit(2), "other")


def test_step_hours(spark):
    table = spark.createDataFrame([("NRT_6h",), ("HIST_24h",), ("6.0",), ("24",), ("x_6h_24h",)], "t string")
    assert [r[0] for r in table.select(step_hours(F.col("t"))).collect()] == [6, 24, 6, 24, 6]
    for bad in ("12", "daily", None):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(bad,)], "t string").select(step_hours(F.col("t"))).collect()


def test_wrong_date_format_fails(spark):
    text = spark.createDataFrame([("2017-01-30 12:00",)], "t string")
    with pytest.raises(PySparkException):
        text.select(parse_stamp(F.col("t"))).collect()


@pytest.mark.parametrize("years, rank", [(7.9, 0), (10, None), (16, None), (20, None)])
def test_split_date_rule(spark, years, rank):
    n = int(round(years * 365.25))
    start = datetime(1990, 1, 1)
    obs = spark.range(n).select(
        F.lit(1).cast("long").alias("obsid"),
        F.timestamp_seconds(F.lit(int(start.timestamp())) + F.col("id") * 86400).alias("ts"),
        F.lit(1.0).alias("q"))
    stations = spark.createDataFrame([(1, "HIST_24h")], "obsid long, CAL_TYPE string")
    got = selection.split_dates(stations, obs).first().Split_date
    real_years = n / 365.25
    want = 0 if real_years <= 8 else (n - 2922 if real_years < 16 else n // 2)
    assert got == start + timedelta(days=want)


def test_strict_records_and_no_valid_station(spark):
    stations = spark.createDataFrame(
        [(1, "HIST_24h", "3", 0, 10.0)], "obsid long, CAL_TYPE string, EC_calib string, Spinup_days int, Min_calib_days double")
    obs = spark.createDataFrame([(1, datetime(2000, 1, 1 + i), 1.0) for i in range(5)],
                                "obsid long, ts timestamp, q double")
    forcing = selection.Forcing(datetime(2000, 1, 1), datetime(2000, 2, 1))
    screened = selection.screen_stations(stations, obs, forcing, 1)
    assert [r.is_valid for r in screened.collect()] == [False]
    with pytest.raises(ValueError):
        selection.require_any_valid(screened)
    with pytest.raises(PySparkException):
        selection.station_records(stations, obs, forcing).select("period_days").collect()
    assert selection.station_records(stations, obs, forcing, strict=False).first().N_data == 5


def test_documented_rule_drops_halves_and_keeps_the_last_part(spark):
    def series(obsid, years):
        return spark.range(int(years * 365.25)).select(
            F.lit(obsid).cast("long").alias("obsid"),
            F.timestamp_seconds(F.col("id") * 86400).alias("ts"), F.lit(1.0).alias("q"))
    obs = series(1, 2).unionByName(series(2, 5)).unionByName(series(3, 9))
    stations = spark.createDataFrame([(i, "HIST_24h") for i in (1, 2, 3)], "obsid long, CAL_TYPE string")
    got = {r.obsid: r for r in selection.documented_periods(stations, obs, 4).collect()}
    day = lambda k: datetime(1970, 1, 1) + timedelta(days=k)
    assert set(got) == {2, 3}
    assert got[2].Cal_Start == day(1826 - 1461) and got[2].Val_Start == day(0)
    assert got[3].Cal_Start == day(3287 // 2) and got[3].Val_End == day(3287 // 2 - 1)


def test_bounds_violations(spark):
    series = spark.createDataFrame([(1, T0, 1.0), (1, T0 + timedelta(days=1), 2.0)], "obsid long, ts timestamp, q double")
    stations = spark.createDataFrame([(1, T0, T0 + timedelta(days=2)), (2, T0, T0)],
                                     "obsid long, Obs_start timestamp, Obs_end timestamp")
    assert {r.obsid for r in alignment.series_bounds_violations(series, stations).collect()} == {1, 2}


def test_gumbel_fit_recovers_its_own_line(spark):
    a, u = 12.0, 80.0
    n = 60
    p = 1 - (np.arange(1, n + 1) - 0.44) / (n + 0.12)
    t = 1 / (1 - p)
    peaks = u - a * np.log(np.log(t / (t - 1)))
    table = spark.createDataFrame([(1, datetime(2000, 1, 1) + timedelta(days=i), float(x)) for i, x in enumerate(peaks)],
                                  "obsid long, period timestamp, peak double")
    ranked = extremes.ranked_peaks(table, ["obsid"])
    assert ranked.count() == 30
    fit = extremes.gumbel_fit(ranked, ["obsid"]).first()
    assert (fit.a, fit.u) == pytest.approx((a, u))
    levels = extremes.thresholds(table, ["obsid"], "Y").first()
    want = [u - a * np.log(np.log(x / (x - 1))) for x in (1.5, 2, 5, 20)]
    assert list(levels)[1:] == pytest.approx(want)

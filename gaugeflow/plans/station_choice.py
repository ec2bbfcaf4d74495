"""Queries: station selection, record lengths and calibration periods."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gaugeflow.functions.values import coordinates_text, non_negative, padded_id, present
from gaugeflow.operators import selection
from gaugeflow.plans import views as v
from gaugeflow.plans.views import FORCING, day, rounded
from gaugeflow.session import settle

MIN_TYPE = 1
SHORT_YEARS, LONG_YEARS = 1.15, 1.3  # the records of the tables are short
PRERUN_END = datetime(2001, 6, 30)


def calibration_stations(spark, sf_dir):
    return selection.calibration_stations(v.stations(spark, sf_dir), MIN_TYPE).select("obsid", "EC_calib")


def record_lengths(spark, sf_dir):
    lengths = selection.record_lengths(v.stations(spark, sf_dir), v.observations(spark, sf_dir), FORCING)
    return rounded(lengths.select("obsid", "n_data", "period_days", "period_years"), "obsid", "n_data")


def screened_stations(spark, sf_dir):
    screened = selection.screen_stations(
        v.stations(spark, sf_dir), v.observations(spark, sf_dir), FORCING, MIN_TYPE)
    return screened.select("obsid", "n_data", F.col("is_valid").cast("int").alias("is_valid"))


def valid_stations(spark, sf_dir):
    """Ids of the valid stations; a table without any fails."""
    screened = settle(selection.screen_stations(
        v.stations(spark, sf_dir), v.observations(spark, sf_dir), FORCING, MIN_TYPE))
    return selection.require_any_valid(screened).filter("is_valid").select("obsid")


def windowed_observations(spark, sf_dir):
    windowed = selection.observation_windows(v.stations(spark, sf_dir), FORCING)
    return rounded(selection.in_window(v.observations(spark, sf_dir), windowed)
                   .select("obsid", day(), "q"), "obsid", "ts")


def _sliced(spark, sf_dir):
    windowed = selection.observation_windows(v.stations(spark, sf_dir), FORCING)
    return settle(selection.in_window(v.observations(spark, sf_dir), windowed))


def trimmed_observations(spark, sf_dir):
    return rounded(selection.trim_to_valid(v.observations(spark, sf_dir)).select("obsid", day(), "q"),
                   "obsid", "ts")


def split_dates(spark, sf_dir):
    dates = selection.split_dates(v.stations(spark, sf_dir), _sliced(spark, sf_dir))
    return dates.select("obsid", day("Split_date"))


def split_dates_short_records(spark, sf_dir):
    dates = selection.split_dates(v.stations(spark, sf_dir), _sliced(spark, sf_dir), SHORT_YEARS, LONG_YEARS)
    return dates.select("obsid", day("Split_date"))


def documented_periods(spark, sf_dir):
    periods = selection.documented_periods(v.stations(spark, sf_dir), _sliced(spark, sf_dir), 0.6)
    return periods.select("obsid", *[day(c) for c in ("Val_Start", "Val_End", "Cal_Start", "Cal_End")])


def _records(spark, sf_dir):
    return selection.station_records(
        v.stations(spark, sf_dir), settle(v.observations(spark, sf_dir)), FORCING, strict=False)


def station_records(spark, sf_dir):
    return _records(spark, sf_dir).select(
        "obsid", "StationName", "N_data", day("Obs_start"), day("Obs_end"), day("Split_date"))


def run_plan(spark, sf_dir):
    plan = selection.run_plan(_windows_input(spark, sf_dir), v.stations(spark, sf_dir), PRERUN_END)
    return plan.select("obsid", *[day(c) for c in (
        "obs_start", "obs_end", "cal_start", "cal_end", "prerun_start", "prerun_end")])


def _windows_input(spark, sf_dir):
    return _records(spark, sf_dir).select("obsid", "Spinup_days", "Obs_end", "Split_date")


def debug_run_windows(spark, sf_dir):
    plan = selection.run_windows(_windows_input(spark, sf_dir), fast_debug=True)
    return plan.select("obsid", *[day(c) for c in ("obs_start", "obs_end", "cal_start", "cal_end")])


def unknown_stations(spark, sf_dir):
    """Ids asked for in the order lines that have no station row."""
    asked = v.table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 150).alias("obsid")).distinct()
    found, unknown = selection.known_stations(asked, v.stations(spark, sf_dir))
    return found.select("obsid", F.lit("known").alias("state")).unionByName(
        unknown.select("obsid", F.lit("unknown").alias("state")))


def work_list(spark, sf_dir):
    listed = v.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 71).alias("obsid")).distinct()
    return rounded(selection.work_list(v.stations(spark, sf_dir), listed).select("obsid", "area"), "obsid")


def pending_stations(spark, sf_dir):
    done = v.history(spark, sf_dir).select("obsid").distinct()
    return selection.pending(v.stations(spark, sf_dir).select("obsid", "CAL_TYPE"), done, ["obsid"])


def station_texts(spark, sf_dir):
    return v.stations(spark, sf_dir).select(
        "obsid", coordinates_text(F.round(F.col("x") / 64), F.round(F.col("y") / 64))
        .alias("coordinates"), padded_id(F.col("obsid")).alias("padded"))


def cleaned_values(spark, sf_dir):
    """Sentinel, NaN and negative values become missing; the rest is summed per station."""
    raw = v.table(spark, sf_dir, "customer").select(
        (F.col("c_nationkey")).cast("long").alias("obsid"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(1e31)).when(F.col("c_custkey") % 7 == 0, F.lit(float("nan")))
        .otherwise(F.col("c_acctbal")).alias("q"))
    return rounded(raw.groupBy("obsid").agg(
        F.count(present(F.col("q"))).alias("n_present"), F.sum(present(F.col("q"))).alias("total"),
        F.sum(non_negative(present(F.col("q")))).alias("total_positive")), "obsid", "n_present")


QUERIES = {f.__name__: f for f in (
    calibration_stations, record_lengths, screened_stations, valid_stations, windowed_observations,
    trimmed_observations, split_dates, split_dates_short_records, documented_periods,
    station_records, run_plan, debug_run_windows, unknown_stations, work_list, pending_stations,
    station_texts, cleaned_values)}


# --- reference SQL ------------------------------------------------------------------------

_BASE = f"""st as ({v.STATIONS}), ob as ({v.OBSERVATIONS}),
  win as (select obsid, timestamp '1995-01-02' + Spinup_days*interval 1 day a,
    timestamp '2001-06-30' b from st),
  inw as (select ob.* from ob join win on win.obsid=ob.obsid and ts between a and b)"""
_LENGTHS = f"""{_BASE},
  cnt as (select obsid, count(q) n from inw group by obsid),
  len as (select st.*, coalesce(n,0) n_data,
    coalesce(n,0)/(case when contains(CAL_TYPE,'_6h') then 4.0 else 1.0 end)::double period_days
    from st left join cnt using (obsid))"""


def _stamp(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M') \"{name or column}\""


def _ranked(view: str) -> str:
    """Valid rows with 0-based rank, size and years."""
    return f"""val as (select i.obsid, ts, row_number() over (partition by i.obsid order by ts)-1 i,
      count(*) over (partition by i.obsid) n,
      case when contains(CAL_TYPE,'_6h') then 6 else 24 end hh
      from {view} i join st on st.obsid=i.obsid where q is not null),
    yr as (select *, n*hh/(24*365.25::double) yrs from val)"""


def _split(short: float, long: float) -> str:
    return f"""{_ranked('inw')}, sp as (select obsid, ts "Split_date" from yr where i =
      case when yrs<={short}::double then 0
           when yrs<{long}::double then n-cast(floor({short}::double*365.25*24/hh) as bigint)
           else n//2 end)"""


_RECORD = f"""{_LENGTHS}, {_split(8, 16)},
  vb as (select obsid, min(case when q is not null then ts end) "Obs_start",
    max(case when q is not null then ts end) "Obs_end", count(q) "N_data"
    from inw group by obsid having count(q)>0),
  rec as (select st.*, "N_data", "Obs_start", "Obs_end", "Split_date"
    from st join vb using (obsid) join sp using (obsid))"""

ORACLES = {
    "calibration_stations": f"""select obsid, EC_calib from ({v.STATIONS})
      where try_cast(EC_calib as int)>={MIN_TYPE}""",
    "record_lengths": f"""with {_LENGTHS} select obsid, n_data, round(period_days,6) period_days,
      round(period_days/365.25,6) period_years from len""",
    "screened_stations": f"""with {_LENGTHS} select obsid, n_data,
      cast(period_days>=Min_calib_days as int) is_valid from len
      where try_cast(EC_calib as int)>={MIN_TYPE}""",
    "valid_stations": f"""with {_LENGTHS} select obsid from len
      where try_cast(EC_calib as int)>={MIN_TYPE} and period_days>=Min_calib_days""",
    "windowed_observations": f"with {_BASE} select obsid, {_stamp('ts')}, round(q,6) q from inw",
    "trimmed_observations": f"""with ob as ({v.OBSERVATIONS}),
      b as (select obsid, min(ts) a, max(ts) z from ob where q is not null group by obsid)
      select ob.obsid, {_stamp('ts')}, round(q,6) q from ob join b on b.obsid=ob.obsid and ts between a and z""",
    "split_dates": f'with {_BASE}, {_split(8, 16)} select obsid, {_stamp(chr(34) + "Split_date" + chr(34), "Split_date")} from sp',
    "split_dates_short_records": f'with {_BASE}, {_split(SHORT_YEARS, LONG_YEARS)} '
    f'select obsid, {_stamp(chr(34) + "Split_date" + chr(34), "Split_date")} from sp',
    "documented_periods": f"""with {_BASE}, {_ranked('inw')},
      f as (select *, case when yrs>=1.2::double then n//2
        else n-cast(floor(0.6::double*365.25*24/hh) as bigint) end k from yr where yrs>=0.6::double)
      select obsid, {_stamp('min(case when k>0 and i=0 then ts end)', 'Val_Start')},
        {_stamp('min(case when i=k-1 then ts end)', 'Val_End')},
        {_stamp('min(case when i=k then ts end)', 'Cal_Start')},
        {_stamp('min(case when i=n-1 then ts end)', 'Cal_End')} from f group by obsid""",
    "station_records": f"""with {_RECORD} select obsid, StationName, "N_data", {_stamp('Obs_start')},
      {_stamp('Obs_end')}, {_stamp('Split_date')} from rec""",
    "run_plan": f"""with {_RECORD} select obsid, {_stamp('Split_date', 'obs_start')},
      {_stamp('Obs_end', 'obs_end')}, {_stamp('Split_date - Spinup_days*interval 1 day', 'cal_start')},
      {_stamp('Obs_end', 'cal_end')}, {_stamp('prerun_start')},
      '2001-06-30 00:00' prerun_end from rec""",
    "debug_run_windows": f"""with {_RECORD} select obsid, {_stamp('Split_date', 'obs_start')},
      {_stamp('Split_date + interval 120 day', 'obs_end')}, {_stamp('Split_date', 'cal_start')},
      {_stamp('Split_date + interval 120 day', 'cal_end')} from rec""",
    "unknown_stations": f"""with a as (select distinct l_partkey%150 obsid from lineitem)
      select obsid, 'known' state from ({v.STATIONS}) where obsid in (select obsid from a) union all
      select obsid, 'unknown' from a where obsid not in (select s_suppkey from supplier)""",
    "work_list": f"""select obsid, round(area,6) area from ({v.STATIONS})
      where area is not null and obsid in (select l_orderkey%71 from lineitem)""",
    "pending_stations": f"""select obsid, CAL_TYPE from ({v.STATIONS})
      where obsid not in (select obsid from ({v.HISTORY}))""",
    "station_texts": f"""select obsid, concat_ws(' ', cast(round(x/64) as varchar),
      cast(round(y/64) as varchar)) coordinates, lpad(cast(obsid as varchar),greatest(5,length(cast(obsid as varchar)))::int,'0') padded
      from ({v.STATIONS})""",
    "cleaned_values": """select cast(c_nationkey as bigint) obsid, count(q) n_present, round(sum(q),6) total,
      round(sum(case when q>=0 then q end),6) total_positive from (select c_nationkey,
        case when c_custkey%5=0 or c_custkey%7=0 then null else c_acctbal end q from customer) group by 1""",
}

"""Queries: goodness of fit, resampling, extremes and threshold events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.values import checked_minutes, step_hours
from gaugeflow.operators import alignment, events, extremes, metrics
from gaugeflow.plans import views as v
from gaugeflow.plans.views import rounded
from gaugeflow.session import settle

KEY = ["obsid"]
RUN_KEY = ["obsid", "run"]
LOW_FLOW = 0.3
LOG_WEIGHT = 0.4
LABELS = list(extremes.RETURN_YEARS)


def _stored(spark, sf_dir):
    """Daily pairs as a stored table, for queries that read them more than once."""
    return settle(v.pairs_daily(spark, sf_dir))


def _pairs_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.series_6h(spark, sf_dir)


def kge_by_station(spark, sf_dir):
    return rounded(metrics.goodness_of_fit(v.pairs_daily(spark, sf_dir), KEY, ["kge", "nse"]).drop("n"), *KEY)


ALL_METRICS = ["rsr", "br", "pc_bias", "pc_bias2", "apb", "apb2", "rmse", "sae", "mae", "mae_skill",
               "bias", "nse", "nse_log", "corr", "kge", "vr", "kge_skill"]


def goodness_of_fit(spark, sf_dir):
    return rounded(metrics.goodness_of_fit(v.pairs_daily(spark, sf_dir), KEY, ALL_METRICS), *KEY, digits=8)


def goodness_of_fit_gaps(spark, sf_dir):
    return rounded(metrics.goodness_of_fit(_pairs_with_gaps(spark, sf_dir), KEY, ALL_METRICS), *KEY, digits=8)


def index_of_agreement(spark, sf_dir):
    return rounded(metrics.index_of_agreement(_stored(spark, sf_dir), KEY), *KEY)


def objectives_by_run(spark, sf_dir):
    return rounded(metrics.objectives(v.pairs_by_run(spark, sf_dir), RUN_KEY), *RUN_KEY)


def statistics_by_station(spark, sf_dir):
    return rounded(metrics.statistics(_pairs_with_gaps(spark, sf_dir), KEY), *KEY)


def low_flow_threshold(spark, sf_dir):
    return rounded(metrics.low_flow_threshold(_pairs_with_gaps(spark, sf_dir), KEY, LOW_FLOW), *KEY)


def objectives_low_flow(spark, sf_dir):
    return rounded(metrics.objectives_low_flow(_stored(spark, sf_dir), KEY, LOW_FLOW), *KEY)


def objectives_peaks_only(spark, sf_dir):
    return rounded(metrics.objectives_low_flow(_stored(spark, sf_dir), KEY, LOW_FLOW, True), *KEY)


def objectives_log_weighted(spark, sf_dir):
    return rounded(metrics.objectives_log_weighted(v.pairs_daily(spark, sf_dir), KEY, LOG_WEIGHT), *KEY)


def mae_skill_peaks(spark, sf_dir):
    return rounded(metrics.mae_skill(_stored(spark, sf_dir), KEY, LOW_FLOW, True), *KEY)


def monthly_boxes(spark, sf_dir):
    return rounded(metrics.monthly_boxes(_stored(spark, sf_dir), KEY, "o"), "obsid", "month", "n")


def monthly_split(spark, sf_dir):
    split = metrics.split_monthly(_pairs_with_gaps(spark, sf_dir))
    return rounded(split.groupBy("obsid", "month").agg(
        F.count("s").alias("n"), F.sum("s").alias("sum_s"), F.sum("o").alias("sum_o")),
        "obsid", "month", "n")


def long_run_scores(spark, sf_dir):
    shifted = v.pairs_daily(spark, sf_dir).withColumn("o", F.col("o") - 10)
    return rounded(metrics.long_run_scores(shifted, KEY), *KEY)


# --- resampling ---------------------------------------------------------------------------

def daily_means(spark, sf_dir):
    daily = alignment.daily_mean(v.series_6h(spark, sf_dir), ["o", "s"])
    return rounded(daily.select("obsid", v.day(), "o", "s"), "obsid", "ts")


def _station_types(spark, sf_dir):
    return v.stations(spark, sf_dir).select("obsid", "CAL_TYPE")


def resampled_pairs(spark, sf_dir):
    series = v.series_6h(spark, sf_dir)
    stations = _station_types(spark, sf_dir)
    sim, obs = alignment.resample_pairs(
        series.select("obsid", "ts", "s"), series.select("obsid", "ts", "o"), stations, 360)
    return rounded(alignment.align(sim, obs).select("obsid", v.day(), "o", "s"), "obsid", "ts")


def dense_series(spark, sf_dir):
    series = v.series_6h(spark, sf_dir).select("obsid", "ts", "o")
    bounds = series.groupBy("obsid").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    filled = alignment.fill_calendar(series, bounds, "a", "b", 360)
    return rounded(filled.select("obsid", v.day(), "o"), "obsid", "ts")


def alignment_violations(spark, sf_dir):
    series = v.series_6h(spark, sf_dir)
    sim = series.filter(F.hour("ts") != 6).select(
        "obsid", "ts", F.when(F.dayofmonth("ts") != 5, F.col("s")).alias("s"))
    obs = series.filter("o IS NOT NULL").select("obsid", "ts", "o")
    return alignment.alignment_violations(sim, obs).select("obsid", v.day(), "reason")


def step_numbers(spark, sf_dir):
    """Steps numbered by time, and the timestamp each number stands for on a regular axis."""
    series = v.series_6h(spark, sf_dir).select("obsid", "ts", "s")
    starts = series.groupBy("obsid").agg(F.min("ts").alias("start"))
    numbered = alignment.number_steps(series).select("obsid", "step", "s")
    stamped = alignment.stamp_steps(numbered, starts, 360)
    return rounded(stamped.select("obsid", "step", v.day(), "s"), "obsid", "step", "ts")


def period_maxima(spark, sf_dir):
    daily = v.pairs_daily(spark, sf_dir)
    tables = [alignment.period_max(daily, "s", unit).select(
        "obsid", F.lit(unit).alias("unit"), v.day("period"), "peak") for unit in ("D", "M", "Y")]
    return rounded(tables[0].unionByName(tables[1]).unionByName(tables[2]), "obsid", "unit", "period")


def series_bounds(spark, sf_dir):
    """Stations whose series does not begin with the month, as their record says."""
    series = v.series_6h(spark, sf_dir)
    expected = series.groupBy("obsid").agg(F.date_trunc("month", F.min("ts")).alias("Obs_start"),
                                           F.max("ts").alias("Obs_end"))
    wrong = alignment.series_bounds_violations(series, expected)
    return wrong.select("obsid", v.day("first_ts"), v.day("expected_first"))


# --- extremes and events ------------------------------------------------------------------

def _peaks(spark, sf_dir, unit="D"):
    return settle(alignment.period_max(v.pairs_daily(spark, sf_dir), "s", unit))


def plotting_positions(spark, sf_dir):
    peaks = _peaks(spark, sf_dir, "M")
    tables = [extremes.ranked_peaks(peaks, KEY, fitter).select(
        "obsid", F.lit(fitter).alias("fitter"), "rank", "peak", "p", "T")
        for fitter in ("Weibull", "Hazen", "Gringorten", "cdf")]
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    return rounded(union.withColumn("rank", F.col("rank").cast("long")), "obsid", "fitter", "rank")


def gumbel_fit(spark, sf_dir):
    return rounded(extremes.gumbel_fit(extremes.ranked_peaks(_peaks(spark, sf_dir), KEY), KEY), *KEY)


def gumbel_moments(spark, sf_dir):
    return rounded(extremes.gumbel_moments(_peaks(spark, sf_dir), KEY), *KEY)


def return_levels(spark, sf_dir):
    wide = extremes.thresholds(_peaks(spark, sf_dir), KEY)
    return rounded(extremes.thresholds_long(wide, KEY), "obsid", "return_period")


def _pseudo_levels(pairs: DataFrame) -> DataFrame:
    """Levels low enough to be exceeded: fractions of the largest observation."""
    top = pairs.groupBy("obsid").agg(F.max("o").alias("top"))
    return top.select("obsid", *[(F.col("top") * share).alias(name)
                                 for name, share in zip(LABELS, (0.2, 0.4, 0.6, 0.8))])


def _table(spark, sf_dir):
    pairs = _stored(spark, sf_dir)
    return events.contingency(pairs, _pseudo_levels(pairs), LABELS)


def contingency(spark, sf_dir):
    return rounded(_table(spark, sf_dir), "obsid", "threshold")


def return_level_contingency(spark, sf_dir):
    pairs = _stored(spark, sf_dir)
    levels = extremes.thresholds(alignment.period_max(pairs, "s", "M"), KEY, "M")
    return rounded(events.contingency(pairs, levels, LABELS), "obsid", "threshold")


def event_scores(spark, sf_dir):
    return rounded(events.event_scores(_table(spark, sf_dir), ["obsid", "threshold"]), "obsid", "threshold")


def event_summaries(spark, sf_dir):
    """The eight named groups of scores, one struct each, unfolded."""
    table = _table(spark, sf_dir)
    keys = ["obsid", "threshold"]
    groups = F.array(*[F.struct(
        F.lit(name).alias("summary"),
        F.map_from_arrays(F.array(*[F.lit(s) for s in scores]),
                          F.array(*[events.score(s) for s in scores])).alias("scores"))
        for name, scores in events.SUMMARIES.items()])
    long = table.select(*keys, F.inline(groups)).select(
        *keys, "summary", F.explode("scores").alias("score", "value"))
    return rounded(long, *keys, "summary", "score")


def performance_diagram(spark, sf_dir):
    return rounded(events.diagram_points(_table(spark, sf_dir), ["obsid", "threshold"]), "obsid", "threshold")


def checked_steps(spark, sf_dir):
    """Steps of each customer's series; one of another length fails the job."""
    minutes = checked_minutes(F.when(F.col("o_custkey") % 2 == 0, 360).otherwise(1440))
    orders = v.table(spark, sf_dir, "orders").withColumn("minutes", minutes)
    return orders.groupBy(F.col("o_custkey").alias("obsid"), "minutes").agg(F.count(F.lit(1)).alias("n"))


def step_hours_of_types(spark, sf_dir):
    return v.stations(spark, sf_dir).select("obsid", step_hours(F.col("CAL_TYPE")).alias("hours"))


QUERIES = {f.__name__: f for f in (
    kge_by_station, goodness_of_fit, goodness_of_fit_gaps, index_of_agreement, objectives_by_run,
    statistics_by_station, low_flow_threshold, objectives_low_flow, objectives_peaks_only,
    objectives_log_weighted, mae_skill_peaks, monthly_boxes, monthly_split, long_run_scores,
    daily_means, resampled_pairs, dense_series, alignment_violations, step_numbers, period_maxima,
    series_bounds, plotting_positions, gumbel_fit, gumbel_moments, return_levels, contingency,
    return_level_contingency, event_scores, event_summaries, performance_diagram,
    checked_steps, step_hours_of_types)}


# --- reference SQL ------------------------------------------------------------------------

_CORR = "covar_pop(o,s)/nullif(stddev_pop(o)*stddev_pop(s),0)"
_BIAS = "avg(s)/nullif(avg(o),0)"
_SPREAD = "(stddev_pop(s)/nullif(avg(s),0))/nullif(stddev_pop(o)/nullif(avg(o),0),0)"
_KGE = f"(1-sqrt(power({_CORR}-1,2)+power({_BIAS}-1,2)+power({_SPREAD}-1,2)))"
_NSE = "(1-sum((s-o)*(s-o))/(var_pop(o)*count(*)+1e-20))"
_FLOORED = f"greatest(coalesce({_KGE},-100.0),-100.0)"


def _valid(view: str) -> str:
    return f"with v as (select * from ({view}) where s is not null and o is not null) "


def _all_metrics(view: str) -> str:
    ls, lo = "ln(nullif(greatest(s,0),0))", "ln(nullif(greatest(o,0),0))"
    body = {
        "rsr": "sqrt(sum((s-o)*(s-o)))/nullif(sqrt(var_pop(o)*count(*)),0)",
        "br": f"1-abs({_BIAS}-1)",
        "pc_bias": "100*sum(s-o)/nullif(sum(o),0)",
        "pc_bias2": "100*(avg(s)-avg(o))/nullif(avg(o),0)",
        "apb": "100*sum(abs(s-o))/nullif(sum(o),0)",
        "apb2": "100*abs(avg(s)-avg(o))/nullif(avg(o),0)",
        "rmse": "sqrt(avg((s-o)*(s-o)))",
        "sae": "sum(abs(s-o))",
        "mae": "avg(abs(s-o))",
        "mae_skill": "1-avg(abs(s-o))",
        "bias": "avg(s-o)",
        "nse": _NSE,
        "nse_log": f"""case when min(s)>0 and min(o)>0 then
            1-sum(({ls}-{lo})*({ls}-{lo}))/nullif(var_pop({lo})*count(*),0) end""",
        "corr": _CORR,
        "kge": _KGE,
        "vr": f"1-abs({_SPREAD}-1)",
        "kge_skill": f"({_KGE}-(1-sqrt(2)))/sqrt(2)",
    }
    cols = ", ".join(f"round(case when count(*)>1 then {e} end,8) {n}" for n, e in body.items())
    return _valid(view) + f"select obsid, cast(count(*) as double) n, {cols} from v group by obsid"


def _tuple(keys: str = "obsid", extra: str = "") -> str:
    return f"""select {keys}, round({_FLOORED},6) kge, round({_CORR},6) corr, round({_BIAS},6) bias,
        round({_SPREAD},6) spread, round(sum(abs(s-o)),6) sae{extra}
        from v group by {keys} having count(*)>1"""


def _every(scored: str, view: str, keys: str = "obsid") -> str:
    """Every key of the pairs: the floor where no score is defined."""
    return f"""with scored as ({scored}), every as (select distinct {keys}, true as present from ({view})),
        paired as (select * from every left join scored using ({keys}))
      select * exclude (present) replace (case when sae is null then -100.0 else kge end as kge) from paired"""


_THRESHOLD = f"""r as (select obsid, o, row_number() over (partition by obsid order by o)-1 i,
      count(*) over (partition by obsid) n from v),
    q as (select *, least(cast({LOW_FLOW} as double)*n, n-1.0::double) pos from r),
    h as (select obsid, max(pos) pos, max(case when i=floor(pos) then o end) lo,
      max(case when i=floor(pos)+1 then o end) hi from q group by obsid),
    t as (select obsid, lo + coalesce((pos-floor(pos))*(hi-lo), 0) threshold from h)"""


def _low_flow(peaks_only: bool) -> str:
    low = "o>threshold" if peaks_only else "o<=threshold"
    bias = f"(avg(case when {low} then s end)/nullif(avg(case when {low} then o end),0))"
    ps, po = "case when o>threshold then s end", "case when o>threshold then o end"
    spread = (f"((stddev_pop({ps})/nullif(avg({ps}),0))"
              f"/nullif(stddev_pop({po})/nullif(avg({po}),0),0))")
    kge = f"1-sqrt(power({_CORR}-1,2)+power({bias}-1,2)+power({spread}-1,2))"
    return _valid(v.PAIRS_DAILY) + f""", {_THRESHOLD}
      select obsid, round(greatest(coalesce({kge},-100.0),-100.0),6) kge, round({_CORR},6) corr,
        round({bias},6) bias, round({spread},6) spread, round(sum(abs(s-o)),6) sae
      from v join t using (obsid) group by obsid having count(*)>1"""


def _log_weighted() -> str:
    w = LOG_WEIGHT
    logs = {k: e.replace("(o,s)", "(lo,ls)").replace("(o)", "(lo)").replace("(s)", "(ls)")
            for k, e in {"corr": _CORR, "bias": _BIAS, "spread": _SPREAD, "kge": _KGE}.items()}
    plain = {"kge": _FLOORED, "corr": _CORR, "bias": _BIAS, "spread": _SPREAD}
    cols = ", ".join(
        f"""round(case when min(s)>0 and min(o)>0 then power(power({1 - w}*({plain[k]}),6)
            + power({w}*({logs[k]}),6), 1.0/6) end,6) {k}""" for k in plain)
    return f"""with v as (select obsid, s, o, ln(case when s>0 and o>0 then s end) ls,
        ln(case when s>0 and o>0 then o end) lo from ({v.PAIRS_DAILY}))
        select obsid, {cols}, round(sum(abs(s-o)),6) sae from v group by obsid having count(*)>1"""


_RIGHT_DAY = "date_trunc('day', ts - interval 1 microsecond) + interval 1 day"


def _stamp(column: str, name: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M') {name}"


def _peak_sql(unit: str) -> str:
    label = {"D": _RIGHT_DAY, "M": "date_trunc('month', ts)", "Y": "date_trunc('year', ts)"}[unit]
    return f"select obsid, {label} period, max(s) peak from ({v.PAIRS_DAILY}) group by 1, 2"


_Z = "-ln(ln(T/(T-1)))"


def _fit_sql(unit: str) -> str:
    return f"""pk as ({_peak_sql(unit)}),
      rk as (select *, row_number() over (partition by obsid order by peak desc, period) r,
        count(*) over (partition by obsid) n from pk),
      tt as (select *, 1/(1-(1-(r-0.44::double)/(n+0.12::double))) T from rk where r<=30),
      zz as (select obsid, peak y, {_Z} z from tt),
      fit as (select obsid, regr_slope(y,z) a, regr_intercept(y,z) u, count(*) m,
        regr_avgx(y,z) mz, regr_sxx(y,z) szz, regr_sxy(y,z) szy, regr_syy(y,z) syy
        from zz group by obsid)"""


def _level(factor: str, years: str) -> str:
    period = f"({years}::double*{factor}::double)"
    return f"(-a*ln(ln({period}/({period}-1)))+u)"


def _levels_wide(factor: str) -> str:
    return ", ".join(f'{_level(factor, name[2:])} "{name}"' for name in LABELS)


_CELLS = ("count(*) n, count_if(s>=lv and o>=lv) a, count_if(s>=lv and o<lv) b, "
          "count_if(s<lv and o>=lv) c, count_if(s<lv and o<lv) d")
_PSEUDO = f"""v as ({v.PAIRS_DAILY}),
  top as (select obsid, max(o) top from v group by obsid),
  lv as (select obsid, threshold, top*share::double lv from top,
    (values ('rl1.5', 0.2), ('rl2', 0.4), ('rl5', 0.6), ('rl20', 0.8)) x(threshold, share)),
  cont as (select obsid, threshold, n::double n, a::double a, b::double b, c::double c, d::double d
    from (select obsid, threshold, {_CELLS} from v join lv using (obsid) group by 1, 2))"""


def _log(e: str) -> str:
    return f"ln(nullif(({e}),0))"


_SCORE_SQL = {
    "PC": "(a+d)/nullif(n,0)", "TS": "a/nullif(a+b+c,0)", "OR": "(a*d)/nullif(b*c,0)",
    "B": "(a+b)/nullif(a+c,0)", "FAR": "b/nullif(a+b,0)", "FARCR": "d/nullif(c+d,0)",
    "HR": "a/nullif(a+c,0)", "F": "b/nullif(b+d,0)", "PCR": "d/nullif(b+d,0)",
    "HSS": "2*(a*d-b*c)/nullif((a+c)*(c+d)+(a+b)*(b+d),0)",
    "PSS": "(a*d-b*c)/nullif((a+c)*(b+d),0)", "CSS": "(a*d-b*c)/nullif((a+b)*(c+d),0)",
    "GSS": "(a-(a+b)*(a+c)/nullif(n,0))/nullif(a-(a+b)*(a+c)/nullif(n,0)+b+c,0)",
    "EDS": f"2*{_log('(a+c)/n')}/nullif({_log('a/n')},0)-1",
    "SEDS": f"({_log('(a+b)/n')}+{_log('(a+c)/n')})/nullif({_log('a/n')},0)-1",
    "Q": "(a*d-b*c)/nullif(a*d+b*c,0)", "BR": "(a+c)/nullif(n,0)", "CR": "(a+b)/nullif(n,0)",
}
_SCORE_SQL.update({alias: _SCORE_SQL[name] for alias, name in events.ALIASES.items()})


def _scores(columns: dict[str, str]) -> str:
    cols = ", ".join(f'round({e},6) "{n}"' for n, e in columns.items())
    return f"with {_PSEUDO} select obsid, threshold, {cols} from cont"


def _summaries() -> str:
    parts = [f"select obsid, threshold, '{g}' summary, '{s}' score, round({_SCORE_SQL[s]},6) \"value\" from cont"
             for g, names in events.SUMMARIES.items() for s in names]
    return f"with {_PSEUDO} " + " union all ".join(parts)


def _plotting() -> str:
    def one(name: str, p: str) -> str:
        return f"""select obsid, '{name}' fitter, r, peak, {p} p from rk where r<=30"""
    shifted = "1-(r-{b}::double)/(n+1-2*{b}::double)"
    parts = [one("Weibull", shifted.format(b="0.0")), one("Hazen", shifted.format(b="0.5")),
             one("Gringorten", shifted.format(b="0.44")), one("cdf", "(n-r)/n::double")]
    return f"""with pk as ({_peak_sql('M')}), rk as (select *,
        row_number() over (partition by obsid order by peak desc, period) r,
        count(*) over (partition by obsid) n from pk), u as ({' union all '.join(parts)})
        select obsid, fitter, r "rank", round(peak,6) peak, round(p,6) p, round(1/(1-p),6) "T" from u"""


ORACLES = {
    "kge_by_station": _valid(v.PAIRS_DAILY)
    + f"select obsid, round({_KGE},6) kge, round({_NSE},6) nse from v group by obsid",
    "goodness_of_fit": _all_metrics(v.PAIRS_DAILY),
    "goodness_of_fit_gaps": _all_metrics(v.SERIES_6H),
    "index_of_agreement": _valid(v.PAIRS_DAILY) + """, m as (select *, avg(o) over (partition by obsid) mo from v)
      select obsid, round(case when count(*)>1 then 1-sum((o-s)*(o-s))
        /nullif(sum(power(abs(s-mo)+abs(o-mo),2)),0) end,6) index_agreement from m group by obsid""",
    "objectives_by_run": _every(_valid(v.PAIRS_BY_RUN) + _tuple("obsid, run"), v.PAIRS_BY_RUN, "obsid, run"),
    "statistics_by_station": _every(_valid(v.SERIES_6H) + _tuple("obsid", f", round({_NSE},6) nse"), v.SERIES_6H),
    "low_flow_threshold": _valid(v.SERIES_6H) + f", {_THRESHOLD} select obsid, round(threshold,6) threshold from t",
    "objectives_low_flow": _every(_low_flow(False), v.PAIRS_DAILY),
    "objectives_peaks_only": _every(_low_flow(True), v.PAIRS_DAILY),
    "objectives_log_weighted": _every(_log_weighted(), v.PAIRS_DAILY),
    "mae_skill_peaks": _valid(v.PAIRS_DAILY) + f""", {_THRESHOLD}
      select obsid, case when count(*)>1 then round(1-avg(abs(s-o)),6) end mae_skill from v join t using (obsid)
      where o>threshold group by obsid""",
    "monthly_boxes": _valid(v.PAIRS_DAILY) + """select obsid, cast(month(ts) as int) as "month", count(o) n,
      round(min(o),6) low, round(max(o),6) high, round(avg(o),6) mean,
      round(quantile_cont(o,0.25),6) q1, round(quantile_cont(o,0.5),6) median,
      round(quantile_cont(o,0.75),6) q3 from v group by 1, 2""",
    "monthly_split": _valid(v.SERIES_6H) + """select obsid, cast(month(ts) as int) as "month", count(s) n,
      round(sum(s),6) sum_s, round(sum(o),6) sum_o from v group by 1, 2""",
    "long_run_scores": f"""with v as (select obsid, s, o-10 o from ({v.PAIRS_DAILY}) where o-10>=0)
      select obsid, cast(count(*) as double) n, round(case when count(*)>1 then {_KGE} end,6) kge,
      round(case when count(*)>1 then {_NSE} end,6) nse,
      round(case when count(*)>1 then ({_KGE}-(1-sqrt(2)))/sqrt(2) end,6) kge_skill
      from v group by obsid""",
    "daily_means": f"""select obsid, {_stamp('d', 'ts')}, round(avg(o),6) o, round(avg(s),6) s
      from (select obsid, {_RIGHT_DAY} d, o, s from ({v.SERIES_6H})) group by obsid, d""",
    "resampled_pairs": f"""select obsid, {_stamp('d', 'ts')}, round(avg(o),6) o, round(avg(s),6) s
      from (select q.obsid, case when contains(CAL_TYPE, '_24h') then {_RIGHT_DAY} else ts end d, o, s
            from ({v.SERIES_6H}) q join ({v.STATIONS}) st on st.obsid=q.obsid)
      group by obsid, d""",
    "dense_series": f"""with q as ({v.SERIES_6H}),
      b as (select obsid, unnest(generate_series(min(ts), max(ts), interval 6 hour)) ts from q group by obsid)
      select b.obsid, {_stamp('b.ts', 'ts')}, round(o,6) o from b
      left join q on q.obsid=b.obsid and q.ts=b.ts""",
    "alignment_violations": f"""with q as ({v.SERIES_6H}),
      a as (select obsid, ts, case when day(ts)<>5 then s end s from q where hour(ts)<>6),
      b as (select obsid, ts, o from q where o is not null),
      j as (select coalesce(a.obsid,b.obsid) obsid, coalesce(a.ts,b.ts) ts,
        case when a.ts is null then 'no simulated step' when b.ts is null then 'no observed step'
             when a.s is null then 'simulated value missing' end reason
        from a full outer join b on a.obsid=b.obsid and a.ts=b.ts)
      select obsid, {_stamp('ts', 'ts')}, reason from j where reason is not null""",
    "step_numbers": f"""with q as (select obsid, ts, s, row_number() over (partition by obsid order by ts) step,
        min(ts) over (partition by obsid) t0 from ({v.SERIES_6H}))
      select obsid, step, {_stamp('t0 + cast(step-1 as int)*interval 6 hour', 'ts')}, round(s,6) s from q""",
    "period_maxima": " union all ".join(
        f"""select obsid, '{u}' unit, {_stamp('period', 'period')}, round(peak,6) peak
        from ({_peak_sql(u)})""" for u in "DMY"),
    "series_bounds": f"""with q as (select obsid, min(ts) a, date_trunc('month', min(ts)) e
        from ({v.SERIES_6H}) group by obsid)
      select obsid, {_stamp('a', 'first_ts')}, {_stamp('e', 'expected_first')} from q where a<>e""",
    "plotting_positions": _plotting(),
    "gumbel_fit": f"""with {_fit_sql('D')} select obsid, round(a,6) a, round(u,6) u, m::double m,
      round(sqrt((syy-szy*szy/szz)/(m-2)/szz),6) se_a,
      round(sqrt((syy-szy*szy/szz)/(m-2)*(1.0/m+mz*mz/szz)),6) se_u from fit""",
    "gumbel_moments": f"""with pk as ({_peak_sql('D')}) select obsid,
      round(sqrt(6)/pi()*stddev_samp(peak),6) a,
      round(avg(peak)-0.5772::double*sqrt(6)/pi()*stddev_samp(peak),6) u from pk group by obsid""",
    "return_levels": f"with {_fit_sql('D')} " + " union all ".join(
        f"select obsid, {name[2:]}::double return_period, round({_level('365.25', name[2:])},6) level from fit"
        for name in LABELS),
    "contingency": f"with {_PSEUDO} select * from cont",
    "return_level_contingency": f"""with {_fit_sql('M')}, v as ({v.PAIRS_DAILY}),
      w as (select obsid, {_levels_wide('12')} from fit),
      lv as (unpivot w on {', '.join(f'"{x}"' for x in LABELS)} into name threshold value lv)
      select obsid, threshold, n::double n, a::double a, b::double b, c::double c, d::double d from (
        select obsid, threshold, {_CELLS} from v join lv using (obsid) group by 1, 2)""",
    "event_scores": _scores(_SCORE_SQL),
    "event_summaries": _summaries(),
    "performance_diagram": _scores({
        "success_ratio": f"1-{_SCORE_SQL['FAR']}", "hit_rate": _SCORE_SQL["HR"],
        "bias": _SCORE_SQL["B"], "threat_score": _SCORE_SQL["TS"]}),
    "checked_steps": """select o_custkey obsid, case when o_custkey%2=0 then 360 else 1440 end "minutes", count(*) n
      from orders group by 1, 2""",
    "step_hours_of_types": f"""select obsid, case when contains(CAL_TYPE,'_6h') then 6 else 24 end as "hours"
      from ({v.STATIONS})""",
}

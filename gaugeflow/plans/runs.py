"""Queries: run histories, ranking, archives, stop rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeflow.operators import history as h
from gaugeflow.plans import views as v
from gaugeflow.plans.views import rounded
from gaugeflow.session import settle

KEY = ["obsid"]
RUN = ["obsid", "gen", "run"]
PARETO = ["kge", "corr", "fit"]


def best_runs(spark, sf_dir):
    return rounded(h.best_runs(v.history(spark, sf_dir), KEY).select(*RUN, "kge"), *RUN)


def ranked_runs(spark, sf_dir):
    ranked = h.rank_runs(v.history(spark, sf_dir), KEY)
    return ranked.select(*RUN, "corrRank", "saeRank", "KGERank", "paretoRank")


def mosaic_ranked_runs(spark, sf_dir):
    """The variant of the map export: plain i/n scores, no minimum number of runs."""
    ranked = h.rank_runs(v.history(spark, sf_dir), KEY, minimum=0, floor=0.0)
    return ranked.select(*RUN, "corrRank", "saeRank", "KGERank", "paretoRank")


def _with_params(spark, sf_dir):
    return v.history(spark, sf_dir).withColumn("params", F.array("bias", "spread"))


def best_parameters(spark, sf_dir):
    ranked = h.rank_runs(_with_params(spark, sf_dir), KEY)
    return rounded(h.best_parameters(ranked, KEY, ["UpperZone", "LowerZone"]), *KEY)


def _maximised(spark, sf_dir):
    return v.history(spark, sf_dir).withColumn("fit", -F.col("sae"))


def pareto_archive(spark, sf_dir):
    return rounded(h.pareto_set(_maximised(spark, sf_dir), KEY, PARETO).select(*RUN, *PARETO), *RUN)


def archive_statistics(spark, sf_dir):
    archive = settle(h.pareto_set(_maximised(spark, sf_dir), KEY, PARETO))
    return rounded(h.archive_statistics(archive, KEY, "kge"), *KEY)


def front_history(spark, sf_dir):
    return rounded(h.front_history(v.history(spark, sf_dir)), "obsid", "gen")


def termination_flags(spark, sf_dir):
    flags = h.termination(h.front_history(v.history(spark, sf_dir)), 2, 8, 2, 0.003)
    return flags.select("obsid", "gen", F.col("stalled").cast("int").alias("stalled"),
                        F.col("reached_max_gen").cast("int").alias("reached_max_gen"))


def kge_target(spark, sf_dir):
    reached = h.reaches_target(h.front_history(v.history(spark, sf_dir)), 0.9995, 1.0, 0.0004)
    return rounded(reached.withColumn("reached", F.col("reached").cast("int")), "obsid", "reached")


def complete_generations(spark, sf_dir):
    """Runs up to the first generation that misses runs: eight order numbers are four generations of two."""
    runs = v.history(spark, sf_dir).withColumn("gen", F.col("run") % 4).withColumn("obsid", F.floor(F.col("run") / 8).cast("long"))
    return h.complete_generations(runs, 2, 2).select(*RUN)


def chosen_scenarios(spark, sf_dir):
    """Two scenarios of runs; listed stations take the first one, the others the second one."""
    runs = v.history(spark, sf_dir).select(*RUN, "kge")
    merged = h.merge_scenarios({"with_loss": runs, "zero_loss": runs.withColumn("kge", F.col("kge") - 1)})
    listed = v.table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(
        F.col("n_nationkey").cast("long").alias("obsid"))
    return rounded(h.choose_scenario(merged, listed, "with_loss", "zero_loss"), *RUN, "scenario")


QUERIES = {f.__name__: f for f in (
    best_runs, ranked_runs, mosaic_ranked_runs, best_parameters, pareto_archive, archive_statistics,
    front_history, termination_flags, kge_target, complete_generations, chosen_scenarios)}


# --- reference SQL ------------------------------------------------------------------------

def _best(minimum: int) -> str:
    return f"""h as ({v.HISTORY}),
      o as (select *, row_number() over (partition by obsid order by kge desc, gen, run) k,
        count(*) over (partition by obsid) n from h),
      b as (select * exclude (k, n) from o where k<=greatest({minimum}, round_even(n*0.1::double, 0)))"""


def _ranked(minimum: int, floor: float) -> str:
    def score(order: str) -> str:
        return (f"{floor}::double + (row_number() over (partition by obsid order by {order}, gen, run))"
                f"*{1 - floor}::double/count(*) over (partition by obsid)")
    return f"""{_best(minimum)}, r as (select *, {score('corr desc')} "corrRank", {score('sae')} "saeRank",
        {score('kge desc')} "KGERank" from b),
      p as (select *, "corrRank"*"saeRank"*"KGERank" "paretoRank" from r)"""


_RANKS = 'obsid, gen, run, "corrRank", "saeRank", "KGERank", "paretoRank"'
_ARCHIVE = f"""m as (select *, -sae fit from ({v.HISTORY})),
  arch as (select * from m a where not exists (select 1 from m b where b.obsid=a.obsid
    and b.kge>=a.kge and b.corr>=a.corr and b.fit>=a.fit
    and (b.kge>a.kge or b.corr>a.corr or b.fit>a.fit)))"""
_FRONT = f"""g as (select obsid, gen, max(kge) k from ({v.HISTORY}) group by 1, 2),
  fr as (select obsid, gen, max(k) over (partition by obsid order by gen) top from g)"""

ORACLES = {
    "best_runs": f"with {_best(2)} select obsid, gen, run, round(kge,6) kge from b",
    "ranked_runs": f"with {_ranked(2, 0.1)} select {_RANKS} from p",
    "mosaic_ranked_runs": f"with {_ranked(0, 0.0)} select {_RANKS} from p",
    "best_parameters": f"""with {_ranked(2, 0.1)}, f as (select *, row_number() over
      (partition by obsid order by "paretoRank", gen, run) k from p)
      select obsid, round(kge,6) effover, round(kge,6) "R", round(bias,6) "param_00_UpperZone",
        round(spread,6) "param_01_LowerZone" from f where k=1""",
    "pareto_archive": f"""with {_ARCHIVE} select obsid, gen, run, round(kge,6) kge, round(corr,6) corr,
      round(fit,6) fit from arch""",
    "archive_statistics": f"""with {_ARCHIVE} select obsid, round(max(kge),6) "effmax_R",
      round(min(kge),6) "effmin_R", round(stddev_pop(kge),6) "effstd_R", round(avg(kge),6) "effavg_R"
      from arch group by obsid""",
    "front_history": f"""with {_FRONT} select obsid, gen, round(top,6) "effmax_R", round(top,6) "effmin_R",
      0.0::double "effstd_R", round(top,6) "effavg_R" from fr""",
    "termination_flags": f"""with {_FRONT}, l as (select *, lag(top,2) over (partition by obsid order by gen) e
      from fr) select obsid, gen, cast(gen>=2 and coalesce(top-e<0.003::double,false) as int) stalled,
      cast(gen>=8 as int) reached_max_gen from l""",
    "kge_target": f"""with {_FRONT}, l as (select obsid, max(top) k from fr group by obsid)
      select obsid, round(k,6) "effmax_R",
        cast(abs(k-1.0::double)<0.0004::double and k>0.9995::double as int) reached from l""",
    "complete_generations": f"""with h as (select run//8 obsid, run%4 gen, run from ({v.HISTORY})),
      c as (select obsid, gen, count(*) n, row_number() over (partition by obsid order by gen)-1 i
        from h group by 1, 2),
      w as (select obsid, gen, max(cast(n<>2 or gen<>i as int)) over (partition by obsid order by gen) bad from c)
      select h.* from h join w on w.obsid=h.obsid and w.gen=h.gen and bad=0""",
    "chosen_scenarios": f"""with h as (select obsid, gen, run, kge from ({v.HISTORY})),
      l as (select n_nationkey from nation where n_regionkey=1)
      select obsid, gen, run, 'with_loss' scenario, round(kge,6) kge from h where obsid in (select * from l)
      union all select obsid, gen, run, 'zero_loss', round(kge-1,6) from h where obsid not in (select * from l)""",
}

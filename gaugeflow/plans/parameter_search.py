"""Queries: the steps of the parameter search, and a whole search."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.skew import attach
from gaugeflow.operators import history as h
from gaugeflow.operators import search
from gaugeflow.plans import views as v
from gaugeflow.plans.views import rounded
from gaugeflow.session import checkpoint_dir, settle

SEED = 7
POP, MU, LAM = 8, 4, 6
SETTINGS = search.SearchSettings(pop=POP, mu=MU, lam=LAM, min_gen=2, max_gen=4, gen_offset=2, seed=SEED)
TOLERANCE = 0.05


def _stations(spark, sf_dir):
    return v.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("obsid"))


def param_ranges(spark, sf_dir) -> DataFrame:
    """One parameter per region row."""
    key = F.col("r_regionkey")
    return v.table(spark, sf_dir, "region").select(
        key.cast("int").alias("idx"), F.col("r_name").alias("name"), (key * 1.0).alias("min"),
        (key * 2.0 + 10).alias("max"), (key * 1.5 + 5).alias("default"))


def _ranges(spark, sf_dir) -> search.Ranges:
    return search.Ranges.from_table(param_ranges(spark, sf_dir))


def _first(spark, sf_dir):
    ranges = _ranges(spark, sf_dir)
    return ranges, search.initial_population(_stations(spark, sf_dir), len(ranges.names), POP, SEED)


def initial_population(spark, sf_dir):
    ranges, people = _first(spark, sf_dir)
    genes = people.select("obsid", "run", F.posexplode(F.arrays_zip(
        F.col("x").alias("x"), ranges.unscale(F.col("x")).alias("param"),
        ranges.perturbed(F.col("x"), TOLERANCE).alias("perturbed"))).alias("idx", "g"))
    return rounded(genes.select("obsid", "run", "idx", "g.x", "g.param", "g.perturbed"), "obsid", "run", "idx")


def rescaled_genes(spark, sf_dir):
    """Genes after unscaling and scaling back, as a restart reads them."""
    ranges, people = _first(spark, sf_dir)
    back = ranges.scale(ranges.unscale(F.col("x")))
    return rounded(people.select("obsid", "run", F.posexplode(back).alias("idx", "x")), "obsid", "run", "idx")


def analytic_model(target: float, name: str = "kge"):
    """1 - root mean square distance of the genes to a target."""
    def model(individuals: DataFrame) -> DataFrame:
        gap = F.transform("x", lambda g: (g - F.lit(target)) * (g - F.lit(target)))
        total = F.aggregate(gap, F.lit(0.0), lambda a, b: a + b)
        return individuals.select("obsid", "run", (1 - F.sqrt(total / F.size("x"))).alias(name))
    return model


def _evaluated(spark, sf_dir):
    ranges, people = _first(spark, sf_dir)
    return ranges, search.evaluate(people, ranges, analytic_model(0.4))


def survivors(spark, sf_dir):
    kept = search.survivors(_evaluated(spark, sf_dir)[1], SETTINGS)
    return rounded(kept.select("obsid", "gen", "run", "kge"), "obsid", "gen", "run")


def children(spark, sf_dir):
    """First offspring of every station, gene by gene."""
    ranges, runs = _evaluated(spark, sf_dir)
    parents = search.survivors(runs, SETTINGS)
    born = search.vary(parents, 1, SETTINGS, len(ranges.names))
    return rounded(born.select("obsid", "run", F.posexplode("x").alias("idx", "x")), "obsid", "run", "idx")


def linear_simulator(base: DataFrame):
    """A column model: a multiple of a base series plus a constant; ``base`` holds the observations too.

    The individuals of a station, bounded by the population, meet each step as one array.
    """
    def simulate(individuals: DataFrame) -> DataFrame:
        one = F.struct("run", F.element_at("params", 1).alias("gain"), F.element_at("params", 2).alias("offset"))
        runs = settle(individuals.groupBy("obsid").agg(F.collect_list(one).alias("runs")))
        steps = attach(base, runs, ["obsid"]).select("obsid", "ts", "s", "o", F.explode("runs").alias("r"))
        return steps.select("obsid", "r.run", "ts", "o", (F.col("r.gain") * F.col("s") + F.col("r.offset")).alias("s"))
    return simulate


def series_evaluation(spark, sf_dir):
    """Objectives of the first population with a model that simulates series."""
    ranges, people = _first(spark, sf_dir)
    model = search.series_model(linear_simulator(v.pairs_daily(spark, sf_dir)))
    runs = search.evaluate(people, ranges, model)
    return rounded(runs.select("obsid", "run", "kge", "corr", "bias", "spread", "sae"), "obsid", "run")


def reservoir(stored, forcing, params):
    """A store that drains by a share each step and is filled by a multiple of the forcing."""
    stored = stored * (1 - 1 / (1 + params[:, 1])) + params[:, 0] * forcing
    return stored, stored


def reservoir_evaluation(spark, sf_dir):
    """Objectives of the first population with a model that remembers its state."""
    ranges, people = _first(spark, sf_dir)
    # a step without a time pairs with no observation; being the last, it moves no other
    pairs = settle(v.pairs_daily(spark, sf_dir).filter("ts IS NOT NULL").withColumnRenamed("s", "forcing"))
    simulate = search.stateful_simulator(reservoir, pairs)
    runs = search.evaluate(people, ranges, search.series_model(simulate))
    return rounded(runs.select("obsid", "run", "kge", "corr", "bias", "spread", "sae"), "obsid", "run")


def _history_path(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def search_fronts(spark, sf_dir):
    """Front history of a whole search on the analytic objective."""
    ranges = _ranges(spark, sf_dir)
    table = search.HistoryTable(spark, _history_path(spark, "search"))
    state = search.run_search(_stations(spark, sf_dir), ranges, analytic_model(0.4), SETTINGS, table)
    return rounded(state.fronts, "obsid", "gen")


GOALS = {"near_low": 0.2, "near_high": 0.8}
OBJECTIVES = list(GOALS)


def _rated(spark, sf_dir):
    """The first population of every station with two competing objectives."""
    people = _first(spark, sf_dir)[1]
    rated = people
    for name, target in GOALS.items():
        rated = rated.join(analytic_model(target, name)(people), ["obsid", "run"])
    return settle(rated)


def front_numbers(spark, sf_dir):
    return h.front_numbers(_rated(spark, sf_dir), ["obsid"], OBJECTIVES).select(
        "obsid", "run", F.col("front").cast("long").alias("front"))


def crowding_distances(spark, sf_dir):
    ranked = settle(h.front_numbers(_rated(spark, sf_dir), ["obsid"], OBJECTIVES))
    far = h.crowding(ranked, ["obsid"], OBJECTIVES, "run")
    finite = F.when(F.col("distance") < 1e300, F.col("distance"))
    return rounded(far.select("obsid", "run", finite.alias("distance")), "obsid", "run")


def survivors_two_objectives(spark, sf_dir):
    kept = h.select_survivors(_rated(spark, sf_dir), ["obsid"], OBJECTIVES, MU, "run")
    return rounded(kept.select("obsid", "run", *OBJECTIVES), "obsid", "run")


QUERIES = {f.__name__: f for f in (
    initial_population, rescaled_genes, survivors, children, series_evaluation, reservoir_evaluation, search_fronts,
    front_numbers, crowding_distances, survivors_two_objectives)}


# --- reference SQL ------------------------------------------------------------------------

def _uniform(stream: str, *ids: str) -> str:
    return (f"(cast('0x'||substr(md5(concat_ws('|','{SEED}','{stream}',{','.join(ids)})),1,13) as bigint)"
            "/4503599627370496::double)")


_PEOPLE = f"""pr as (select cast(r_regionkey as int) idx, r_regionkey::double lo, r_regionkey*2.0::double+10 hi
    from region),
  np as (select count(*) n from pr),
  ppl as (select s_suppkey obsid, run, idx, lo, hi, {_uniform('init', 's_suppkey', 'run', 'idx')} x
    from supplier, (select unnest(range(1,{POP + 1})) run), pr)"""
_SCORED = f"""{_PEOPLE},
  sc as (select obsid, run, 1-sqrt(sum((x-0.4::double)*(x-0.4::double))/count(*)) kge from ppl group by 1, 2),
  sv as (select *, row_number() over (partition by obsid order by kge desc, run) k from sc
    qualify k<={MU})"""
_IDS = ("obsid", "1", "run")
_CHILDREN = f"""{_SCORED},
  pool as (select obsid, run prun, row_number() over (partition by obsid order by run)-1 slot from sv),
  kid as (select s_suppkey obsid, run from supplier, (select unnest(range(1,{LAM + 1})) run)),
  pick as (select obsid, run, {_uniform('how', *_IDS)} how,
    cast(floor({_uniform('p1', *_IDS)}*{MU}) as int) a,
    cast(floor({_uniform('p2', *_IDS)}*{MU - 1}) as int) b0 from kid),
  both2 as (select *, b0+cast(b0>=a as int) b from pick),
  gene as (select t.obsid, t.run, p1.idx, how, p1.x x1, p2.x x2 from both2 t
    join pool q1 on q1.obsid=t.obsid and q1.slot=a join pool q2 on q2.obsid=t.obsid and q2.slot=b
    join ppl p1 on p1.obsid=t.obsid and p1.run=q1.prun
    join ppl p2 on p2.obsid=t.obsid and p2.run=q2.prun and p2.idx=p1.idx),
  rnd as (select *, 1.3::double*{_uniform('mate', *_IDS, 'idx')}-0.15::double g,
    {_uniform('hit', *_IDS, 'idx')} hit,
    sqrt(-2*ln(1-{_uniform('noise:r', *_IDS, 'idx')}))*cos(2*pi()*{_uniform('noise:t', *_IDS, 'idx')}) z
    from gene)"""

_CORR = "covar_pop(o,s)/nullif(stddev_pop(o)*stddev_pop(s),0)"
_BIAS = "avg(s)/nullif(avg(o),0)"
_SPREAD = "(stddev_pop(s)/nullif(avg(s),0))/nullif(stddev_pop(o)/nullif(avg(o),0),0)"
_KGE = f"(1-sqrt(power({_CORR}-1,2)+power({_BIAS}-1,2)+power({_SPREAD}-1,2)))"
_RATED = f"""{_PEOPLE},
  o as (select obsid, run, 1-sqrt(sum((x-0.2::double)*(x-0.2::double))/count(*)) near_low,
      1-sqrt(sum((x-0.8::double)*(x-0.8::double))/count(*)) near_high from ppl group by 1, 2),
  dom as (select a.obsid, a.run better, b.run worse from o a join o b on a.obsid=b.obsid
    and a.near_low>=b.near_low and a.near_high>=b.near_high
    and (a.near_low>b.near_low or a.near_high>b.near_high)),
  chain as (select obsid, run, 0 depth from o union
    select dom.obsid, worse, depth+1 from chain join dom on dom.obsid=chain.obsid and better=chain.run),
  fr as (select obsid, run, max(depth) front from chain group by 1, 2),
  ranked as (select o.*, cast(front as bigint) front from o join fr using (obsid, run))"""


def _gap(value: str) -> str:
    w = f"(partition by obsid, front order by {value}, run)"
    p = "(partition by obsid, front)"
    return f"""case when lag({value}) over {w} is null or lead({value}) over {w} is null then null
      when max({value}) over {p}=min({value}) over {p} then 0
      else (lead({value}) over {w}-lag({value}) over {w})/((max({value}) over {p}-min({value}) over {p})*2) end"""


def _replay(gens: int) -> str:
    """The whole search again, one generation after the other: children, scores, survivors, archive, stop flags."""
    ids = ("obsid", "gen", "run")
    parts = [f"""{_PEOPLE},
      genes0 as materialized (select obsid, 0 gen, run, idx, x from ppl),
      runs0 as materialized (select obsid, 0 gen, run, 1-sqrt(sum((x-0.4::double)*(x-0.4::double))/count(*)) kge from genes0 group by 1, 2, 3),
      pool0 as materialized (select * from runs0), all0 as materialized (select * from genes0),
      top0 as materialized (select obsid, 0 gen, max(kge) top from runs0 group by 1),
      live0 as materialized (select obsid from top0)"""]
    for g in range(1, gens + 1):
        p, floor = g - 1, "and false" if g < SETTINGS.min_gen else ""
        parts.append(f"""
      slots{g} as materialized (select *, row_number() over (partition by obsid order by gen, run)-1 slot,
        count(*) over (partition by obsid) size from pool{p} semi join live{p} using (obsid)),
      kids{g} as (select obsid, {g} gen, unnest(range(1,{LAM + 1})) run, size from (select distinct obsid, size from slots{g})),
      drawn{g} as (select *, {_uniform('how', *ids)} how, cast(floor({_uniform('p1', *ids)}*size) as int) a,
        cast(floor({_uniform('p2', *ids)}*greatest(size-1,1)) as int) b0 from kids{g}),
      both{g} as (select *, case when size=1 then 0 else b0+cast(b0>=a as int) end b from drawn{g}),
      bred{g} as (select t.obsid, t.gen, t.run, x1.idx, how, x1.x xa, x2.x xb from both{g} t
        join slots{g} q1 on q1.obsid=t.obsid and q1.slot=a join slots{g} q2 on q2.obsid=t.obsid and q2.slot=b
        join all{p} x1 on x1.obsid=t.obsid and x1.gen=q1.gen and x1.run=q1.run
        join all{p} x2 on x2.obsid=t.obsid and x2.gen=q2.gen and x2.run=q2.run and x2.idx=x1.idx),
      moved{g} as (select *, 1.3::double*{_uniform('mate', *ids, 'idx')}-0.15::double g, {_uniform('hit', *ids, 'idx')} hit,
        sqrt(-2*ln(1-{_uniform('noise:r', *ids, 'idx')}))*cos(2*pi()*{_uniform('noise:t', *ids, 'idx')}) z from bred{g}),
      genes{g} as materialized (select obsid, gen, run, idx, least(greatest(case when how<{SETTINGS.crossover}::double then (1-g)*xa+g*xb
        when how<{SETTINGS.crossover + SETTINGS.mutation}::double and hit<0.3::double then xa+0.3::double*z else xa end, 0), 1) x from moved{g}),
      runs{g} as materialized (select obsid, gen, run, 1-sqrt(sum((x-0.4::double)*(x-0.4::double))/count(*)) kge from genes{g} group by 1, 2, 3),
      all{g} as materialized (select * from all{p} union all select * from genes{g}),
      pool{g} as materialized (select obsid, gen, run, kge from (select * from pool{p} union all select * from runs{g})
        qualify row_number() over (partition by obsid order by kge desc, gen, run)<={MU}),
      top{g} as materialized (select * from top{p} union all select r.obsid, {g}, greatest(max(kge), max(t.top))
        from runs{g} r join top{p} t on t.obsid=r.obsid and t.gen={p} group by 1),
      live{g} as materialized (select obsid from live{p} anti join (select t.obsid from top{g} t join top{g} e on e.obsid=t.obsid
        and e.gen=t.gen-{SETTINGS.gen_offset} where t.gen={g} and t.top-e.top<{SETTINGS.effmax_tol}::double {floor}) using (obsid))""")
    return "with " + ",".join(parts)


ORACLES = {
    "search_fronts": f"""{_replay(SETTINGS.max_gen)} select obsid, gen, round(top,6) "effmax_R", round(top,6) "effmin_R",
      0.0::double "effstd_R", round(top,6) "effavg_R" from top{SETTINGS.max_gen}""",
    "initial_population": f"""with {_PEOPLE} select obsid, run, idx, round(x,6) x,
      round(lo+x*(hi-lo),6) param, round((lo+x*(hi-lo))*1.05::double,6) perturbed from ppl""",
    "rescaled_genes": f"with {_PEOPLE} select obsid, run, idx, round(x,6) x from ppl",
    "survivors": f"with {_SCORED} select obsid, 0 gen, run, round(kge,6) kge from sv",
    "children": f"""with {_CHILDREN} select obsid, run, idx, round(least(greatest(
      case when how<0.6::double then (1-g)*x1+g*x2
           when hit<0.3::double then x1+0.3::double*z else x1 end, 0), 1), 6) x from rnd""",
    "series_evaluation": f"""with {_PEOPLE},
      w as (select obsid, run, max(case when idx=0 then lo+x*(hi-lo) end) gain,
        max(case when idx=1 then lo+x*(hi-lo) end) shift from ppl group by 1, 2),
      v as (select d.obsid, run, o, gain*s+shift s from ({v.PAIRS_DAILY}) d join w on w.obsid=d.obsid)
      select obsid, run, round(greatest(coalesce({_KGE},-100.0),-100.0),6) kge, round({_CORR},6) corr,
        round({_BIAS},6) bias, round({_SPREAD},6) spread, round(sum(abs(s-o)),6) sae from v group by 1, 2""",
    "reservoir_evaluation": f"""with recursive {_PEOPLE},
      w as (select obsid, run, max(case when idx=0 then lo+x*(hi-lo) end) gain,
        1-1/(1+max(case when idx=1 then lo+x*(hi-lo) end)) stays from ppl group by 1, 2),
      st as materialized (select obsid, o, s f, row_number() over (partition by obsid order by ts) i from ({v.PAIRS_DAILY})),
      sim as (select obsid, run, 1::bigint i, o, gain*f s, gain, stays from st join w using (obsid) where i=1
        union all select sim.obsid, sim.run, st.i, st.o, sim.s*stays+gain*f, gain, stays
        from sim join st on st.obsid=sim.obsid and st.i=sim.i+1)
      select obsid, run, round(greatest(coalesce({_KGE},-100.0),-100.0),6) kge, round({_CORR},6) corr,
        round({_BIAS},6) bias, round({_SPREAD},6) spread, round(sum(abs(s-o)),6) sae from sim group by 1, 2""",
    "front_numbers": f"with recursive {_RATED} select obsid, run, front from ranked",
    "crowding_distances": f"""with recursive {_RATED},
      d as (select obsid, run, {_gap('near_low')} a, {_gap('near_high')} b from ranked)
      select obsid, run, round(a+b,6) distance from d""",
    "survivors_two_objectives": f"""with recursive {_RATED},
      d as (select *, {_gap('near_low')} a, {_gap('near_high')} b from ranked),
      k as (select *, row_number() over (partition by obsid
        order by front, coalesce(a+b, 1e300::double) desc, run) k from d)
      select obsid, run, round(near_low,6) near_low, round(near_high,6) near_high from k where k<={MU}""",
}

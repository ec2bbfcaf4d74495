"""Queries: station network, inflows and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeflow.operators import grid as g
from gaugeflow.operators import history as h
from gaugeflow.operators import inflows, metrics, network
from gaugeflow.plans import views as v
from gaugeflow.plans.views import day, rounded
from gaugeflow.session import settle

WORKERS = 4
MAX_SHARE = 0.1


def _regions(spark, sf_dir):
    ldd, gauges = v.network(spark, sf_dir)
    regions = network.interstation_regions(ldd, gauges)
    return ldd, gauges, settle(regions)


def _tree(spark, sf_dir):
    ldd, gauges, regions = _regions(spark, sf_dir)
    parents = settle(network.station_parents(ldd, gauges, regions))
    return ldd, regions, parents, network.station_tree(parents, regions)


def _parents(spark, sf_dir):
    ldd, gauges, regions = _regions(spark, sf_dir)
    return ldd, settle(network.station_parents(ldd, gauges, regions))


def station_conflicts(spark, sf_dir):
    ldd, _ = v.network(spark, sf_dir)
    gauges = v.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("obsid"), (F.col("l_suppkey") * 37 % 1700).alias("cell")).distinct()
    near = gauges.select("obsid", F.when(F.col("obsid") % 9 == 0, F.lit(77)).otherwise(F.col("cell")).alias("cell"))
    return network.station_conflicts(near, ldd)


def outlet_conflicts(spark, sf_dir):
    """Suppliers as stations; the outlet cells of customers hold station ids, some of them shifted or repeated."""
    gauges = v.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("obsid"), (F.col("s_suppkey") * 3).alias("cell"))
    held = F.col("c_custkey") % 3 + F.floor(F.col("c_custkey") / 3) + F.when(F.col("c_custkey") % 5 == 0, 1).otherwise(0)
    outlets = v.table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0 OR c_nationkey = 7").select(
        F.col("c_custkey").alias("cell"), held.cast("long").alias("station"))
    return network.outlet_conflicts(gauges, outlets)


def interstation_regions(spark, sf_dir):
    return _regions(spark, sf_dir)[2]


def sampling_frequency(spark, sf_dir):
    _, regions, _, tree = _tree(spark, sf_dir)
    return network.cell_frequency(regions, tree)


def station_tree(spark, sf_dir):
    return _tree(spark, sf_dir)[3].select("obsid", "parent", "depth", "root", "upstream_cells", "wave")


def direct_links(spark, sf_dir):
    return network.direct_links(_parents(spark, sf_dir)[1])


def links_wide(spark, sf_dir):
    """The wide link table, unfolded again by slot."""
    wide = network.links_wide(settle(network.direct_links(_parents(spark, sf_dir)[1])))
    return wide.unpivot(["obsid"], [c for c in wide.columns if c != "obsid"], "slot", "upstream_id").select(
        "obsid", F.col("slot").cast("int").alias("slot"), "upstream_id").filter("upstream_id IS NOT NULL")


def inlet_cells(spark, sf_dir):
    ldd, parents = _parents(spark, sf_dir)
    return network.inlet_cells(parents, ldd)


def nested_groups(spark, sf_dir):
    return network.nested_groups(_tree(spark, sf_dir)[3]).select("obsid", "group_id")


def group_areas(spark, sf_dir):
    return network.group_areas(network.nested_groups(_tree(spark, sf_dir)[3]))


def worker_allocation(spark, sf_dir):
    groups = network.nested_groups(_tree(spark, sf_dir)[3])
    return network.allocate_workers(groups, WORKERS)


def thinned_stations(spark, sf_dir):
    tree = _tree(spark, sf_dir)[3]
    return network.thin_stations(tree, "upstream_cells", MAX_SHARE).withColumn("keep", F.col("keep").cast("int"))


# --- inflows ------------------------------------------------------------------------------

def _simulated(spark, sf_dir):
    """Daily simulated series of the stations whose number is eleven times a supplier's."""
    return v.pairs_daily(spark, sf_dir).select(
        (F.col("obsid") * 11).alias("obsid"), "ts", F.col("s").alias("q"))


def upstream_inflows(spark, sf_dir):
    links = network.direct_links(_parents(spark, sf_dir)[1])
    gathered = inflows.gather_inflows(settle(links), _simulated(spark, sf_dir))
    return rounded(gathered.select("obsid", "inlet_no", "upstream_id", day(), "q"),
                   "obsid", "inlet_no", "upstream_id", "ts")


def upstream_inflows_wide(spark, sf_dir):
    """The wide inflow table, unfolded again by slot."""
    links = network.direct_links(_parents(spark, sf_dir)[1])
    links = settle(links)
    slots = links.agg(F.max("inlet_no")).first()[0] or 0
    wide = inflows.inflows_wide(inflows.gather_inflows(links, _simulated(spark, sf_dir)), "ts", slots)
    flows = [f"q_{i}" for i in range(1, slots + 1)]
    long = wide.select("obsid", day(), *flows).unpivot(["obsid", "ts"], flows, "slot", "q").filter("q IS NOT NULL")
    return rounded(long, "obsid", "ts", "slot")


def missing_upstream(spark, sf_dir):
    links = network.direct_links(_parents(spark, sf_dir)[1])
    return inflows.missing_upstream(links, _simulated(spark, sf_dir)).select("obsid", "inlet_no", "upstream_id")


def inflow_flags(spark, sf_dir):
    _, parents = _parents(spark, sf_dir)
    return inflows.inflow_flags(parents, network.direct_links(parents))


# --- grids --------------------------------------------------------------------------------

def _cells(spark, sf_dir):
    """Grid cells with the last five regions ungauged."""
    return v.grid(spark, sf_dir).withColumn(
        "region", F.when(F.col("region") > 45, network.NO_STATION).otherwise(F.col("region")))


def bounding_boxes(spark, sf_dir):
    return g.bounding_boxes(_cells(spark, sf_dir))


def clipped_grid(spark, sf_dir):
    """Every grid value in the box of every station, and the part inside its mask, by row."""
    cells = _cells(spark, sf_dir)
    boxes = settle(g.bounding_boxes(cells))
    clipped = g.clip_to_boxes(cells.select("x", "y", "value"), boxes, tile=16)
    masked = g.mask_values(clipped.withColumn("boxed", F.col("value")), g.station_masks(cells))
    return rounded(masked.groupBy("obsid", "y").agg(
        F.count("boxed").alias("n_box"), F.sum("boxed").alias("box_sum"),
        F.count("value").alias("n_mask"), F.sum("value").alias("mask_sum")),
        "obsid", "y", "n_box", "n_mask")


def masked_cells(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    gauged = g.station_masks(cells)
    return rounded(g.cells_in_masks(v.grid(spark, sf_dir).select("cell", "x", "y", "value"), gauged)
                   .select("cell", "value"), "cell")


def _network_cells(regions):
    return regions.select("cell", (F.col("cell") % 7).alias("x"), F.floor(F.col("cell") / 7).alias("y"), "region")


def station_outlets(spark, sf_dir):
    _, gauges, regions = _regions(spark, sf_dir)
    return g.outlets(gauges, _network_cells(regions)).select("obsid", "cell", "x", "y")


def inlets_in_masks(spark, sf_dir):
    ldd, gauges, regions = _regions(spark, sf_dir)
    inlets = network.inlet_cells(network.station_parents(ldd, gauges, regions), ldd)
    return g.inlets_in_masks(inlets, _network_cells(regions)).select("obsid", "upstream_id", "cell", "x", "y")


SCORES = ["kge", "corr", "bias", "spread", "sae"]


def _best_values(spark, sf_dir):
    """(obsid, param, value) of the best run of each station: two parameters and its scores."""
    ranked = h.rank_runs(v.history(spark, sf_dir), ["obsid"], minimum=0, floor=0.0)
    best = h.best_run(ranked, ["obsid"], ["run", *SCORES])
    wide = best.select("obsid", *[F.col(c).cast("double").alias(c) for c in SCORES],
                       (F.col("run") % 40).cast("double").alias("UpperZone"))
    return wide.unpivot(["obsid"], [*SCORES, "UpperZone"], "param", "value")


def _long_run_values(spark, sf_dir):
    scores = metrics.long_run_scores(v.pairs_daily(spark, sf_dir), ["obsid"])
    wide = scores.select("obsid", F.col("kge").alias("KGELongTermRun"),
                         F.col("kge_skill").alias("KGESkillScore"), F.col("nse").alias("NSELongTermRun"))
    return wide.unpivot(["obsid"], ["KGELongTermRun", "KGESkillScore", "NSELongTermRun"], "param", "value")


def _defaults(values):
    """-9999 for scores, 10 for the parameter."""
    return values.select("param").distinct().withColumn(
        "value", F.when(F.col("param") == "UpperZone", 10.0).otherwise(-9999.0))


def _known(spark, sf_dir):
    return v.stations(spark, sf_dir).filter("area IS NOT NULL").select("obsid")


def parameter_mosaic(spark, sf_dir):
    """Default values where a station is uncalibrated or absent."""
    values = settle(_best_values(spark, sf_dir))
    return rounded(g.mosaic(_cells(spark, sf_dir), _known(spark, sf_dir), values, _defaults(values)),
                   "cell", "region", "param")


def parameter_mosaic_flagged(spark, sf_dir):
    """-1 where a station is uncalibrated; long-run scores included."""
    values = settle(_best_values(spark, sf_dir).unionByName(_long_run_values(spark, sf_dir)))
    painted = g.mosaic(_cells(spark, sf_dir), _known(spark, sf_dir), values, _defaults(values), uncalibrated=-1)
    return rounded(painted, "cell", "region", "param")


def overridden_values(spark, sf_dir):
    values = _best_values(spark, sf_dir)
    fixed = v.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("obsid"),
        F.when(F.col("n_regionkey") == 0, "UpperZone").otherwise("sae").alias("param"),
        (F.col("n_regionkey") * 0.2).alias("value"))
    return rounded(g.override_values(values, fixed), "obsid", "param")


def calibration_counts(spark, sf_dir):
    return g.calibration_counts(_known(spark, sf_dir), v.history(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    station_conflicts, outlet_conflicts, interstation_regions, sampling_frequency, station_tree, direct_links, links_wide,
    inlet_cells, nested_groups, group_areas, worker_allocation, thinned_stations, upstream_inflows,
    upstream_inflows_wide, missing_upstream, inflow_flags, bounding_boxes, clipped_grid, masked_cells,
    station_outlets, inlets_in_masks, parameter_mosaic, parameter_mosaic_flagged, overridden_values,
    calibration_counts)}


# --- reference SQL ------------------------------------------------------------------------

# every cell walks down to its pit; k counts the stations met, the cell itself included
_WALK = f"""with recursive net as ({v.NETWORK}),
  walk as (select cell origin, cell at_cell, 0 step, is_station here from net
    union all select w.origin, n.cell, w.step+1, n.is_station
    from walk w join net c on c.cell=w.at_cell join net n on n.cell=c.down),
  hits as (select *, row_number() over (partition by origin order by step) k from walk where here),
  reg as (select net.cell, coalesce(h.at_cell,-1) region
    from net left join hits h on h.origin=net.cell and h.k=1),
  par as (select net.cell obsid, net.down, h.at_cell parent
    from net left join hits h on h.origin=net.cell and h.k=2 where is_station),
  tree as (select par.obsid, parent,
      (select count(*) from hits h where h.origin=par.obsid) depth,
      (select max_by(h.at_cell, h.k) from hits h where h.origin=par.obsid) root,
      (select count(*) from walk w where w.at_cell=par.obsid) upstream_cells,
      (select max(h.k)-1 from hits h join net o on o.cell=h.origin and o.is_station
        where h.at_cell=par.obsid) wave
    from par),
  links as (select parent obsid, row_number() over (partition by parent order by obsid) inlet_no,
    obsid upstream_id from par where parent is not null),
  roots as (select root, row_number() over (order by upstream_cells desc, root) group_id
    from tree where obsid=root),
  grp as (select obsid, group_id, upstream_cells from tree join roots using (root))"""

# one inlet after the other: the first cell of its way down that no earlier one has
_PLACED = """turns as (select parent, obsid, down, row_number() over (order by parent, obsid) k from par where parent is not null),
  placed as (select 0::bigint k, []::bigint[] taken, null::bigint upstream_id, null::bigint obsid, null::bigint cell
    union all select t.k, list_filter(list_append(f.taken, t.c), lambda x: x is not null), t.obsid, t.parent, t.c
    from placed f join lateral (select k, parent, obsid, (select arg_min(w.at_cell, w.step) from walk w
      where w.origin=turns.down and not list_contains(f.taken, w.at_cell)) c from turns) t on t.k=f.k+1)"""
# stations by wave: kept unless a kept one above comes too close
_THINNED = f"""ordered as (select obsid, upstream_cells area, row_number() over (order by wave, obsid) k from tree),
  thinned as (select 0::bigint k, []::bigint[] kept, null::bigint obsid, null::boolean keep
    union all select t.k, case when t.ok then list_append(f.kept, t.obsid) else f.kept end, t.obsid, t.ok
    from thinned f join lateral (select k, obsid, coalesce(area > {{share}} * (select max(a.area) from hits h join ordered a on a.obsid=h.origin
      where h.at_cell=o.obsid and list_contains(f.kept, h.origin)), true) ok from ordered o) t on t.k=f.k+1)"""

_SIM = f"select obsid*11 obsid, ts, s q from ({v.PAIRS_DAILY})"
_CELLS = f"""cl as (select cell, x, y, case when region>45 then -1 else region end region, "value" val
  from ({v.GRID}))"""
_BOXES = """bx as (select region obsid, min(x) x0, max(x) x1, min(y) y0, max(y) y1 from cl
  where region<>-1 group by region)"""
_RANKED = f"""h as ({v.HISTORY}),
  o as (select *, row_number() over (partition by obsid order by kge desc, gen, run) k,
    count(*) over (partition by obsid) n from h),
  b as (select * exclude (k, n) from o where k<=round_even(n*0.1::double, 0)),
  r as (select *, (row_number() over (partition by obsid order by corr desc, gen, run)/(count(*) over (partition by obsid))::double)
      * (row_number() over (partition by obsid order by sae, gen, run)/(count(*) over (partition by obsid))::double)
      * (row_number() over (partition by obsid order by kge desc, gen, run)/(count(*) over (partition by obsid))::double) pr
    from b),
  f as (select *, row_number() over (partition by obsid order by pr, gen, run) k from r),
  w as (select obsid, kge, corr, bias, spread, sae, (run%40)::double "UpperZone" from f where k=1),
  vals as (unpivot w on kge, corr, bias, spread, sae, "UpperZone" into name param value val)"""
_KNOWN = f"kn as (select obsid from ({v.STATIONS}) where area is not null)"
_CORR = "covar_pop(o,s)/nullif(stddev_pop(o)*stddev_pop(s),0)"
_BIAS = "avg(s)/nullif(avg(o),0)"
_SPREAD = "(stddev_pop(s)/nullif(avg(s),0))/nullif(stddev_pop(o)/nullif(avg(o),0),0)"
_KGE = f"(1-sqrt(power({_CORR}-1,2)+power({_BIAS}-1,2)+power({_SPREAD}-1,2)))"
_LONG = f"""lr as (select obsid, {_KGE} "KGELongTermRun", ({_KGE}-(1-sqrt(2)))/sqrt(2) "KGESkillScore",
    1-sum((s-o)*(s-o))/(var_pop(o)*count(*)+1e-20) "NSELongTermRun"
    from ({v.PAIRS_DAILY}) where o>=0 group by obsid),
  lv as (unpivot lr on "KGELongTermRun", "KGESkillScore", "NSELongTermRun" into name param value val)"""


def _mosaic(values: str, missing: str) -> str:
    return f"""df as (select distinct param, case when param='UpperZone' then 10.0 else -9999.0 end fallback
        from {values})
      select cell, region, df.param, round(case when kn.obsid is null then fallback
        else coalesce(vv.val, {missing}) end, 6) "value"
      from cl cross join df left join kn on kn.obsid=region
      left join {values} vv on vv.obsid=kn.obsid and vv.param=df.param"""


ORACLES = {
    "station_conflicts": f"""with gg as (select distinct l_suppkey obsid,
        case when l_suppkey%9=0 then 77 else l_suppkey*37%1700 end cell from lineitem)
      select obsid, cell, 'off grid' conflict from gg where cell not in (select c_custkey from customer)
      union all select obsid, cell, 'shared cell' from gg
      where cell in (select cell from gg group by cell having count(*)>1)""",
    "outlet_conflicts": """with g as (select s_suppkey obsid, s_suppkey*3 cell from supplier),
        o as (select c_custkey cell, c_custkey%3+c_custkey//3+case when c_custkey%5=0 then 1 else 0 end station
          from customer where c_custkey%3=0 or c_nationkey=7)
      select *, case when found=0 then 'lost' when found>1 then 'found multiple times' else 'wrong id' end conflict
      from (select obsid, cell, (select count(*) from o where station=obsid) found,
        (select min(station) from o where o.cell=g.cell) "instead" from g)
      where found<>1 or "instead"<>obsid""",
    "interstation_regions": f"{_WALK} select * from reg",
    "sampling_frequency": f"""{_WALK} select net.cell, count(h.k) frequency from net
      left join hits h on h.origin=net.cell group by 1""",
    "station_tree": f"{_WALK} select * from tree",
    "direct_links": f"{_WALK} select * from links",
    "links_wide": f"{_WALK} select obsid, cast(inlet_no as int) slot, upstream_id from links",
    "inlet_cells": f"{_WALK}, {_PLACED} select obsid, upstream_id, cell from placed where k>0",
    "inlets_in_masks": f"""{_WALK}, {_PLACED} select obsid, upstream_id, cell, cell%7 x, cell//7 y
      from placed join reg using (cell) where region=obsid""",
    "thinned_stations": f"""{_WALK}, {_THINNED.format(share=1 + MAX_SHARE)}
      select obsid, cast(keep as int) keep from thinned where k>0""",
    "nested_groups": f"{_WALK} select obsid, group_id from grp",
    "group_areas": f"{_WALK} select group_id, cast(sum(upstream_cells) as bigint) area from grp group by 1",
    "worker_allocation": f"""{_WALK}, ar as (select group_id, sum(upstream_cells)::double area from grp group by 1),
      q as (select sum(area)/{WORKERS} quota from ar),
      fold as (select 0::bigint group_id, 1 worker, 0.0::double held
        union all select ar.group_id, case when held>=quota then worker+1 else worker end,
          case when held>=quota then area else held+area end
        from fold join ar on ar.group_id=fold.group_id+1, q)
      select obsid, group_id, cast(worker as bigint) worker from grp join fold using (group_id)""",
    "upstream_inflows": f"""{_WALK} select l.obsid, inlet_no, upstream_id, strftime(ts,'%Y-%m-%d %H:%M') ts,
      round(q,6) q from links l join ({_SIM}) s on s.obsid=l.upstream_id""",
    "upstream_inflows_wide": f"""{_WALK} select l.obsid, strftime(ts,'%Y-%m-%d %H:%M') ts, 'q_'||inlet_no slot,
      round(q,6) q from links l join ({_SIM}) s on s.obsid=l.upstream_id""",
    "missing_upstream": f"{_WALK} select * from links where upstream_id not in (select obsid from ({_SIM}))",
    "inflow_flags": f"""{_WALK} select par.obsid, count(l.inlet_no) n_inflows,
      case when count(l.inlet_no)>0 then '1' else '0' end inflow_flag
      from par left join links l using (obsid) group by 1""",
    "bounding_boxes": f"with {_CELLS}, {_BOXES} select * from bx",
    "clipped_grid": f"""with {_CELLS}, {_BOXES} select obsid, y, count(*) n_box, round(sum(val),6) box_sum,
      count(case when region=obsid then 1 end) n_mask,
      round(sum(case when region=obsid then val end),6) mask_sum
      from cl join bx on x between x0 and x1 and y between y0 and y1 group by 1, 2""",
    "masked_cells": f"with {_CELLS} select cell, round(val,6) \"value\" from cl where region<>-1",
    "station_outlets": f"""{_WALK} select cell obsid, cell, cell%7 x, cell//7 y from reg
      where region=cell""",
    "parameter_mosaic": f"with {_CELLS}, {_RANKED}, {_KNOWN}, {_mosaic('vals', 'fallback')}",
    "parameter_mosaic_flagged": f"""with {_CELLS}, {_RANKED}, {_KNOWN}, {_LONG},
      al as (select * from vals union all select obsid, param, val from lv), {_mosaic('al', '-1.0')}""",
    "overridden_values": f"""with {_RANKED}, fx as (select n_nationkey::bigint obsid,
        case when n_regionkey=0 then 'UpperZone' else 'sae' end param, n_regionkey*0.2::double v from nation)
      select vals.obsid, vals.param, round(coalesce(fx.v, val),6) "value" from vals
      left join fx on fx.obsid=vals.obsid and fx.param=vals.param""",
    "calibration_counts": f"""with {_KNOWN}, hh as (select distinct obsid from ({v.HISTORY}))
      select count(hh.obsid) calibrated, count(*)-count(hh.obsid) uncalibrated
      from kn left join hh using (obsid)""",
}

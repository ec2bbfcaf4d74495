"""Queries: text formats, job logs and the diagnostic table."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeflow.operators import diagnostics, inflows, logs, metrics, network
from gaugeflow.plans import topology
from gaugeflow.plans import views as v
from gaugeflow.plans.views import day, rounded
from gaugeflow.session import settle
from gaugeflow.sources import jobs, series, tables

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _series_lines(spark, sf_dir):
    """Two-gauge series text of every nation: headers, then step, key and balance per customer."""
    key = F.col("c_custkey")
    body = v.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/cal/"), F.col("c_nationkey").cast("string"), F.lit("/out/7/dis.tss")).alias("file"),
        F.concat(F.lit("   "), (key + 1).cast("string"), F.lit("\t "), key.cast("string"), F.lit("  "),
                 F.when(key % 6 == 0, F.lit("1e31")).otherwise(F.col("c_acctbal").cast("string")))
        .alias("value"))
    heads = body.select("file").distinct().select("file", F.explode(F.array(
        F.lit("timeseries scalar"), F.lit("3"), F.lit("timestep"), F.lit("11"), F.lit("12"))).alias("value"))
    return heads.unionByName(body)


def parsed_series(spark, sf_dir):
    parsed = series.parse_series(_series_lines(spark, sf_dir)).select(
        series.file_obsid(F.col("file")).alias("obsid"), series.file_run_id(F.col("file")).alias("run_id"),
        "step", "gauge", "q")
    return rounded(parsed, "obsid", "run_id", "step", "gauge")


def parsed_last_gauge(spark, sf_dir):
    parsed = series.parse_last_gauge(_series_lines(spark, sf_dir))
    return rounded(parsed, "file", "step")


def parsed_wide_table(spark, sf_dir):
    """Wide observation text, a column per station, turned into the long table."""
    wide = v.table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("Timestamp")).pivot(
        "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]).agg(
        F.max("o_totalprice").cast("string"))
    named = wide.toDF("Timestamp", "1", "2", "3", "4", "5")
    return rounded(series.parse_wide(named, "Timestamp", ["1", "2", "3", "4", "5"]).select("obsid", day(), "q"),
                   "obsid", "ts")


def stamped_series(spark, sf_dir):
    """Simulated series as CSV rows: formatted time and value."""
    table = series.stamped_csv(v.series_6h(spark, sf_dir).select("obsid", "ts", F.col("s").alias("q")))
    return rounded(table, "obsid", "Timestamp")


def parsed_links(spark, sf_dir):
    """Wide link text with blanks, turned into numbered links."""
    key = F.col("c_custkey")
    wide = v.table(spark, sf_dir, "customer").select(
        key.cast("string").alias("ID"),
        F.when(key % 2 == 0, (key + 1).cast("string")).otherwise("").alias("u1"),
        F.when(key % 3 == 0, (key + 2).cast("string")).alias("u2"),
        F.when(key % 5 == 0, F.concat((key + 3).cast("string"), F.lit(".0"))).otherwise(" ").alias("u3"))
    return tables.parse_links(wide, ["u1", "u2", "u3"])


def station_key_values(spark, sf_dir):
    """Transposed station files of all suppliers, read back as one wide table."""
    wide = v.table(spark, sf_dir, "supplier")
    lines = wide.select(
        F.concat(F.lit("/cal/"), F.col("s_suppkey").cast("string"), F.lit("/station/station_data.csv")).alias("file"),
        F.inline(F.array(
            F.struct(F.lit(None).cast("string").alias("key"), F.col("s_suppkey").cast("string").alias("value")),
            F.struct(F.lit("StationName").alias("key"), F.col("s_name").alias("value")),
            F.struct(F.lit("CatchmentArea").alias("key"), F.col("s_acctbal").cast("string").alias("value")))))
    records = tables.parse_station_records(lines)
    return tables.records_wide(records, ["StationName", "CatchmentArea"]).select(
        "obsid", "StationName", F.round(F.col("CatchmentArea").cast("double"), 6).alias("CatchmentArea"))


def inflow_text(spark, sf_dir):
    """Lines of the combined inflow file of every station."""
    links = settle(network.direct_links(topology._parents(spark, sf_dir)[1]))
    steps = v.table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 100 * 11).alias("obsid"),
                                                   F.dayofyear("o_orderdate").alias("step")).agg(
        F.count(F.lit(1)).cast("double").alias("q"))
    return series.inflow_text(inflows.gather_inflows(links, steps))


# --- logs ---------------------------------------------------------------------------------

def _log_files(spark, sf_dir):
    """An error and an output log per order."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    text = {"key": key.cast("string"), "cust": cust.cast("string")}
    job = F.when(F.length(text["key"]) >= 6, text["key"]).otherwise(F.lpad(text["key"], 6, "0"))
    base = F.concat(F.lit("/logs/cal_01_"), text["cust"])
    gen = (key % 12).cast("string")
    real = F.concat(F.lit("\nreal\t"), (key % 60).cast("string"), F.lit("m"), (cust % 60).cast("string"),
                    F.lit(".123s\nuser\t0m1.0s\n"))
    err = F.when(key % 4 == 0, F.concat(real, real)).when(key % 4 == 1, real).otherwise(F.lit("no time\n"))
    max_line, stall_line = (F.lit(line + "\n") for line in (logs.LAST_GENERATION, logs.NO_IMPROVEMENT))
    stops = (F.when(key % 3 == 0, F.concat(max_line, stall_line)).when(key % 3 == 1, max_line)
             .otherwise(stall_line))
    shown = F.when(key % 7 == 0, F.lit("99")).otherwise(gen)
    out = F.concat(
        F.when(key % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit("DrainingArea.km2.LDD          "), F.col("o_totalprice").cast("string"), F.lit("\n"))),
        F.lit("Found "), (key % 9).cast("string"), F.lit(" inflows\nStarting calibration\nGeneration "),
        (key % 3).cast("string"), F.lit(", run 1 done. KGE: 0.1\n"),
        F.when(key % 8 == 0, F.lit("killed\n")).otherwise(F.concat(
            F.lit(">> gen: "), shown, F.lit(", effmax_KGE: 0."), text["cust"], F.lit("\n"), stops,
            F.lit("Done generation "), gen, F.lit("\n>> Time elapsed: "), cust.cast("string"), F.lit(".50 s\n"))))
    orders = v.table(spark, sf_dir, "orders")
    return orders.select(F.inline(F.array(
        F.struct(F.concat(base, F.lit(".e"), job).alias("file"), err.alias("text")),
        F.struct(F.concat(base, F.lit(".o"), job).alias("file"), out.alias("text")))))


def job_table(spark, sf_dir):
    table = logs.job_table(jobs.pair_logs(_log_files(spark, sf_dir)))
    return table.withColumn("elapsed_sec", F.round("elapsed_sec", 6))


def folder_sizes(spark, sf_dir):
    """Size in KB per customer and folder of listed files (one per order line)."""
    items = v.table(spark, sf_dir, "lineitem")
    files = items.select(
        F.col("l_suppkey").cast("string").alias("catchment"),
        F.when(F.col("l_linenumber") < 3, "out").when(F.col("l_linenumber") < 5, "settings")
        .when(F.col("l_linenumber") < 7, "maps").otherwise("inflow").alias("folder"),
        F.floor("l_extendedprice").alias("length"))
    return logs.folder_sizes(files, ["out", "settings", "maps", "inflow"])


# --- diagnostics --------------------------------------------------------------------------

def diagnostic_table(spark, sf_dir):
    pairs = v.series_6h(spark, sf_dir)
    before = v.ts_of("ts") - F.expr("INTERVAL 1 MICROSECOND")
    label = F.date_trunc("hour", before) + F.make_dt_interval(hours=6 - F.hour(before) % 6)
    states = v.table(spark, sf_dir, "events").groupBy(
        (F.col("user_id") % 50).alias("obsid"), label.alias("ts"), F.col("event_type").alias("variable")).agg(
        F.max("value").alias("value"))
    records = pairs.groupBy("obsid").agg((F.min("ts") + F.expr("INTERVAL 10 DAYS")).alias("Split_date"))
    scores = metrics.objectives(pairs, ["obsid"]).filter("obsid % 7 <> 3")  # some stations were never calibrated
    table = diagnostics.diagnostic_table(pairs.select("obsid", "ts", "s"), pairs.select("obsid", "ts", "o"),
                                         states, settle(records), settle(scores), EVENT_TYPES)
    return rounded(table.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm")), "obsid", "ts", "period")


QUERIES = {f.__name__: f for f in (
    parsed_series, parsed_last_gauge, parsed_wide_table, stamped_series, parsed_links, station_key_values,
    inflow_text, job_table, folder_sizes, diagnostic_table)}


# --- reference SQL ------------------------------------------------------------------------

_CORR = "covar_pop(o,s)/nullif(stddev_pop(o)*stddev_pop(s),0)"
_BIAS = "avg(s)/nullif(avg(o),0)"
_SPREAD = "(stddev_pop(s)/nullif(avg(s),0))/nullif(stddev_pop(o)/nullif(avg(o),0),0)"
_KGE = f"(1-sqrt(power({_CORR}-1,2)+power({_BIAS}-1,2)+power({_SPREAD}-1,2)))"
_STEPS = """stp as (select o_custkey%100*11 obsid, dayofyear(o_orderdate) step, count(*) q from orders group by 1, 2),
  inf as (select l.obsid, l.inlet_no, l.upstream_id, step, q from links l join stp on stp.obsid=l.upstream_id),
  ids as (select distinct obsid, inlet_no, upstream_id from inf),
  cnt as (select obsid, count(*)+1 c from ids group by 1)"""

ORACLES = {
    "parsed_series": """select c_nationkey::bigint obsid, '7' run_id, cast(c_custkey+1 as int) step, gauge,
      round(case when gauge=1 then c_custkey::double when c_custkey%6<>0 then c_acctbal end, 6) q
      from customer, (values (1),(2)) x(gauge)""",
    "parsed_last_gauge": """select '/cal/'||c_nationkey||'/out/7/dis.tss' file, cast(c_custkey+1 as int) step,
      round(case when c_custkey%6<>0 then c_acctbal end, 6) q from customer""",
    "parsed_wide_table": """with d as (select distinct o_orderdate from orders),
      p as (select * from (values ('1-URGENT',1),('2-HIGH',2),('3-MEDIUM',3),('4-NOT SPECIFIED',4),('5-LOW',5)) x(p,k))
      select k::bigint obsid, strftime(d.o_orderdate,'%Y-%m-%d %H:%M') ts, round(max(o_totalprice),6) q
      from d cross join p left join orders o on o.o_orderdate=d.o_orderdate and o.o_orderpriority=p.p
      group by 1, 2""",
    "stamped_series": f"""select obsid, strftime(ts,'%d/%m/%Y %H:%M') "Timestamp", round(s,6) q
      from ({v.SERIES_6H})""",
    "parsed_links": """with w as (select c_custkey obsid, unnest([1,2,3]) slot,
        unnest([case when c_custkey%2=0 then c_custkey+1 end, case when c_custkey%3=0 then c_custkey+2 end,
                case when c_custkey%5=0 then c_custkey+3 end]) upstream_id from customer)
      select obsid, row_number() over (partition by obsid order by slot) inlet_no, upstream_id
      from w where upstream_id is not null""",
    "station_key_values": """select s_suppkey obsid, s_name "StationName", round(s_acctbal,6) "CatchmentArea"
      from supplier""",
    "inflow_text": f"""{topology._WALK}, {_STEPS}
      select obsid, 1::bigint line_no, 'timeseries scalar' "value" from cnt
      union all select obsid, 2, c::varchar from cnt union all select obsid, 3, 'timestep' from cnt
      union all select obsid, inlet_no+3, upstream_id::varchar from ids
      union all select inf.obsid, step+2+max(c), step::varchar||' '||
        string_agg(q::varchar||'.0', ' ' order by inlet_no) from inf join cnt using (obsid) group by inf.obsid, step""",
    "job_table": f"""select o_custkey catchment, lpad(o_orderkey::varchar,greatest(6,length(o_orderkey::varchar))::int,'0') job,
      case when o_orderkey%4 in (0,1) then o_orderkey%60*60+o_custkey%60 end calib_sec,
      case when o_orderkey%4=0 then o_orderkey%60*60+o_custkey%60 end longrun_sec,
      case when o_orderkey%5<>0 then o_totalprice::varchar end draining_area,
      o_orderkey%9 inflows,
      case when o_orderkey%8<>0 then o_orderkey%3 end first_gen,
      case when o_orderkey%8<>0 then round(o_custkey+0.5,6)::double end elapsed_sec,
      case when o_orderkey%8<>0 then o_orderkey%12 end last_gen,
      case when o_orderkey%8=0 then null when o_orderkey%3=0 then 'maxGen AND no-improvement'
        when o_orderkey%3=1 then 'maxGen' else 'no-improvement' end termination,
      case when o_orderkey%8=0 then null when o_orderkey%7=0 then 'error'
        else '0.'||o_custkey end kge from orders""",
    "folder_sizes": """with f as (select l_suppkey::varchar catchment, case when l_linenumber<3 then 'out'
        when l_linenumber<5 then 'settings' when l_linenumber<7 then 'maps' else 'inflow' end folder,
        floor(l_extendedprice) len from lineitem),
      k as (select catchment, folder, cast(ceil(sum(len)/1024) as bigint) kb from f group by 1, 2)
      select catchment, max(case when folder='out' then kb end) out_kb,
        max(case when folder='settings' then kb end) settings_kb,
        max(case when folder='maps' then kb end) maps_kb, max(case when folder='inflow' then kb end) inflow_kb
      from k group by 1""",
    "diagnostic_table": f"""with p as ({v.SERIES_6H}),
      e as (select user_id%50 obsid, date_trunc('hour', ts - interval 1 microsecond)
          + cast((6 - hour(ts - interval 1 microsecond)%6) as int) * interval 1 hour ts,
        {', '.join(f"max(case when event_type='{t}' then value end) {t}" for t in EVENT_TYPES)}
        from events group by 1, 2),
      sc as (select obsid, greatest(coalesce({_KGE},-100.0),-100.0) kge, {_CORR} corr, {_BIAS} bias, {_SPREAD} spread
        from p where s is not null and o is not null and obsid%7<>3 group by 1),
      sp as (select obsid, min(ts)+interval 10 day d from p group by 1)
      select p.obsid, strftime(p.ts,'%Y-%m-%d %H:%M') ts, round(s,6) s, round(o,6) o,
        {', '.join(f"round({t},6) {t}" for t in EVENT_TYPES)}, round(kge,6) kge, round(corr,6) corr,
        round(bias,6) bias, round(spread,6) spread,
        case when p.ts>=d then 'calibration' else 'other' end period
      from p join e on e.obsid=p.obsid and e.ts=p.ts left join sc on sc.obsid=p.obsid join sp on sp.obsid=p.obsid""",
}

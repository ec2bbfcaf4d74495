"""Queries: tables that are written as files on shared storage and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.operators import alignment, inflows, metrics, selection
from gaugeflow.operators import history as h
from gaugeflow.operators import network
from gaugeflow.plans import runs, station_choice, texts, topology, verification
from gaugeflow.plans import views as v
from gaugeflow.plans.views import FORCING, day, rounded
from gaugeflow.session import checkpoint_dir, settle
from gaugeflow.sources import grids, series, tables

RUN = ["obsid", "gen", "run"]
PARAMS = ["UpperZone", "LowerZone"]
SCORES = ["kge", "corr", "bias", "spread", "sae"]
LAST_GEN = 9  # generations of the history view: 0 to 9


def _folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def _csv(df: DataFrame, path: str, *by: str) -> None:
    df.write.option("header", True).partitionBy(*by).csv(path)


# --- readers ------------------------------------------------------------------------------

def station_file(spark, sf_dir):
    """Station metadata as CSV with dashes and blanks for what is not given."""
    path, stations = _folder(spark), v.stations(spark, sf_dir)
    _csv(stations.select(
        F.col("obsid").alias("ObsID"), "StationName", "EC_calib", F.coalesce(F.col("area").cast("string"), F.lit("-")).alias("DrainingArea.km2.LDD"),
        F.when(F.col("obsid") % 4 != 0, F.col("Min_calib_days").cast("string")).otherwise(" ").alias("Min_calib_days"),
        F.col("x").alias("GridX"), F.col("y").alias("GridY")), path)
    read = tables.read_stations(spark, path, coordinates=("GridX", "GridY"))
    return rounded(read.withColumnRenamed("DrainingArea.km2.LDD", "area"), "obsid", "StationName", "EC_calib")


def best_run_table(spark, sf_dir):
    """The series of best runs as a wide CSV, a column per station, read as a long table."""
    path = _folder(spark)
    wide = v.table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("Timestamp")).pivot(
        "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]).agg(F.max("o_totalprice"))
    _csv(wide.toDF("Timestamp", "1", "2", "3", "4", "5"), path)
    return rounded(series.read_wide(spark, path).select("obsid", day(), "q"), "obsid", "ts")


def param_ranges_file(spark, sf_dir):
    """Parameter ranges, one per nation, in the order of the file."""
    path, key = _folder(spark), F.col("n_nationkey")
    nations = v.table(spark, sf_dir, "nation").orderBy(F.desc("n_name")).coalesce(1)
    _csv(nations.select(F.col("n_name").alias("ParameterName"), (key * 0.5).alias("MinValue"), (key * 2.0 + 1).alias("MaxValue"),
                        (key * 1.25).alias("DefaultValue")), path)
    return rounded(tables.read_param_ranges(spark, path), "idx", "name")


def links_files(spark, sf_dir):
    """Link tables of two and of three slots, read together."""
    folder, key = _folder(spark), F.col("c_custkey")
    slots = [F.when(key % 2 == 0, (key + 1).cast("string")).otherwise("").alias("u1"),
             F.when(key % 3 == 0, F.concat((key + 2).cast("string"), F.lit(".0"))).alias("u2"),
             F.when(key % 5 == 0, (key + 3).cast("string")).otherwise(" ").alias("u3")]
    rows = v.table(spark, sf_dir, "customer")
    paths = [f"{folder}/narrow", f"{folder}/wide"]
    _csv(rows.filter(key % 4 == 0).select(key.alias("ID"), *slots[:2]), paths[0])
    _csv(rows.filter(key % 4 != 0).select(key.alias("ID"), *slots), paths[1])
    return tables.read_links(spark, paths)


def _history(spark, sf_dir) -> DataFrame:
    return v.history(spark, sf_dir).withColumn("rand_id", F.lpad(F.col("run").cast("string"), 12, "0")).withColumn(
        "params", F.array("bias", "spread"))


def _write_history(runs_: DataFrame, path: str) -> None:
    """The text format: a folder per station, pseudo runs among the others."""
    names = {c: n for n, c in tables.OBJECTIVE_COLUMNS.items()}
    lines = runs_.select("obsid", F.col("rand_id").alias("randId"), *[F.col("params")[i].alias(p) for i, p in enumerate(PARAMS)],
                         *[F.col(c).cast("double").alias(names[c]) for c in SCORES], F.col("gen").alias("generation"), F.col("run").alias("runNumber"))
    pseudo = runs_.select("obsid").distinct().select("obsid", F.explode(F.array(*map(F.lit, h.PSEUDO_RUNS))).alias("randId"))
    _csv(lines.unionByName(pseudo, allowMissingColumns=True), path, "obsid")


def run_history_files(spark, sf_dir):
    path = _folder(spark)
    _write_history(_history(spark, sf_dir), path)
    read = tables.read_history(spark, path, PARAMS, recursive=True, pattern="*.csv")
    return rounded(read.select(*RUN, "rand_id", *[F.col("params")[i].alias(p) for i, p in enumerate(PARAMS)], *SCORES), *RUN, "rand_id")


def scenario_files(spark, sf_dir):
    """Histories found below two roots, one of which lies inside the other."""
    root, runs_ = _folder(spark), _history(spark, sf_dir)
    _write_history(runs_, f"{root}/stations")
    _write_history(runs_.filter("obsid % 3 = 0").withColumn("kge", F.col("kge") - 1), f"{root}/zero_loss/stations")
    found = tables.read_scenarios(spark, {"with_loss": root, "zero_loss": f"{root}/zero_loss"}, PARAMS, "*.csv")
    return rounded(found.select("scenario", *RUN, "kge"), "scenario", *RUN)


def _best(spark, sf_dir) -> DataFrame:
    return h.best_parameters(h.rank_runs(_history(spark, sf_dir), ["obsid"]), ["obsid"], PARAMS)


def best_parameter_files(spark, sf_dir):
    """Best parameter sets written with six digits per station, and read by their column positions."""
    path = _folder(spark)
    tables.write_exports(tables.best_export(_best(spark, sf_dir)).select("obsid", F.lit(0).alias("_row"), "effover", "R", *[
        f"param_{i:02d}_{n}" for i, n in enumerate(PARAMS)]), path)
    read = tables.read_best_parameters(spark, path, PARAMS)
    return read.select("obsid", F.posexplode("params").alias("idx", "value"))


# --- writers ------------------------------------------------------------------------------

def stored_stations(spark, sf_dir):
    """Accepted and rejected stations from their two folders."""
    path = _folder(spark)
    screened = selection.screen_stations(v.stations(spark, sf_dir), v.observations(spark, sf_dir), FORCING, station_choice.MIN_TYPE)
    tables.write_stations(screened.select("obsid", "n_data", "is_valid"), path)
    return spark.read.parquet(path).select("obsid", "n_data", F.col("is_valid").cast("boolean").cast("int").alias("is_valid"))


def stored_observations(spark, sf_dir):
    """Trimmed records by parts of the stations; every second part is written again."""
    path, part = _folder(spark), F.pmod(F.col("obsid"), F.lit(8))
    trimmed = selection.trim_to_valid(v.observations(spark, sf_dir)).withColumn("part", part)
    tables.write_table(trimmed.withColumn("q", F.when(F.col("part") % 2 == 0, -F.col("q")).otherwise(F.col("q"))), path, ["part"])
    tables.write_table(trimmed.filter("part % 2 = 0"), path, ["part"])
    return rounded(spark.read.parquet(path).select("obsid", day(), "q"), "obsid", "ts")


def stored_records(spark, sf_dir):
    """Station rows enriched with their observation period."""
    path = _folder(spark)
    tables.write_table(station_choice._records(spark, sf_dir), path)
    return spark.read.parquet(path).select("obsid", "StationName", "N_data", day("Obs_start"), day("Obs_end"), day("Split_date"))


def _stored_runs(spark, sf_dir) -> DataFrame:
    """A history in two appends that share a generation, and one append that broke off before its commit."""
    path, runs_ = _folder(spark), settle(_history(spark, sf_dir))
    tables.append_runs(runs_.filter("gen < 5"), path)
    tables.append_runs(runs_.filter("gen >= 4"), path, list(range(4, LAST_GEN + 1)))
    tables.write_table(runs_.filter("gen = 0").withColumn("gen", F.lit(LAST_GEN + 1).cast("long")), path, ["gen"])
    return tables.read_runs(spark, path)


def stored_runs(spark, sf_dir):
    return rounded(_stored_runs(spark, sf_dir).select(*RUN, *SCORES), *RUN)


def stored_runs_log(spark, sf_dir):
    return rounded(tables.runs_log(_stored_runs(spark, sf_dir)), "run_id")


def ranked_export_files(spark, sf_dir):
    """The ranked history as text with six significant digits, a folder per station."""
    path = _folder(spark)
    tables.write_exports(tables.ranked_export(h.rank_runs(_history(spark, sf_dir), ["obsid"]), PARAMS), path)
    read = spark.read.option("header", True).csv(path)
    return read.withColumns({c: F.col(c).cast("long") for c in ("obsid", "generation", "runNumber")})


def stored_statistics(spark, sf_dir):
    path = _folder(spark)
    tables.write_table(metrics.statistics(verification._pairs_with_gaps(spark, sf_dir), ["obsid"]), path)
    return rounded(spark.read.parquet(path), "obsid")


# --- grids --------------------------------------------------------------------------------

def _variables(spark, sf_dir) -> DataFrame:
    """A static variable of parts and two daily ones of their shipments, the part being the cell."""
    part, lines = v.table(spark, sf_dir, "part"), v.table(spark, sf_dir, "lineitem")

    def place(key: str):
        return (F.col(key) % 50).alias("x"), F.floor(F.col(key) / 50).alias("y")

    ts = F.col("l_shipdate").cast("timestamp").alias("ts")
    daily = [lines.select(F.lit(name).alias("var"), *place("l_partkey"), ts, F.col(c).cast("double").alias("value"))
             for name, c in (("rain", "l_quantity"), ("heat", "l_extendedprice"))]
    static = part.select(F.lit("elev").alias("var"), *place("p_partkey"), F.lit(None).cast("timestamp").alias("ts"),
                         F.col("p_retailprice").cast("double").alias("value"))
    return static.unionByName(daily[0]).unionByName(daily[1])


def clipped_variables(spark, sf_dir):
    """Every variable of a grid folder in the box of every station, by year; the folder holds a backup too."""
    path, key = _folder(spark), F.col("s_suppkey")
    grid = _variables(spark, sf_dir)
    grids.write_grid(grid, path)
    grids.write_grid(grid.filter("var = 'rain'").withColumn("var", F.lit("rain_bak")), path)
    x, y = key % 40, F.floor(key / 3)
    boxes = v.table(spark, sf_dir, "supplier").select(
        key.alias("obsid"), x.alias("x0"), (x + key % 12).alias("x1"), y.alias("y0"), (y + key % 9).alias("y1"))
    clipped = grids.clip_grids(spark, path, settle(boxes))
    return rounded(clipped.groupBy("obsid", "var", F.year("ts").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("x", "y").alias("n_cells"), F.sum(F.floor("value")).alias("total"),
        F.min("value").alias("low"), F.max("value").alias("high")), "obsid", "var", "year", "n", "n_cells", "total")


# --- completeness -------------------------------------------------------------------------

def _ends(spark, sf_dir) -> DataFrame:
    """Last expected day: that of the series, a day later for some stations, and stations without any series."""
    last = v.pairs_daily(spark, sf_dir).groupBy("obsid").agg(F.max("ts").alias("end"))
    late = F.when(F.col("obsid") % 7 == 0, F.col("end") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("end"))
    absent = last.filter("obsid % 5 = 0").withColumn("obsid", F.col("obsid") + 1_000_000)
    return last.withColumn("end", late).unionByName(absent)


def incomplete_series(spark, sf_dir):
    """Expected series that are absent or do not stop at their end."""
    found = alignment.end_violations(v.pairs_daily(spark, sf_dir), settle(_ends(spark, sf_dir)))
    return found.select("obsid", day("expected_last"), day("last_ts"))


def complete_series(spark, sf_dir):
    """Days of the series that are as long as expected."""
    whole, _ = series.complete(v.pairs_daily(spark, sf_dir), settle(_ends(spark, sf_dir)), ["obsid"])
    return whole.groupBy("obsid").agg(F.count(F.lit(1)).alias("n_days"))


def incomplete_inflows(spark, sf_dir):
    """Links whose upstream series is absent or does not reach the end of the forcing."""
    links = settle(network.direct_links(topology._parents(spark, sf_dir)[1]))
    found = inflows.incomplete_inflows(links, topology._simulated(spark, sf_dir), FORCING.end)
    return found.select("obsid", "inlet_no", "upstream_id", day("last_ts"))


QUERIES = {f.__name__: f for f in (
    station_file, best_run_table, param_ranges_file, links_files, run_history_files, scenario_files, best_parameter_files,
    stored_stations, stored_observations, stored_records, stored_runs, stored_runs_log, ranked_export_files, stored_statistics,
    clipped_variables, incomplete_series, complete_series, incomplete_inflows)}


# --- reference SQL ------------------------------------------------------------------------

def _scores(digits: int = 6) -> str:
    return ", ".join(f"round({c},{digits}) {c}" for c in SCORES)


_ENDS = f"""d as ({v.PAIRS_DAILY}), l as (select obsid, max(ts) last_ts, count(*) n_days from d group by 1),
  e as (select obsid, case when obsid%7=0 then last_ts + interval 1 day else last_ts end expected_last from l
    union all select obsid+1000000, last_ts from l where obsid%5=0)"""


def _stamp(column: str, name: str = "") -> str:
    return f"strftime({column},'%Y-%m-%d %H:%M') {name or column}"


ORACLES = {
    "station_file": f"""select obsid, "StationName", "EC_calib", round(area,6) area,
      case when obsid%4<>0 then "Min_calib_days" end "Min_calib_days", x, y
      from (select * replace (nullif("EC_calib",'-') as "EC_calib") from ({v.STATIONS}))""",
    "best_run_table": texts.ORACLES["parsed_wide_table"],
    "param_ranges_file": """select cast(row_number() over (order by n_name desc)-1 as int) idx, n_name as name,
      n_nationkey*0.5::double as min, n_nationkey*2.0::double+1 as max, n_nationkey*1.25::double as "default" from nation""",
    "links_files": """with w as (select c_custkey obsid, unnest([1,2,3]) slot, unnest([case when c_custkey%2=0 then c_custkey+1 end,
        case when c_custkey%3=0 then c_custkey+2 end, case when c_custkey%5=0 and c_custkey%4<>0 then c_custkey+3 end]) upstream_id from customer)
      select obsid, row_number() over (partition by obsid order by slot) inlet_no, upstream_id from w where upstream_id is not null""",
    "run_history_files": f"""select obsid, gen, run, lpad(run::varchar,12,'0') rand_id, round(bias,6) "UpperZone", round(spread,6) "LowerZone",
      {_scores()} from ({v.HISTORY})""",
    "scenario_files": f"""with hh as ({v.HISTORY}) select 'with_loss' scenario, obsid, gen, run, round(kge,6) kge from hh
      union all select 'zero_loss', obsid, gen, run, round(kge-1,6) from hh where obsid%3=0""",
    "best_parameter_files": f"""with {runs._ranked(2, 0.1)}, f as (select *, row_number() over
      (partition by obsid order by "paretoRank", gen, run) k from p)
      select obsid, cast(unnest([0,1]) as int) idx, unnest([printf('%g',bias)::double, printf('%g',spread)::double]) "value" from f where k=1""",
    "stored_stations": station_choice.ORACLES["screened_stations"],
    "stored_observations": station_choice.ORACLES["trimmed_observations"],
    "stored_records": station_choice.ORACLES["station_records"],
    "stored_runs": f"select obsid, gen, run, {_scores()} from ({v.HISTORY})",
    "stored_runs_log": f"select lpad(run::varchar,12,'0') run_id, round(kge,6) kge from ({v.HISTORY})",
    "ranked_export_files": f"""with {runs._ranked(2, 0.1)} select obsid, lpad(run::varchar,12,'0') "randId", gen generation, run "runNumber",
      {", ".join(f"printf('%g',{c}::double) " + chr(34) + n + chr(34) for c, n in
                 [("bias", PARAMS[0]), ("spread", PARAMS[1]), *[(c, n) for n, c in tables.OBJECTIVE_COLUMNS.items()],
                  *[(chr(34) + r + chr(34), r) for r in ("corrRank", "saeRank", "KGERank", "paretoRank")]])} from p""",
    "stored_statistics": verification.ORACLES["statistics_by_station"],
    "clipped_variables": """with c as (select 'elev' var, p_partkey k, null::timestamp ts, p_retailprice::double val from part
        union all select 'rain', l_partkey, l_shipdate::timestamp, l_quantity::double from lineitem
        union all select 'heat', l_partkey, l_shipdate::timestamp, l_extendedprice::double from lineitem),
      b as (select s_suppkey obsid, s_suppkey%40 x0, s_suppkey%40 + s_suppkey%12 x1, s_suppkey//3 y0, s_suppkey//3 + s_suppkey%9 y1 from supplier)
      select obsid, var, cast(year(ts) as int) "year", count(*) n, count(distinct k) n_cells, cast(sum(floor(val)) as bigint) total,
        round(min(val),6) low, round(max(val),6) high
      from c join b on k%50 between x0 and x1 and k//50 between y0 and y1 group by 1, 2, 3""",
    "incomplete_series": f"""with {_ENDS} select obsid, {_stamp('expected_last')}, {_stamp('last_ts')} from e left join l using (obsid)
      where last_ts is distinct from expected_last""",
    "complete_series": f"with {_ENDS} select obsid, n_days from e join l using (obsid) where last_ts=expected_last",
    "incomplete_inflows": f"""{topology._WALK}, s as (select obsid upstream_id, max(ts) last_ts from ({topology._SIM}) group by 1)
      select obsid, inlet_no, upstream_id, {_stamp('last_ts')} from links left join s using (upstream_id)
      where last_ts is distinct from timestamp '{FORCING.end}'""",
}

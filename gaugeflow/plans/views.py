"""Hydrological tables derived from the star-schema tables, for Spark and as SQL.

Each view is written twice: as a DataFrame and as the SQL text the checks run.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.values import add_days
from gaugeflow.operators.selection import Forcing

FORCING = Forcing(datetime(1995, 1, 2), datetime(2001, 6, 30))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ts_of(name: str):
    return F.col(name).cast("timestamp")


def rounded(df: DataFrame, *keys: str, digits: int = 6) -> DataFrame:
    """Key columns as they are, every other column rounded for the comparison."""
    return df.select(*keys, *[F.round(F.col(f"`{c}`").cast("double"), digits).alias(c)
                              for c in df.columns if c not in keys])


def day(name: str = "ts"):
    return F.date_format(name, "yyyy-MM-dd HH:mm").alias(name)


# --- series -------------------------------------------------------------------------------

def pairs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").alias("obsid"), ts_of("l_shipdate").alias("ts"))
            .agg(F.sum("l_quantity").alias("o"), (F.sum("l_extendedprice") / 2000).alias("s")))


PAIRS_DAILY = """select l_suppkey obsid, l_shipdate ts, sum(l_quantity) o, sum(l_extendedprice)/2000 s
  from lineitem group by 1, 2"""


def pairs_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").alias("obsid"), F.col("l_linenumber").alias("run"),
                     ts_of("l_shipdate").alias("ts"))
            .agg(F.sum("l_quantity").alias("o"), (F.sum("l_extendedprice") / 2000).alias("s")))


PAIRS_BY_RUN = """select l_suppkey obsid, l_linenumber run, l_shipdate ts, sum(l_quantity) o,
  sum(l_extendedprice)/2000 s from lineitem group by 1, 2, 3"""


def series_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = ts_of("ts") - F.expr("INTERVAL 1 MICROSECOND")
    label = F.date_trunc("hour", before) + F.make_dt_interval(hours=6 - F.hour(before) % 6)
    return (table(spark, sf_dir, "events")
            .groupBy((F.col("user_id") % 50).alias("obsid"), label.alias("ts"))
            .agg(F.avg(F.when(F.col("event_type") != "error", F.col("value"))).alias("o"),
                 F.avg("value").alias("s")))


SERIES_6H = """select user_id%50 obsid,
  date_trunc('hour', ts - interval 1 microsecond)
    + cast((6 - hour(ts - interval 1 microsecond)%6) as int) * interval 1 hour ts,
  avg(case when event_type<>'error' then value end) o, avg(value) s
  from events group by 1, 2"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations with gaps: every ninth day of a month is missing."""
    daily = pairs_daily(spark, sf_dir)
    return daily.select("obsid", "ts", F.when(F.dayofmonth("ts") % 9 != 0, F.col("o")).alias("q"))


OBSERVATIONS = f"""select obsid, ts, case when day(ts)%9<>0 then o end q from ({PAIRS_DAILY})"""


# --- stations -----------------------------------------------------------------------------

def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("obsid"),
        F.col("s_name").alias("StationName"),
        F.when(key % 3 == 0, "NRT_6h").otherwise("HIST_24h").alias("CAL_TYPE"),
        F.when(key % 10 == 0, "T").when(key % 10 == 1, "-")
        .otherwise((key % 4).cast("string")).alias("EC_calib"),
        (30 + key % 40).cast("int").alias("Spinup_days"),
        (110 + key % 5 * 90).cast("double").alias("Min_calib_days"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("area"),
        (4000000 + key * 500).cast("double").alias("x"),
        (2000000 + key * 250).cast("double").alias("y"),
        add_days(F.lit(datetime(1994, 1, 1)), key % 365).alias("prerun_start"))


STATIONS = """select s_suppkey obsid, s_name StationName,
  case when s_suppkey%3=0 then 'NRT_6h' else 'HIST_24h' end CAL_TYPE,
  case when s_suppkey%10=0 then 'T' when s_suppkey%10=1 then '-'
       else cast(s_suppkey%4 as varchar) end EC_calib,
  cast(30 + s_suppkey%40 as int) Spinup_days, cast(110 + s_suppkey%5*90 as double) Min_calib_days,
  case when s_acctbal>0 then s_acctbal end area,
  cast(4000000 + s_suppkey*500 as double) x,
  cast(2000000 + s_suppkey*250 as double) y,
  timestamp '1994-01-01' + cast(s_suppkey%365 as int) * interval 1 day prerun_start
  from supplier"""


# --- run histories ------------------------------------------------------------------------

def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    lines = items.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.avg("l_discount").alias("disc"), F.avg("l_tax").alias("tax"), F.sum("l_quantity").alias("sae"))
    return orders.join(lines, "o_orderkey").select(
        (F.col("o_custkey") % 20).alias("obsid"), (F.col("o_orderkey") % 10).alias("gen"),
        F.col("o_orderkey").alias("run"),
        (1 - F.abs(1 - F.col("o_totalprice") / 150000)).alias("kge"),
        F.round(1 - F.col("disc"), 9).alias("corr"), F.round(1 + F.col("tax"), 9).alias("bias"),
        F.round(1 - F.col("tax"), 9).alias("spread"), "sae")


HISTORY = """select o_custkey%20 obsid, o_orderkey%10 gen, o_orderkey run,
  1 - abs(1 - o_totalprice/150000) kge, round(1 - disc, 9) corr, round(1 + tax, 9) bias,
  round(1 - tax, 9) spread, sae
  from orders join (select l_orderkey, avg(l_discount) disc, avg(l_tax) tax, sum(l_quantity) sae
                    from lineitem group by 1) on o_orderkey=l_orderkey"""


# --- network and grid ---------------------------------------------------------------------

def network(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(ldd, gauges): seven basins, stations on every eleventh cell."""
    k = F.floor(F.col("c_custkey") / 7)
    cells = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cell"),
        F.when(k != 0, F.col("c_custkey") % 7 + 7 * F.greatest(k - 1 - (k * k) % 5, F.lit(0)))
        .alias("down"))
    return cells, cells.filter(F.col("cell") % 11 == 0).select("cell", F.col("cell").alias("obsid"))


NETWORK = """select c_custkey as cell,
  case when c_custkey//7=0 then null
       else c_custkey%7 + 7*greatest(c_custkey//7 - 1 - ((c_custkey//7)*(c_custkey//7))%5, 0) end down,
  c_custkey%11=0 is_station from customer"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("cell"), (key % 50).alias("x"), F.floor(key / 50).alias("y"),
        F.col("p_size").cast("long").alias("region"), F.col("p_retailprice").alias("value"))


GRID = """select p_partkey as cell, p_partkey%50 x, p_partkey//50 y, cast(p_size as bigint) region,
  p_retailprice as value from part"""
